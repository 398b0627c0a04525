import hashlib
import itertools
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.rows import documents, edge_rows, prose
from visitlens.llm import personal
from visitlens.llm.common import read

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    def luhn(d):
        doubled = [int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))]
        return sum(doubled) % 10 == 0

    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    spans += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return [(a, personal.BASE_KINDS[k], b) for a, k, b in sorted(spans)]


@given(st.text(alphabet=st.sampled_from("a1.@-_ +é()0259"), max_size=60))
@settings(max_examples=500, deadline=None)
def test_base_spans_equal_the_plain_patterns(text):
    assert personal.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "@" * 100_000, "1" * 100_000 + ".", "1." * 100_000, "+1" + "(" * 100_000):
        personal.base_spans(text)


def test_best_segmentation_equals_brute_force():
    text = "x 1.2.3.4 9 y"
    start, end = next(personal.regions(text))
    limits, segments = personal.lattice(text, start, end)
    weights = {(kind, name): math.sin(hash((len(name), kind == "ip", i))) for i, kind in enumerate(personal.KINDS)
               for name in {f for found in segments.values() for f in found}}
    field = personal.Field(weights)
    size = len(limits) - 1

    def paths(at):
        if at == size:
            yield []
            return
        for rest in paths(at + 1):
            yield [(at, at + 1, personal.OUTSIDE), *rest]
        for (i, j) in segments:
            if i == at:
                for kind, rest in itertools.product(personal.KINDS, paths(j)):
                    yield [(i, j, kind), *rest]

    def score(path):
        return sum(0 if kind == personal.OUTSIDE else field._score(kind, segments[i, j]) for i, j, kind in path)

    best = max(paths(0), key=score)
    assert score([(i, j, k) for i, j, k in best]) == max(map(score, paths(0)))
    spans = [(limits[i], kind, limits[j]) for i, j, kind in best if kind != personal.OUTSIDE]
    assert field.best(text, start, end) == spans
    # Expected counts are probabilities: every token is covered exactly once.
    expected = field._expected(field._edges(segments, len(limits)), len(limits))
    for token in range(size):
        covered = sum(share for key, share in expected.items() if len(key) == 3 and key[0] <= token < key[1])
        assert abs(covered - 1) < 1e-9


def test_redaction_merges_overlaps():
    spans = [(2, "card", 6), (4, "phone", 8), (9, "ip", 10)]
    assert personal.redact("abcdefghijk", spans) == "ab<CARD+PHONE>i<IP>k"


def test_added_spans_and_awkward_rows(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    field = personal.learn(docs)
    found = personal.find("a b@c.de was 12.1.2.3 f +1 (131) 555-7634 190.137.223.204 g 4111111111111111 1", field)
    assert ("phone" in {k for _, k, _ in found[1]}) and set(found[0]) <= set(found[1])
    rows = [*edge_rows(), (50, "call +1 (131) 555-7634 or a.b@c.org, 10.0.0.1"), (51, "token = \"0b96a8c8d79c4a5085c919698889f59b72ab7bb6\" it")]
    got = sorted((tuple(r) for r in personal.search(documents(spark, rows), field).collect()), key=repr)
    for row in got:
        text = dict((i, t) for i, t in rows if i != 8).get(row[0], "another")
        base = plain_spans(text or "")
        assert row[1:5] == tuple(sum(k == kind for _, k, _ in base) for kind in personal.BASE_KINDS)
        assert row[5] == hashlib.sha256(personal.joined(base).encode()).hexdigest()
        assert set(filter(None, personal.joined(base).split(","))) <= set(row[6].split(","))
    assert [r[6].split(":")[0] for r in got if r[0] == 51] == ["secret"]
    clean = personal.redacted(documents(spark, rows), field)
    assert {r["doc_id"]: r["text"] for r in clean.collect()}[50] == "call <PHONE> or <EMAIL>, <IP>"
    assert clean.columns == documents(spark, rows).columns
    assert personal.search(documents(spark, []), field).collect() == []
    assert personal.learn(documents(spark, [])).weights == {}


def test_many_shapes_leave_no_kind_unlearned(spark):
    signs = "!#$%&'()*+,-./:;<=>?[]^_{|}~"
    odd = [f"7{a}8{b}9" for a in signs for b in signs]
    rows = [(i, f"see {' and '.join(odd[i::30])} there") for i in range(30)]
    rows += [(100 + i, f"{prose(i, 9)} call +1 (131) 555-{7000 + i} or a{i}.b@c.org") for i in range(30)]
    rows += [(200 + i, f'{prose(i, 9)} token = "{hashlib.sha1(str(i).encode()).hexdigest()}" it') for i in range(30)]
    docs = documents(spark, rows)
    assert len({personal.shape_of(x)[:12] for x in odd}) > 400
    for field in (personal.learn(docs), personal.learn(docs, most_regions=60)):
        assert {"phone", "email", "secret"} <= {key[0] for key in field.weights}
        text = f'token = "{hashlib.sha1(b"x").hexdigest()}" it'
        assert [kind for _, kind, _ in personal.find(text, field)[1]] == ["secret"]


def test_regions_take_turns_by_kind_and_shape():
    def row(order, kinds, shape):
        return {"order": order, "kinds": kinds, "shape": shape, "text": "", "start": 0}

    rows = [row(i, "", f"9{i}") for i in range(900)] + [row(1000 + i, "phone", f"+{i % 300}") for i in range(900)] + [row(5000, "secret", "a")]
    picked = personal.in_turn(rows, 240)
    assert len(picked) == 240 and {r["kinds"] for r in picked} == {"", "phone", "secret"}
    assert len({r["shape"] for r in picked if r["kinds"] == "phone"}) == sum(r["kinds"] == "phone" for r in picked) > 100
    assert personal.in_turn(rows[::-1], 240) == picked and len(personal.in_turn(rows, 5000)) == len(rows)
