"""Periodic runs against a comparison of all words at all distances."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from tests.llm.rows import by_row, documents, edge_rows
from visitlens.llm import runs
from visitlens.llm.common import read

SF = "/root/testdata/sf0.001"


def brute(words, least=24, exponent=3):
    found, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def looped(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = looped((text or "").encode().split(), doc_id)
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    lines = "".join("%d,%d,%d\n" % r for r in found)
    return (doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def made(rng):
    letters = rng.choice([1, 2, 3, 50])
    draw = lambda n: [rng.randrange(letters) for _ in range(n)]
    kind = rng.randrange(4)
    words = draw(rng.randrange(300))
    if kind == 1:
        for _ in range(3):
            block, times = draw(rng.randrange(1, 80)), rng.randrange(2, 7)
            at = rng.randrange(len(words) + 1)
            words[at:at] = (block * times)[:len(block) * times - rng.randrange(len(block))]
    if kind == 2:  # runs in runs
        block = draw(rng.randrange(1, 4))
        while len(block) < 150:
            block = block * rng.randrange(1, 5) + draw(rng.randrange(4))
        words[50:50] = block * 3
    if kind == 3:  # Fibonacci words: many overlapping runs
        x, words = [0], [0, 1]
        while len(words) < rng.randrange(50, 500):
            x, words = words, words + x
    return [str(w).encode() for w in words]


@pytest.mark.parametrize("seed", range(8))
def test_batches_of_made_texts(seed):
    rng = random.Random(seed)
    texts = [made(rng) for _ in range(30)]
    codes, sizes = runs.laid(texts)
    found = runs.in_texts(runs.runs_of(codes, sizes), sizes, runs.LEAST)
    for words, got in zip(texts, found):
        assert got == brute(words)
        assert runs.without(words, got) == collapsed(words, got)


def test_long_periods_in_a_long_text():
    rng = random.Random(1)
    block = [b"%d" % rng.randrange(30) for _ in range(9000)]
    words = [b"x"] * 30 + block * 3 + block[:777] + [b"y"]
    codes, sizes = runs.laid([words, [], [b"a"]])
    found = runs.in_texts(runs.runs_of(codes, sizes), sizes, runs.LEAST)
    assert found == [[(0, 30, 1), (30, 27777, 9000)], [], []]


def test_scales_find_what_the_comparison_of_neighbours_leaves():
    """The set proposes every longer period by itself, also where most of a period is highly periodic."""
    block = [b"a"] * 40 + [b"b", b"c"] * 9 + [b"d"]
    words = block * 4
    codes, sizes = runs.laid([words])
    found = runs.runs_of(codes, sizes).period
    assert found[(0, len(words))] == len(block) and (0, 40) in found


def test_edge_rows(spark):
    rows = edge_rows() + [(30, "a b " * 20), (31, "a b " * 30), (32, "a\x1cb " * 30), (33, "w " * 24), (34, "w " * 23)]
    docs = documents(spark, rows)
    got = by_row(runs.periodic_runs(docs), "doc_id", "n_words", "collapsed")
    words = [(i, (t or "").encode().split()) for i, t in rows]
    want = [(i, len(w), b" ".join(collapsed(w, brute(w))).decode()) for i, w in words]
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert runs.periodic_runs(docs).count() == 0 and runs.with_loops(docs).count() == 0


def test_loops(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 13 * 7))) for i in range(300)] + [(None, "a b c"), (7, None)]
    got = by_row(runs.with_loops(documents(spark, rows)), "doc_id", "text")
    want = [(i, None if t is None else " ".join(w.decode() for w in looped(t.encode().split(), i))) for i, t in rows]
    assert got == sorted(want, key=repr)


def test_query_on_a_whole_table(spark):
    rows = read(spark, SF, "documents").select("doc_id", "text").collect()
    want = sorted((expected(*r) for r in rows), key=repr)
    assert by_row(runs.op13_synchronising_runs(spark, SF), *COLUMNS) == want
