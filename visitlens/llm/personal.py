"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

The patterns find e-mail addresses, IP addresses, card numbers and phone numbers; their spans always
stay. Around every digit and every ``@`` the field reads the words of the text and scores whole
segments of up to ``MAX_TOKENS`` tokens by features of the segment (shape, length, digit count, Luhn
sum, what stands before and after) and by the labels of neighbouring segments. A Viterbi recursion
over segment ends, labels and bounded segment lengths picks boundaries and kinds together. The field
knows one kind more, ``secret``: keys and tokens assigned in a text.

It is trained by maximum likelihood (forward-backward over segments) on regions of a bounded sample
of documents; the patterns, and assignments such as ``token = "..."``, say what is right there.

Defined results: a null text counts as empty; an empty text has no spans, and the checksum of the
empty string; repeated rows are searched each for itself; an empty table gives no rows; columns other
than ``doc_id`` and ``text`` are ignored (``redacted`` keeps them).
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import defaultdict, deque
from collections.abc import Iterator
from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import arrow_schema, held_out, ids_and_texts, kind_of, map_batches, read, rows_batch, sample_by_hash

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
OUTSIDE = "-"
MAX_TOKENS = 16
LEARN_DOCUMENTS = 6000
LEARN_REGIONS = 2400
EPOCHS = 4
RATE = 0.15
SEED = 5

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its first digit only: where that fails, later ones fail too.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(r"\b(?:token|secret|key|password)\s*=\s*\"([^\"\s]{16,256})\"", re.I)
TRIGGER = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
TOKEN = re.compile(r"[^\W_]+|\s+|.", re.S)
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, str, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, ``@`` and domain, from the left; found from each ``@`` so that time is linear."""
    low, at = 0, text.find("@")
    while at >= 0:
        before = text[low:at]
        start = low + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        low = domain.end() if domain else at + 1
        at = text.find("@", low)


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, by start and then kind as listed."""
    spans = [(start, 0, end) for start, end in emails(text)]
    for match in ADDRESS.finditer(text):
        parts = (part.lstrip("0") for part in match.group().split("."))
        if all(len(part) < 3 or len(part) == 3 and int(part) <= 255 for part in parts):
            spans.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", match.group()) if match.end() - match.start() <= 64 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((match.start(), 2, match.end()))
    for match in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", match.group())) <= 15:
            spans.append((match.start(), 3, match.end()))
    return [(start, BASE_KINDS[kind], end) for start, kind, end in sorted(spans)]


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of neighbouring words that hold a digit or an ``@``, parted by one blank at most."""
    at = 0
    while trigger := TRIGGER.search(text, at):
        start = trigger.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = trigger.end()
        while True:
            gap = SPACE.search(text, end)
            end = gap.start() if gap else len(text)
            if not text.startswith(" ", end):
                break
            gap = SPACE.search(text, end + 1)
            word_end = gap.start() if gap else len(text)
            if word_end == end + 1 or not TRIGGER.search(text, end + 1, word_end):
                break
            end = word_end
        yield start, end
        at = end


def shape_of(piece: str) -> str:
    """Letters and digits by kind, runs shortened, other characters as they are."""
    out = []
    for token in TOKEN.findall(piece):
        if token.isdigit() and token.isascii():
            mark = "9"
        elif token.isalpha():
            mark = "a"
        elif token[0].isalnum():
            mark = "x"
        else:
            mark = token[0]
        if not out or out[-1] != mark:
            out.append(mark)
    return "".join(out)


def features(text: str, start: int, end: int) -> tuple[str, ...]:
    """Features of the whole segment; none of them looks at single tokens."""
    piece = text[start:end]
    digits = NOT_DIGIT.sub("", piece)
    before, after = text[start - 1:start], text[end:end + 1]
    left = re.findall(r"\w+|[^\w\s]", text[max(0, start - 24):start])[-2:]
    out = [
        "bias", "shape " + shape_of(piece)[:24], f"digits {min(20, len(digits))}",
        f"length {int(math.log2(end - start) * 2)}", "left " + (left[-1].lower() if left and not left[-1].isalnum() else ""),
        "before " + ("w" if before.isalnum() else before.strip()), "after " + ("w" if after.isalnum() else after.strip()),
        f"first {'w' if piece[0].isalnum() else piece[0]}", f"last {'w' if piece[-1].isalnum() else piece[-1]}",
        f"at {piece.count('@')}",
    ]
    if 12 <= len(digits) <= 19:
        out.append(f"luhn {luhn(digits)}")
    if 9 <= len(digits) <= 15 and piece[0] == "+":
        out.append("dialled")
    parts = piece.split(".")
    if len(parts) == 4 and all(part.isdigit() and part.isascii() and len(part) <= 3 for part in parts):
        out.append(f"octets {all(int(part) <= 255 for part in parts)}")
    if len(piece) >= 16 and piece.isalnum() and digits and len(digits) < len(piece):
        out.append("opaque")
        if len(left) == 2 and left[-1] in "\"'=:":
            out.append("assigned")
    return tuple(out)


def lattice(text: str, start: int, end: int) -> tuple[list[int], dict[tuple[int, int], tuple[str, ...]]]:
    """Token limits of a region, and features of the segments that may carry a kind."""
    limits = [start, *(match.end() for match in TOKEN.finditer(text, start, end))]
    segments = {}
    for i in range(len(limits) - 1):
        if not (text[limits[i]].isalnum() or text[limits[i]] in "+(._%-"):
            continue
        for j in range(i + 1, min(i + MAX_TOKENS, len(limits) - 1) + 1):
            last = text[limits[j] - 1]
            if (last.isalnum() or last == ")") and TRIGGER.search(text, limits[i], limits[j]):
                segments[i, j] = features(text, limits[i], limits[j])
    return limits, segments


LABELS = (OUTSIDE, *KINDS)


class Field:
    """Weights by (label, feature) and by (label, next label)."""

    def __init__(self, weights: dict | None = None):
        self.weights: dict = dict(weights or {})

    def _score(self, label: str, found: tuple[str, ...]) -> float:
        get = self.weights.get
        return sum(get((label, name), 0.0) for name in found)

    def _edges(self, segments: dict, size: int) -> list[list[tuple[int, str, float]]]:
        """For every end, the (start, label, score) of what may end there."""
        ends: list[list[tuple[int, str, float]]] = [[] for _ in range(size)]
        for end in range(1, size):
            ends[end].append((end - 1, OUTSIDE, 0.0))
        for (i, j), found in segments.items():
            ends[j].extend((i, label, self._score(label, found)) for label in KINDS)
        return ends

    def _step(self, before: str, label: str) -> float:
        return self.weights.get((before, ">" + label), 0.0)

    def best(self, text: str, start: int, end: int) -> list[Span]:
        """The likeliest segmentation of a region, without what is outside."""
        limits, segments = lattice(text, start, end)
        if not segments:
            return []
        best: list[dict[str, tuple[float, int, str]]] = [{OUTSIDE: (0.0, -1, "")}]
        for at, edges in enumerate(self._edges(segments, len(limits))[1:], 1):
            here: dict[str, tuple[float, int, str]] = {}
            for i, label, score in edges:
                value, before = max((v + self._step(b, label), b) for b, (v, _, _) in best[i].items())
                if label not in here or value + score > here[label][0]:
                    here[label] = (value + score, i, before)
            best.append(here)
        at, label = len(limits) - 1, max(best[-1], key=lambda name: (best[-1][name][0], name))
        spans = []
        while at > 0:
            _, i, before = best[at][label]
            if label != OUTSIDE:
                spans.append((limits[i], label, limits[at]))
            at, label = i, before
        return spans[::-1]

    def _expected(self, edges: list, size: int) -> dict[tuple, float]:
        """Probability of every (start, end, label) and of every pair of neighbouring labels."""
        def total(values: list[float]) -> float:
            top = max(values)
            return top + math.log(sum(math.exp(v - top) for v in values))

        forward: list[dict[str, float]] = [{OUTSIDE: 0.0}]
        for at in range(1, size):
            ways = defaultdict(list)
            for i, label, score in edges[at]:
                ways[label].extend(v + self._step(b, label) + score for b, v in forward[i].items())
            forward.append({label: total(values) for label, values in ways.items()})
        backward: list[dict[str, list]] = [defaultdict(list) for _ in range(size)]
        whole = total(list(forward[-1].values()))
        for label in forward[-1]:
            backward[-1][label] = [0.0]
        expected: dict[tuple, float] = defaultdict(float)
        for at in range(size - 1, 0, -1):
            rest = {label: total(values) for label, values in backward[at].items() if values}
            for i, label, score in edges[at]:
                if label not in rest:
                    continue
                for b, v in forward[i].items():
                    way = self._step(b, label) + score + rest[label]
                    share = math.exp(v + way - whole)
                    expected[i, at, label] += share
                    expected[b, label] += share
                    backward[i][b].append(way)
        return expected

    def learn(self, examples: list[tuple[str, int, int, list[Span]]], epochs: int = EPOCHS, rate: float = RATE) -> Field:
        """Stochastic gradient ascent of the likelihood, with adaptive steps."""
        scale: dict = defaultdict(lambda: 1e-6)
        prepared = []
        for text, start, end, gold in examples:
            limits, segments = lattice(text, start, end)
            place = {limit: i for i, limit in enumerate(limits)}
            kept = [(place[a], place[b], kind) for a, kind, b in gold
                    if a in place and b in place and (place[a], place[b]) in segments]
            path, at, label = [], 0, OUTSIDE
            for i, j, kind in [*sorted(kept), (len(limits) - 1, None, None)]:
                if i < at:
                    continue
                path += [(k, k + 1, OUTSIDE) for k in range(at, i)]
                if j is not None:
                    path.append((i, j, kind))
                    at = j
            prepared.append((len(limits), segments, path))
        for _ in range(epochs):
            for size, segments, path in prepared:
                gradient: dict = defaultdict(float)
                before = OUTSIDE
                for i, j, label in path:
                    gradient[before, ">" + label] += 1
                    for name in segments[i, j] if label != OUTSIDE else ():
                        gradient[label, name] += 1
                    before = label
                for key, share in self._expected(self._edges(segments, size), size).items():
                    if share < 1e-6:
                        continue
                    if len(key) == 2:
                        gradient[key[0], ">" + key[1]] -= share
                    elif key[2] != OUTSIDE:
                        for name in segments[key[0], key[1]]:
                            gradient[key[2], name] -= share
                for key, slope in gradient.items():
                    scale[key] += slope * slope
                    self.weights[key] = self.weights.get(key, 0.0) + rate * slope / math.sqrt(scale[key])
        return self


def gold_spans(text: str) -> list[Span]:
    """What training takes as right: the patterns' spans, longest first where they overlap, and secrets."""
    spans = [*base_spans(text), *((m.start(1), "secret", m.end(1)) for m in SECRET.finditer(text))]
    out: list[Span] = []
    for span in sorted(spans, key=lambda s: (s[0] - s[2], KINDS.index(s[1]))):
        if all(span[2] <= a or b <= span[0] for a, _, b in out):
            out.append(span)
    return sorted(out)


def in_turn(rows: list, most: int) -> list:
    """At most ``most`` regions. Every set of kinds gives one a turn, regions without kinds as many as all sets together.

    Inside a set the shapes take turns in the order of their least hash. So neither frequent shapes nor
    many shapes of one kind crowd out others.
    """
    by_kinds: dict = defaultdict(lambda: defaultdict(list))
    for row in sorted(rows, key=lambda r: (r["order"], r["text"], r["start"])):
        by_kinds[row["kinds"]][row["shape"]].append(row)
    queues = {
        kinds: deque(row for rank in zip_longest(*shapes.values()) for row in rank if row is not None)
        for kinds, shapes in sorted(by_kinds.items())
    }
    none = queues.pop("", deque())
    picked: list = []
    while len(picked) < most and (none or any(queues.values())):
        turn = [queue.popleft() for queue in queues.values() if queue]
        turn += [none.popleft() for _ in range(min(len(none), len(turn) or len(none)))]
        picked += turn[:most - len(picked)]
    return picked


def learn(
    docs: DataFrame, documents: int = LEARN_DOCUMENTS, most_regions: int = LEARN_REGIONS, seed: int = SEED,
) -> Field:
    """Train on regions of about ``documents`` documents (least id hash), at most ``most_regions``.

    ``in_turn`` says which.
    """
    learning = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
    schema = "order long, kinds string, shape string, text string, start long, end long, spans string"
    target = arrow_schema(schema)

    def cut(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                gold = gold_spans(text) if TRIGGER.search(text) else []
                for start, end in regions(text) if TRIGGER.search(text) else ():
                    if end - start > 200:
                        continue
                    low = max(0, start - 40)
                    inside = [f"{a - low}:{kind}:{b - low}" for a, kind, b in gold if start <= a and b <= end]
                    key = hashlib.sha256(f"{seed} {doc_id} {start}".encode()).digest()
                    kinds = "+".join(sorted({s.split(":")[1] for s in inside}))
                    rows.append((int.from_bytes(key[:7], "big"), kinds, shape_of(text[start:end])[:12], text[low:end + 40], start - low, end - low, ",".join(inside)))
            yield rows_batch(rows, target)

    chosen = sample_by_hash(learning, documents, seed)
    examples = []
    for row in in_turn(map_batches(chosen, cut, schema).collect(), most_regions):
        gold = [(int(a), kind, int(b)) for a, kind, b in (s.split(":") for s in row["spans"].split(",") if s)]
        examples.append((row["text"], row["start"], row["end"], gold))
    return Field().learn(examples)


def find(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and all spans: the field adds those that touch none of the patterns'."""
    if not TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    starts, ends = [], []  # of the stretches the patterns' spans cover
    for start, _, end in base:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    added = []
    for start, end in regions(text):
        for span in field.best(text, start, end):
            before = bisect_left(starts, span[2])
            if before == 0 or ends[before - 1] <= span[0]:
                added.append(span)
    return base, sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def search(docs: DataFrame, field: Field) -> DataFrame:
    """One row per document: counts by kind, checksum of the patterns' spans, all spans."""
    schema = (f"doc_id {kind_of(docs, 'doc_id')}, n_email long, n_ip long, n_card long, n_phone long, "
              "base_sha256 string, spans string")
    target, weights = arrow_schema(schema), field.weights

    def look(batches: Iterator) -> Iterator:
        own = Field(weights)
        for batch in batches:
            rows = []
            for text in batch["text"].to_pylist():
                base, every = find(text, own)
                counts = [sum(kind == name for _, kind, _ in base) for name in BASE_KINDS]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            yield rows_batch(rows, target, batch["doc_id"])

    return map_batches(ids_and_texts(docs), look, schema)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each stretch covered by spans replaced by its kinds in angle brackets."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        kinds = [kind]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            kinds += [spans[i][1]] if spans[i][1] not in kinds else []
            i += 1
        out += [text[at:start], "<", "+".join(kinds).upper(), ">"]
        at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """The same rows and columns, with all spans in ``text`` replaced. Null texts stay null."""
    weights = field.weights
    place = docs.columns.index("text")

    def change(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = Field(weights)
        for batch in batches:
            texts = [None if t is None else redact(t, find(t, own)[1]) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_batches(docs, change, docs.schema)


def op6_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return search(docs, learn(docs))
