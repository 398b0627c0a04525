"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that is
at least ``exponent`` periods and ``least`` words long and that no neighbouring word extends. The texts
of a batch are laid end to end, with a word of its own after each, so that no run leaves its text.

- Periods below 12 come from regions that are highly periodic: words are compared with those q further.
- For longer ones there is a synchronising set at every dyadic scale t = 8, 16, 32, ...: a position is
  in the set if the least hash of the t + 1 blocks of t words that start in the t + 1 places from there
  belongs to the first or to the last. Blocks with a period of at most t / 3 take no part. Membership
  depends on 2 t words only, so equal contexts agree on it, and every t places hold a member unless
  3 t - 1 words there have a period of at most t / 3. A run with 3 t / 2 <= q < 3 t is not so throughout
  (else q were not its smallest period), so it holds a member and, q words on, another with the same
  context: pairs of members with equal contexts at such distances propose all periods. Occurrences of
  a context lie more than t / 3 apart, which bounds the pairs of a member.
- A proposed period is extended word by word to both sides; hashes decide nothing. A stretch found
  before with a smaller period is not a run of this one.

Work is linear in the words times the scales. Only texts long enough for a scale stay in it.

Defined results: a null or empty text, or one of white space, has no words, no runs, and collapses to the
empty text; words end at ASCII white space only; each repeated row is searched for itself; an empty table
gives no rows; columns other than ``doc_id`` and ``text`` are ignored. A text of any length is searched as
a whole, by one task that needs some 150 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import arrow_schema, ids_and_texts, kind_of, map_batches, read, rows_batch

LEAST = 24
EXPONENT = 3
FIRST = 8  # the smallest scale
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def mixed(one, two):
    """Hashes of pairs of hashes."""
    import numpy as np

    x = one * np.uint64(0x9E3779B97F4A7C15) + (two ^ (two >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _forward(codes, i: int, q: int) -> int:
    """The first place from ``i`` whose word differs from that ``q`` further."""
    stop, step = len(codes) - q, 64
    while i < stop:
        j = min(i + step, stop)
        differ = codes[i:j] != codes[i + q:j + q]
        k = int(differ.argmax())
        if differ[k]:
            return i + k
        i, step = j, step * 2
    return stop


def _backward(codes, i: int, q: int) -> int:
    """The first place of the stretch of words equal to those ``q`` further that ends before ``i``."""
    step = 64
    while i > 0:
        j = max(i - step, 0)
        differ = (codes[j:i] != codes[j + q:i + q])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            return i - k
        i, step = j, step * 2
    return 0


class Found:
    """Runs as (start, end) -> smallest period, at places of all texts laid end to end."""

    def __init__(self, exponent: int):
        self.exponent = exponent
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, q: int) -> None:
        """Periods must come in ascending order within a stretch."""
        if end - start >= max(FIRST, self.exponent * q):
            self.period.setdefault((start, end), q)


def highly_periodic(codes, found: Found) -> None:
    """Runs with periods below those of the first scale."""
    import numpy as np

    for q in range(1, FIRST * 3 // 2):
        same = np.flatnonzero(codes[q:] == codes[:-q])
        if not len(same):
            continue
        gap = np.flatnonzero(np.diff(same) != 1)
        first, last = same[np.r_[0, gap + 1]], same[np.r_[gap, len(same) - 1]]
        long = last + 1 + q - first >= max(FIRST, found.exponent * q)
        for start, end in zip(first[long].tolist(), (last[long] + 1 + q).tolist()):
            found.add(start, end, q)


def members(block, periodic, t: int):
    """The synchronising set at scale ``t``, from hashes of blocks of ``t`` words and those that are excluded."""
    import numpy as np

    none = np.uint64(2**64 - 1)
    name = np.where(periodic, none, block) if periodic is not None else block
    least, width = name, 1
    while width < t:
        least, width = np.minimum(least[:-width], least[width:]), width * 2
    least = np.minimum(least[:-1], least[1:])
    m = len(least)
    return np.flatnonzero(((least == name[:m]) | (least == name[t:t + m])) & (least != none))


def proposals(at, context, t: int):
    """(place, distance) of members with equal contexts, 3 t / 2 to 3 t apart; by distance, then place."""
    import numpy as np

    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    places, gaps = [], []
    for lag in range(1, len(at)):
        apart = at[lag:] - at[:-lag]
        near = (context[lag:] == context[:-lag]) & (apart < 3 * t)
        if not near.any():
            break
        near &= 2 * apart >= 3 * t
        places.append(at[:-lag][near])
        gaps.append(apart[near])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    places, gaps = np.concatenate(places), np.concatenate(gaps)
    order = np.lexsort((places, gaps))
    return places[order], gaps[order]


def runs_of(codes, sizes, exponent: int = EXPONENT) -> Found:
    """Runs of texts laid end to end: ``codes`` has a code of its own after each text, ``sizes`` their words.

    Every run of at least ``FIRST`` words is found, whatever the shorter ones.
    """
    import numpy as np

    if exponent < 3:
        raise ValueError("synchronising sets propose runs of three periods or more")
    found = Found(exponent)
    sizes = np.asarray(sizes, dtype=np.int64)
    if not len(codes):
        return found
    highly_periodic(codes, found)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    live = np.arange(len(sizes))  # texts of this scale, laid end to end in ``now``
    now, shift, block, t = codes, np.zeros(len(sizes), np.int64), None, 0
    while True:
        after = t * 2 or FIRST
        long = live[sizes[live] >= after * 3 // 2 * exponent]
        if not len(long):
            return found
        if block is None or 2 * (sizes[long].sum() + len(long)) <= len(now):  # lay only those
            live = long
            now = np.concatenate([codes[starts[i]:starts[i] + sizes[i] + 1] for i in live])
            shift = np.concatenate([[0], np.cumsum(sizes[live] + 1)[:-1]]) - starts[live]
            block, t = mixed(now.view(np.uint64), np.uint64(0)), 1
        while t < after:
            block, t = mixed(block[:-t], block[t:]), t * 2
        if len(now) < 2 * t:
            return found
        context = mixed(block[:-t], block[t:])
        inside = [(s, e) for (s, e), q in found.period.items() if 3 * q <= t <= e - s]
        periodic = None
        if inside:  # blocks with a period of at most t / 3 lie in runs found before
            s, e = np.array(inside, dtype=np.int64).T
            text = np.searchsorted(starts[live], s, side="right") - 1
            here = (text >= 0) & (s < starts[live][text] + sizes[live][text])
            s, e = s[here] + shift[text[here]], e[here] + shift[text[here]]
            edges = np.zeros(len(now) + 1, np.int64)
            np.add.at(edges, s, 1)
            np.add.at(edges, e - t + 1, -1)
            periodic = np.cumsum(edges)[:len(block)] > 0
        at = members(block, periodic, t)
        places, gaps = proposals(at, context[at], t)
        before, q, origin = -1, 0, starts[live] + shift
        for place, gap in zip(places.tolist(), gaps.tolist()):
            if gap != q:
                before, q = -1, gap
            if place < before:
                continue  # of the stretch just extended
            start, before = _backward(now, place, q), _forward(now, place, q)
            if before + q - start >= exponent * q:
                back = int(shift[np.searchsorted(origin, start, side="right") - 1])
                found.add(start - back, before + q - back, q)


def laid(texts: list[list[bytes]]):
    """Words as codes, equal for equal words; after each text a code of its own."""
    import numpy as np
    from collections import defaultdict
    from itertools import count

    known: dict = defaultdict(count().__next__)
    parts = []
    for number, words in enumerate(texts):
        parts += [np.fromiter(map(known.__getitem__, words), np.int64, len(words)), np.array([-1 - number])]
    return np.concatenate(parts) if parts else np.empty(0, np.int64), [len(words) for words in texts]


def in_texts(found: Found, sizes: list[int], least: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of every text, by start, then period."""
    from bisect import bisect_right
    from itertools import accumulate

    starts = [0, *accumulate(n + 1 for n in sizes)][:-1]
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    for (start, end), q in found.period.items():
        if end - start >= least:
            text = bisect_right(starts, start) - 1
            out[text].append((start - starts[text], end - start, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def without(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside runs or in the first period of every run that holds them."""
    out, at = [], 0
    for start, end in sorted((s + q, s + n) for s, n, q in runs):
        if start > at:
            out += words[at:start]
        at = max(at, end)
    return out + words[at:]


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length and period in words, by start, then period) and
    ``collapsed``: the text with one period left of every run, words joined by one space."""
    schema = f"doc_id {kind_of(docs, 'doc_id')}, n_words bigint, runs array<{RUN}>, collapsed string"
    target = arrow_schema(schema)

    def work(batches: Iterator) -> Iterator:
        for batch in batches:
            texts = [t.encode().split() for t in batch["text"].to_pylist()]
            codes, sizes = laid(texts)
            every = in_texts(runs_of(codes, sizes, exponent), sizes, least)
            yield rows_batch(
                [(len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], b" ".join(without(words, runs)).decode())
                 for words, runs in zip(texts, every)],
                target, batch["doc_id"])

    return map_batches(ids_and_texts(docs), work, schema)


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest exact length / period; of equal ones that of least start, then period."""
    def pick(best: Column, run: Column) -> Column:
        more = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), pick)


def with_loops(docs: DataFrame) -> DataFrame:
    """The documents of the query: of every tenth id by hash, the words from some place on repeat in a loop."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.col("text").cast("string")
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    some = docs.select("doc_id", text.alias("text"), F.floor(crc / 10).alias("g"), F.when(crc % 10 == 0, words).alias("w"))
    n, a = F.size("w").cast("bigint"), F.col("a")
    some = some.withColumn("a", F.when(n > 0, F.col("g") % n))
    some = some.withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    looped = F.concat(
        F.slice("w", F.lit(1), a.cast("int")),
        F.transform(F.sequence(a, n - 1), lambda i: F.get(F.col("w"), (a + (i - a) % F.col("p")).cast("int"))))
    return some.select("doc_id", F.when(a.isNotNull(), F.array_join(looped, " ")).otherwise(F.col("text")).alias("text"))


def op13_synchronising_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_loops(read(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", strongest()).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
