"""Removal of byte strings that start in two places or more, by prefix doubling over sparse positions.

A suffix array of every byte would sort one rank pair per byte and round. Here the suffixes that
are sorted are sparse, chosen by content so that equal text chooses equal places: of the
``GRAM``-byte strings inside each window of ``length`` bytes, the one of least hash. Neighbouring
windows with the same least string are one stretch. Ranks grow in rounds, and what is unique drops
out after each:

1. the least string alone (``GRAM`` bytes): a window whose least string is nowhere else is unique;
2. the whole stretch (``length`` bytes and more): where it is elsewhere too, all its windows are;
3. single windows (exactly ``length`` bytes) of stretches that are unique but share their least
   string: the ends of repeated passages.

Ranks are names, hashes of 64 bits in the first round and of 128 bits later: only equality counts
here, so nothing needs the order of a sort across the cluster.

Equal texts are one text with a count: if they are long enough, all their bytes go.

Defined results: a null text counts as empty; a text shorter than ``length`` bytes stays whole;
repeated rows are copies of each other; a null id takes part like any other; an empty table gives no
rows; columns other than ``doc_id`` and ``text`` are ignored (``without_repeats`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import Shelf, arrow_schema, kind_of, map_batches, packed, read, rows_batch, unpacked
from visitlens.llm.similarity import by_key, text_key

LENGTH = 200
GRAM = 40
CHUNK = 1 << 18  # windows hashed at once
TASK_WINDOWS = 1 << 20  # windows of one least string that are compared inside one task
BASES = (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
SEED = 23


class Hasher:
    """Hashes of all substrings of one length, from prefix sums modulo 2**64."""

    def __init__(self):
        import numpy as np

        random = np.random.default_rng(SEED)
        self._bytes = random.integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._powers = [[np.ones(1, np.uint64), np.ones(1, np.uint64)] for _ in BASES]

    def _grow(self, which: int, size: int) -> list:
        import numpy as np

        powers = self._powers[which]
        if len(powers[0]) < size:
            size = max(size, 2 * len(powers[0]))
            for i, base in enumerate((BASES[which], pow(BASES[which], -1, 2**64))):
                grown = np.empty(size, np.uint64)
                grown[0], done = 1, 1
                while done < size:
                    more = min(done, size - done)
                    grown[done:done + more] = grown[:more] * np.uint64(pow(base, done, 2**64))
                    done += more
                powers[i] = grown
        return powers

    def __call__(self, raw, length: int, which: int = 0):
        """One hash for every start of a ``length``-byte substring of ``raw`` (an array of bytes)."""
        import numpy as np

        up, down = self._grow(which, len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self._bytes[which][raw] * up[:len(raw)], out=sums[1:])
        found = (sums[length:] - sums[:-length]) * down[:len(raw) - length + 1]
        found ^= found >> np.uint64(32)
        found *= np.uint64(0x9E3779B97F4A7C15)
        return found ^ (found >> np.uint64(29))


def sliding_least(values, width: int):
    import numpy as np

    span, least = 1, values
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def stretches(raw: bytes, hasher: Hasher, length: int, gram: int) -> Iterator[tuple[int, int, int, bool]]:
    """(first window, last window, least string, whether that occurs twice in there) over the whole text."""
    import numpy as np

    width = length - gram + 1
    every = np.frombuffer(raw, np.uint8)
    for base in range(0, len(raw) - length + 1, CHUNK):
        part = every[base:base + CHUNK + length - 1]
        grams = hasher(part, gram)
        least = sliding_least(grams, width)
        low = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        high = np.r_[low[1:], len(least)] - 1
        name = least[low]
        twice = np.zeros(len(low), bool)
        inside = np.arange(width)
        for at in range(0, len(low), 4096):
            some = slice(at, at + 4096)
            first = low[some] + (grams[low[some, None] + inside] == name[some, None]).argmax(axis=1)
            last = high[some] + width - 1 - (grams[high[some, None] + inside] == name[some, None])[:, ::-1].argmax(axis=1)
            twice[some] = first != last
        yield from zip((low + base).tolist(), (high + base).tolist(), name.view(np.int64).tolist(), twice.tolist())


def sparse(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """All stretches of all texts: doc_id, k1, name, low, high, twice."""
    schema = f"doc_id {kind_of(docs, 'doc_id')}, k1 long, name long, low int, high int, twice boolean"

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hasher = Hasher()
        for batch in batches:
            found, counts = [], []
            for raw in batch["raw"].to_pylist():
                before = len(found)
                if len(raw) >= length:
                    found += stretches(raw, hasher, length, gram)
                counts.append(len(found) - before)
            owner = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            lead = batch.select(["doc_id", "k1"]).take(owner)
            columns = list(zip(*found)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [lead["doc_id"], lead["k1"], pa.array(columns[2], pa.int64()), pa.array(columns[0], pa.int32()),
                 pa.array(columns[1], pa.int32()), pa.array(columns[3], pa.bool_())],
                ["doc_id", "k1", "name", "low", "high", "twice"],
            )

    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return map_batches(docs.select("doc_id", text_key()[0], raw.alias("raw")), work, schema)


def named(held: DataFrame, length: int) -> DataFrame:
    """128-bit names of the whole stretches listed in ``parts``: doc_id, k1, name, low, high, twice, s1, s2."""
    schema = f"doc_id {kind_of(held, 'doc_id')}, k1 long, name long, low int, high int, twice boolean, s1 long, s2 long"
    target = arrow_schema(schema)

    def work(batches: Iterator) -> Iterator:
        from xxhash import xxh3_128_intdigest

        for batch in batches:
            rows = []
            for doc_id, k1, raw, parts in zip(*(batch[c].to_pylist() for c in ("doc_id", "k1", "raw", "parts"))):
                for p in parts:
                    whole = xxh3_128_intdigest(raw[p["low"]:p["high"] + length])
                    s1, s2 = (int.from_bytes(b, "little", signed=True) for b in (
                        (whole >> 64).to_bytes(8, "little"), (whole & 2**64 - 1).to_bytes(8, "little")))
                    rows.append((doc_id, k1, p["name"], p["low"], p["high"], p["twice"], s1, s2))
            yield rows_batch(rows, target)

    return map_batches(held.select("doc_id", "k1", "raw", "parts"), work, schema)


def window_names(raw: bytes, hasher: Hasher, length: int):
    import numpy as np

    every = np.frombuffer(raw, np.uint8)
    return hasher(every, length, 0).view(np.int64), hasher(every, length, 1).view(np.int64)


def runs_of(mask) -> list[tuple[int, int]]:
    """(first, last) of every run of true values."""
    import numpy as np

    edges = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def test_in_tasks(stretch: DataFrame, length: int, id_kind: str) -> DataFrame:
    """Round 3 where a least string has few enough windows for one task: intervals doc_id, k1, start, end."""
    schema = f"doc_id {id_kind}, k1 long, start int, end int"
    target = arrow_schema(schema)

    def finish_with(hasher):
        def finish(table):
            import numpy as np

            raws, low, single = table["raw"].to_pylist(), table["low"].to_pylist(), table["single"].to_pylist()
            one, two = zip(*(window_names(raw, hasher, length) for raw in raws))
            counts = np.array([len(x) for x in one])
            one, two = np.concatenate(one), np.concatenate(two)
            order = np.lexsort((two, one))
            same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            repeated = np.zeros(len(one), bool)
            repeated[order] = np.r_[same, False] | np.r_[False, same]
            rows, ends = [], np.cumsum(counts)
            ids, keys = table["doc_id"].to_pylist(), table["k1"].to_pylist()
            for i in np.flatnonzero(single):
                for a, b in runs_of(repeated[ends[i] - counts[i]:ends[i]]):
                    rows.append((ids[i], keys[i], low[i] + a, low[i] + b + length))
            yield rows_batch(rows, target)
        return finish

    def work(batches: Iterator) -> Iterator:
        yield from by_key("name", finish_with(Hasher()))(batches)

    return map_batches(stretch.repartition("name").sortWithinPartitions("name"), work, schema)


def test_by_windows(stretch: DataFrame, length: int, id_kind: str) -> DataFrame:
    """Round 3 for least strings with very many windows: one row per window, counted by name across the cluster."""
    schema = f"doc_id {id_kind}, k1 long, single boolean, at int, w1 long, w2 long"

    def spread(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hasher = Hasher()
        for batch in batches:
            for row in range(batch.num_rows):
                one, two = window_names(batch["raw"][row].as_py(), hasher, length)
                lead = batch.select(["doc_id", "k1", "single"]).take(pa.array(np.full(len(one), row)))
                at = pa.array(np.arange(len(one), dtype=np.int32) + batch["low"][row].as_py())
                yield pa.RecordBatch.from_arrays([*lead.columns, at, pa.array(one), pa.array(two)],
                                                 ["doc_id", "k1", "single", "at", "w1", "w2"])

    windows = map_batches(stretch.select("doc_id", "k1", "single", "low", "raw"), spread, schema)
    often = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return windows.filter("single").join(often, ["w1", "w2"], "left_semi").select(
        "doc_id", "k1", F.col("at").alias("start"), (F.col("at") + length).cast("int").alias("end"))


def marked(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, task_windows: int = TASK_WINDOWS) -> DataFrame:
    """The rows of ``docs``, :func:`packed`, with ``_raw`` (bytes), ``_cuts`` (intervals, overlapping, any order) and ``_whole``.

    ``_whole``: all bytes go, since the text has copies.
    """
    docs = packed(docs)
    shelf = Shelf(spark, "substrings")
    id_kind = kind_of(docs, "doc_id")
    keys = docs.select("doc_id", *text_key())
    copies = shelf.keep(
        keys.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).filter("n > 1"), "copies")
    every = sparse(docs, length, gram)
    often = every.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("any")).filter("n > 1 or any").select("name")
    parts = every.join(often, "name", "left_semi").groupBy("doc_id", "k1").agg(
        F.collect_list(F.struct("name", "low", "high", "twice")).alias("parts"))
    doubled = keys.join(copies, ["k1", "k2"]).select(
        "doc_id", "k1", F.col("doc_id").eqNullSafe(F.col("first")).alias("lead")).distinct()
    # One entry for every text that has repeated stretches or copies.
    known = parts.select("doc_id", "k1", "parts", F.lit(None).cast("boolean").alias("lead")).unionByName(
        doubled.select("doc_id", "k1", F.lit(None).cast(parts.schema["parts"].dataType).alias("parts"), "lead"))
    known = known.groupBy(F.col("doc_id").alias("_id"), F.col("k1").alias("_k1")).agg(
        F.max("lead").alias("_lead"), F.first("parts", ignorenulls=True).alias("_parts"))
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    keyed = docs.withColumn("_key", text_key()[0])
    held = keyed.join(known, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k1")), "left")
    held = shelf.keep(
        held.select(*docs.columns, "_key", F.col("_lead").isNotNull().alias("_copied"),
                    F.when(F.coalesce("_lead", F.lit(True)), F.col("_parts")).alias("_parts")), "held")
    whole = F.col("_copied") & (F.octet_length(raw) >= length)

    # Of a text that has copies, and of a row that is repeated, one takes part.
    open_ = held.filter(F.col("_parts").isNotNull()).select(
        "doc_id", F.col("_key").alias("k1"), raw.alias("raw"), F.col("_parts").alias("parts"))
    stretch = named(open_, length).distinct()
    stretch = shelf.keep(stretch, "stretch")
    spans = shelf.keep(stretch.groupBy("name", "s1", "s2").agg(
        F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice"), F.min(F.struct("doc_id", "k1", "low", "high")).alias("of")), "spans")
    doubtful = spans.groupBy("name").agg(
        F.count(F.lit(1)).alias("spans"), F.min("n").alias("least"), F.max("twice").alias("any"),
        F.sum(F.col("of.high") - F.col("of.low") + 1).alias("windows"),
    ).filter("least = 1 and (spans > 1 or any)").select("name", "windows")
    again = stretch.join(spans.filter("n > 1").select("name", "s1", "s2"), ["name", "s1", "s2"], "left_semi").select(
        "doc_id", "k1", F.col("low").alias("start"), (F.col("high") + length).cast("int").alias("end"))
    asked = spans.join(doubtful, "name").select("name", "windows", (F.col("n") == 1).alias("single"), "of.*")
    asked = asked.groupBy(F.col("doc_id").alias("_id"), F.col("k1").alias("_k1")).agg(
        F.collect_list(F.struct("name", "windows", "single", "low", "high")).alias("asked"))
    cut = open_.drop("parts").dropDuplicates(["doc_id", "k1"]).join(
        asked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("k1") == F.col("_k1")))
    cut = cut.select("doc_id", "k1", "raw", F.explode("asked").alias("a")).select(
        "doc_id", "k1", "a.name", "a.windows", "a.single", "a.low",
        F.substring("raw", F.col("a.low") + 1, F.col("a.high") - F.col("a.low") + length).alias("raw"))
    cut = shelf.keep(cut, "cut")
    found = again.unionByName(test_in_tasks(cut.filter(F.col("windows") <= task_windows), length, id_kind))
    if not cut.filter(F.col("windows") > task_windows).isEmpty():
        found = found.unionByName(test_by_windows(cut.filter(F.col("windows") > task_windows), length, id_kind))
    cuts = found.groupBy(F.col("doc_id").alias("_id"), F.col("k1").alias("_k1")).agg(
        F.collect_list(F.struct("start", "end")).alias("_cuts"))
    # Only texts with repeated stretches can have cuts; the others are not shuffled for them.
    columns = (*docs.columns, raw.alias("_raw"), "_cuts", whole.alias("_whole"))
    some = held.filter(F.col("_parts").isNotNull()).join(
        cuts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k1")), "left").select(*columns)
    none = held.filter(F.col("_parts").isNull()).withColumn("_cuts", F.lit(None).cast(cuts.schema["_cuts"].dataType))
    return some.unionByName(none.select(*columns))


def merged(cuts: list[dict] | None, whole: bool, size: int) -> list[tuple[int, int]]:
    """Maximal removed runs."""
    if whole:
        return [(0, size)]
    runs: list[list[int]] = []
    for cut in sorted((c["start"], c["end"]) for c in cuts or ()):
        if runs and cut[0] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], cut[1])
        else:
            runs.append(list(cut))
    return [(a, b) for a, b in runs]


def kept_bytes(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, end in runs:
        out.append(raw[at:start])
        at = end
    return b"".join([*out, raw[at:]])


def report(found: DataFrame) -> DataFrame:
    schema = f"doc_id {kind_of(found, 'doc_id')}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    target = arrow_schema(schema)

    def work(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for raw, cuts, whole in zip(*(batch[c].to_pylist() for c in ("_raw", "_cuts", "_whole"))):
                runs = merged(cuts, whole, len(raw))
                rest = kept_bytes(raw, runs)
                rows.append((len(raw), len(raw) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
            yield rows_batch(rows, target, batch["doc_id"])

    return map_batches(found.select("doc_id", "_raw", "_cuts", "_whole"), work, schema)


def without_repeats(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The same rows and columns, with repeated strings cut out of ``text``.

    A character whose bytes are cut in part goes whole. Rows left without text, of those that had some, go.
    """
    found = marked(spark, docs, **options)
    schema = packed(docs).schema
    names = schema.names
    place = names.index("text")

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts, keep = [], []
            for text, raw, cuts, whole in zip(*(c.to_pylist() for c in (batch.column(place), batch["_raw"], batch["_cuts"], batch["_whole"]))):
                runs = merged(cuts, whole, len(raw))
                texts.append(kept_bytes(raw, runs).decode("utf-8", "ignore") if runs else text)
                keep.append(not runs or bool(texts[-1]))
            columns = [batch[name] for name in names]
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))

    return unpacked(map_batches(found, work, schema), docs.columns)


def op2_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(marked(spark, read(spark, sf_dir, "documents").select("doc_id", "text")))
