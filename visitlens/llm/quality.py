"""Quality rules with an isolation forest over rule statistics.

Every document gets its rule statistics. Isolation trees split random subsamples of them at random;
documents that are isolated after few splits are anomalous; the subsamples are drawn from all documents that
are not held out, without labels. The threshold on the score is calibrated on every labelled one of
them: the greatest gain of rejected bad over rejected good documents, while at most ``good_loss`` of
the good ones are rejected.

Defined results: a null or empty text has no words and fails the base rules; without labels, or with
labels of one kind, the threshold is one that no score reaches; repeated rows are judged each for
itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.llm.common import Shelf, arrow_schema, held_out, kind_of, map_batches, one_label, read, rows_batch, sample_by_hash

TREES = 200
TREE_SAMPLE = 512
GOOD_LOSS = 0.02
MIN_WORDS = 50
SEED = 11
BUCKETS = 1 << 14  # stretches of scores that are counted before the scores in them are ranked

SEPARATORS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
FEATURES = ("word_length", "symbols", "marks", "upper", "dup_lines", "repeat_words", "line_words", "distinct", "top_word")

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
STATS = ", " + COUNTS + ", base_failed boolean, " + ", ".join(f"{name} float" for name in FEATURES)


def repeated_words(codes, distinct: int) -> int:
    """Words inside 3-word windows that occur twice or more."""
    import numpy as np

    if len(codes) < 4:
        return 0
    pairs = codes[:-1] * distinct + codes[1:]
    if distinct >= 2_000_000:  # keep the product below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + codes[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    start = np.flatnonzero(counts[place] > 1)
    inside = np.zeros(len(codes), bool)
    for shift in range(3):
        inside[start + shift] = True
    return int(inside.sum())


def statistics_of(text: str) -> tuple:
    """The counts and the features of one text. Words are cut at ASCII white space only."""
    import numpy as np

    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, SEPARATORS))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n_dup_lines = len(lines) - len(set(lines))
    numbers: dict = {}
    codes = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, n_words)
    n_repeat = repeated_words(codes, len(numbers))
    failed = n_words < MIN_WORDS or 100 * n_repeat > 50 * n_words
    some, size = max(1, n_words), max(1, len(raw))
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    marks = raw.count(b"!") + raw.count(b"?")
    top = int(np.bincount(codes).max()) if n_words else 0
    return (
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat, failed,
        word_chars / some, n_symbols / some, marks / some, upper / size, n_dup_lines / max(1, len(lines)), n_repeat / some,
        math.log1p(n_words / max(1, len(lines))), len(numbers) / some**0.9, top / some,
    )


def statistics(docs: DataFrame, *carried: str) -> DataFrame:
    """One row per document: the counts, whether the base rules fail, the features; ``carried`` columns first."""
    lead = ("doc_id", *carried)
    schema = ", ".join(f"{name} {kind_of(docs, name)}" for name in lead) + STATS
    target = arrow_schema(schema)

    def count(batches: Iterator) -> Iterator:
        for batch in batches:
            yield rows_batch([statistics_of(text) for text in batch["text"].to_pylist()], target, *(batch[name] for name in lead))

    rows = docs.select(*lead, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_batches(rows, count, schema)


def grow(rows, rng, limit: int, tree: list, depth: int = 0) -> int:
    """Append the nodes of a random tree; (feature, split, left, right), leaves with their path length."""
    at = len(tree)
    low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (0, 0)
    open_ = [i for i in range(rows.shape[1]) if low[i] < high[i]] if len(rows) > 1 and depth < limit else []
    if not open_:
        tree.append((-1, depth + mean_path(len(rows)), at, at))
        return at
    feature = open_[rng.integers(len(open_))]
    split = rng.uniform(low[feature], high[feature])
    left = rows[:, feature] < split
    tree.append(None)
    tree[at] = (
        feature, split, grow(rows[left], rng, limit, tree, depth + 1), grow(rows[~left], rng, limit, tree, depth + 1)
    )
    return at


def mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 2:
        return float(max(0, n - 1))
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def forest(rows, trees: int = TREES, subsample: int = TREE_SAMPLE, seed: int = SEED) -> list[list[tuple]]:
    import numpy as np

    rng = np.random.default_rng(seed)
    size = min(subsample, len(rows))
    limit = math.ceil(math.log2(max(2, size)))
    out = []
    for _ in range(trees if size else 0):
        tree: list = []
        grow(rows[rng.choice(len(rows), size, replace=False)], rng, limit, tree)
        out.append(tree)
    return out


def anomaly(rows, trees: list[list[tuple]], subsample: int):
    """2 ** -(mean path / expected path), between 0 and 1; 0 with no trees."""
    import numpy as np

    if not trees or not len(rows):
        return np.zeros(len(rows))
    total = np.zeros(len(rows))
    for tree in trees:
        feature, split, left, right = (np.array(c) for c in zip(*tree))
        at = np.zeros(len(rows), np.int64)
        inner = np.flatnonzero(feature[at] >= 0)
        while len(inner):
            node = at[inner]
            at[inner] = np.where(rows[inner, feature[node]] < split[node], left[node], right[node])
            inner = inner[feature[at[inner]] >= 0]
        total += split[at]
    return 2.0 ** -(total / len(trees) / max(mean_path(subsample), 1e-9))


def features_of(batch):
    """The features of an Arrow batch, a row for each document."""
    import numpy as np

    return np.column_stack([batch[name].to_numpy(zero_copy_only=False) for name in FEATURES]).astype(np.float64)


def calibrate(scores, labels, good_loss: float = GOOD_LOSS) -> float:
    """The threshold above which documents are rejected; 2 (never) where nothing is gained."""
    import numpy as np

    good, bad = np.sort(scores[labels == 1]), np.sort(scores[labels == 0])
    if not len(good) or not len(bad):
        return 2.0
    at = np.unique(scores)
    lost = 1 - np.searchsorted(good, at, "left") / len(good)
    gained = 1 - np.searchsorted(bad, at, "left") / len(bad)
    gain = np.where(lost <= good_loss, gained - lost, -1)
    best = int(gain.argmax())
    return float(at[best]) if gain[best] > 0 else 2.0


def calibrated(levels: DataFrame, good_loss: float = GOOD_LOSS) -> float:
    """:func:`calibrate` over any number of scores: ``levels`` holds every score once, with its ``good`` and ``bad`` documents."""
    levels = levels.withColumn("bucket", F.floor(F.col("score") * BUCKETS))
    sums = levels.groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()  # at most BUCKETS + 1
    before, n_good, n_bad = [], 0, 0
    for row in sorted(sums):
        before.append((row["bucket"], n_good, n_bad))
        n_good, n_bad = n_good + row["good"], n_bad + row["bad"]
    if not n_good or not n_bad:
        return 2.0
    known = levels.sparkSession.createDataFrame(before, "bucket long, good_before long, bad_before long")
    lower = Window.partitionBy("bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    reached = lambda c, n: 1 - (F.coalesce(F.sum(c).over(lower), F.lit(0)) + F.col(f"{c}_before")) / F.lit(n)
    found = levels.join(F.broadcast(known), "bucket").select("score", reached("good", n_good).alias("lost"), reached("bad", n_bad).alias("gained"))
    best = found.filter(F.col("lost") <= good_loss).agg(
        F.max(F.struct((F.col("gained") - F.col("lost")).alias("gain"), (-F.col("score")).alias("low"))).alias("best")).collect()[0]["best"]
    return -best["low"] if best and best["gain"] > 0 else 2.0


class Rules:
    """A forest with its threshold."""

    def __init__(self, trees: list, subsample: int, threshold: float):
        self.trees, self.subsample, self.threshold = trees, subsample, threshold

    @classmethod
    def learn(
        cls, docs: DataFrame, labels: DataFrame, trees: int = TREES, subsample: int = TREE_SAMPLE, good_loss: float = GOOD_LOSS,
        seed: int = SEED,
    ) -> Rules:
        """Learn from the documents that are not held out: as many rows as the trees hold go to the driver, all are scored."""
        import numpy as np

        shelf = Shelf(docs.sparkSession, "quality")
        learning = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & ~held_out())
        learning = shelf.keep(statistics(learning).filter("not base_failed").select("doc_id", *FEATURES), "statistics")
        rows = sample_by_hash(learning, trees * subsample, seed).toPandas().sort_values(["doc_id", *FEATURES])
        grown = forest(rows[list(FEATURES)].to_numpy(dtype=np.float64), trees, subsample, seed)
        size = min(subsample, len(rows))

        def score(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch["label"], pa.array(anomaly(features_of(batch), grown, size))], ["label", "score"])

        labelled = learning.join(one_label(labels, "quality"), "doc_id").select("label", *FEATURES)
        levels = map_batches(labelled, score, "label int, score double").groupBy("score").agg(
            F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
        levels = shelf.keep(levels, "levels")
        threshold = calibrated(levels, good_loss)
        shelf.close()
        return cls(grown, size, threshold)

    def judge(self, docs: DataFrame) -> DataFrame:
        """The counts, base_failed, kept, and the anomaly score with the threshold it is held against."""
        kind = kind_of(docs, "doc_id")
        schema = f"doc_id {kind}, {COUNTS}, base_failed boolean, kept boolean, anomaly double, threshold double"
        trees, subsample, threshold = self.trees, self.subsample, self.threshold

        def score(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                value = anomaly(features_of(batch), trees, subsample)
                failed = batch["base_failed"].to_numpy(zero_copy_only=False).astype(bool)
                counts = [batch[name.split()[0]] for name in COUNTS.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], *counts, batch["base_failed"], pa.array(~failed & (value < threshold)), pa.array(value),
                     pa.array(np.full(len(value), threshold))],
                    ["doc_id", *(name.split()[0] for name in COUNTS.split(", ")), "base_failed", "kept", "anomaly", "threshold"],
                )

        return map_batches(statistics(docs), score, schema)


def op5_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return Rules.learn(docs, read(spark, sf_dir, "labels")).judge(docs)
