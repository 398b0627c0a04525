"""Document fingerprints by one-permutation MinHash, in DataFrame expressions alone.

Every shingle of five words is hashed once. The top bits of the hash choose a bin, and each bin keeps
its least hash. A bin that stayed empty takes the value of another one: it probes the bins in an order
of its own, a full cycle drawn from the bin's hash, until it meets a filled one. The low ``BITS`` bits
of all bins, packed as a hexadecimal string, are the fingerprint. Two of them agree in a share of bins
that exceeds the Jaccard similarity by chance agreement of few bits; the likeness takes that off.

Neighbours by ascending id come from windows over buckets of ids, with bounds at quantiles, so that
buckets hold about equally many rows; each bucket also gets the first row of the next one.

Defined results: a null text counts as empty; texts without words share one fingerprint; texts of one
to four words are one shingle; rows of one id follow each other by text, a null id comes first; a
table of one row is its own next; an empty table gives no rows; columns other than ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.llm.common import read

WORDS = 5
BINS = 256
BITS = 8
QUICK_PROBES = 16
SEPARATORS = r"[\x20\t-\r]+"
BUCKETS_PER_PARTITION = 4
MOST_BUCKETS = 65_536


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """64-bit hashes of all word n-grams, through hashes of the words."""
    split = F.filter(F.split(text, SEPARATORS), lambda w: w != "")
    codes = F.transform(split, lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(1), F.size(h) - (words - 1)), lambda i: F.xxhash64(*(F.element_at(h, i + n) for n in range(words))))
        return F.when(F.size(h) >= words, several).otherwise(F.array(F.xxhash64(h)))

    return let(codes, grams)


def probe_orders(bins: int) -> list[tuple[int, int, int]]:
    """Start, odd stride and the stride's inverse of every bin's probe sequence, fixed by the bin's number."""
    from random import Random

    draw = Random(bins)
    orders = [(draw.randrange(bins), 2 * draw.randrange(bins // 2) + 1) for _ in range(bins)]
    return [(start, stride, pow(stride, -1, bins)) for start, stride in orders]


def dense_bins(hashes: Column, bins: int = BINS, quick: int = QUICK_PROBES) -> Column:
    """The least hash of every bin, in the order of the bins; empty ones hold what their probing meets first.

    ``quick`` probes are looked up one after the other. Where all fail (few bins are filled), the least
    place on the sequence among the filled bins is computed, which gives the same bin.
    """
    shift = 64 - (bins.bit_length() - 1)
    bin_of = lambda x: F.shiftrightunsigned(x, shift).cast("int")
    start, stride, inverse = (F.array(*(F.lit(order[i]) for order in probe_orders(bins))) for i in range(3))
    of = lambda numbers, b: F.element_at(numbers, b + 1)

    # In a sorted array the hashes of a bin are neighbours, least first.
    def firsts(ordered: Column) -> Column:
        return F.filter(
            ordered, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.element_at(ordered, F.greatest(i, F.lit(1))))))

    def densified(values: Column, some: Column) -> Column:
        def probe(b: Column) -> Column:
            met = [F.element_at(values, F.pmod(of(start, b) + of(stride, b) * j, F.lit(bins)) + 1) for j in range(quick)]
            place = F.array_min(F.transform(some, lambda x: F.pmod((bin_of(x) - of(start, b)) * of(inverse, b), F.lit(bins))))
            last = F.element_at(values, F.pmod(of(start, b) + of(stride, b) * place, F.lit(bins)) + 1)
            return F.coalesce(*met, last)

        return F.transform(values, lambda v, b: F.coalesce(v, probe(b)))

    def spread(some: Column) -> Column:
        filled = let(
            F.map_from_arrays(F.transform(some, bin_of), some),
            lambda found: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.element_at(found, b)))
        return let(filled, lambda values: densified(values, some))

    return let(let(F.sort_array(hashes), firsts), spread)


def low_bits(text: Column, words: int = WORDS, bins: int = BINS, bits: int = BITS) -> Column:
    """The low bits of every bin, as an array of numbers."""
    dense = dense_bins(shingle_hashes(text, words), bins)
    return F.transform(dense, lambda v: v.bitwiseAND(F.lit((1 << bits) - 1)))


def packed(values: Column, bits: int = BITS) -> Column:
    """The bits as a hexadecimal string of fixed length."""
    return F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), bits // 4, "0")), "").alias("fingerprint")


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity: share of equal bins, less what few bits agree in by chance."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    chance = 1.0 / (1 << bits)
    return F.greatest(F.lit(0.0), (equal / F.size(a) - chance) / (1 - chance))


def bucket_of(bounds: list[int]) -> Column:
    """Number of bounds below the id, found in two steps of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    width = max(1, round(len(bounds) ** 0.5))
    below = lambda some: F.size(F.filter(some, lambda b: b < F.col("doc_id")))
    coarse = F.array(*(F.lit(b) for b in bounds[width - 1::width]))
    fine = F.array(*(F.array(*(F.lit(b) for b in bounds[at:at + width])) for at in range(0, len(bounds) + 1, width)))
    return let(below(coarse), lambda c: c * width + below(F.element_at(fine, c + 1)))


def with_next(docs: DataFrame, buckets: int | None = None) -> tuple[DataFrame, Window]:
    """Rows ``bucket, ghost, doc_id, text`` and the window in which each row's successor by id follows it.

    A ghost is the first row of the next bucket (after the last: of the first), there to be followed to.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    buckets = buckets or min(MOST_BUCKETS, BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = F.array(*(F.lit(i / buckets) for i in range(1, buckets)))
    found = rows.agg(F.percentile_approx("doc_id", shares, 100 * buckets).alias("b")).collect()[0]["b"] if buckets > 1 else None
    bounds = sorted(set(found or ()))
    keyed = rows.withColumn("bucket", bucket_of(bounds))
    # One row per bucket: its first id, and the bucket before it (before the first: the last).
    line = Window.orderBy("of")
    every = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = keyed.groupBy(F.col("bucket").alias("of")).agg(
        F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("none"))
    heads = heads.select(
        "of", F.when(~F.col("none"), F.col("least")).alias("id"), F.coalesce(F.lag("of").over(line), F.max("of").over(every)).alias("at"))
    ghosts = (
        keyed.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("bucket") == F.col("of")))
        .groupBy("at", "id").agg(F.min("text").alias("text"))
        .select(F.col("at").alias("bucket"), F.lit(1).alias("ghost"), F.col("id").alias("doc_id"), "text")
    )
    both = keyed.select("bucket", F.lit(0).alias("ghost"), "doc_id", "text").unionByName(ghosts)
    return both, Window.partitionBy("bucket").orderBy("ghost", "doc_id", "text")


def fingerprints(docs: DataFrame, words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Fingerprint and word n-gram bins of every document: doc_id, bins, fingerprint."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", low_bits(text, words, bins, bits).alias("bins")).withColumn("fingerprint", packed(F.col("bins"), bits))


def compared(docs: DataFrame, words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and the likeness to that and to the next document."""
    rows, window = with_next(docs)
    size = F.char_length("text")
    quarter = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - quarter), F.substring(F.lead("text").over(window), F.lit(1), quarter))
    rows = rows.withColumn("edited", edited)
    rows = rows.select(
        "bucket", "ghost", "doc_id", "text", size.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        low_bits(F.col("text"), words, bins, bits).alias("bins"),
        F.when(F.col("ghost") == 0, low_bits(F.col("edited"), words, bins, bits)).alias("edited_bins"),
    )
    rows = rows.withColumn("next_bins", F.lead("bins").over(window)).filter("ghost = 0")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", packed(F.col("bins"), bits).alias("fingerprint"),
        packed(F.col("edited_bins"), bits).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins"), bits).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins"), bits).alias("near_next"),
    )


def op3_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(read(spark, sf_dir, "documents"))
