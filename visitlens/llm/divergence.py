"""How far the sources of a language differ in their words.

Texts are kept by language as their terms between blanks, one string each: cheaper to write and to read twice
than lists of terms. A CountVectorizer of every language (a term must be in ``min_df`` of its documents; the
vocabulary has no other bound) turns documents into exact sparse vectors. Their entries are summed by (language, source):
a combining sum of fixed-width rows, in which a source with a third of all documents costs one row a term
and task. Smoothed shares of a source and of a language are whole numbers out of 10^9.

Pairs of sources are compared in blocks of terms and tiles of sources: a task holds at most 2 x ``tile``
rows of ``width`` terms, of which only those columns are laid out that one of its sources uses. All other
terms have each source's share of an unused term, and are added as one product.

Defined results: null text, lang and source are read as empty texts; each repeated row is a document; a
language without kept terms has pairs of value 0 and no terms; an empty table gives no rows; other columns
are ignored. Ties go to the lower item in UTF-8 order.

A vocabulary is held by the driver and sent to the tasks, as CountVectorizer does: ``min_df`` is what bounds
it. Languages are taken one after the other.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.llm.common import Shelf, map_batches, read
from visitlens.operators.bounds import broadcast_if

MIN_DF = 30
VOCABULARY = 2**31 - 1
SCALE = 1_000_000_000
SMOOTH = 5
TOP_TERMS = 50
TILE = 64
WIDTH = 1 << 14

# UTF-8 bytes: letters in lower case, those beyond ASCII as they are, all others a blank.
TERM_BYTES = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b) in string.ascii_letters else 32 for b in range(256))


def only_terms(docs: DataFrame) -> DataFrame:
    """language, number, text: only the letters (A-Z lower-cased) and the characters beyond ASCII, all others as blanks."""
    def clean(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [text.translate(TERM_BYTES) for text in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["language"], batch["number"], pa.array(texts, pa.binary()).view(pa.string())], ["language", "number", "text"])

    return map_batches(docs.select("language", "number", "text"), clean, "language int, number int, text string")


def terms_of(text: Column) -> Column:
    """The terms of a text that :func:`only_terms` made."""
    return F.array_remove(F.split(text, " "), "")


def share(count: str | Column, total: str | Column, n_terms: str | Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * n_terms)), exact."""
    def exact(x, kind: str) -> Column:
        return (F.col(x) if isinstance(x, str) else x).cast(kind)

    above = F.lit(SCALE).cast("decimal(10,0)") * (exact(count, "decimal(20,0)") + SMOOTH)
    below = exact(total, "decimal(20,0)") + exact(n_terms, "decimal(12,0)") * SMOOTH
    return F.lit(1) + F.call_function("div", above, below)


class Sums:
    """Occurrences of the kept terms by source.

    ``groups``: language, number, lang, source: all that occur, the languages numbered, and the sources in
    each; ``counts``: language, number, place, count (above 0); ``terms``: language, place, term; ``sizes``:
    language, n_terms.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, shelf: Shelf, min_df: int):
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
        docs = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").alias("text"))
        groups = docs.select("lang", "source").distinct()
        langs = sorted(row["lang"] for row in groups.select("lang").distinct().collect())
        names = spark.createDataFrame(list(enumerate(langs)), "language int, lang string")
        number = F.row_number().over(Window.partitionBy("language").orderBy("source")) - 1
        self.groups = shelf.keep(groups.join(F.broadcast(names), "lang").select("language", number.alias("number"), "lang", "source"), "groups")
        texts = shelf.keep(only_terms(docs.join(broadcast_if(self.groups, self.groups.count()), ["lang", "source"])), "texts", "language")
        counts, terms, sizes = [], [], []
        for language in range(len(langs)):
            part = texts.where(F.col("language") == language).select("number", terms_of(F.col("text")).alias("terms"))
            vectors = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=VOCABULARY)
            model = vectors.fit(part)
            entries = model.transform(part).select("number", F.unwrap_udt("vector").alias("v")).select(
                "number", F.inline(F.arrays_zip(F.col("v.indices").alias("place"), F.col("v.values").alias("times"))))
            entries = entries.groupBy("number", "place").agg(F.sum(F.col("times").cast("bigint")).alias("count"))
            counts.append(shelf.keep(entries.select(F.lit(language).alias("language"), "number", "place", "count"), "counts"))
            found = [(language, place, term) for place, term in enumerate(model.vocabulary)]
            terms.append(shelf.keep(spark.createDataFrame(found, "language int, place int, term string"), "terms"))
            sizes.append((language, len(found)))
        self.counts = _all(counts, spark, "language int, number int, place int, count bigint")
        self.terms = _all(terms, spark, "language int, place int, term string")
        self.sizes = spark.createDataFrame(sizes, "language int, n_terms int")


def _all(frames: list[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    every = spark.createDataFrame([], schema)
    for frame in frames:
        every = every.unionByName(frame)
    return every


def shares(sums: Sums) -> tuple[DataFrame, DataFrame]:
    """Of groups (n_terms, total, ``unused``: the share of a term they lack), and of their terms (language,
    number, place, p)."""
    totals = sums.counts.groupBy("language", "number").agg(F.sum("count").alias("total"))
    groups = (
        sums.groups.join(totals, ["language", "number"], "left").fillna({"total": 0})
        .join(F.broadcast(sums.sizes), "language")
        .withColumn("unused", F.when(F.col("n_terms") > 0, share(F.lit(0), "total", "n_terms")).otherwise(F.lit(0)).cast("bigint"))
    )
    used = sums.counts.join(groups.select("language", "number", "total", "n_terms"), ["language", "number"])
    return groups, used.select("language", "number", "place", share("count", "total", "n_terms").alias("p"))


def distances(groups: DataFrame, used: DataFrame, tile: int = TILE, width: int = WIDTH) -> DataFrame:
    """language, one, other (numbers of sources), value: summed differences of their shares of all terms."""
    blocks = F.expr(f"cast(sequence(0, greatest(n_terms - 1, 0) div {width}) as array<int>)")
    every = groups.select("language", "number", "unused", F.explode(blocks).alias("block"))
    parts = used.groupBy("language", "number", F.expr(f"cast(place div {width} as int)").alias("block")).agg(
        F.collect_list(F.struct("place", "p")).alias("entries"))
    tiles = groups.groupBy("language").agg((F.max("number") / F.lit(tile)).cast("int").alias("last"))
    here = (F.col("number") / F.lit(tile)).cast("int")
    rows = every.join(parts, ["language", "number", "block"], "left").join(F.broadcast(tiles), "language").select(
        "language", "block", "number", "unused", "entries",
        F.explode(F.sequence(F.lit(0), F.col("last"))).alias("with"), here.alias("tile"))
    rows = rows.select("language", "block", "number", "unused", F.col("entries.place").alias("places"), F.col("entries.p").alias("shares"),
                       F.least("tile", "with").alias("a"), F.greatest("tile", "with").alias("b"))

    def compare(key, rows):
        import numpy as np
        import pandas as pd

        number, unused = rows["number"].to_numpy(), rows["unused"].to_numpy()
        places = [np.empty(0, np.int64) if p is None else np.asarray(p) for p in rows["places"]]
        columns = np.unique(np.concatenate(places))
        table = np.repeat(unused[:, None], len(columns), axis=1)
        for row, (at, p) in enumerate(zip(places, rows["shares"])):
            if len(at):
                table[row, np.searchsorted(columns, at)] = p
        of, found = number // tile, []
        for row in range(len(number)):
            others = np.flatnonzero(of != of[row]) if key[2] != key[3] else np.flatnonzero(number != number[row])
            value = np.abs(table[others] - table[row]).sum(axis=1) - len(columns) * np.abs(unused[others] - unused[row])
            found.append(pd.DataFrame({"language": key[0], "one": number[row], "other": number[others], "value": value}))
        return pd.concat(found)

    parts = rows.groupBy("language", "block", "a", "b").applyInPandas(compare, "language int, one int, other int, value bigint")
    used_alone = parts.groupBy("language", "one", "other").agg(F.sum("value").alias("value"))
    ends = groups.select("language", "number", "unused", "n_terms")
    return (
        used_alone.join(ends.withColumnsRenamed({"number": "one", "unused": "u1"}), ["language", "one"])
        .join(ends.drop("n_terms").withColumnsRenamed({"number": "other", "unused": "u2"}), ["language", "other"])
        .select("language", "one", "other", (F.col("value") + F.col("n_terms") * F.abs(F.col("u1") - F.col("u2"))).alias("value"))
    )


def telling_terms(sums: Sums, used: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """language, number, item, value, rank: terms a source has more often than its language, the first ``top``."""
    by_term = sums.counts.groupBy("language", "place").agg(F.sum("count").alias("count"))
    totals = by_term.groupBy("language").agg(F.sum("count").alias("total"))
    common = by_term.join(F.broadcast(totals), "language").join(F.broadcast(sums.sizes), "language").select(
        "language", "place", share("count", "total", "n_terms").alias("q"))
    found = used.join(common, ["language", "place"]).filter("p > q").join(sums.terms, ["language", "place"])
    order = Window.partitionBy("language", "number").orderBy(F.desc("value"), "item")
    found = found.select("language", "number", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def audit(spark: SparkSession, docs: DataFrame, min_df: int = MIN_DF, top: int = TOP_TERMS, tile: int = TILE, width: int = WIDTH) -> DataFrame:
    """lang, source, part, item, value, rank.

    ``pair``: the distance to each other source of the language, all of them; ``term``: the terms a source
    has more often than its language, the first ``top``.
    """
    shelf = Shelf(spark, "divergence")
    sums = Sums(spark, docs, shelf, min_df)
    groups, used = shares(sums)
    groups, used = shelf.keep(groups, "shares"), shelf.keep(used, "used")
    pairs = distances(groups, used, tile, width)
    pairs = pairs.join(groups.select("language", F.col("number").alias("other"), F.col("source").alias("item")), ["language", "other"])
    order = Window.partitionBy("language", "one").orderBy(F.desc("value"), "item")
    pairs = pairs.select("language", F.col("one").alias("number"), F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    terms = telling_terms(sums, used, top).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).join(groups.select("language", "number", "lang", "source"), ["language", "number"]).select(
        "lang", "source", "part", "item", "value", "rank")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, read(spark, sf_dir, "documents"))


# Text cells are read as the query reads them; all arithmetic is on whole numbers.
ORACLE = rf"""
with d as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text
  from documents
), t as (
  select id, lang, source,
    unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from d
), kept as (
  select lang, term from t group by lang, term having count(distinct id) >= {MIN_DF}
), sized as (
  select l.lang, count(k.term) as v from (select distinct lang from d) l left join kept k using (lang) group by l.lang
), g as (
  select distinct lang, source from d
), every as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n
  from g join kept k using (lang) left join (select lang, source, term, count(*) as n from t group by all) c using (lang, source, term)
), p as (
  select lang, source, term, n, 1 + ({SCALE}::hugeint * (n + {SMOOTH})) // (sum(n) over (partition by lang, source) + {SMOOTH} * v) as p
  from every join sized using (lang)
), q as (
  select lang, term, 1 + ({SCALE}::hugeint * (n + {SMOOTH})) // (sum(n) over (partition by lang) + {SMOOTH} * v) as q
  from (select lang, term, sum(n) as n from every group by all) join sized using (lang)
), pairs as (
  select a.lang, a.source, b.source as item, sum(abs(x.p - y.p)) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
    left join p x on x.lang = a.lang and x.source = a.source
    left join p y on y.lang = a.lang and y.source = b.source and y.term = x.term
  group by all
), found as (
  select lang, source, 'pair' as part, item, coalesce(value, 0)::bigint as value from pairs
  union all
  select lang, source, 'term', term, (p - q)::bigint from p join q using (lang, term) where n > 0 and p > q
)
select lang, source, part, item, value, rank::int as rank from (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found
) where part = 'pair' or rank <= {TOP_TERMS}
"""
