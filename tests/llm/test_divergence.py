"""Source divergence against whole-number arithmetic in plain Python, and the query against its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.rows import by_row
from visitlens.llm import divergence

SF = "/root/testdata/sf0.01"
COLUMNS = ("lang", "source", "part", "item", "value", "rank")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_df, top):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = [(a or "", b or "", TERM.findall((t or "").translate(lower))) for a, b, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        often = Counter(w for a, _, words in docs if a == lang for w in set(words))
        kept = [w for w, n in often.items() if n >= min_df]
        counts = defaultdict(Counter)
        for a, source, words in docs:
            if a == lang:
                counts[source].update(w for w in words if w in set(kept))
        def shares(count):
            below = sum(count.values()) + 5 * len(kept)
            return {w: 1 + 10**9 * (count[w] + 5) // below for w in kept}
        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in p:
            pairs = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in p if o != s]
            terms = [(p[s][w] - q[w], w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, cut in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found[:cut], 1)]
    return sorted(out, key=repr)


def table(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    for name in ("doc_id", "language", "terms", "place", "count", "number", "vector", "item"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def made(seed):
    rng = random.Random(seed)
    words = ["The", "the", "naïve", "日本", "end", "Ära", "ära", "x1y", "don't", "_", "rare"]
    rows = []
    for _ in range(120):
        text = None if rng.random() < 0.05 else " ".join(rng.choices(words, k=rng.randrange(0, 12)))
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", "d", "e", None, ""]), text))
    rows += [("one", "s", "word"), ("one", "t", "word"), ("one", "u", None), ("solo", "s", "the")]
    return rows + rows[:10] + [("en", "hot", "the end " * 3000)] * 3


@pytest.mark.parametrize("min_df, tile, width", [(2, 2, 2), (4, 64, 1 << 14), (1000, 3, 1)])
def test_made_tables(spark, min_df, tile, width):
    rows = made(min_df)
    got = by_row(divergence.audit(spark, table(spark, rows), min_df=min_df, top=3, tile=tile, width=width), *COLUMNS)
    assert got == brute(rows, min_df, 3)


def test_texts_are_kept_as_their_terms(spark):
    chars = "".join(map(chr, range(128))) + "ÀÉßİſK\u0130\u212a\u2028\xa0\x85日😀"
    texts = [chars, chars[::-1], "", " ", "-", "A", " Ab,  cD ", "".join(f"a{c}B" for c in chars), "İstanbul İİ", "x" * 70_000 + " Y"]
    rows = spark.createDataFrame([(3, i, t) for i, t in enumerate(texts)], "language int, number int, text string")
    cleaned = divergence.only_terms(rows)
    got = {r["number"]: r["terms"] for r in cleaned.select("number", divergence.terms_of(F.col("text")).alias("terms")).collect()}
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    assert got == {i: TERM.findall(t.translate(lower)) for i, t in enumerate(texts)}
    assert [r["number"] for r in cleaned.where(F.length("text") == 0).collect()] == [2]


def test_empty_table(spark):
    assert divergence.audit(spark, table(spark, [])).count() == 0


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(divergence.ORACLE)
    assert tuple(want.columns) == COLUMNS
    assert by_row(divergence.op12_source_divergence(spark, SF), *COLUMNS) == sorted(want.fetchall(), key=repr)
