"""Small documents with every awkward case, and comparison helpers."""

from pyspark.sql import functions as F

WORDS = "the river bends around a hill where old stones keep warm in summer and cold in winter while birds nest above".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] + ("." if i % 9 == 8 else "") for i in range(n))


def edge_rows() -> list[tuple]:
    long_text = prose(3, 4000)
    return [
        (1, prose(1, 80)), (2, None), (3, ""), (4, " \n\t "), (5, "one"), (6, "one two three four"),
        (7, prose(2, 120)), (8, prose(2, 120)), (8, prose(2, 120)), (8, "another text with the same id"), (None, prose(5, 60)),
        (None, None), (9, long_text), (10, "x" * 5000), (11, "naïve ﬁ 日本語 \U0001f600 " * 9), (12, prose(2, 119) + " end"),
    ]


def documents(spark, rows, clashing=True):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    for name in ("label", "tokens", "bucket", "path", "words", "k1", "raw", "held_out", "score", "n", "row", "set", "id") if clashing else ():
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def by_row(df, *columns) -> list[tuple]:
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
