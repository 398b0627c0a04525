import hashlib
from collections import Counter

import pytest

from tests.llm.rows import documents, edge_rows, prose
from visitlens.llm import substrings


def plain(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(raw[at:at + length] for _, raw in raws for at in range(len(raw) - length + 1))
    out = []
    for doc_id, raw in raws:
        mark = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            if counts[raw[at:at + length]] > 1:
                mark[at:at + length] = b"\1" * length
        kept = bytes(c for c, m in zip(raw, mark) if not m)
        spans = sum(m and not (at and mark[at - 1]) for at, m in enumerate(mark))
        out.append((doc_id, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passage_rows():
    shared, other = prose(21, 60), " ".join(f"k{i}" for i in range(90))
    rows = [(100 + i, f"{' '.join(f'a{i}b{k}' for k in range(20 + i))} {shared} {'z' * i}{' '.join(f'c{i}d{k}' for k in range(15))}") for i in range(9)]
    rows += [(200, other + " " + other), (201, "ab" * 400), (202, "xyz" + other[:150]), (203, "é" * 150), (204, "q" + "é" * 150)]
    return rows


@pytest.mark.parametrize("options", [{}, {"task_windows": 40}, {"length": 60, "gram": 20}])
def test_equals_brute_force(spark, options):
    rows = [*edge_rows(), *passage_rows()]
    got = substrings.report(substrings.marked(spark, documents(spark, rows), **options)).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, options.get("length", 200))


def test_chunks_of_long_texts_join_up(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 128)
    rows = passage_rows()
    got = substrings.report(substrings.marked(spark, documents(spark, rows))).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 200)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = substrings.op2_prefix_doubling(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got), key=repr) == plain([tuple(r) for r in docs.collect()], 200)


def test_texts_without_repeats(spark):
    rows = [*edge_rows(), *passage_rows()]
    docs = documents(spark, rows)
    kept = substrings.without_repeats(spark, docs)
    assert kept.columns == docs.columns
    expected = []
    for doc_id, size, removed, _, digest in plain(rows, 200):
        if size == 0 or removed < size:
            expected.append((doc_id, digest if removed else None))
    texts = {}
    for row in kept.collect():
        texts.setdefault(row["doc_id"], []).append(row["text"])
    assert sorted(str(i) for i, _ in expected) == sorted(str(i) for i, some in texts.items() for _ in some)
    for doc_id, digest in expected:
        if digest and doc_id != 203 and doc_id != 204:
            assert digest in [hashlib.sha256((t or "").encode()).hexdigest() for t in texts[doc_id]]
    assert substrings.report(substrings.marked(spark, documents(spark, []))).collect() == []


UNDERSCORED = ("_key", "_raw", "_cuts", "_whole", "_copied", "_parts", "_lead", "_id", "_k1", "_k2", "rest", "none", "a.b", "parts", "row")


def test_columns_of_any_name_stay_as_they_are(spark):
    """Columns with the names that the operators use inside, here and in the join, are carried through."""
    from pyspark.sql import functions as F

    from visitlens.llm.similarity import one_of_each

    rows = [*edge_rows(), (20, prose(4, 90) + " tail"), (21, "head " + prose(4, 90))]
    plain = documents(spark, rows, clashing=False)
    clashing = plain
    for name in UNDERSCORED:
        clashing = clashing.withColumn(name, F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    columns = [F.col(f"`{name}`") for name in plain.columns]
    for stage in (substrings.without_repeats, one_of_each):
        got = stage(spark, clashing)
        assert got.columns == clashing.columns
        assert sorted(got.select(*columns).collect(), key=repr) == sorted(stage(spark, plain).collect(), key=repr)
        assert all(row[name] == f"{name} of {'none' if row['doc_id'] is None else row['doc_id']}" for row in got.collect() for name in UNDERSCORED)
    bare = plain.select("doc_id", "text")
    assert sorted(substrings.without_repeats(spark, bare).collect(), key=repr) == sorted(
        substrings.without_repeats(spark, plain).select("doc_id", "text").collect(), key=repr)
    assert substrings.report(substrings.marked(spark, clashing)).count() == len(rows)
