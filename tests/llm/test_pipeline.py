import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa

import corpus_pipeline
from tests.llm.test_packing import reference_ids
from tests.llm.test_similarity import plain as classes_of
from tests.llm.test_substrings import plain as removed_of
from visitlens.llm import common, packing, personal, toxicity

SF = "/root/testdata/sf0.001"


def test_every_stage_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kinds = docs.columns, docs.dtypes
    (_, toxic), (_, similar), (_, repeats), (_, private), (_, pack) = corpus_pipeline.STAGES
    score = toxicity.Model.learn(docs, spark.read.parquet(f"{SF}/labels.parquet")).scorer()
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}

    one = toxic(spark, docs, SF)
    assert one.columns == columns and one.dtypes == kinds
    rows = {i: t for i, t in rows.items() if score(t)[0] < 0.5}
    assert {r["doc_id"]: r["text"] for r in one.collect()} == rows

    two = similar(spark, one, SF)
    assert two.dtypes == kinds
    heads = {c for _, c, _ in classes_of(list(rows.items()))}
    rows = {i: t for i, t in rows.items() if i in heads}
    assert {r["doc_id"]: r["text"] for r in two.collect()} == rows

    three = repeats(spark, two, SF)
    assert three.dtypes == kinds
    sizes = {r[0]: r for r in removed_of(list(rows.items()), 200)}
    kept = {r["doc_id"]: r for r in three.collect()}
    assert set(kept) == {i for i, r in sizes.items() if r[1] == 0 or r[2] < r[1]}
    windows = Counter(raw[at:at + 200] for raw in (t.encode() for t in rows.values()) for at in range(len(raw) - 199))
    for i, row in kept.items():
        assert (row["text"] == rows[i]) == (sizes[i][2] == 0)
        assert row["n_chars"] == len(row["text"])
        assert len(row["text"].encode()) <= sizes[i][1] - sizes[i][2]
    assert max(windows.values()) > 1

    four = private(spark, three, SF)
    assert four.dtypes == kinds
    last = {r["doc_id"]: r["text"] for r in four.collect()}
    field = personal.learn(three)
    assert last == {i: personal.redact(r["text"], personal.find(r["text"], field)[1]) for i, r in kept.items()}
    assert not any(re.search(r"[a-z0-9]@mail", text) for text in last.values())

    expected = []
    for i, ids in zip(last, reference_ids(list(last.values()))):
        for number, (start, length) in enumerate(packing.cut(len(ids), 2048)):
            expected.append((i, number, start, length, crc32(np.array(ids[start:start + length], "<u4").tobytes())))
    assert sorted(tuple(r)[:5] for r in pack(spark, four, SF).collect()) == sorted(expected)
    assert sorted(tuple(r)[:5] for r in corpus_pipeline.run(spark, SF).collect()) == sorted(expected)


def test_stages_take_empty_tables_and_other_columns(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30).withColumn("token", F.lit(1)).withColumn("text", F.expr("if(doc_id % 7 = 0, null, text)"))
    for some in (docs, docs.limit(0), docs.drop("n_chars")):
        now = some
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == some.columns, name
        assert (corpus_pipeline.STAGES[-1][1](spark, now, SF).count() > 0) == (some.count() > 0)


def test_batches_are_cut_by_rows_and_bytes():
    """Rows stay in order; only a row that is larger by itself exceeds the bound."""
    texts = ["x" * (2_000_000 if i % 300 == 0 else i % 7) for i in range(2500)]
    batch = pa.RecordBatch.from_pydict({"i": list(range(2500)), "text": texts})
    parts = list(common.slices(batch))
    assert [t for part in parts for t in part["text"].to_pylist()] == texts
    assert all(part.num_rows <= common.BATCH_ROWS and (part.num_rows == 1 or part.nbytes <= common.BATCH_BYTES) for part in parts)
    assert list(common.slices(batch.slice(0, 0))) == []


def test_long_texts_keep_their_rows(spark):
    long = "a long line of plain words. " * 75_000
    rows = [(i, (long + str(i), None, "short text")[i % 3], "en") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    kept = personal.redacted(docs, personal.learn(docs))
    assert sorted(map(tuple, kept.collect())) == rows
