import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.rows import documents, edge_rows, labels
from visitlens.llm import quality
from visitlens.llm.common import read


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


@given(st.text(alphabet=st.sampled_from("ab \n\t\x0b\x0c\r\x1c\xa0#é日|"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_counts_equal_plain_ones(text):
    assert quality.statistics_of(text)[:6] == plain_counts(text)


def test_windows_with_very_many_distinct_words():
    codes = np.arange(10)
    codes[5:8] = codes[:3]
    assert quality.repeated_words(codes, 3_000_000) == quality.repeated_words(codes, 20) == 6


def test_path_lengths_equal_a_walk_down_each_tree():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(200, 3))
    rows[0] = 50
    trees = quality.forest(rows, 30, 64)

    def walk(tree, row):
        node = tree[0]
        while node[0] >= 0:
            node = tree[node[2] if row[node[0]] < node[1] else node[3]]
        return node[1]

    expected = [2 ** -(np.mean([walk(t, row) for t in trees]) / quality.mean_path(64)) for row in rows]
    found = quality.anomaly(rows, trees, 64)
    assert np.allclose(found, expected)
    assert found.argmax() == 0


def test_threshold_keeps_the_good():
    scores, known = np.array([0.1, 0.2, 0.3, 0.8, 0.9, 0.85]), np.array([1, 1, 1, 0, 0, 1])
    assert quality.calibrate(scores, known, good_loss=0.3) == 0.8
    assert quality.calibrate(scores, known, good_loss=0.0) == 0.9
    assert quality.calibrate(scores, np.ones(6)) == 2.0 == quality.calibrate(np.zeros(0), np.zeros(0))


@pytest.mark.parametrize("good_loss", [0.0, 0.1, 0.5])
def test_threshold_in_buckets_equals_the_plain_one(spark, good_loss):
    rng = np.random.default_rng(int(good_loss * 10))
    known = rng.integers(0, 2, 400)
    for scores in (rng.integers(0, 40, 400) / 40 * (1 - known * 0.3), 0.5 + rng.random(400) / quality.BUCKETS / 50, np.full(400, 0.4)):
        rows = spark.createDataFrame([(float(s), int(k)) for s, k in zip(scores, known)], "score double, label int")
        levels = rows.groupBy("score").agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
        assert quality.calibrated(levels, good_loss) == quality.calibrate(scores, known, good_loss)
        assert quality.calibrated(levels.withColumn("bad", F.lit(0)), good_loss) == 2.0
    assert quality.calibrated(levels.limit(0), good_loss) == 2.0


def test_threshold_comes_from_all_labelled_documents(spark):
    rng = np.random.default_rng(3)
    words = np.array(["w" * n + str(i) for i, n in enumerate(rng.integers(1, 9, 300))])
    bad = rng.random(12_000) < 0.3
    rows = [(i, " ".join(rng.choice(words[:60 if b else 300], rng.integers(55, 75))) + "!?#" * int(rng.integers(0, 4 + 3 * b))) for i, b in enumerate(bad)]
    docs, known = documents(spark, rows).repartition(4), labels(spark, [(i, int(not b), 0) for i, b in enumerate(bad)])
    rules = quality.Rules.learn(docs, known, trees=20, subsample=64, good_loss=0.05)
    judged = rules.judge(docs).filter("not base_failed and crc32(cast(doc_id as string)) % 5 != 0").select("doc_id", "anomaly", "kept").toPandas()
    assert len(judged) > 9_000
    scores, good = judged["anomaly"].to_numpy(), ~bad[judged["doc_id"]]
    assert 0 < rules.threshold < 1 and rules.threshold == quality.calibrate(scores, good.astype(int), 0.05)
    assert (judged["kept"].to_numpy() == (scores < rules.threshold)).all()


def test_awkward_rows(spark):
    docs = documents(spark, edge_rows())
    known = labels(spark, [(1, 1, 0), (1, 1, 0), (7, 0, 0), (None, 1, 1), (9, None, None), (77, 1, 0)])
    rows = quality.Rules.learn(docs, known, trees=10, subsample=8).judge(docs).collect()
    expected = sorted(((i, *plain_counts(t or "")) for i, t in edge_rows()), key=repr)
    assert sorted((tuple(r)[:7] for r in rows), key=repr) == expected
    assert not any(r["kept"] for r in rows if r["base_failed"])
    none = documents(spark, [])
    assert quality.Rules.learn(none, labels(spark, [])).judge(none).collect() == []
    assert all(r["kept"] != r["base_failed"] for r in quality.Rules.learn(docs, labels(spark, [])).judge(docs).collect())


def test_held_out_verdicts(spark):
    found = quality.op5_isolation_forest(spark, "/root/testdata/sf0.1")
    found = found.join(read(spark, "/root/testdata/sf0.1", "labels"), "doc_id").filter("crc32(cast(doc_id as string)) % 5 = 0")
    rows = found.filter("not base_failed").select("kept", "quality").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1
