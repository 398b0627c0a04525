import hashlib
import re

import pytest

from tests.llm.rows import documents, edge_rows, prose
from visitlens.llm import fingerprints


def shingles(text):
    words = re.findall(r"[^\x20\t-\r]+", text)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


@pytest.mark.parametrize("partitions", ["1", "4", "9"])
def test_edited_texts_and_likeness(spark, conf, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    rows = [(7 * i - 40, prose(i, 30 + 11 * i % 300)) for i in range(60)] + [(-100, None), (-99, ""), (5000, "é" * 7), (5001, "a b c")]
    texts = dict(rows)
    order = sorted(texts)
    found = {r["doc_id"]: r for r in fingerprints.compared(documents(spark, rows)).collect()}
    assert len(found) == len(rows)
    squares = []
    for i, doc_id in enumerate(order):
        text, after = texts[doc_id] or "", texts[order[(i + 1) % len(order)]] or ""
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + after[:quarter]
        row = found[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        squares += [(row["near_edited"] - jaccard(text, edited)) ** 2, (row["near_next"] - jaccard(text, after)) ** 2]
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert (sum(squares) / len(squares)) ** 0.5 < 0.05
    assert found[-100]["fingerprint"] == found[-99]["fingerprint"]


def test_awkward_rows(spark):
    rows = edge_rows()
    found = fingerprints.compared(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    prints = {}
    for row, (doc_id, text) in ((r, t) for r in found for t in rows if r["doc_id"] == t[0] and r["n_chars"] == len(t[1] or "")):
        prints.setdefault(text or "", set()).add(row["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    alone = fingerprints.compared(documents(spark, [(1, prose(1, 50))])).collect()[0]
    assert alone["near_next"] == 1.0
    assert fingerprints.compared(documents(spark, [])).collect() == []


def test_densification_follows_each_bin_s_probe_sequence(spark):
    from pyspark.sql import functions as F

    hashes = [int.from_bytes(hashlib.sha256(bytes([i])).digest()[:8], "big", signed=True) for i in range(5)]
    df = spark.createDataFrame([(hashes,)], "h array<long>")
    got = df.select(fingerprints.dense_bins(F.col("h"), 64).alias("d")).collect()[0]["d"]
    filled = {}
    for h in hashes:
        b = (h & (2**64 - 1)) >> 58
        filled[b] = min(filled.get(b, h), h)
    for b, (start, stride, _) in enumerate(fingerprints.probe_orders(64)):
        met = b if b in filled else next((start + j * stride) % 64 for j in range(64) if (start + j * stride) % 64 in filled)
        assert got[b] == filled[met]


def test_chance_agreement_is_taken_off(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(400))) for i in range(40)]
    found = fingerprints.compared(documents(spark, rows)).select("near_next").collect()
    assert sum(r["near_next"] for r in found) / 40 < 0.01
    no_python = fingerprints.compared(documents(spark, rows))._jdf.queryExecution().toString()
    assert "Python" not in no_python and "Pandas" not in no_python and "Arrow" not in no_python
