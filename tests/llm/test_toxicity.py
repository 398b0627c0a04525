import numpy as np

from tests.llm.rows import documents, edge_rows, labels, prose
from visitlens.llm import toxicity
from visitlens.llm.common import read


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(3)
    dense = rng.random((300, 40)) * (rng.random((300, 40)) < 0.2)
    dense[10] = dense[200]
    dense[5] = 0
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    sparse = [dict(zip(np.flatnonzero(v).tolist(), v[v > 0].tolist())) for v in dense]
    index = toxicity.BlockMax(sparse, 40, block=16)
    for number, vector in enumerate(sparse):
        for without in (-1, number):
            numbers, cosines = index.nearest(vector, 7, without)
            if not vector:
                assert len(numbers) == 0
                continue
            scores = np.round(dense @ dense[number], 9)
            if without >= 0:
                scores[without] = -1
            order = np.lexsort((np.arange(300), -scores))[:7]
            assert np.allclose(cosines, scores[order], atol=1e-8)
            assert numbers.tolist() == order.tolist()


def test_isotonic_is_the_nearest_monotone_function():
    points = toxicity.isotonic([0.1, 0.2, 0.3, 0.4, 0.4], [0, 1, 0, 1, 1], [1, 1, 1, 1, 1])
    assert points == [(0.1, 0.0), (0.2, 0.5), (0.3, 0.5), (0.4, 1.0)]


def test_labels_are_learned_from_rows_not_held_out_and_awkward_rows(spark):
    rows = [(i, prose(i, 60) + (" you vile troll" if i % 3 == 0 else "")) for i in range(120)]
    docs = documents(spark, rows)
    known = labels(spark, [(i, 1, int(i % 3 == 0)) for i in range(120)] + [(0, 1, 1), (1, 1, None), (None, 1, 1), (999, 1, 1)])
    model = toxicity.Model.learn(docs, known, block=8)
    assert all(zlib_crc(i) % 5 for i in model.ids)
    found = {r["doc_id"]: r for r in model.score(docs).collect()}
    assert all(found[i]["predicted"] == int(i % 3 == 0) for i in range(120))
    assert all(found[i]["held_out"] == (zlib_crc(i) % 5 == 0) for i in range(120))
    edges = model.score(documents(spark, edge_rows())).collect()
    assert len(edges) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in edges)
    assert {r["score"] for r in edges if r["doc_id"] in (2, 3, 4)} == {model.prior}
    kept = model.clean(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(120) if i % 3]
    assert model.score(docs.limit(0)).collect() == []
    for none in (labels(spark, []), labels(spark, [(1, 1, 0)])):
        assert {r["predicted"] for r in toxicity.Model.learn(docs, none).score(docs).collect()} == {0}


def zlib_crc(i: int) -> int:
    import zlib

    return zlib.crc32(str(i).encode())


def test_held_out_accuracy(spark):
    found = toxicity.op1_block_max_toxicity(spark, "/root/testdata/sf0.1").filter("held_out")
    rows = found.join(read(spark, "/root/testdata/sf0.1", "labels"), "doc_id").select("toxic", "predicted").collect()
    toxic, clean = ([r["predicted"] for r in rows if r["toxic"] == t] for t in (1, 0))
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.01


def test_every_telling_term_has_a_dimension(spark):
    rows = [(i, prose(i, 20) + (f" xq{i // 2 % 300}z" if i % 2 else ""), i % 2) for i in range(3000)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int")
    terms = set(toxicity.learn_terms(sample))
    assert {f"=xq{i}z" for i in range(300)} <= terms


def test_document_frequencies_are_those_of_all_documents(spark):
    rows = [(i, prose(i, 20) + (" vile vile" if i % 20 == 0 else "")) for i in range(400)] + [(500, None), (501, "")]
    known = labels(spark, [(i, 1, int(i % 20 == 0)) for i in range(0, 400, 10)])
    model = toxicity.Model.learn(documents(spark, rows), known, block=8)
    assert np.isclose(dict(model.terms)["=vile"], np.log(403 / 21) + 1)
    assert np.isclose(model.shared, np.log(403 / 401) + 1)
