import numpy as np

from tests.llm.rows import documents, edge_rows, prose
from visitlens.llm import language
from visitlens.llm.common import read

GERMAN = "der fluss biegt um einen berg wo alte steine im sommer warm bleiben und voegel nisten".split()


def test_vectors_are_bound_and_bundled_as_defined():
    vectors = language.Vectors(64, 3, 7)
    grams = language.gram_codes("Ab, c", 3)
    assert [[(g >> 42) & 0x1FFFFF, (g >> 21) & 0x1FFFFF, g & 0x1FFFFF] for g in grams.tolist()] == [
        [0, 97, 98], [97, 98, 0], [98, 0, 99], [0, 99, 0]]
    by_hand = sum(
        np.roll(vectors._letter((g >> 42) & 0x1FFFFF), 2).astype(int) * np.roll(vectors._letter((g >> 21) & 0x1FFFFF), 1)
        * vectors._letter(g & 0x1FFFFF) for g in grams.tolist())
    assert np.allclose(language.bundles(["Ab, c"], vectors, 3)[0], by_hand / np.linalg.norm(by_hand), atol=1e-6)


def test_prediction_and_awkward_rows(spark):
    from pyspark.sql import functions as F

    rows = [(i, prose(i, 40), "en") for i in range(40)]
    rows += [(100 + i, " ".join(GERMAN[(i + j * j) % len(GERMAN)] for j in range(40)), "de") for i in range(40)]
    rows += [(500, "text without a language", None)]
    learn = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    languages, prototypes = language.profiles(learn, dimensions=256)
    assert languages == ["de", "en"]
    found = {r["doc_id"]: r for r in language.predict(learn, languages, prototypes).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows[:80])
    edges = language.predict(documents(spark, edge_rows()), languages, prototypes).collect()
    assert len(edges) == len(edge_rows())
    assert {(r["lang_pred"], r["score"]) for r in edges if r["doc_id"] in (2, 3, 4)} == {("und", 0.0)}
    assert all(0 <= r["score"] <= 1 for r in edges)
    assert {r["lang_pred"] for r in language.predict(learn, [], []).collect()} == {"und"}
    assert language.predict(learn.limit(0), languages, prototypes).collect() == []
    assert language.profiles(learn.withColumn("lang", F.lit(None).cast("string")), dimensions=64) == ([], [])


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    docs = read(spark, "/root/testdata/sf0.01", "documents")
    found = language.op9_hyperdimensional_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    share = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).collect()[0][0]
    assert share > 0.97


def test_slices_of_long_texts_count_every_gram(monkeypatch):
    texts = ["", prose(1, 400), "ein kurzer satz", prose(2, 900), "\u6c34" * 50]
    whole = language.bundles(texts, language.Vectors(64, 3, 7), 3)
    monkeypatch.setattr(language, "SLICE_GRAMS", 37)
    assert np.array_equal(whole, language.bundles(texts, language.Vectors(64, 3, 7), 3))
    monkeypatch.setattr(language, "CHUNK_GRAMS", 1)
    assert np.array_equal(whole, language.bundles(texts, language.Vectors(64, 3, 7), 3))


def test_memory_of_a_text_of_new_letters_is_bounded():
    """The counts of 64 texts with 100,000 n-grams of their own would take 51 MB a kind; a slice of them takes 4."""
    import tracemalloc

    letters = np.random.default_rng(3).integers(0x4E00, 0x9FA5, 100_000)
    texts = ["".join(map(chr, letters)), *["short text"] * 63]
    vectors = language.Vectors(16, 3, 7)
    tracemalloc.start()
    try:
        assert language.bundles(texts, vectors, 3).shape == (64, 16)
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()
