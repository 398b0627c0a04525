from array import array
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.rows import documents, edge_rows
from visitlens.llm import pieces


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary()


@given(st.text(alphabet=st.sampled_from("abehlnorstw \n▁é日\U0001f600"), max_size=80))
@settings(max_examples=300, deadline=None)
def test_heap_equals_the_library(text):
    import sentencepiece

    cached = test_heap_equals_the_library.__dict__
    model = cached.setdefault("model", sentencepiece.SentencePieceProcessor(model_file=pieces.model_path()))
    vocabulary = cached.setdefault("vocabulary", pieces.Vocabulary())
    whole = pieces.SPACE + text.replace(" ", pieces.SPACE)
    assert (pieces.heap_merge(whole, vocabulary) if text else []) == model.encode(text)


def awkward():
    more = ["a  b   c\n\td", "▁x ▁▁y", "<s> a</s><unk>", "x" * 300 + " " + "ab" * 100, " " * 70 + "a", "a\u0000b", "aaaaaaaaaaaaaaaaaaa", "http://example.com/" + "q" * 40]
    return [*edge_rows(), *((900 + i, text) for i, text in enumerate(more))]


def test_ids_equal_the_library(spark, model, vocabulary):
    rows = awkward()
    got = pieces.encode(documents(spark, rows).repartition(7), vocabulary).collect()  # several blocks
    assert sorted(((r["doc_id"], list(r["ids"])) for r in got), key=repr) == sorted(((i, model.encode(t or "")) for i, t in rows), key=repr)
    short = pieces.encode(documents(spark, rows), vocabulary, digest=True).collect()
    digests = [(i, len(ids), sum(vocabulary.bytes[0] <= x < vocabulary.bytes[0] + 256 for x in ids), crc32(array("i", ids).tobytes()))
               for i, ids in ((i, model.encode(t or "")) for i, t in rows)]
    assert sorted(map(tuple, short), key=repr) == sorted(digests, key=repr)
    assert pieces.encode(documents(spark, []), vocabulary).collect() == []


def test_whole_table_equals_the_library(spark, model):
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    for row in pieces.op8_relational_lattice(spark, "/root/testdata/sf0.001").collect():
        ids = model.encode(texts.pop(row["doc_id"]) or "")
        assert (row["n_pieces"], row["ids_crc32"]) == (len(ids), crc32(array("i", ids).tobytes()))
    assert texts == {}


def test_round_trip(spark, vocabulary):
    rows = [(i, t) for i, (_, t) in enumerate(awkward()) if "▁" not in (t or "")]
    back = pieces.decode(pieces.encode(documents(spark, rows), vocabulary), vocabulary)
    assert dict(back.collect()) == {i: t or "" for i, t in rows}


def test_repeated_and_null_ids_keep_their_rows(spark, vocabulary):
    rows = [(1, "alpha beta"), (1, "gamma delta"), (1, "alpha beta"), (None, "of no id"), (None, ""), (2, None), (2, "x" * 90)]
    back = pieces.decode(pieces.encode(documents(spark, rows), vocabulary), vocabulary).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


@given(st.text(alphabet=st.sampled_from("abehlnorstw\n.,%#é日\U0001f600"), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_no_merge_crosses_fragments(text):
    vocabulary = test_no_merge_crosses_fragments.__dict__.setdefault("vocabulary", pieces.Vocabulary())
    word = pieces.SPACE + text
    parts = vocabulary.fragments(word)
    assert "".join(parts) == word
    assert sum((pieces.heap_merge(p, vocabulary) for p in parts), []) == pieces.heap_merge(word, vocabulary)


def test_long_texts_and_blocks(spark, model, vocabulary):
    rows = [(0, "word " * 400_000), (1, "y" * 200_000), *((i, f"the {i} " + "word " * (i % 5)) for i in range(2, 40))]
    got = pieces.encode(documents(spark, rows).repartition(5), vocabulary).collect()
    assert sorted((r["doc_id"], list(r["ids"])) for r in got) == [(i, model.encode(t)) for i, t in rows]


def test_every_word_is_folded_once(spark, vocabulary, capsys):
    plan = pieces.encoded_blocks(documents(spark, [(1, "a b")]), vocabulary)
    plan.explain()
    text = capsys.readouterr().out
    assert "CartesianProduct" not in text and text.count("ObjectHashAggregate") <= 2


def test_query_decodes_the_whole_table(spark):
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r["decoded"] for r in pieces.op8_relational_lattice(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: t or "" for i, t in texts.items()}


def test_viterbi_equals_brute_force(spark, vocabulary):
    small = pieces.Vocabulary.__new__(pieces.Vocabulary)
    small.pieces = {"a": (1, -1.0), "b": (2, -1.5), "ab": (3, -1.2), "ba": (4, -2.0), "aba": (5, -3.5), "bb": (6, -0.5)}
    small.bytes, small.longest = {b: 100 + b for b in range(256)}, 3
    words = ["a", "abab", "bbab", "abba", "abc", "babab"]

    def best(word):
        if not word:
            return 0.0, []
        ways = []
        for size in range(1, 4):
            piece = small.pieces.get(word[:size])
            if piece is None and size == 1:
                piece = (100 + ord(word[0]), pieces.UNKNOWN)
            if piece and len(word) >= size:
                score, ids = best(word[size:])
                ways.append((piece[1] + score, [piece[0], *ids]))
        return max(ways)

    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = dict(pieces.encoded_words(df, ["word"], small, "viterbi").collect())
    assert {w: list(ids) for w, ids in got.items()} == {w: best(w)[1] for w in words}


def test_nothing_is_shuffled_or_kept(spark, vocabulary, capsys, monkeypatch):
    monkeypatch.setattr("visitlens.llm.common.Shelf.keep", None)
    plan = pieces.encoded_blocks(documents(spark, [(i, f"a word {i}") for i in range(50)]), vocabulary)
    plan.explain()
    text = capsys.readouterr().out
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and "SinglePartition" not in text
    assert plan.count() == 50


def test_small_blocks_and_folds_equal_the_library(spark, model, vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 1)  # a block of every slice of documents
    monkeypatch.setattr(pieces, "BLOCK_STEP", 7)
    monkeypatch.setattr(pieces, "FOLDED_EDGES", 0)  # a fold after every batch of edges
    long = "ab" * 70
    rows = [(i, None if i % 50 == 0 else f"the {i * 7919} wintering{i % 13}, {long[:i % 140]} \U0001f600{chr(0x3040 + i % 90)}é") for i in range(2500)]
    got = pieces.encode(documents(spark, rows).coalesce(1), vocabulary).collect()
    assert sorted((r["doc_id"], list(r["ids"])) for r in got) == [(i, model.encode(t or "")) for i, t in rows]


def test_folds_by_arrays_and_by_aggregate_agree(spark, vocabulary):
    words = ["▁anonly", "erenesnd", "▁", "▁▁▁", "aaaaaaaaaaaaaaaaaaa", "q" * 60, "日", "\U0001f600", "▁internationalisation"]
    known = dict(pieces.encoded_words(spark.createDataFrame([(w,) for w in words], "word string"), ["word"], vocabulary).collect())
    table = spark.createDataFrame(list(enumerate(words)), "at int, word string").selectExpr("at", "word", "cast(null as binary) as rest")
    found = pieces.packed_edges(table.coalesce(1).sortWithinPartitions("at"), vocabulary).select("span", "id").toArrow()
    import numpy as np

    scores = np.zeros(1 + max(i for i, _ in vocabulary.pieces.values()))
    for i, score in vocabulary.pieces.values():
        scores[i] = score
    sizes, ids = pieces.merge_all(*(c.combine_chunks().to_numpy() for c in found.columns), vocabulary, scores)
    assert [i.tolist() for i in np.split(ids, np.cumsum(sizes)[:-1])] == [list(known[w]) for w in words]
