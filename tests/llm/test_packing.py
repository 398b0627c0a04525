from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.rows import documents, edge_rows, prose
from visitlens.llm import packing


def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [e.ids + [0] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@given(st.text(alphabet=st.sampled_from("ab \n\t.é日'<|endoftext>0"), max_size=40))
@settings(max_examples=200, deadline=None)
def test_word_cache_changes_no_id(text):
    encode = test_word_cache_changes_no_id.__dict__.setdefault("encode", packing.word_encoder(packing.ranks_path()))
    assert np.frombuffer(encode(text), "<u4").tolist() == reference_ids([text])[0][:-1]


def test_cut_leaves_the_first_piece_shorter():
    assert packing.cut(5, 8) == [(0, 5)]
    assert packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(20, 8) == [(0, 4), (4, 8), (12, 8)]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_no_constraint_is_broken(rule):
    lengths = np.array(sorted([7, 7, 5, 5, 4, 3, 3, 2, 2, 1, 1, 1], reverse=True))
    bins = packing.best_fit(lengths, 10, 3, 80.0, (1.0, 1.0, 1.0), rule)
    for number in set(bins.tolist()):
        inside = lengths[bins == number]
        assert inside.sum() <= 10 and len(inside) <= 3 and (inside**2).sum() <= 80


def check(spark, rows, most, **options):
    docs = documents(spark, rows)
    placed = packing.pack(spark, docs, most=most, **options).collect()
    texts = [text or "" for _, text in rows]
    expected = []
    for (doc_id, _), ids in zip(rows, reference_ids(texts)):
        for number, (start, length) in enumerate(packing.cut(len(ids), most)):
            expected.append((doc_id, number, start, length, crc32(np.array(ids[start:start + length], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in placed), key=repr) == sorted(expected, key=repr)
    sequences = {}
    for row in placed:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    return len(sequences), sum(e[3] for e in expected)


def test_pieces_and_places_on_awkward_rows(spark):
    check(spark, edge_rows(), 64)


def test_few_sequences_are_wasted_over_several_groups(spark):
    rows = [(i, prose(i, 1 + i * 13 % 97)) for i in range(400)]
    used, tokens = check(spark, rows, 128, group_pieces=100)
    assert used <= 1.05 * tokens / 128 + 2


def test_no_documents(spark):
    assert packing.pack(spark, documents(spark, [])).collect() == []
