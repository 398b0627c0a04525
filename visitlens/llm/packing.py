"""Best-fit packing of tokenised documents into sequences of a fixed length.

Vector best-fit: every open sequence has three residual capacities (tokens, documents, attention
cost, the sum of squared lengths), and a piece goes to the sequence where a weighted norm of what
would be left is least (or the weighted dot product of piece and residual is largest), among those
where it fits in all three.

Pieces are dealt by hash to groups of bounded size, each packed in one task; sequences a group
leaves loose are opened again and their pieces packed together in a second round.

Defined results: a null text counts as empty; an empty document is the end token alone; repeated
rows are packed each for itself; an empty table gives no rows; columns other than ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import Shelf, ids_and_texts, map_batches, read

MAX_TOKENS = 2048
END_TOKEN = 0
CACHED_WORDS = 300_000
GROUP_PIECES = 4096
LOOSE = 1 / 64
WEIGHTS = (1.0, 0.01, 0.01)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


def ranks_path() -> str:
    """The byte-level BPE vocabulary as ranks: the ids of ``byte_bpe_50k.json``, encoded faster."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def word_encoder(path: str):
    """Text to little-endian 32-bit ids. Ids of words are remembered, up to a bound.

    The pattern never joins characters across a single space, so a text is cut there; texts with
    wider gaps or white space at the end are encoded in one go.
    """
    import base64
    from array import array

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encode = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            ids = self[word] = array("I", encode(" " + word)).tobytes()
            return ids

    words = Words()

    def to_ids(text: str) -> bytes:
        if "  " in text or text[-1:].isspace():
            return array("I", encode(text)).tobytes()
        if len(words) > CACHED_WORDS:
            words.clear()
        head, *rest = text.split(" ")
        return array("I", encode(head)).tobytes() + b"".join(map(words.__getitem__, rest))

    return to_ids


def cut(n_tokens: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of pieces of ``most`` tokens, of which the first may be shorter."""
    first = n_tokens % most or most
    return [(0, first), *((at, most) for at in range(first, n_tokens, most))]


def pieces(docs: DataFrame, path: str | None = None, most: int = MAX_TOKENS) -> DataFrame:
    """One row per piece of each document: place in the document, length, checksum of the ids."""
    path = path or ranks_path()

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        to_ids = word_encoder(path)
        end = END_TOKEN.to_bytes(4, "little")
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = memoryview(to_ids(text) + end)
                for number, (start, length) in enumerate(cut(len(ids) // 4, most)):
                    out.append((doc_id, number, start, length, crc32(ids[4 * start:4 * (start + length)])))
            columns = list(zip(*out)) or [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return map_batches(ids_and_texts(docs), encode, PIECES)


def best_fit(lengths, most: int, max_docs: int, max_cost: float, weights, rule: str = "norm"):
    """Bin number of each piece; ``lengths`` in descending order."""
    import numpy as np

    capacity = np.array([most, max_docs, max_cost], dtype=float)
    scale = np.array(weights, dtype=float) / capacity**2
    room = np.zeros((3, 256))
    labels = np.zeros(256, dtype=np.int64)
    count = opened = 0
    least = int(lengths[-1]) if len(lengths) else 0
    bins = np.empty(len(lengths), dtype=np.int64)
    for place, length in enumerate(lengths):
        need = np.array([length, 1.0, float(length) ** 2])
        left = room[:, :count] - need[:, None]
        fits = np.flatnonzero((left >= 0).all(axis=0))
        if len(fits):
            if rule == "norm":
                best = fits[np.argmin(scale @ left[:, fits] ** 2)]
            else:
                best = fits[np.argmax((scale * need) @ room[:, fits])]
            room[:, best] -= need
        else:
            if count == room.shape[1]:
                room = np.concatenate([room, np.zeros_like(room)], axis=1)
                labels = np.concatenate([labels, np.zeros_like(labels)])
            best, opened = count, opened + 1
            labels[best] = opened - 1
            room[:, best] = capacity - need
            count += 1
        bins[place] = labels[best]
        if (room[:, best] < (least, 1, least**2)).any():  # nothing fits here any more
            count -= 1
            room[:, best], labels[best] = room[:, count], labels[count]
    return bins


def placed(rows: DataFrame, round_: int, n_groups: int, most: int, max_docs: int, max_cost: float, weights, rule: str) -> DataFrame:
    """Pack each of ``n_groups`` hash groups for itself; sequence numbers are unique over groups and rounds."""

    def pack(key, table):
        import numpy as np

        table = table.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        lengths = table["length"].to_numpy()
        bins = best_fit(lengths, most, max_docs, max_cost, weights, rule)
        order = np.argsort(bins, kind="stable")
        table, bins, lengths = table.iloc[order], bins[order], lengths[order]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]][: len(bins)])
        counts = np.diff(np.r_[first, len(bins)])
        table = table.assign(
            sequence_id=(2 * int(key[0]) + round_ << 32) + bins,
            offset=starts - np.repeat(starts[first], counts),
            filled=np.repeat(np.add.reduceat(lengths, first), counts) if len(first) else lengths,
        )
        return table[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "filled"]]

    group = F.pmod(F.xxhash64("doc_id", "piece", F.lit(round_)), F.lit(n_groups))
    return (
        rows.withColumn("grp", group).groupBy("grp")
        .applyInPandas(pack, PLACED + ", filled long")
    )


def pack(
    spark: SparkSession, docs: DataFrame, path: str | None = None, most: int = MAX_TOKENS, max_docs: int | None = None,
    max_cost: float | None = None, weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm",
    group_pieces: int = GROUP_PIECES, loose: float = LOOSE,
) -> DataFrame:
    """Pieces of all documents with their sequence and the place in it.

    ``max_docs`` and ``max_cost`` default to bounds no sequence of ``most`` tokens exceeds.
    """
    max_docs, max_cost = max_docs or most, max_cost or float(most) ** 2
    if max_cost < float(most) ** 2:
        raise ValueError("max_cost must admit one piece of full length")
    shelf = Shelf(spark, "packing")
    every = shelf.keep(pieces(docs, path, most), "pieces")
    full = every.filter(F.col("length") == most)
    short = every.filter(F.col("length") < most)
    limits = (most, max_docs, max_cost, weights, rule)
    first = shelf.keep(placed(short, 0, -(-short.count() // group_pieces) or 1, *limits), "first")
    again = first.filter(F.col("filled") < most * (1 - loose))
    second = placed(
        again.select("doc_id", "piece", "start", "length", "ids_crc32"), 1, -(-again.count() // group_pieces) or 1, *limits
    )
    # A full piece fills a sequence alone; its number is negative, so that it meets no packed one.
    alone = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return (
        first.filter(F.col("filled") >= most * (1 - loose)).drop("filled")
        .unionByName(second.drop("filled")).unionByName(alone)
    )


def op10_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, read(spark, sf_dir, "documents"))
