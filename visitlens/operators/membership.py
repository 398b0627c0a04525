"""A filter of session ids that travels to the action scan where the ids themselves are too many to.

A table of blocks, each of LANES words of 64 bits. An id sets one bit in every word of one block; an action whose
session does not find all its bits is none of a chosen session and goes no further. No chosen session is ever
lost; of the others about one in a hundred passes (at BITS_PER_ID), and an exact join after the filter drops it.

The words are combined by ``bit_or``, so building it sends at most one row a block and task. A block is one row
of fixed width; MOST_BLOCKS of them are some 100 MB and serve some 45 million sessions. Beyond that there
is no filter: callers then go without, which changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.operators.bounds import reshuffled

LANES = 8
WORD_BITS = 64
BITS_PER_ID = 12
MOST_BLOCKS = 1 << 20
KEY = ("session_id",)
_WORDS = [f"_word{lane}" for lane in range(LANES)]


def blocks_for(n_ids: int) -> int:
    """The least power of two with BITS_PER_ID bits for each id."""
    needed = max(1, -(-n_ids * BITS_PER_ID // (LANES * WORD_BITS)))
    return 1 << (needed - 1).bit_length()


def fits(n_ids: int) -> bool:
    return blocks_for(n_ids) <= MOST_BLOCKS


def _block(keys: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks))


def _bits(keys: Sequence[str]) -> list[Column]:
    """One set bit for every word of the key's block, from six bits each of a second hash."""
    other = F.xxhash64(*keys, F.lit(1))
    return [
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(other, 6 * lane).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int"))
        for lane in range(LANES)
    ]


def filter_of(ids: DataFrame, n_ids: int, keys: Sequence[str] = KEY) -> DataFrame:
    """The blocks of a filter of the ``n_ids`` values of ``keys`` (an upper bound; more only let more others
    pass): a row for every block that has one. A null is no id. Key columns have the same types on both sides."""
    ids = ids.dropna(subset=list(keys))
    bits = ids.select(_block(keys, blocks_for(n_ids)).alias("_block"), *[b.alias(w) for b, w in zip(_bits(keys), _WORDS)])
    return bits.groupBy("_block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])


def may_be_in(rows: DataFrame, blocks: DataFrame, n_ids: int, keys: Sequence[str] = KEY) -> DataFrame:
    """``rows`` without most of those whose key is not in the filter, none of the others dropped.

    A broadcast join on the block number, which is below MOST_BLOCKS: the rows are not shuffled.
    """
    if not fits(n_ids):
        return rows
    found = F.broadcast(blocks.withColumnRenamed("_block", "_of"))
    has_all = _block(keys, blocks_for(n_ids)) == F.col("_of")
    for bit, word in zip(_bits(keys), _WORDS):
        has_all &= F.col(word).bitwiseAND(bit) != 0
    return rows.join(found, has_all, "left_semi")


def chosen_actions(actions: DataFrame, sessions: DataFrame, n_sessions: int) -> DataFrame:
    """Actions of the given sessions, each once: those the filter lets pass are joined exactly.

    ``sessions`` (one row each, ``n_sessions`` or fewer) is read twice and should be a kept table. For a
    bounded choice of sessions :func:`~visitlens.operators.details.details_of` needs no filter.
    """
    ids = sessions.select("session_id")
    passed = may_be_in(actions, filter_of(ids, n_sessions), n_sessions) if fits(n_sessions) else actions
    return passed.join(reshuffled(ids), "session_id", "left_semi")
