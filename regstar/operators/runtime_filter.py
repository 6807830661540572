"""Runtime filter: the keys of a filtered side as a blocked Bloom filter.

A large side that joins a filtered one is shuffled whole, although few of its
rows find a partner. Here the filtered side is written once and its keys are
put into a Bloom filter of 64-bit words: each key sets ``BITS`` bits of one
word. The filter is one aggregation (``bit_or`` by word, pre-aggregated in each
task), at most ``max_keys * bits_per_key / 64`` rows of two numbers, and so
bounded; it is broadcast and tested on the large side's scan, before any
shuffle. A row without a partner passes by chance (about one in a hundred at 16
bits for a key); the join after it is exact, so the filter changes no result.
With more keys than ``max_keys`` there is no filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.session import cut_lineage

BITS = 4


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _mask(key: Column) -> Column:
    """``BITS`` bits (some may coincide) named by a second hash of the key."""
    h = F.xxhash64(key, F.lit(BITS))
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def may_match(
    rows: DataFrame,
    key: Column,
    side: DataFrame,
    side_key: str,
    *,
    max_keys: int = 2_000_000,
    bits_per_key: int = 16,
) -> tuple[DataFrame, DataFrame]:
    """(``rows`` that may have a partner, ``side`` as written): join the two by
    ``key == side_key`` afterwards. Both keys are of one type. Rows whose key is
    null have no partner and are left out; repeated rows and keys stay as they
    are."""
    table = cut_lineage(side)
    n = table.count()
    if n > max_keys:
        return rows.where(key.isNotNull()), table
    words = max(1, n * bits_per_key // 64)
    held = table.where(F.col(side_key).isNotNull()).select(
        _word(F.col(side_key), words).alias("__word"), _mask(F.col(side_key)).alias("__bits")
    )
    bloom = F.broadcast(held.groupBy("__word").agg(F.bit_or("__bits").alias("__mask")))
    mask = _mask(key)
    passes = (_word(key, words) == F.col("__word")) & (F.col("__mask").bitwiseAND(mask) == mask)
    return rows.where(key.isNotNull()).join(bloom, passes, "left_semi"), table
