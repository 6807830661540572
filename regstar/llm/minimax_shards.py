"""Sharding by minimax contiguous partition.

Equal texts form an atomic group; groups stand in the order of their text
hash. The shards are contiguous runs of groups, and the largest shard is as
small as any such partition allows: the smallest feasible capacity is found by
binary search, where a capacity is checked greedily (fill a shard until the
next group would not fit), and the groups are cut there.

The list of group sizes is never gathered. The driver holds sums of ranges of
the hash: first 4,096 ranges, then finer ones only where a cut may fall. For a
range that is not opened yet, the check is made once as if it could not be cut
(capacity found: an upper bound) and once as if it could be cut anywhere (a
lower bound). The ranges in which cuts between these bounds may fall are
opened into 256 each, until both bounds agree; a range that holds one group is
never opened. Two or three such passes over (hash, bytes) are usual, and the
ranges held depend on the number of shards, not on the data.

Defined cases: a null text counts as an empty one (size 1, checksum of no
bytes) and is in its group; a null doc_id is placed like any other; repeated
rows share a shard and have slots of their own; fewer groups than shards leave
shards empty; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstar.llm.shared import SharedTables, columns, numbered

KEY_BITS = 63  # of the hash, so that keys are not negative
FIRST_BITS, MORE_BITS = 12, 8


@dataclass
class Ranges:
    """Neighbouring key ranges in order: first key, log2 of the width, bytes,
    and number of groups."""

    first: np.ndarray
    width: np.ndarray
    bytes: np.ndarray
    groups: np.ndarray

    def __post_init__(self):
        self.ends = np.cumsum(self.bytes)

    @property
    def total(self) -> int:
        return int(self.ends[-1])

    def whole(self) -> np.ndarray:
        """Ranges that cannot be cut: one group."""
        return self.groups <= 1


def greedy(ranges: Ranges, capacity: int, shards: int, anywhere: bool) -> list[int]:
    """Bytes before each cut when shards are filled one after the other.
    ``anywhere``: ranges of more than one group can be cut at any byte."""
    ends, whole, at, cuts = ranges.ends, ranges.whole(), 0, []
    for _ in range(shards):
        to = at + capacity
        i = int(np.searchsorted(ends, to, "right"))  # the first range that ends after it
        if i == len(ends):
            return [*cuts, ranges.total]
        new = to if anywhere and not whole[i] else int(ends[i - 1]) if i else 0
        if new <= at:  # the next range does not fit at all
            return [*cuts, at]
        at = new
        cuts.append(at)
    return cuts


def smallest_capacity(ranges: Ranges, shards: int, anywhere: bool) -> int:
    """Binary search for the smallest capacity that reaches the end."""
    low, high = -(-ranges.total // shards), ranges.total
    while low < high:
        middle = (low + high) // 2
        if greedy(ranges, middle, shards, anywhere)[-1] == ranges.total:
            high = middle
        else:
            low = middle + 1
    return low


def to_open(ranges: Ranges, low: int, high: int, shards: int) -> np.ndarray:
    """Positions of the ranges of several groups in which a cut may fall when
    the capacity is between ``low`` and ``high``."""
    large = np.flatnonzero(~ranges.whole() & (ranges.bytes > low))
    if len(large):
        return large
    early, late = greedy(ranges, low, shards, False), greedy(ranges, high, shards, True)
    starts = ranges.ends - ranges.bytes
    hit = np.zeros(len(starts), bool)
    for k in range(shards):
        a = early[min(k, len(early) - 1)]
        b = late[min(k, len(late) - 1)]
        hit |= (starts < max(a, b)) & (ranges.ends > min(a, b))
        hit |= (starts < b) & (ranges.ends > b)
    return np.flatnonzero(hit & ~ranges.whole())


def _sums(groups: DataFrame, widths: dict[int, list[int]]) -> list[tuple]:
    """(first key, width, bytes, groups) of the ranges of 2**width keys that
    lie in the given wider ranges: ``widths`` has, by log2 of a range's width,
    its keys without their low bits."""
    parts = []
    for width, keys in widths.items():
        new = max(0, width - MORE_BITS)
        inside = groups.where(F.shiftrightunsigned("key", width).isin(keys)) if width < KEY_BITS else groups
        if width == KEY_BITS:
            new = KEY_BITS - FIRST_BITS
        parts.append(
            inside.groupBy(F.shiftrightunsigned("key", new).alias("k"))
            .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("groups"))
            .withColumn("width", F.lit(new))
        )
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return [(r["k"] << r["width"], r["width"], r["bytes"], r["groups"]) for r in out.collect()]


def _ranges(rows: list[tuple]) -> Ranges:
    rows = sorted(rows)
    return Ranges(*(np.array([r[i] for r in rows], np.int64) for i in range(4)))


def cut_keys(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """(first keys of shards 1, 2, ..., smallest capacity) for ``groups``
    (key, bytes), one row for each group."""
    rows = _sums(groups, {KEY_BITS: []})
    if not rows:
        return [], 0
    while True:
        ranges = _ranges(rows)
        low, high = smallest_capacity(ranges, shards, True), smallest_capacity(ranges, shards, False)
        opened = to_open(ranges, low, high, shards) if low < high else []
        if not len(opened):
            break
        widths: dict[int, list[int]] = {}
        for i in opened:
            width = int(ranges.width[i])
            widths.setdefault(width, []).append(int(ranges.first[i]) >> width)
        kept = set(range(len(ranges.first))) - set(map(int, opened))
        rows = [tuple(int(x[i]) for x in (ranges.first, ranges.width, ranges.bytes, ranges.groups)) for i in kept]
        rows += _sums(groups, widths)
    cuts = greedy(ranges, high, shards, False)[:-1]
    return [int(ranges.first[np.searchsorted(ranges.ends, c, "right")]) for c in cuts], high


def shard_documents(docs: DataFrame, *, shards: int = 16, rows_per_bucket: int = 100_000) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of ``docs``
    (doc_id, text); size is the text's UTF-8 bytes plus 1."""
    shared = SharedTables(docs.sparkSession, "shards")
    text = F.coalesce("text", F.lit(""))
    rows = shared.put(
        columns(docs, "doc_id", "text").select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS).alias("key"),
        ),
        "rows",
    )
    groups = shared.put(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    cuts, _ = cut_keys(groups, shards)
    shard = F.lit(0)
    for first in cuts:
        shard = shard + (F.col("key") >= F.lit(first)).cast("int")
    salt = F.xxhash64("doc_id", "key")
    placed, _ = numbered(
        rows.withColumn("shard", shard), "shard", salt, ["doc_id", "key"], shared, rows_per_bucket=rows_per_bucket
    )
    return placed.select("doc_id", "size", "text_crc32", "shard", F.col("index").cast("long").alias("slot"))
