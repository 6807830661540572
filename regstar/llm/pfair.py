"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are dealt into blocks of ``block`` documents. With
the target weights w as whole shares of their sum Q, block j of a source (from
0) is released at slot floor(j * Q / w) and due at ceil((j + 1) * Q / w); each
slot takes the released block that is due first. So after any number of slots
every source is less than one block from its target.

All lags are zero after Q slots: the schedule repeats with that period. Only
one period is therefore computed (its size depends on the weights, not on the
documents), and every document's place follows from its block number. A source
that runs out ends a phase; the others go on by their own shares, so each
phase keeps the bound and no document is left out. There are at most as many
phases as sources.

Documents are numbered within their source without gathering a source in one
task: ranks within (source, hash bucket of doc_id), plus the sizes of the
buckets before.

Defined cases: a source without a weight (or null) belongs to the class
``other``, with its own weight; a class with weight 0 comes after all others;
the last block of a class may be short; rows that repeat are placed once
each; a null doc_id is placed like any other; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.llm.shared import SharedTables, numbered

OTHER = "other"


def period(shares: dict[str, int]) -> list[str]:
    """The classes of one period of sum(shares) slots, by earliest deadline
    among released blocks (equal deadlines: larger share, then name)."""
    q = sum(shares.values())
    waiting = [(0, name, 0) for name in shares]  # (release, class, block)
    heapq.heapify(waiting)
    ready: list[tuple] = []
    slots = []
    for t in range(q):
        while waiting and waiting[0][0] <= t:
            _, name, j = heapq.heappop(waiting)
            w = shares[name]
            heapq.heappush(ready, (-(-(j + 1) * q // w), -w, name, j))
        due, _, name, j = heapq.heappop(ready)
        if due <= t:
            raise AssertionError("a deadline was missed")
        slots.append(name)
        if j + 1 < shares[name]:
            heapq.heappush(waiting, ((j + 1) * q // shares[name], name, j + 1))
    return slots


def phases(blocks: dict[str, int], shares: dict[str, int]) -> list[dict]:
    """The schedule of all ``blocks`` (number of blocks by class), as runs:
    ``first_slot``, ``slots`` (one period), and for each class in it
    ``first_block`` and ``end_block`` (exclusive)."""
    left, taken, at, runs = dict(blocks), dict.fromkeys(blocks, 0), 0, []
    left = {k: n for k, n in left.items() if n}
    while left:
        live = {k: shares.get(k, 0) for k in left}
        if any(live.values()):
            live = {k: w for k, w in live.items() if w}
        else:
            live = dict.fromkeys(live, 1)  # only classes of weight 0 are left
        slots = period(live)
        rounds = min(left[k] // w for k, w in live.items())
        used = {k: rounds * w for k, w in live.items()}
        length = rounds * len(slots)
        for name in slots:  # the last period ends at the first slot without a block
            if used[name] == left[name]:
                break
            used[name] += 1
            length += 1
        runs.append(
            {
                "first_slot": at,
                "slots": slots,
                "classes": {k: (taken[k], taken[k] + n) for k, n in used.items()},
            }
        )
        at += length
        for k, n in used.items():
            taken[k] += n
            left[k] -= n
        left = {k: n for k, n in left.items() if n}
    return runs


def mix(
    docs: DataFrame,
    weights: dict[str, int],
    *,
    other_weight: int = 1,
    block: int = 16,
    rows_per_bucket: int = 100_000,
    carry: Column | None = None,
) -> DataFrame:
    """Place of each document: (doc_id, class, block, slot, position).

    ``weights``: whole shares by source. ``slot`` counts blocks from 0;
    ``position`` counts documents within the block. Ordering by (slot,
    position) reads the mix. ``carry`` is a further column, named ``carried``.
    """
    spark = docs.sparkSession
    shared = SharedTables(spark, "pfair")
    listed = F.col("source").isin(*weights) if weights else F.lit(False)
    carried = [] if carry is None else ["carried"]
    rows = docs.select(
        "doc_id",
        F.when(listed, F.col("source")).otherwise(F.lit(OTHER)).alias("class"),
        *([] if carry is None else [carry.alias("carried")]),
    )
    rows, sizes = numbered(
        rows, "class", F.xxhash64("doc_id"), ["doc_id"], shared, rows_per_bucket=rows_per_bucket
    )
    # Every class of the schedule: at most one more than the weights name.
    totals = {r["class"]: -(-r["n"] // block) for r in sizes.groupBy("class").agg(F.sum("n_").alias("n")).collect()}
    shares = dict(weights) | {OTHER: other_weight}
    table = []
    for run in phases(totals, shares):
        q = len(run["slots"])
        for name, (first, end) in run["classes"].items():
            places = [i for i, x in enumerate(run["slots"]) if x == name]
            table.append((name, first, end, run["first_slot"], q, places))
    schedule = spark.createDataFrame(
        table or [("", 0, 0, 0, 1, [0])],
        "class string, first long, end long, first_slot long, period long, places array<int>",
    )
    index = F.col("index")
    placed = (
        rows.withColumn("block", F.floor(index / block))
        .withColumn("position", F.pmod(index, F.lit(block)).cast("long"))
        # The schedule's rows are bounded by the square of the number of classes.
        .join(F.broadcast(schedule), "class")
        .where("block >= first AND block < end")
    )
    of_period = F.pmod(F.col("block") - F.col("first"), F.size("places")).cast("int")
    slot = F.expr("first_slot + (block - first) div size(places) * period") + F.get("places", of_period)
    return placed.select("doc_id", "class", "block", slot.cast("long").alias("slot"), "position", *carried)


def mixed(docs: DataFrame, weights: dict[str, int], **options) -> DataFrame:
    """``docs`` (all its columns) in the order of the mix."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return mix(docs, weights, carry=row, **options).orderBy("slot", "position").select("carried.*")
