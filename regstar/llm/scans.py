"""Running state over an array column, in DataFrame functions, in time linear
in the array.

``aggregate`` that appends to an array copies the array for every element. Here
elements are taken in blocks: a block's results are appended to an array of at
most ``BLOCK``, and the blocks to one of length / ``BLOCK``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once. (An expression that is named
    inside a function of an array's elements is otherwise computed for each.)"""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(
    items: Column, state: Column, state_type: str, result_type: str, step: Callable[[Column, Column], tuple[Column, Column]]
) -> Column:
    """Array of the results of ``step(state, item) -> (new state, result)``,
    called on the items in order."""

    def one(acc: Column, item: Column) -> Column:
        new, result = step(acc["state"], item)
        return F.struct(new.cast(state_type).alias("state"), F.concat(acc["out"], F.array(result.cast(result_type))).alias("out"))

    def block(acc: Column, some: Column) -> Column:
        start = F.struct(acc["last"]["state"].alias("state"), F.array().cast(f"array<{result_type}>").alias("out"))
        return F.struct(
            F.aggregate(some, start, one).alias("last"), F.concat(acc["outs"], F.array(acc["last"]["out"])).alias("outs")
        )

    def blocks(all_items: Column) -> Column:
        last = F.floor((F.size(all_items) - 1) / BLOCK).cast("int")
        # One element after the other: ``slice`` would read the whole array for each block.
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.transform(
                F.sequence(i * BLOCK, F.least((i + 1) * BLOCK, F.size(all_items)) - 1), lambda j: F.get(all_items, j)
            ),
        )

    nothing = F.array().cast(f"array<{result_type}>")
    start = F.struct(
        F.struct(state.cast(state_type).alias("state"), nothing.alias("out")).alias("last"),
        F.array().cast(f"array<array<{result_type}>>").alias("outs"),
    )
    whole = lambda acc: F.flatten(F.concat(acc["outs"], F.array(acc["last"]["out"])))
    some = bound(items, lambda x: F.aggregate(blocks(x), start, block, whole))
    return F.when(F.size(items) > 0, some).otherwise(nothing)


def cutter(text: Column, use: Callable[[Callable[[Column, Column], Column]], Column], size: int = 2048) -> Column:
    """``use(cut)``, where ``cut(start, end)`` is the text between two positions
    (code points, from 0). ``substr`` counts from the beginning of the text each
    time; here it counts from the beginning of a part of ``size`` code points."""

    def cutting(parts: Column) -> Column:
        def cut(start: Column, end: Column) -> Column:
            first, last = F.floor(start / size).cast("int"), F.floor(end / size).cast("int")
            head, tail = F.get(parts, first), F.coalesce(F.get(parts, last), F.lit(""))
            within = F.substr(head, start % size + 1, end - start)
            over = F.concat(
                F.substr(head, start % size + 1),
                F.array_join(F.slice(parts, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
                F.substr(tail, F.lit(1), end % size),
            )
            return F.when(start >= end, F.lit("")).when(first == last, within).otherwise(over)

        return use(cut)

    return bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)), cutting)
