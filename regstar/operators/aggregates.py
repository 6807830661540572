"""Aggregation-shaped operators: arg-max with ties, conditional shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def arg_max_rows(df: DataFrame, value: str) -> DataFrame:
    """Rows of ``df`` whose ``value`` equals the maximum of ``value``; ties and
    repeated rows kept.

    One pass over ``df``: equal rows are counted (pre-aggregated in each task),
    the maximum is a one-row aggregate over these counts, and the rows that
    reach it are joined back from the same counts. Both readers get the same
    plan up to the counts' shuffle, so the planner runs it once: both need every
    column, rows without a value are left out for both, and the rows come out
    of an explode, which holds back filters of a later join. No checkpoint, no
    global sort, no single-partition window. A null maximum (no rows, or only
    nulls) gives no rows.
    """
    names = df.columns
    counted = df.where(F.col(value).isNotNull()).groupBy(*names).agg(F.count("*").alias("__n"))
    # The count takes part in the comparison (last), so that it is not pruned.
    top = counted.agg(F.max(F.struct(value, "__n"))[value].alias("__max"))
    tied = counted.join(F.broadcast(top), F.col(value) == F.col("__max"))
    row = F.struct(*(F.col(f"`{c}`") for c in names))
    once = tied.select("__n", F.explode(F.array(row)).alias("__row"))
    return once.withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("__n")))).select("__row.*")


def weighted_share(df: DataFrame, counted: Column, over: Column, weight: Column) -> DataFrame:
    """One row (on_time, total, share): the weights of rows that meet
    ``counted``, of rows that meet ``over``, and their ratio (null for an
    empty total). One aggregation."""
    of = lambda condition: F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))
    sums = df.agg(of(counted).alias("on_time"), of(over).alias("total"))
    return sums.withColumn("share", F.try_divide(F.col("on_time").cast("double"), F.col("total").cast("double")))


def share_of(df: DataFrame, condition: Column, *, numerator: str, total: str, share: str) -> DataFrame:
    """One row: rows meeting ``condition``, all rows, and their ratio.

    One pass with a partial aggregation; an empty input gives a null share
    instead of a division error.
    """
    return df.agg(
        F.count_if(condition).alias(numerator),
        F.count(F.lit(1)).alias(total),
    ).select(
        numerator,
        total,
        F.try_divide(F.col(numerator).cast("double"), F.col(total).cast("double")).alias(share),
    )
