"""As-of lookup: the version of a dimension row that is valid on a fact's day.

Facts are first reduced to their distinct (key, day) pairs, pre-aggregated in
each task. These pairs and the versions are sorted together within a key, and
each pair takes the last version before it; a key holds at most a calendar of
pairs and its own versions there, however many facts share it. What was found is
then joined to the facts by equality of key and day: broadcast if its size is
proven, else a shuffle join whose heavy pairs AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regstar.operators.lookup import bounded_broadcast


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    *,
    key: Column,
    day: Column,
    carry: Sequence[str],
    version_key: str = "key",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """``facts`` with the columns ``carry`` of the version of ``key`` that is
    valid on ``day``; null where there is none.

    Of the versions of a key the one that started last, on that day or before
    it, counts; it holds until the day before ``valid_to`` (null: without an end).
    One that has ended leaves a gap, it brings no earlier one back. Of several that
    start on one day, the first by its carried columns counts. Versions without a
    key or a start are never valid; facts without a key or day have none.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in carry], F.col(valid_to).alias("__until"))
    starts = (
        versions.select(F.col(version_key).alias("__key"), F.col(valid_from).alias("__day"), row.alias("__row"))
        .where("__key IS NOT NULL AND __day IS NOT NULL")
        .groupBy("__key", "__day")
        .agg(F.min("__row").alias("__row"))
    )
    pairs = facts.select(key.alias("__key"), day.alias("__day")).where("__key IS NOT NULL AND __day IS NOT NULL").distinct()
    nothing = F.lit(None).cast(starts.schema["__row"].dataType)
    line = starts.withColumn("__asked", F.lit(0)).unionByName(pairs.select("*", nothing.alias("__row"), F.lit(1).alias("__asked")))
    before = Window.partitionBy("__key").orderBy("__day", "__asked").rowsBetween(Window.unboundedPreceding, 0)
    last = line.withColumn("__row", F.last("__row", ignorenulls=True).over(before))
    valid = (F.col("__asked") == 1) & F.col("__row").isNotNull()
    valid = valid & (F.col("__row.__until").isNull() | (F.col("__day") < F.col("__row.__until")))
    found = last.where(valid).select("__key", "__day", *[F.col(f"__row.`{c}`").alias(c) for c in carry])
    found = bounded_broadcast(found)
    return facts.join(found, (key == F.col("__key")) & (day == F.col("__day")), "left").drop("__key", "__day")
