"""Calendar dimension: one row per day, both bounds included."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstar.functions import CALENDAR_END, CALENDAR_START, quarter_label


def calendar_days(start: date = CALENDAR_START, end: date = CALENDAR_END) -> int:
    return (end - start).days + 1


def dim_calendar(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    """Days from ``start`` to ``end``: ``dt``, ``date_id``, ``date`` (ISO text),
    ``year``, ``month``, ``day``, ``quarter`` (``'Q1'``..``'Q4'``).

    Generated by ``spark.range`` across tasks (no driver-side list, no array
    exploded in one task). ``date_id`` is the day offset from ``start``, the
    same value :func:`regstar.functions.date_key` computes from a date, so
    facts can carry date keys without joining the calendar. The row count is
    fixed by the bounds (73,050 by default), which is what makes it safe to
    broadcast.
    """
    days = spark.range(0, calendar_days(start, end))
    dt = F.date_add(F.lit(start), F.col("id").cast("int"))
    return days.select(dt.alias("dt"), F.col("id").cast("int").alias("date_id")).select(
        "dt",
        "date_id",
        F.date_format("dt", "yyyy-MM-dd").alias("date"),
        F.year("dt").alias("year"),
        F.month("dt").alias("month"),
        F.dayofmonth("dt").alias("day"),
        quarter_label("dt").alias("quarter"),
    )
