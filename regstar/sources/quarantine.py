"""Delimited files whose bad records are set aside instead of ending the job.

``read_delimited`` either fails on a record it can't parse or pads it silently.
Here each line is parsed by itself, once; records that fit the schema become the
good rows, and every other line goes to a side table with its file and line
number. Good and bad rows together are the records of the files.

A record is a line (a line break inside quotes is not supported); lines without
any character but blanks are no records; a byte order mark is dropped; with
``header`` the first line of each file is dropped if it holds the schema's names,
and is a bad record if it does not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from regstar.session import cut_lineage

_CORRUPT = "__corrupt_record"
_POSITION = (1 << 33) - 1  # the part of monotonically_increasing_id that counts a partition's rows


@dataclass(frozen=True)
class Records:
    """``good``: rows of the schema. ``bad``: (file, line, record), with the
    line's number in its file, from 1, and its text."""

    good: DataFrame
    bad: DataFrame


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    *,
    header: bool,
    sep: str = ",",
    null_value: str | None = None,
) -> Records:
    """The good and the bad records of one or several files (parsed once, and
    written to the shared folder)."""
    options = {
        "sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT,
        "nullValue": "\x00" if null_value is None else null_value,
    }
    wide = StructType([*(StructField(f.name, f.dataType, True) for f in schema.fields), StructField(_CORRUPT, StringType(), True)])
    names = StructType([*(StructField(f"c{i}", StringType(), True) for i in range(len(schema))), wide[_CORRUPT]])
    line = F.regexp_replace("value", "^﻿", "")
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        *split, F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION)).alias("at"), line.alias("record")
    )

    def parsed(as_type: StructType):
        return F.from_csv("record", as_type.simpleString(), options)

    head = parsed(names)
    is_names = head[_CORRUPT].isNull()
    for i, field in enumerate(schema.fields):
        is_names = is_names & (head[f"c{i}"] == field.name)
    table = lines.withColumns({"row": parsed(wide), "names": F.coalesce(is_names, F.lit(False)) if header else F.lit(False)})
    # Written once: good rows, bad rows and the counts of lines read it.
    table = cut_lineage(table)
    # How many lines come before each part of a file that one task read.
    parts = table.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    parts = parts.select("file", "block", (earlier - F.col("first") + 1).alias("shift"))
    is_record = F.length(F.trim("record")) > 0
    is_bad = F.col(f"row.{_CORRUPT}").isNotNull()
    good = table.where(is_record & ~is_bad)
    bad = table.where(is_record & is_bad)
    if header:
        # A line that could be one, or a first line that is none, is settled by its number.
        first = table.join(parts.where("shift <= 1"), ["file", "block"]).where(F.col("at") + F.col("shift") == 1)
        first = first.select("file", "block", "at", "names").withColumn("is_first", F.lit(True))
        first = F.broadcast(first) if first.limit(100_001).count() <= 100_000 else first  # one row for each file
        good = good.drop("names").join(first, ["file", "block", "at"], "left")
        unnamed = good.where(F.col("is_first") & ~F.col("names"))
        good = good.where(F.col("is_first").isNull())
        bad = bad.drop("names").join(first, ["file", "block", "at"], "left").where("is_first IS NULL OR NOT names")
        bad = bad.select("file", "block", "at", "record").unionByName(unnamed.select("file", "block", "at", "record"))
    bad = bad.join(parts, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line"), "record")
    return Records(good.select(*(F.col(f"row.{f.name}").alias(f.name) for f in schema.fields)), bad)
