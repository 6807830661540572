"""Delimited-file sources (CSV with header, TSV without)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    *,
    header: bool,
    sep: str = ",",
    null_value: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Read one or several delimited files with a fixed schema.

    Several paths are one scan (one job, files split across tasks), which is
    how a union of same-shaped files is expressed. With ``strict`` a row with
    the wrong number of fields fails the job (``FAILFAST``) and, for header
    files, the header must match the schema's names (``enforceSchema=false``);
    the permissive default would silently pad or drop fields.

    ``null_value`` names a marker text read as SQL null (for example
    ``'null'``). It is never set by default: codes such as ``NA`` stay text.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
    )
    if header:
        reader = reader.option("enforceSchema", not strict)
    # An empty field is null, a quoted empty one is empty text. Spark reads
    # both as null unless null has another marker; no text holds this one.
    reader = reader.option("nullValue", "\x00" if null_value is None else null_value)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_csv_with_header(spark: SparkSession, paths, schema: StructType, **kw) -> DataFrame:
    return read_delimited(spark, paths, schema, header=True, sep=",", **kw)


def read_tsv(spark: SparkSession, paths, schema: StructType, **kw) -> DataFrame:
    return read_delimited(spark, paths, schema, header=False, sep="\t", **kw)


def write_delimited(df: DataFrame, path: str, *, header: bool, sep: str = ",") -> str:
    """Write a frame as delimited text (one file per task) and return the path.

    Values come back from :func:`read_delimited` as they were: blanks at the
    edges are kept, quotes are doubled, empty text is written in quotes and
    null as nothing. (A line break inside a value is not supported.)"""
    (
        df.write.mode("overwrite")
        .option("header", header)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .csv(path)
    )
    return path
