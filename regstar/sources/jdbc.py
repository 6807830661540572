"""Relational sources over JDBC.

Credentials are never part of the code: they are passed in, or taken from the
standard PostgreSQL client variables ``PGUSER`` / ``PGPASSWORD``.

A JDBC read without a partition column is one task for the whole table; with
``partition_column`` and bounds it becomes ``num_partitions`` range queries
that run in parallel.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    driver: str | None = None,
) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``; validated, nothing is read."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    user = user if user is not None else os.environ.get("PGUSER")
    password = password if password is not None else os.environ.get("PGPASSWORD")
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    ranged = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(v is not None for v in ranged):
        if any(v is None for v in ranged):
            raise ValueError(
                "partition_column, lower_bound, upper_bound and num_partitions go together"
            )
        if int(num_partitions) < 1:
            raise ValueError("num_partitions must be positive")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def claim_predicates(buckets: int, column: str = "claimnumber") -> list[str]:
    """Conditions that split a table into even parts, whatever the values of
    ``column`` are: hash buckets (PostgreSQL's ``hashtext``), null in the first."""
    if buckets < 1:
        raise ValueError("buckets must be positive")
    part = f"mod(abs(hashtext({column})::bigint), {buckets})"
    return [f"{part} = {i}" if i else f"{part} = 0 OR {column} IS NULL" for i in range(buckets)]


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, predicates: list[str] | None = None, **kw
) -> DataFrame:
    """Read a table (or a parenthesised query) through JDBC; with
    ``predicates``, one query for each of them."""
    if predicates:
        properties = jdbc_options(url, table, **kw)
        return spark.read.jdbc(url, table, predicates=predicates, properties={
            k: v for k, v in properties.items() if k not in ("url", "dbtable")
        })
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()
