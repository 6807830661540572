"""Tables in the cluster's shared folder, and what Python workers need."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regstar.session import remove_dir, shared_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


class SharedTables:
    """Parquet tables of one operator run, in a fresh folder under
    ``spark.checkpoint.dir``. A table that two plans read is computed once,
    and a lost executor costs a re-read of it, not its lineage."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.root = shared_dir(spark, "llm", operator)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table that no later plan reads."""
        remove_dir(self.spark, f"{self.root}/{name}")


def for_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver found it.
    (A cluster ships the package with ``--py-files``; then this adds nothing.)"""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
    return spark


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, by exact name, whatever other columns there are."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*(df[f"`{have[n.lower()]}`"].alias(n) for n in names))


def numbered(df: DataFrame, group: str, salt: Column, order: list, shared: SharedTables, *, rows_per_bucket: int):
    """(frame, sizes): ``df`` with ``index``: 0, 1, ... within each value of ``group``, without
    gathering a group in one task. Rows are ranked by ``salt`` and ``order``
    within (group, hash bucket of salt), and the sizes of the group's buckets
    before are added; those are a few numbers for each ``rows_per_bucket`` rows.
    ``sizes`` has them as (group, bucket_, n_)."""
    buckets = max(64, df.count() // rows_per_bucket)
    df = df.withColumn("bucket_", F.pmod(salt, F.lit(buckets)))
    sizes = shared.put(df.groupBy(group, "bucket_").agg(F.count("*").alias("n_")), f"sizes_of_{group}")
    before = sizes.select(
        group, "bucket_", (F.sum("n_").over(Window.partitionBy(group).orderBy("bucket_")) - F.col("n_")).alias("before_")
    )
    rank = F.row_number().over(Window.partitionBy(group, "bucket_").orderBy(salt, *order)) - 1
    ranked = df.withColumn("rank_", rank).join(before, [group, "bucket_"])
    return ranked.withColumn("index", F.col("rank_") + F.col("before_")).drop("bucket_", "before_", "rank_"), sizes
