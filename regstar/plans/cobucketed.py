"""Claims and responses stored so that they join without a shuffle.

Both tables are written bucketed and sorted by the cleaned claim number, into
the same number of buckets. Spark then reads bucket i of one with bucket i of
the other: every question and fact on such a star joins its two largest inputs
with no exchange on either side, however often it is asked; the shuffle is paid
once, when the tables are written.

A bucket can't be split at run time as a shuffle partition can, so claim numbers
that more than ``rows_per_bucket`` claims hold (there are at most as many of
them as buckets) are written to tables of their own, outside the buckets, and
joined with the short list of their responses. Claims without a number have no
response and are not joined at all.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regstar.functions import clean_bk
from regstar.operators import bounded_broadcast, union_all
from regstar.plans.star import Star
from regstar.session import shared_dir
from regstar.sources import Sources
from regstar.sources.schemas import CLAIM

KEY = "claimnumber"
ANSWER_COLUMNS = ("response_id", "response_date", "response")


@dataclass(frozen=True)
class BucketedTable:
    """A Parquet table bucketed and sorted by ``key``; any session can open it."""

    path: str
    schema: StructType
    key: str
    buckets: int

    def open(self, spark: SparkSession) -> DataFrame:
        """The table, registered in the session's catalogue (which is how Spark
        learns the bucketing); nothing is read or written."""
        name = f"regstar_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return spark.table(name)


def write_bucketed(rows: DataFrame, key: str, buckets: int, path: str) -> BucketedTable:
    """Write ``rows`` in one file for each bucket (one task writes a bucket)."""
    name = f"regstar_{uuid.uuid4().hex}"
    spread = rows.repartition(buckets, key)
    spread.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    rows.sparkSession.sql(f"DROP TABLE {name}")  # the files stay
    return BucketedTable(path, rows.schema, key, buckets)


@dataclass(frozen=True)
class AnsweredClaims:
    """Claims and their responses, as written by :func:`write_answered`."""

    claims: BucketedTable
    responses: BucketedTable
    heavy_claims: str
    heavy_responses: str
    unnumbered: str

    def open(self, spark: SparkSession) -> DataFrame:
        """Claims (source columns, cleaned number) with their response's
        ``ANSWER_COLUMNS``, null where there is none: a left join, so several
        responses of one number give several rows."""
        responses = self.responses.open(spark).withColumnRenamed(KEY, "answered")
        claims = self.claims.open(spark)
        even = claims.join(responses.hint("merge"), claims[KEY] == responses["answered"], "left").drop("answered")
        heavy = spark.read.schema(self.claims.schema).parquet(self.heavy_claims)
        short = spark.read.schema(self.responses.schema).parquet(self.heavy_responses).withColumnRenamed(KEY, "answered")
        short = bounded_broadcast(short, written=True)
        heavy = heavy.join(short, heavy[KEY] == short["answered"], "left").drop("answered")
        alone = spark.read.schema(self.claims.schema).parquet(self.unnumbered)
        types = {f.name: f.dataType for f in self.responses.schema.fields}
        alone = alone.withColumns({c: F.lit(None).cast(types[c]) for c in ANSWER_COLUMNS})
        return union_all([even, heavy, alone])


def write_answered(
    star: Star, path: str | None = None, *, rows_per_bucket: int = 1_000_000, least_buckets: int = 8
) -> AnsweredClaims:
    """Write the claims and the responses of a star's sources, co-bucketed."""
    spark = star.spark
    base = path or shared_dir(spark, "cobucketed")
    claims = star.sources.claim.select(*CLAIM.fieldNames()).withColumn(KEY, clean_bk(KEY))
    # Written once as it comes: it is counted by number before it is dealt out.
    claims.write.parquet(f"{base}/claims_as_read")
    claims = spark.read.schema(claims.schema).parquet(f"{base}/claims_as_read")
    total = claims.count()
    buckets = max(least_buckets, -(-total // rows_per_bucket))
    counted = claims.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count("*").alias("n"))
    counted.where(F.col("n") > rows_per_bucket).select(KEY).write.parquet(f"{base}/heavy_numbers")
    heavy = F.broadcast(spark.read.parquet(f"{base}/heavy_numbers"))  # at most total / rows_per_bucket rows
    responses = star.response.select(F.col("response_bk").alias(KEY), *ANSWER_COLUMNS).where(F.col(KEY).isNotNull())
    claims.where(F.col(KEY).isNull()).write.parquet(f"{base}/unnumbered")
    claims.join(heavy, KEY, "left_semi").write.parquet(f"{base}/heavy_claims")
    responses.join(heavy, KEY, "left_semi").write.parquet(f"{base}/heavy_responses")
    even = claims.where(F.col(KEY).isNotNull()).join(heavy, KEY, "left_anti")
    return AnsweredClaims(
        write_bucketed(even, KEY, buckets, f"{base}/claims"),
        write_bucketed(responses.join(heavy, KEY, "left_anti"), KEY, buckets, f"{base}/responses"),
        f"{base}/heavy_claims", f"{base}/heavy_responses", f"{base}/unnumbered",
    )


def answered_star(star: Star, answered: AnsweredClaims) -> Star:
    """A star whose claims come with their responses from co-bucketed tables;
    its other sources and dimensions are those of ``star``."""
    given = {
        name: (lambda name=name: getattr(star.sources, name)) for name in Sources.NAMES if name != "claim"
    }
    sources = Sources(claim=lambda: answered.open(star.spark), **given)
    return Star(star.spark, sources, check_small_dims=star.check_small_dims, answered=True)
