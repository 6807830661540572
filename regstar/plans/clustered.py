"""The reimbursement fact clustered by response date and country at once.

Partitioning by country alone lets a question on one month read a country's
whole history; by date alone, every country. Here each row gets a level of its
response date (equal shares of the rows, from quantiles) and one of its country
(a hash: countries are asked for by equality), ``BITS`` bits each, and the two are
interleaved to a number on the Morton curve. The number's first bits name the
folder (``zone``), the rest orders the rows of a file. A question on some
countries and days so skips

- folders, when it is planned: the filter is an expression over ``zone`` alone;
- row groups of the files left, by their lowest and highest date and country.

Rows without a response date or country have level 0. A zone that holds many
rows (a heavy country, or one day) is split over several writers by the
rebalance hint.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.plans.star import COUNTRY_PART, Star
from regstar.session import shared_dir

BITS = 8
LEVELS = 1 << BITS
DAY, COUNTRY, ZONE = "response_date_id", "country_bk", "zone"


def country_level(code: Column) -> Column:
    return F.when(code.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(code), F.lit(LEVELS))).cast("int")


def interleaved(day: Column, country: Column) -> Column:
    """Morton number of two levels; the day has the higher bit of each pair."""
    z = F.lit(0)
    for i in range(BITS):
        z = z.bitwiseOR(F.shiftleft(F.shiftright(day, i).bitwiseAND(F.lit(1)), 2 * i + 1))
        z = z.bitwiseOR(F.shiftleft(F.shiftright(country, i).bitwiseAND(F.lit(1)), 2 * i))
    return z


def _every_second_bit(z: Column, first: int, count: int) -> Column:
    out = F.lit(0)
    for i in range(count):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(z, first + 2 * i).bitwiseAND(F.lit(1)), i))
    return out


@dataclass(frozen=True)
class Grid:
    """``bounds``: the lowest day of each level but the first, ascending;
    ``zone_bits``: leading bits of the Morton number that name a folder."""

    bounds: tuple[int, ...]
    zone_bits: int

    def day_level(self, day: int) -> int:
        return bisect_right(self.bounds, day)

    def prune(self, rows: DataFrame, countries: Iterable[str], first: int, last: int) -> DataFrame:
        """``rows`` without the zones that hold none of ``countries`` or no day
        from ``first`` to ``last``."""
        days, places = (self.zone_bits + 1) // 2, self.zone_bits // 2
        # The zone's last bit is a country's where the number of bits is even.
        zone, even = F.col(ZONE), self.zone_bits % 2 == 0
        day = _every_second_bit(zone, int(even), days)
        place = _every_second_bit(zone, int(not even), places)
        wanted = day.between(self.day_level(first) >> (BITS - days), self.day_level(last) >> (BITS - days))
        levels = [F.shiftright(country_level(F.lit(c)), BITS - places) for c in countries]
        return rows.where(wanted & place.isin(levels)) if levels else rows.where(F.lit(False))


def on_curve(fact: DataFrame, calendar: DataFrame, bounds: tuple[int, ...]) -> DataFrame:
    """``fact`` with ``__z``, its place on the curve. The calendar (a fixed number
    of days) is joined with each day's level."""
    level = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("__day"))) if bounds else F.lit(0)
    days = calendar.select(F.col("date_id").alias("__day")).withColumn("__level", level)
    placed = fact.join(F.broadcast(days), F.col(DAY) == F.col("__day"), "left")
    z = interleaved(F.coalesce("__level", F.lit(0)), country_level(F.col(COUNTRY)))
    return placed.withColumn("__z", z).drop("__day", "__level")


def cluster(
    star: Star, path: str | None = None, *, rows_per_zone: int = 4_000_000, row_group_bytes: int = 32 << 20
) -> Star:
    """A written star whose reimbursement fact is written once more, clustered;
    its other tables are those of ``star``."""
    spark = star.spark
    fact = star.reimbursement(with_attributes=True)
    fact = fact.select([c for c in fact.columns if c not in (ZONE, COUNTRY_PART)])
    # One row of LEVELS - 1 numbers, and a count.
    cuts = [i / LEVELS for i in range(1, LEVELS)]
    seen = fact.agg(F.count("*").alias("n"), F.percentile_approx(DAY, cuts, 100 * LEVELS).alias("cuts")).first()
    zones = max(1, -(-seen["n"] // rows_per_zone))
    grid = Grid(tuple(sorted(set(seen["cuts"] or []))), min(2 * BITS, max(2, (zones - 1).bit_length())))
    placed = on_curve(fact, star.calendar, grid.bounds)
    placed = placed.withColumn(ZONE, F.shiftright("__z", 2 * BITS - grid.zone_bits))
    ordered = placed.hint("rebalance", ZONE).sortWithinPartitions(ZONE, "__z", COUNTRY, DAY).drop("__z")
    base = path or shared_dir(spark, "clustered")
    ordered.write.partitionBy(ZONE).option("parquet.block.size", row_group_bytes).parquet(base)
    facts = dict(star.facts) | {"reimbursement_claim": spark.read.schema(ordered.schema).parquet(base)}
    return Star(
        spark, star.sources, check_small_dims=star.check_small_dims, dims=dict(star._dims), facts=facts, grid=grid
    )
