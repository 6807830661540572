"""The clustered fact: equal answers from fewer files and row groups."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from regstar.plans import catalogue as C
from regstar.plans import questions as Q
from regstar.plans.clustered import BITS, Grid, cluster, interleaved, on_curve
from regstar.plans.star import answered_in, build_star, materialize
from regstar.sources import driver_sources
from tests.conftest import SF_MID, rows


@pytest.fixture(scope="module")
def stars(spark):
    written = materialize(build_star(spark, driver_sources(spark, SF_MID)))
    return written, cluster(written, rows_per_zone=400, row_group_bytes=8 << 10)


def scan(df):
    """(files, rows) that the scan of a plan without a shuffle read."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    metrics = plan.collectLeaves().apply(0).metrics()
    return metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()


def test_interleaving_is_undone(spark):
    pairs = spark.createDataFrame([(0, 0), (255, 255), (170, 85), (3, 200)], "a int, b int")
    for a, b, z in pairs.select("a", "b", interleaved(F.col("a"), F.col("b")).alias("z")).collect():
        bits = [z >> i & 1 for i in range(2 * BITS)]
        assert (a, b) == (sum(x << i for i, x in enumerate(bits[1::2])), sum(x << i for i, x in enumerate(bits[::2])))


def test_rows_and_answers_are_equal(stars):
    written, clustered = stars
    names = [c for c in clustered.reimbursement(with_attributes=True).columns if c != "zone"]
    assert rows(clustered.reimbursement(with_attributes=True), *names) == rows(written.reimbursement(with_attributes=True), *names)
    for ask in (
        lambda s: Q.q3_top_price(s, C.Q3_COUNTRIES, C.Q3_YEAR, C.Q3_QUARTER),
        lambda s: Q.q3_top_price(s, C.Q3_COUNTRIES, C.Q3_YEAR, "Q5"),
        lambda s: Q.q4_top(s, C.Q4_COUNTRY, C.Q4_START, C.Q4_END),
        lambda s: Q.q4_top(s, C.Q4_COUNTRY, C.Q4_START, C.Q4_END, measure="pct", approved_only=True),
        lambda s: Q.q4_top(s, "no such country", C.Q4_START, C.Q4_END),
    ):
        assert rows(ask(clustered)) == rows(ask(written))


@pytest.mark.parametrize("zone_bits", [2, 3, 5, 6])
def test_no_wanted_row_is_pruned(spark, stars, zone_bits):
    _, star = stars
    fact = star.reimbursement(with_attributes=True).drop("zone")
    bounds = star.grid.bounds
    placed = on_curve(fact, star.calendar, bounds)
    zoned = placed.withColumn("zone", F.shiftright("__z", 2 * BITS - zone_bits))
    first, last = 35_700, 36_100
    wanted = zoned.where(F.col("response_date_id").between(first, last) & F.col("country_bk").isin("NB", "NH"))
    pruned = Grid(bounds, zone_bits).prune(wanted, ["NB", "NH"], first, last)
    assert pruned.count() == wanted.count() > 0


def test_a_question_reads_few_files_and_row_groups(stars):
    written, star = stars
    fact = star.reimbursement(with_attributes=True).select("claimnumber", "drug_price", "country_bk", "response_date_id", "zone")
    files, all_rows = scan(fact)
    days = date(1998, 10, 1), date(1998, 12, 31)
    some = answered_in(star, ["NB"], *days).select("claimnumber", "drug_price")
    read_files, read_rows = scan(some)
    _, read_by_country = scan(answered_in(written, ["NB"], *days).select("claimnumber", "drug_price"))
    assert read_files * 4 < files
    assert some.count() <= read_rows < all_rows / 8
    assert read_rows < read_by_country


def test_quarter_days():
    assert Q.quarter_days(1998, "Q4") == (date(1998, 10, 1), date(1998, 12, 31))
    assert Q.quarter_days(2000, "Q1") == (date(2000, 1, 1), date(2000, 3, 31))
    assert Q.quarter_days(2000, "Q5") == (date(2000, 1, 1), date(2000, 12, 31))
