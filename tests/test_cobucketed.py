"""Claims and responses stored co-bucketed: no shuffle, equal results."""

import re

import pytest
from pyspark.sql import functions as F

from regstar.plans import catalogue as C
from regstar.plans import questions as Q
from regstar.plans.cobucketed import ANSWER_COLUMNS, answered_star, write_answered
from regstar.plans.star import build_star
from regstar.sources import Sources, driver_sources
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def stars(spark):
    star = build_star(spark, driver_sources(spark, SF_SMALL))
    return star, answered_star(star, write_answered(star, rows_per_bucket=400))


def below(plan: str, node: str) -> list[str]:
    """The lines of the first ``node``'s subtree."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if node in line)
    depth = re.search(r"[A-Za-z]", lines[at]).start()
    out = []
    for line in lines[at + 1 :]:
        letter = re.search(r"[A-Za-z]", line)
        if letter and letter.start() <= depth:
            break
        out.append(line)
    return out


def test_responses_join_without_exchange(stars):
    _, star = stars
    questions = [
        Q.q1_claims_per_year(star), Q.q2a_on_time_share(star),
        Q.q3_top_price(star, C.Q3_COUNTRIES, C.Q3_YEAR, C.Q3_QUARTER), C.reimbursements(star),
    ]
    for df in questions:
        plan = df._jdf.queryExecution().executedPlan().toString()
        subtree = below(plan, "SortMergeJoin [claimnumber")
        assert sum("FileScan" in line and "Bucketed: true" in line for line in subtree) == 2, plan
        assert not any("Exchange" in line for line in subtree), plan


def test_facts_and_questions_are_equal(stars):
    plain, bucketed = stars
    assert rows(C.reimbursements(bucketed)) == rows(C.reimbursements(plain))
    assert rows(C.registrations(bucketed)) == rows(C.registrations(plain))
    for ask in (
        Q.q1_claims_per_year, Q.q2a_on_time_share, lambda s: Q.q2b_share(s, denominator="registration"),
        lambda s: Q.q3_top_price(s, C.Q3_COUNTRIES, C.Q3_YEAR, C.Q3_QUARTER),
        lambda s: Q.q4_top(s, C.Q4_COUNTRY, C.Q4_START, C.Q4_END, measure="pct"),
    ):
        assert rows(ask(bucketed)) == rows(ask(plain))


def test_heavy_numbers_leave_the_buckets(spark):
    """A third of the claims has one number, some have none; responses repeat."""
    now = driver_sources(spark, SF_SMALL)
    number = F.when(F.crc32("productcodeid") % 3 == 0, "cl-1-1 ").when(F.crc32("productcodeid") % 7 == 1, F.lit(None))
    claims = now.claim.withColumn("claimnumber", number.otherwise(F.col("claimnumber")))
    names = now.responses[0].columns
    again = spark.createDataFrame([("CL-1-1", "1997-01-02", "O"), (None, "1997-01-02", "F")], names)
    given = {name: getattr(now, name) for name in Sources.NAMES}
    star = build_star(spark, Sources(**given | {"claim": claims, "responses": [now.responses[0], again]}))
    answered = write_answered(star, rows_per_bucket=700)
    heavy = spark.read.parquet(answered.heavy_claims)
    assert {r[0] for r in heavy.select("claimnumber").distinct().collect()} == {"CL-1-1"}
    per_bucket = answered.claims.open(spark).groupBy(F.spark_partition_id()).count()
    assert per_bucket.agg(F.max("count")).first()[0] < heavy.count()
    other = answered_star(star, answered)
    assert rows(C.reimbursements(other)) == rows(C.reimbursements(star))
    assert rows(Q.q1_claims_per_year(other)) == rows(Q.q1_claims_per_year(star))


def test_tables_open_in_another_session(spark):
    star = build_star(spark, driver_sources(spark, SF_SMALL))
    answered = write_answered(star)
    later = answered.open(spark.newSession())
    assert rows(later.select("claimnumber", *ANSWER_COLUMNS)) == rows(answered.open(spark).select("claimnumber", *ANSWER_COLUMNS))
    assert later.where("response IS NOT NULL").count() > 0
