"""Runtime filter: no partner is lost, few others pass, and results are exact."""

from pyspark.sql import functions as F

from regstar.operators import may_match
from regstar.plans import catalogue as C
from regstar.plans import questions as Q
from regstar.plans.star import build_star
from regstar.sources import driver_sources
from tests.conftest import SF_SMALL, rows


def test_partners_pass_and_few_others(spark):
    side = spark.range(0, 40_000, 20).select(F.concat(F.lit("K"), "id").alias("k"))
    side = side.union(spark.createDataFrame([("K0",), (None,)], "k string"))
    large = spark.range(40_000).select(F.concat(F.lit("K"), "id").alias("key"))
    large = large.union(spark.createDataFrame([("K0",), (None,)], "key string"))
    some, table = may_match(large, F.col("key"), side, "k")
    got = some.count()
    want = large.join(table, F.col("key") == F.col("k"), "left_semi")
    assert some.intersect(want).count() == 2_000 and want.count() == 2_001
    assert 2_001 <= got <= 2_001 + 0.03 * 38_000
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_empty_sides_and_the_bound(spark):
    large = spark.range(100).select(F.col("id").alias("key"))
    side = spark.range(50).select(F.col("id").alias("k"))
    none, _ = may_match(large, F.col("key"), side.limit(0), "k")
    assert none.count() == 0
    assert may_match(large.limit(0), F.col("key"), side, "k")[0].count() == 0
    unfiltered, table = may_match(large, F.col("key"), side, "k", max_keys=10)
    assert unfiltered.count() == 100 and table.count() == 50


def test_question_is_the_same_with_and_without_the_filter(spark):
    star = build_star(spark, driver_sources(spark, SF_SMALL))
    with_filter = Q.prices_by_country(star, C.Q3_YEAR, C.Q3_QUARTER)
    without = Q.prices_by_country(star, C.Q3_YEAR, C.Q3_QUARTER, max_keys=0)
    assert rows(with_filter) == rows(without) != []
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (with_filter, without)]
    assert ["LeftSemi" in p for p in plans] == [True, False]
