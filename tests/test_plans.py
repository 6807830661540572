"""Plan shape: pushdown and pruning reach the scan, no Python evaluation,
arg-max without a global window, results independent of partitioning."""

from regstar.plans import questions as Q
from regstar.plans.star import build_star
from regstar.sources import driver_sources
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_python_evaluation_anywhere(spark):
    from regstar.plans.catalogue import CATALOGUE

    for name, fn in CATALOGUE.items():
        p = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "REPARTITION" not in p, name


def test_scan_reads_only_needed_columns(spark):
    star = build_star(spark, driver_sources(spark, SF_SMALL))
    p = _plan(Q.q1_claims_per_year(star))
    # The lineitem scan reads the handful of columns the mapping needs, not all 11.
    li = [line for line in p.splitlines() if "lineitem.parquet" in line]
    assert li
    for line in li:
        schema = line[line.index("ReadSchema: struct<") :]
        assert "l_quantity" not in schema and "l_linestatus" not in schema


def test_claim_filter_is_applied_on_the_scan(spark):
    """The claim type is derived from the return flag, so no row group can be
    pruned by it; but the filter stands on the scan, below every join."""
    src = driver_sources(spark, SF_SMALL)
    from pyspark.sql import functions as F

    p = _optimized(src.claim.where(F.col("claimtype") == "REFUND"))
    lines = p.splitlines()
    at = next(i for i, line in enumerate(lines) if "Relation" in line and "l_returnflag" in line)
    assert "Filter" in lines[at - 1] and "l_returnflag" in lines[at - 1]


def test_country_filter_is_below_the_response_shuffle(spark):
    from regstar.plans import catalogue as C

    star = build_star(spark, driver_sources(spark, SF_SMALL))
    for df in (
        Q.q3_top_price(star, C.Q3_COUNTRIES, C.Q3_YEAR, C.Q3_QUARTER),
        Q.q4_top(star, C.Q4_COUNTRY, C.Q4_START, C.Q4_END, measure="pct"),
    ):
        p = _optimized(df)
        assert "checkpoint" not in p.lower()
        lines = p.splitlines()
        depth = lambda *keys: min(len(x) - len(x.lstrip(" :+-")) for x in lines if all(k in x for k in keys))
        assert depth("Filter", "country_bk#") > depth("= __response_key")


def test_arg_max_is_a_broadcast_join_not_a_window(spark):
    star = build_star(spark, driver_sources(spark, SF_SMALL))
    from regstar.plans import catalogue as C

    df = Q.q4_top(star, C.Q4_COUNTRY, C.Q4_START, C.Q4_END, measure="pct")
    df.collect()
    p = _plan(df)
    assert "Window" not in p
    assert "BroadcastHashJoin" in p


def test_results_do_not_depend_on_shuffle_partitions(spark):
    import __spark_entry__ as E

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(E.queries()["fact_reimbursement"](spark, SF_SMALL).collect(), key=repr)
        q1a = E.queries()["q1_claims_per_year"](spark, SF_SMALL).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = sorted(E.queries()["fact_reimbursement"](spark, SF_SMALL).collect(), key=repr)
        q1b = E.queries()["q1_claims_per_year"](spark, SF_SMALL).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b and q1a == q1b


def test_calendar_is_consecutive_days(spark):
    from pyspark.sql import functions as F

    from regstar.plans.calendar import dim_calendar

    cal = dim_calendar(spark)
    s = cal.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("dt").alias("lo"),
        F.max("dt").alias("hi"),
        F.countDistinct("dt").alias("days"),
        F.max(F.abs(F.datediff("dt", F.lit("1900-01-01").cast("date")) - F.col("date_id"))).alias("off"),
    ).collect()[0]
    assert (s.n, s.days, s.off) == (73050, 73050, 0)
    assert str(s.lo) == "1900-01-01" and str(s.hi) == "2100-01-01"
    q = cal.where("dt = DATE'2011-11-15'").collect()[0]
    assert (q.date, q.year, q.month, q.day, q.quarter) == ("2011-11-15", 2011, 11, 15, "Q4")


def test_claims_of_a_maximum_are_read_once(spark):
    """The rows that tie and their maximum come from one shuffle, also below
    the join with the products."""
    from regstar.plans import catalogue as C

    star = build_star(spark, driver_sources(spark, SF_SMALL))
    df = Q.q3_top_price(star, C.Q3_COUNTRIES, C.Q3_YEAR, C.Q3_QUARTER)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    # One scan for the claims, one for the responses.
    assert final.count("FileScan parquet [l_orderkey") == 2
    assert "ReusedExchange" in final


def test_small_lists_are_looked_up_after_the_shuffles(spark):
    """Neither the small lists' columns nor source columns that no fact has are
    shuffled or written with the shared lookups."""
    from regstar.functions.keys import KEY_WHITESPACE
    from regstar.plans.facts import LOOKUP_ONLY, REFUND, REGISTER, claim_lookups

    found = claim_lookups(build_star(spark, driver_sources(spark, SF_SMALL)), (REGISTER, REFUND), with_attributes=True)
    assert not set(found.columns) & set(LOOKUP_ONLY)
    lines = _optimized(found).replace(KEY_WHITESPACE, "").splitlines()
    depth = lambda key: min(len(x) - len(x.lstrip(" :+-")) for x in lines if key in x)
    small = max(depth("= __country_key"), depth("= __indication_key"))
    assert small < min(depth("= __response_key"), depth("= __product_key"))


def test_sql_response_build_does_not_shuffle_by_code(spark):
    """All responses have a few codes, so they must not be dealt out by them."""
    from regstar.plans.catalogue import dim_response_sql

    p = _plan(dim_response_sql(spark, SF_SMALL))
    dealt = [line.split("hashpartitioning(")[1] for line in p.splitlines() if "Exchange hashpartitioning(response#" in line]
    assert "BroadcastHashJoin [response#" in p and not dealt


def test_a_lookup_evaluates_its_key_once(spark):
    """A sort-merge join sorts by its keys, so a key that is an expression would
    be evaluated again for each comparison."""
    from regstar.functions.keys import KEY_WHITESPACE, clean_bk
    from regstar.operators import lookup

    fact = spark.createDataFrame([(1, " a\t"), (2, "A"), (3, "b"), (4, None)], "n int, code string")
    dim = spark.createDataFrame([("A", 7), ("A", 8), ("C", 9), (None, 1)], "bk string, id int")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup(fact, dim, fact_key=clean_bk("code"), dim_key="bk", carry={"id": "id"})
        plan = found._jdf.queryExecution().executedPlan().toString().replace(KEY_WHITESPACE, "")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    sorts = [x for x in plan.splitlines() if "Sort [" in x or "SortMergeJoin [" in x]
    assert sorts and not any("btrim" in x or "trim(" in x for x in sorts)
    assert found.columns == ["n", "code", "id"]
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == [(1, " a\t", 7), (1, " a\t", 8), (2, "A", 7), (2, "A", 8), (3, "b", None), (4, None, None)]
