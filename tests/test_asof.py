"""As-of lookup against trying every version."""

from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regstar.operators import as_of

DAY = date(2020, 1, 1)
VERSION = "key string, name string, n int, valid_from date, valid_to date"


def on(n):
    return None if n is None else DAY + timedelta(days=n)


def asked(spark, facts, versions):
    f = spark.createDataFrame([(i, k, on(d)) for i, (k, d) in enumerate(facts)], "id int, k string, day date")
    v = spark.createDataFrame([(k, name, n, on(a), on(b)) for k, name, n, a, b in versions], VERSION)
    out = as_of(f, v, key=F.upper("k"), day=F.col("day"), carry=["name", "n"])
    assert out.columns == ["id", "k", "day", "name", "n"]
    return sorted((r.id, r.name, r.n) for r in out.select("id", F.col("name"), "n").collect())


def by_force(facts, versions):
    out = []
    for i, (k, d) in enumerate(facts):
        of = [v for v in versions if None not in (k, d, v[0], v[3]) and v[0] == k.upper() and v[3] <= d]
        last = [v for v in of if v[3] == max(x[3] for x in of)]
        best = min(last, key=lambda v: (v[1] is not None, v[1] or "", v[2], v[4] is not None, v[4] or 0), default=None)
        ended = best is not None and best[4] is not None and best[4] <= d
        out.append((i, None, None) if best is None or ended else (i, best[1], best[2]))
    return sorted(out)


FACTS = [("a", 5), ("a", 5), ("A", 10), ("b", 0), ("b", 3), ("b", 4), (None, 1), ("a", None), ("z", 1), ("a", -1), ("b", 9)]
VERSIONS = [
    ("A", "one", 1, 0, None), ("A", "two", 2, 5, None), ("A", "three", 3, 5, None), ("A", None, 4, 10, 11),
    ("B", "x", 1, 0, 4), ("B", "y", 2, 6, 8), (None, "n", 0, 0, None), ("B", "no start", 9, None, None), ("B", "x", 1, 0, 4),
]


def names(rows):
    return sorted(rows, key=repr)


def test_given_versions(spark):
    got = asked(spark, FACTS, VERSIONS)
    assert names(got) == names(by_force(FACTS, VERSIONS))
    found = {i: name for i, name, _ in got}
    assert found[0] == found[1] == "three" and found[3] == found[4] == "x"
    assert found[5] is None and found[10] is None and found[9] is None


def test_empty_tables(spark):
    assert asked(spark, [], VERSIONS) == []
    assert asked(spark, FACTS, []) == [(i, None, None) for i in range(len(FACTS))]


keys, days = st.sampled_from("ab"), st.integers(0, 12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(keys, days), min_size=1, max_size=40),
    st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from("pqr"), days, days, st.none() | days), min_size=1, max_size=25),
)
def test_any_versions(spark, facts, versions):
    assert names(asked(spark, facts, versions)) == names(by_force(facts, versions))


def test_a_hot_key_is_reduced_before_the_sort(spark):
    facts = spark.range(200_000).select(F.lit("A").alias("k"), F.date_add(F.lit(DAY), (F.col("id") % 50).cast("int")).alias("day"))
    v = spark.createDataFrame([("A", f"v{i}", i, on(5 * i), None) for i in range(10)], VERSION)
    out = as_of(facts, v, key=F.col("k"), day=F.col("day"), carry=["name"])
    assert {r["name"]: r["count"] for r in out.groupBy("name").count().collect()} == {f"v{i}": 20_000 for i in range(10)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
