"""Properties of the operators against brute force on random small inputs."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regstar.operators import arg_max_rows, duplicate_keys, recode, share_of, unmapped_codes

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.one_of(st.none(), st.integers(min_value=-3, max_value=3)), min_size=0, max_size=12)
codes = st.lists(st.sampled_from(["y", "Y", "n", "N", "x", None]), min_size=0, max_size=12)


@SETTINGS
@given(values)
def test_arg_max_rows_keeps_exactly_the_maximal_rows(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v int")
    got = sorted(r.i for r in arg_max_rows(df, "v").collect())
    present = [v for v in vals if v is not None]
    want = sorted(i for i, v in enumerate(vals) if present and v == max(present))
    assert got == want


@SETTINGS
@given(codes)
def test_recode_and_unmapped_partition_the_rows(spark, raw):
    dictionary = spark.createDataFrame([("y", "Approved"), ("Y", "Approved"), ("N", "Declined")], "`from` string, `to` string")
    df = spark.createDataFrame([(i, c) for i, c in enumerate(raw)], "i int, code string")
    kept = {r.i: r.recoded for r in recode(df, dictionary, code="code").collect()}
    mapping = {"y": "Approved", "Y": "Approved", "N": "Declined"}
    assert kept == {i: mapping[c] for i, c in enumerate(raw) if c in mapping}
    unm = {r.code: r.n_rows for r in unmapped_codes(df, dictionary, code="code").collect()}
    assert unm == dict(Counter(c for c in raw if c not in mapping))


@SETTINGS
@given(st.lists(st.booleans(), min_size=0, max_size=15))
def test_share_of_matches_python(spark, flags):
    df = spark.createDataFrame([(f,) for f in flags], "f boolean")
    r = share_of(df, F.col("f"), numerator="n", total="t", share="s").collect()[0]
    assert (r.n, r.t) == (sum(flags), len(flags))
    assert r.s == (sum(flags) / len(flags) if flags else None)


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c", None]), min_size=0, max_size=12))
def test_duplicate_keys_reports_repeated_and_null_keys(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.n_rows for r in duplicate_keys(df, ["k"]).collect()}
    counts = Counter(keys)
    assert got == {k: n for k, n in counts.items() if n > 1 or k is None}
