"""Nearest known codes against comparing every code with every known one."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regstar.operators.nearest import nearest_codes, proposals, shortened


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def by_force(codes, known, most):
    out = set()
    for c in {c for c in codes if c is not None}:
        of = {k: edits(c, k) for k in known if k is not None}
        least = min(of.values(), default=most + 1)
        out |= {(c, k, d) for k, d in of.items() if d == least <= most}
    return out


def asked(spark, codes, known, most):
    df = nearest_codes(
        spark.createDataFrame([(c,) for c in codes], "code string"),
        spark.createDataFrame([(k,) for k in known], "known string"),
        max_distance=most,
    )
    return sorted(map(tuple, df.select("code", "known", "distance").collect()))


def test_given_codes(spark):
    codes = ["n", "no", "yes", "Y", "", None, "aab", "é", "abcd", "no", "zzzzzz"]
    known = ["N", "no.", "Yes", "", "ba", "abab", "e", None, "dcba", "abcd", "zzzz"]
    for most in (1, 2):
        assert asked(spark, codes, known, most) == sorted(by_force(codes, known, most))
    assert asked(spark, [], known, 2) == asked(spark, codes, [], 2) == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("ab😀", max_size=7), min_size=1, max_size=30),
    st.lists(st.text("ab😀", max_size=7), min_size=1, max_size=30),
)
def test_any_codes(spark, codes, known):
    assert asked(spark, codes, known, 2) == sorted(by_force(codes, known, 2))


def test_shortened_texts(spark):
    got = spark.createDataFrame([("abc",), ("",), ("aa",)], "c string").select("c", shortened(F.col("c"), 2).alias("t"))
    assert {c: set(t) for c, t in got.collect()} == {
        "abc": {"abc", "ab", "ac", "bc", "a", "b", "c"}, "": {""}, "aa": {"aa", "a", ""},
    }


def test_proposals_keep_every_code(spark):
    counted = spark.createDataFrame([("n", 3), ("zzzzz", 1), (None, 2), ("y" * 100, 4)], "code string, n long")
    known = spark.createDataFrame([("N",), ("m",), ("y" * 100,)], "known string")
    got = {tuple(r) for r in proposals(counted, known, code="code", known="known").select("code", "n", "proposal", "nearest", "distance").collect()}
    assert got == {("n", 3, "N", 2, 1), ("zzzzz", 1, None, 0, None), (None, 2, None, 0, None), ("y" * 100, 4, None, 0, None)}
