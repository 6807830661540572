"""Every catalogue query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01), plus the DataFrame/SQL twins."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

from oracle_queries import ORACLE_SQL
from regstar.plans.catalogue import CATALOGUE

NAMES = sorted(CATALOGUE)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(CATALOGUE) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    rep = compare(spark, SF_SMALL, [name])[name]
    assert rep["columns_match"], rep
    assert rep["values_match"], rep
    assert rep["spark_rows"] == rep["oracle_rows"]


@pytest.mark.parametrize(
    "df_form, sql_form",
    [
        ("q3_top_price", "q3_sql_twin"),
        ("q4a_top_amount", "q4a_sql"),
        ("q4b_top_percent", "sql_view_question"),
        ("q2b_share_own_total", "q2b_sql_twin"),
        ("q2a_on_time_share", "q2a_sql_twin"),
    ],
)
def test_dataframe_and_sql_forms_agree(spark, df_form, sql_form):
    q = E.queries()
    a = q[df_form](spark, SF_SMALL)
    b = q[sql_form](spark, SF_SMALL)
    common = [c for c in a.columns if c in b.columns]
    assert common
    ra = sorted(tuple(r[c] for c in common) for r in a.collect())
    rb = sorted(tuple(r[c] for c in common) for r in b.collect())
    assert ra == rb


def test_entry_runs(spark):
    df = E.entry(spark)
    got = df.collect()
    assert df.columns == ["year", "count"]
    assert len(got) > 0 and [r.year for r in got] == sorted(r.year for r in got)


def test_written_star_answers_like_the_catalogue(spark):
    """The bench's build-once path (materialized star) gives the same answers
    as the catalogue queries, which the oracles check."""
    from regstar.plans import catalogue as C
    from regstar.plans import questions as Q
    from regstar.plans.star import build_star, materialize
    from regstar.sources import driver_sources

    star = materialize(build_star(spark, driver_sources(spark, SF_SMALL)))
    pairs = [
        (Q.q1_claims_per_year(star), "q1_claims_per_year"),
        (Q.q2a_on_time_share(star), "q2a_on_time_share"),
        (Q.q2b_share(star, denominator="reimbursement"), "q2b_share_as_reference"),
        (Q.q3_top_price(star, C.Q3_COUNTRIES, C.Q3_YEAR, C.Q3_QUARTER), "q3_top_price"),
        (Q.q4_top(star, C.Q4_COUNTRY, C.Q4_START, C.Q4_END, measure="price_over_pct"), "q4a_top_amount"),
        (Q.q4_top(star, C.Q4_COUNTRY, C.Q4_START, C.Q4_END, measure="pct"), "q4b_top_percent"),
    ]
    for df, name in pairs:
        expected = E.queries()[name](spark, SF_SMALL)
        assert sorted(df.collect(), key=repr) == sorted(expected.collect(), key=repr), name


def test_q1_twin_counts_the_reimbursement_fact(spark):
    """T13: the SQL form of Q1 counts reimbursement claims per year; the
    DataFrame operator over the same fact gives the same counts."""
    from regstar.plans import questions as Q
    from regstar.plans.star import build_star
    from regstar.sources import driver_sources

    star = build_star(spark, driver_sources(spark, SF_SMALL))
    df_form = [(r.year, r["count"]) for r in Q.claims_per_year(star.reimbursement(), star).collect()]
    sql_form = [(r.year, r.number_of_claims) for r in E.queries()["q1_sql_twin"](spark, SF_SMALL).collect()]
    assert df_form == sql_form and df_form
