"""The business questions, parameterised, as DataFrame plans over the star.

Every question is a single plan: scalars (a total, a maximum) stay inside the
plan as one-row aggregates instead of being collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.functions import date_key, quarter_label
from regstar.operators import arg_max_rows, union_all, weighted_share
from regstar.plans.facts import REFUND, REGISTER, answered_prices, offers, weighted_claims, with_products
from regstar.plans.star import Star, answered_in

APPROVED = "Approved"
QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def claims_per_year(fact: DataFrame, star: Star) -> DataFrame:
    """Fact rows per submission year, ascending. The calendar (fixed size) is
    broadcast, so the only shuffle is the partial count per year."""
    cal = F.broadcast(star.calendar.select("date_id", "year"))
    return (
        fact.join(cal, fact.submission_date_id == cal.date_id)
        .groupBy("year")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("year")
    )


def q1_claims_per_year(star: Star) -> DataFrame:
    """Q1: registration claims per submission year. On a star that is not
    written, claims are counted by day with their weights: no fact is built."""
    if star.facts_written:
        return claims_per_year(star.registration(), star)
    claims = weighted_claims(star, (REGISTER,), answers=False)
    per_day = claims.groupBy("submission_date_id").agg(F.sum("weight").alias("n"))
    cal = F.broadcast(star.calendar.select("date_id", "year"))
    days = per_day.join(cal, per_day.submission_date_id == cal.date_id)
    return days.groupBy("year").agg(F.sum("n").alias("count")).orderBy("year")


def on_time_approved() -> Column:
    """Approved, with the answer on or before the expected date. Date keys
    grow with the date, and a null key (date outside the calendar, or no
    response) fails the comparison, as the inner calendar joins would."""
    return (F.col("response") == APPROVED) & (
        F.col("response_date_id") <= F.col("expectedresponse_date_id")
    )


def _claims_with_answers(star: Star, *claimtypes: str) -> DataFrame:
    """claimtype, response and date keys, weight: of written facts, or of the
    claims themselves (both claim types in one pass)."""
    if not star.facts_written:
        return weighted_claims(star, claimtypes)
    parts = []
    for claimtype in claimtypes:
        fact = star.registration(with_attributes=True) if claimtype == REGISTER else star.reimbursement(with_attributes=True)
        cols = ("response", "response_date_id", "expectedresponse_date_id")
        parts.append(fact.select(F.lit(claimtype).alias("claimtype"), *cols, F.lit(1).cast("long").alias("weight")))
    return union_all(parts)


def q2a_on_time_share(star: Star) -> DataFrame:
    """Q2.a: share of reimbursement claims approved on time."""
    claims = _claims_with_answers(star, REFUND)
    return weighted_share(claims, on_time_approved(), F.lit(True), F.col("weight"))


def q2b_share(star: Star, *, denominator: str = "reimbursement") -> DataFrame:
    """Q2.b: registration claims approved on time, over the number of
    ``denominator`` claims: ``'reimbursement'`` (as the modelled program
    computes it) or ``'registration'`` (its SQL form)."""
    over = {"reimbursement": REFUND, "registration": REGISTER}.get(denominator)
    if over is None:
        raise ValueError("denominator is 'reimbursement' or 'registration'")
    claims = _claims_with_answers(star, *dict.fromkeys((REGISTER, over)))
    kind = F.col("claimtype")
    return weighted_share(claims, (kind == REGISTER) & on_time_approved(), kind == over, F.col("weight"))


def q3_top_price(
    star: Star,
    countries: Iterable[str],
    year: int,
    quarter: str,
) -> DataFrame:
    """Q3: products of the highest approved price among reimbursement claims
    of a group of countries answered in one quarter; ties kept.

    The maximum is taken over all matching claims; only then are claims whose
    product is unknown dropped (the product lookup is an inner join in the
    second step only)."""
    if star.facts_written:
        cal = star.calendar.where((F.col("year") == year) & (F.col("quarter") == quarter)).select("date_id")
        fact = answered_in(star, countries, *quarter_days(year, quarter))
        rows = fact.where(F.col("response") == APPROVED).join(cal, fact.response_date_id == cal.date_id)
        top = arg_max_rows(rows.select("product_id", "product_bk", "product_name", "drug_price"), "drug_price")
        return top.where(F.col("product_id").isNotNull()).select("product_bk", "product_name").distinct()
    day = F.col("response_date")
    answers = (F.col("response") == APPROVED) & (F.year(day) == year) & (quarter_label(day) == quarter)
    rows = offers(star, countries, answers & date_key(day).isNotNull()).select("product_key", "drug_price").distinct()
    return with_products(star, arg_max_rows(rows, "drug_price")).select("product_bk", "product_name").distinct()


def quarter_days(year: int, quarter: str) -> tuple[date, date]:
    """First and last day of a quarter (``'Q1'`` .. ``'Q4'``); of the year for
    any other label, which no day has."""
    first = 3 * QUARTERS.index(quarter) + 1 if quarter in QUARTERS else 1
    last = first + 2 if quarter in QUARTERS else 12
    return date(year, first, 1), date(year + last // 12, last % 12 + 1, 1) - timedelta(days=1)


def prices_by_country(star: Star, year: int, quarter: str, **bounds) -> DataFrame:
    """For each country (null: unknown ones): approved offers answered in a
    quarter, the highest and the lowest price in each currency."""
    day = F.col("response_date")
    answers = (F.col("response") == APPROVED) & (F.year(day) == year) & (quarter_label(day) == quarter)
    prices = answered_prices(star, answers & date_key(day).isNotNull(), **bounds)
    return prices.groupBy("country_bk", "drug_price_currency").agg(
        F.count("*").alias("offers"), F.max("drug_price").alias("highest"), F.min("drug_price").alias("lowest")
    )


MEASURES = {
    "price_over_pct": lambda: F.try_divide(F.col("drug_price"), F.col("reimbursement_claimed_prc")),
    "price_times_pct": lambda: F.col("drug_price") * F.col("reimbursement_claimed_prc") / F.lit(100.0),
    "pct": lambda: F.col("reimbursement_claimed_prc"),
}


def q4_top(
    star: Star,
    country: str,
    start: date,
    end: date,
    *,
    measure: str = "price_over_pct",
    approved_only: bool = False,
) -> DataFrame:
    """Q4: reimbursement claims of one country answered between ``start`` and
    ``end`` (inclusive) whose ``measure`` is the highest; ties kept.

    ``price_over_pct`` (Q4.a as modelled: price divided by percentage, a zero
    percentage gives null), ``pct`` (Q4.b), or ``price_times_pct`` (the
    amount granted, which the Q4.a title asks for). ``approved_only`` adds the
    approval filter the modelled questions lack."""
    if star.facts_written:
        cal = star.calendar.where(F.col("dt").between(start, end)).select("date_id")
        fact = answered_in(star, [country], start, end)
        if approved_only:
            fact = fact.where(F.col("response") == APPROVED)
        rows = fact.join(cal, fact.response_date_id == cal.date_id).withColumn("measure", MEASURES[measure]())
        cols = ("product_id", "product_bk", "product_name", "reimbursement_claimed_prc", "drug_price", "measure")
        top = arg_max_rows(rows.select(*cols), "measure").where(F.col("product_id").isNotNull())
    else:
        answers = F.col("response_date").between(start, end) & date_key("response_date").isNotNull()
        if approved_only:
            answers = answers & (F.col("response") == APPROVED)
        rows = offers(star, [country], answers).withColumn("measure", MEASURES[measure]())
        top = with_products(star, arg_max_rows(rows, "measure"))
    return top.select("product_bk", "product_name", "reimbursement_claimed_prc", "drug_price")
