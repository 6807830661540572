"""A history of the claim sources: how they stood at first, and the change sets
that lead from there to :func:`driver_sources`. Rows in the shape of the sources
only; the work on them is the store's.

- at first, claims submitted from ``SUBMITTED_FROM`` on are not there yet; those
  of country ``MOVED_TO`` are recorded under ``MOVED_FROM``; and every claim of
  type OTHER that is in the sources is there a second time as a REFUND claim
  under a number of its own, with an answer
- only answers ``F`` are there, those of orders that answer late (from
  ``ANSWERED_FROM`` on) with the date ``unknown``
- change set 1: the new claims, and the answers ``O`` and ``P``
- change set 2: the moved claims, and the late answers with their dates
- change set 3: the second REFUND claims and their answers are withdrawn
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstar.sources import schemas
from regstar.sources.driver_tables import Sources, driver_sources

SUBMITTED_FROM = "1997-07-01"
ANSWERED_FROM = "1996-01-01"
MOVED_FROM, MOVED_TO = "NA", "NH"
SECOND = "WD-"


def history(spark: SparkSession, sf_dir: str) -> tuple[Sources, list[dict[str, DataFrame]]]:
    """(sources at first, change sets as keyword arguments of ``Changes``)."""
    now = driver_sources(spark, sf_dir)
    claims, (answers,) = now.claim, now.responses
    number, date, code = (f.name for f in schemas.RESPONSES.fields)
    new = F.col("submissiondate") >= F.lit(SUBMITTED_FROM).cast("date")
    moved = F.col("countrycode") == MOVED_TO
    late = (F.col(code) == "F") & (F.col(date) >= ANSWERED_FROM) & (F.col(date) != "unknown")

    others = claims.where(F.col("claimtype") == "OTHER")
    second = others.withColumns(
        {
            "claimtype": F.lit("REFUND"),
            "claimnumber": F.concat(F.lit(SECOND), F.trim("claimnumber")),
            "drugprice": F.lit("999999 CHF"),
        }
    )
    second_answers = second.select(
        F.col("claimnumber").alias(number), F.lit("1998-11-11").alias(date), F.lit("F").alias(code)
    )
    at_first = claims.where(~new).withColumn(
        "countrycode", F.when(moved, F.lit(MOVED_FROM)).otherwise(F.col("countrycode"))
    )
    answered = answers.where(F.col(code) == "F").withColumn(date, F.when(late, F.lit("unknown")).otherwise(F.col(date)))
    given = {name: (lambda name=name: getattr(now, name)) for name in Sources.NAMES if name not in ("claim", "responses")}
    first = Sources(claim=at_first.unionByName(second), responses=[answered.unionByName(second_answers)], **given)
    return first, [
        {"claims": claims.where(new), "responses": answers.where(F.col(code) != "F")},
        {"claims": claims.where(~new & moved), "responses": answers.where(late)},
        {"withdrawn_claims": second.select("claimnumber"), "withdrawn_responses": second.select("claimnumber")},
    ]
