"""Column expressions (all JVM-side, no Python workers)."""

from pyspark.sql import SparkSession

from regstar.functions.keys import (
    CALENDAR_END,
    CALENDAR_START,
    CLEAN_BK_SQL,
    clean_bk,
    date_key,
    date_of_key,
    surrogate_key,
)
from regstar.functions.text import (
    NULL_PRICE_TEXT,
    has_price,
    parse_date,
    price_amount,
    price_currency,
    quarter_label,
)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``format_bk(s)`` callable from SQL text.

    A SQL function (``CREATE TEMPORARY FUNCTION ... RETURN``) is inlined by the
    analyzer, so SQL text gets the same native plan as :func:`clean_bk`.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION format_bk(s STRING) "
        f"RETURNS STRING RETURN {CLEAN_BK_SQL}"
    )


__all__ = [
    "CALENDAR_END",
    "CALENDAR_START",
    "CLEAN_BK_SQL",
    "NULL_PRICE_TEXT",
    "clean_bk",
    "date_key",
    "date_of_key",
    "has_price",
    "parse_date",
    "price_amount",
    "price_currency",
    "quarter_label",
    "register_sql_functions",
    "surrogate_key",
]
