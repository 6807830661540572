"""Text parsing expressions: prices, quarters, dates held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regstar.functions.keys import ColumnOrName, _col

# Fixed value: the text that marks a missing price in the claim source.
NULL_PRICE_TEXT = "null"


def price_amount(c: ColumnOrName) -> Column:
    """Amount of a price text such as ``'150 CHF'``: everything but the last
    three characters, trimmed, as INT. Text that is not an integer gives null
    (``try_cast``; a plain cast fails under ANSI mode)."""
    p = _col(c)
    head = p.substr(F.lit(1), F.length(p) - 3)
    return F.trim(head).try_cast("int")


def price_currency(c: ColumnOrName) -> Column:
    """Currency of a price text: its last three characters."""
    return F.substring(_col(c), -3, 3)


def has_price(c: ColumnOrName) -> Column:
    """Price present: neither SQL null nor the ``'null'`` marker text."""
    p = _col(c)
    return p.isNotNull() & (p != F.lit(NULL_PRICE_TEXT))


def quarter_label(c: ColumnOrName) -> Column:
    """``'Q1'`` .. ``'Q4'`` for a date."""
    return F.concat(F.lit("Q"), F.quarter(_col(c)).cast("string"))


def parse_date(c: ColumnOrName) -> Column:
    """Date held as text to DATE; unparsable text gives null."""
    return _col(c).try_cast("date")
