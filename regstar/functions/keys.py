"""Business-key cleaning and surrogate keys as native column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The characters that Python's ``str.strip`` removes from both
# ends of a text (ASCII white space, the separators U+001C to U+001F, U+0085,
# the no-break space and the Unicode spaces).
KEY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_bk(c: ColumnOrName) -> Column:
    """Business key as compared across sources: edges stripped, upper case.

    Null stays null. ``btrim`` with a character set is a plain scan of the
    two ends (no regular expression); it runs inside whole-stage codegen and,
    unlike a Python function, lets filters on the key reach the scan.
    """
    return F.upper(F.btrim(_col(c), F.lit(KEY_WHITESPACE)))


# SQL body of the same expression, for SQL text (see ``register_sql_functions``).
CLEAN_BK_SQL = "upper(btrim(s, '" + "".join(f"\\u{ord(c):04x}" for c in KEY_WHITESPACE) + "'))"


def surrogate_key(*cols: ColumnOrName) -> Column:
    """Deterministic 128-bit key over the raw source columns of a dimension row.

    Computed per row (no sort, no shuffle, no dependence on partitioning): the
    MD5, as 16 bytes, of the columns' texts, each with its length before it and
    a mark for null, so that no two different rows give one text. With 64 bits
    some pairs of 10^12 rows would collide; with 128 none is expected.
    """
    parts = []
    for c in cols:
        text = _col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


# Fixed values of the calendar dimension: first and last day, both included.
CALENDAR_START = date(1900, 1, 1)
CALENDAR_END = date(2100, 1, 1)


def date_key(c: ColumnOrName, start: date = CALENDAR_START, end: date = CALENDAR_END) -> Column:
    """Calendar surrogate key of a date: days since ``start``.

    Equal to the key a lookup into the calendar would return, and null for
    dates outside the calendar (as an unmatched left lookup would be), so the
    three date roles of a fact need no join at all. Keys grow with the date,
    so comparing keys compares dates.
    """
    d = _col(c)
    return F.when(
        d.between(F.lit(start), F.lit(end)), F.datediff(d, F.lit(start))
    ).cast("int")


def date_of_key(c: ColumnOrName, start: date = CALENDAR_START) -> Column:
    """Inverse of :func:`date_key`."""
    return F.date_add(F.lit(start), _col(c))
