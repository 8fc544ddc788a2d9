"""Cursor and calendar helpers.

Cursors have one-second precision: the source formats them as
``yyyy-MM-dd HH:mm:ss`` and anything longer is cut to 19 characters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The source's timestamp layout and the business's local zone.
NAIVE_UTC_PATTERN = "yyyy-M-d H:m:s"
LOCAL_TZ = "America/Santiago"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _canonical(s: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` exactly (the source's own layout)."""
    return ((F.length(s) == 19) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
            & (F.substring(s, 11, 1) == " ") & (F.substring(s, 14, 1) == ":") & (F.substring(s, 17, 1) == ":"))


def parse_naive_utc(col: Column | str) -> Column:
    """Naive UTC text -> TIMESTAMP_NTZ; NULL, '' and malformed text -> NULL.

    Canonical text takes Spark's native string cast (fast path); any other
    shape goes through the lenient pattern parser."""
    s = F.substring(_c(col), 1, 19)
    fast = F.when(_canonical(s), s.try_cast("timestamp_ntz"))
    slow = F.try_to_timestamp(s, F.lit(NAIVE_UTC_PATTERN)).cast("timestamp_ntz")
    return F.coalesce(fast, slow)


def parse_date(col: Column | str) -> Column:
    """``yyyy-MM-dd`` text -> DATE (fast native cast for the canonical form)."""
    s = _c(col).cast("string")
    canonical = (F.length(s) == 10) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
    return F.coalesce(F.when(canonical, s.try_cast("date")), F.try_to_date(s, "yyyy-MM-dd"))


def floor_to_second(col: Column | str) -> Column:
    return F.date_trunc("second", _c(col)).cast("timestamp_ntz")


def utc_to_local_date(col: Column | str, tz: str = LOCAL_TZ) -> Column:
    """UTC timestamp text -> local calendar date text (``yyyy-MM-dd``).

    '' and NULL -> ''; text that already is a date passes unchanged;
    malformed text -> its first 10 characters.
    """
    s = _c(col)
    is_date = (F.length(s) == 10) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), parse_naive_utc(s))
    return (
        F.when(F.coalesce(s, F.lit("")) == "", F.lit(""))
        .when(is_date, s)
        .otherwise(F.coalesce(F.date_format(local, "yyyy-MM-dd"), F.substring(s, 1, 10)))
    )
