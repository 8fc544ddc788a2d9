"""Incremental extraction: cursor predicate, cold start, cap, max cursor.

The cursor predicate is inclusive (``>=``) and the watermark is floored to
the second (the cursor's precision), so a record exactly at the watermark is
fetched again; the append-only Bronze and the latest-wins Silver absorb it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import floor_to_second, parse_naive_utc


def cursor_col(df: DataFrame, cursor: str) -> Column:
    """The cursor as a comparable value: text cursors are parsed ('' -> NULL)."""
    if isinstance(df.schema[cursor].dataType, T.StringType):
        return parse_naive_utc(F.nullif(F.col(cursor), F.lit("")))
    return F.col(cursor)


def incremental_filter(df: DataFrame, cursor: str, watermark) -> DataFrame:
    """``cursor >= floor_to_second(watermark)``; NULL watermark = cold start
    (no cursor predicate at all).  On a typed column this is a literal
    comparison, pushed down to the Parquet scan."""
    if watermark is None:
        return df
    wm = F.lit(watermark)
    if isinstance(df.schema[cursor].dataType, (T.TimestampNTZType, T.TimestampType)):
        wm = floor_to_second(wm.cast("timestamp_ntz"))
    return df.filter(cursor_col(df, cursor) >= wm)


def has_children(headers: DataFrame, children: DataFrame | None, parent_col: str = "account_move_id",
                 key: str = "id", list_col: str = "line_ids") -> DataFrame:
    """Headers with at least one line: a non-empty id list when the source
    ships one, else a left-semi join against the line frame."""
    if children is None:
        return headers.filter(F.coalesce(F.size(list_col) > 0, F.lit(False)))
    # distinct first: the partial aggregate ships one row per parent per map
    # task, so a header owning a third of all lines is no hot build side
    p = children.select(F.col(parent_col).alias("_parent")).distinct()
    return headers.join(p, headers[key] == p["_parent"], "left_semi")


def capped(df: DataFrame, cursor: str, key: str, cap: int) -> DataFrame:
    """At most ``cap`` rows in (cursor, key) order, widened to every row that
    ties with the last one on the cursor (a cap must never strand a second
    full of records: the next run starts at that second, inclusive).

    The threshold comes from a distributed top-k (``TakeOrderedAndProject``,
    ``cap`` rows at most), then one pushed-down filter."""
    if not cap:
        return df
    from strata.session import shared_root

    shared_root(df.sparkSession)
    # the candidate set is read twice (top-k, then filter): materialise it once
    df = df.checkpoint(eager=True)
    c = cursor_col(df, cursor)
    top = df.select(c.alias("_c"), F.col(key)).filter(F.col("_c").isNotNull()) \
        .orderBy(F.col("_c").asc(), F.col(key).asc()).limit(cap)
    threshold = top.agg(F.max("_c").alias("_t")).first()["_t"]
    if threshold is None:
        return df.filter(c.isNull())
    return df.filter(c <= F.lit(threshold))


def fetch_new_ids(headers: DataFrame, watermark, children: DataFrame | None = None, cap: int = 0,
                  cursor: str = "write_date", key: str = "id", parent_col: str = "account_move_id") -> DataFrame:
    """-> (key, cursor) of the records a run must process.

    Cold start (NULL watermark): every header with lines; with a cap, rows
    are taken in (cursor, key) order and NULL-cursor rows come outside the
    cap (no later ``>=`` predicate could ever select them).  Incremental:
    ``cursor >= watermark`` headers with lines, capped with ties."""
    base = has_children(headers, children, parent_col, key)
    base = base.select(F.col(key), cursor_col(headers, cursor).alias(cursor))
    if watermark is None:
        if not cap:
            return base
        return capped(base.filter(F.col(cursor).isNotNull()), cursor, key, cap).unionByName(
            base.filter(F.col(cursor).isNull()))
    return capped(incremental_filter(base, cursor, watermark), cursor, key, cap)


def max_cursor(df: DataFrame, cursor: str, by: list[str] | None = None) -> DataFrame:
    """Highest cursor (NULL and '' skipped) — overall or per group."""
    c = cursor_col(df, cursor)
    agg = F.max(c).alias("max_cursor")
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)
