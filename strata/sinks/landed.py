"""Typed landing tables: raw records, partitioned by the day of their cursor.

A landing step reads newly landed files once and appends their records with a
typed cursor. An increment then opens only the partitions from its watermark's
day on, where a scan of text cursors has to read everything landed. Records
without a cursor, and those that no cursor search can find (broken, without an
id, with a cursor text that is no timestamp), have a partition each.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import parse_naive_utc
from strata.operators import transform as tr
from strata.sinks.staged import CODEC, freed_shuffles, sliced

DAY = "cursor_day"
CURSOR = "_cursor"
NO_CURSOR, UNREADABLE = "none", "unreadable"  # both stand after every day as text
DAILY, MONTHLY = "yyyy-MM-dd", "yyyy-MM"
_STRFTIME = {DAILY: "%Y-%m-%d", MONTHLY: "%Y-%m"}


def with_cursor(raw: DataFrame, cursor: str = "write_date", grain: str = DAILY) -> DataFrame:
    """``raw`` with its typed cursor and landing partition."""
    at = parse_naive_utc(F.nullif(F.col(cursor).cast("string"), F.lit("")))
    out = raw.withColumn(CURSOR, at)
    day = (F.when(tr.unreadable(raw), UNREADABLE).when(F.col(CURSOR).isNull(), NO_CURSOR)
           .otherwise(F.date_format(CURSOR, grain)))
    return out.withColumn(DAY, day)


def land(raw: DataFrame, path: str, cursor: str = "write_date", grain: str = DAILY, slices: int = 1) -> int:
    """Append raw records to the typed landing table, in ``slices`` parts by id
    (``sinks.staged``); returns their number."""
    if tr.CORRUPT not in raw.columns:
        raw = raw.withColumn(tr.CORRUPT, F.lit(None).cast("string"))
    if tr.SOURCE_FILE not in raw.columns:
        raw = raw.withColumn(tr.SOURCE_FILE, F.lit(None).cast("string"))
    rows = 0
    with freed_shuffles(raw.sparkSession):
        for part in sliced(raw, "id", slices):
            obs = Observation("landed")
            (with_cursor(part, cursor, grain).repartitionByRange(DAY, "id").sortWithinPartitions(DAY, CURSOR)
             .observe(obs, F.count(F.lit(1)).alias("rows"))
             .write.mode("append").option("compression", CODEC).partitionBy(DAY).parquet(path))
            rows += int(obs.get.get("rows", 0))
    return rows


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every landed record, with its typed cursor and partition."""
    text, stamp = T.StringType(), T.TimestampNTZType()
    extra = [T.StructField(n, t) for n, t in ((tr.CORRUPT, text), (tr.SOURCE_FILE, text), (CURSOR, stamp), (DAY, text))
             if n not in schema.fieldNames()]
    return spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(path)


def readable(landed: DataFrame, since: dt.datetime | None, grain: str = DAILY) -> DataFrame:
    """Records a run may take: all with an id and a readable cursor or none (cold
    start), else those whose cursor is at or after ``since`` (to the second)."""
    if since is None:
        return landed.filter(F.col(DAY) != UNREADABLE)
    since = since.replace(microsecond=0)
    return landed.filter((F.col(DAY) >= since.strftime(_STRFTIME[grain])) & (F.col(DAY) < NO_CURSOR)
                         & (F.col(CURSOR) >= F.lit(since).cast("timestamp_ntz")))


def unreadable(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col(DAY) == UNREADABLE)


class LandedSource:
    """A sync job's source over typed landing tables (see ``sync_run.Source``)."""

    def __init__(self, headers: str, lines: str | None, header_schema: T.StructType, line_schema: T.StructType | None,
                 grain: str = DAILY):
        self.paths, self.schemas, self.grain = (headers, lines), (header_schema, line_schema), grain

    def headers(self, spark: SparkSession, since) -> DataFrame:
        return readable(scan(spark, self.paths[0], self.schemas[0]), since, self.grain).drop(DAY, CURSOR)

    def unreadable_headers(self, spark: SparkSession) -> DataFrame:
        return unreadable(scan(spark, self.paths[0], self.schemas[0])).drop(DAY, CURSOR)

    def lines(self, spark: SparkSession) -> DataFrame | None:
        if self.paths[1] is None:
            return None
        return scan(spark, self.paths[1], self.schemas[1]).drop(DAY, CURSOR)
