"""Bronze -> Silver: current state, one row per key, latest version wins.

Full rebuild: rescan Bronze (``date is not null`` is the full-scan predicate),
rename audit columns, dedup.  Incremental: dedup over the previous Silver
united with the Bronze rows ingested since Silver's newest row; with a total
dedup order this equals the full rebuild (a key-replacing merge would let a
late, older version win).  ``refresh`` does so on a bucketed table and rewrites
only the buckets that new rows fall in; ``materialize`` writes whole versions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import dedup_latest, full_order
from strata.schemas import BRONZE_LINE, BRONZE_MOVE, SILVER_RENAMES, EntitySpec
from strata.sinks.staged import freed_shuffles, put_down

# Fixed value: the look-back floor when Silver is still empty.
EPOCH = "1970-01-01 00:00:00"

MOVES = EntitySpec("stg_account_moves", key=("id",), cursor="source_modified_at",
                   order=("ingested_at desc",), tiebreak=("sync_batch_id desc",))
LINES = EntitySpec("stg_account_move_lines", key=("id",), cursor="source_modified_at",
                   order=("ingested_at desc",), tiebreak=("sync_batch_id desc",))


def mirror(bronze: DataFrame, bronze_schema=None) -> DataFrame:
    """Silver mirror projection: declared Bronze columns with audit renames."""
    names = [f.name for f in bronze_schema.fields] if bronze_schema is not None else [
        c for c in bronze.columns if c != "date_month"]
    return bronze.select(*[F.col(n).alias(SILVER_RENAMES.get(n, n)) for n in names])


def silver_order(df: DataFrame, spec: EntitySpec, total: bool = True) -> list[str]:
    order = spec.dedup_order()
    return full_order(df, spec.key, order) if total else order


def build_silver(bronze: DataFrame, spec: EntitySpec, bronze_schema=None, total: bool = True) -> DataFrame:
    """Full rebuild of one Silver table from its whole Bronze table."""
    current = mirror(bronze.filter(F.col("date").isNotNull()), bronze_schema)
    return dedup_latest(current, list(spec.key), silver_order(current, spec, total))


def silver_headers(bronze_moves: DataFrame, total: bool = True) -> DataFrame:
    return build_silver(bronze_moves, MOVES, BRONZE_MOVE, total)


def silver_lines(bronze_lines: DataFrame, total: bool = True) -> DataFrame:
    return build_silver(bronze_lines, LINES, BRONZE_LINE, total)


def lookback(silver: DataFrame) -> DataFrame:
    """One-row frame: ``coalesce(max(ingested_at), epoch)`` of Silver."""
    return silver.agg(
        F.coalesce(F.max("ingested_at"), F.lit(EPOCH).cast("timestamp_ntz")).alias("lookback_ts"))


def lookback_value(silver: DataFrame):
    """The look-back scalar (one aggregate value, collected)."""
    with freed_shuffles(silver.sparkSession):
        return lookback(silver).first()["lookback_ts"]


def bronze_increment(bronze: DataFrame, silver: DataFrame, since=None) -> DataFrame:
    """Bronze rows ingested at or after Silver's newest row (ingestion axis,
    not the accounting-date axis: a changed record re-enters Bronze with a
    fresh ``synced_at`` whatever its date).  The look-back is one scalar,
    applied as a literal so the predicate reaches the Parquet scan."""
    if since is None:
        since = lookback_value(silver)
    return bronze.filter(F.col("synced_at") >= F.lit(since).cast("timestamp_ntz"))


def silver_incremental(silver: DataFrame, bronze: DataFrame, spec: EntitySpec, bronze_schema=None,
                       total: bool = True) -> DataFrame:
    """dedup(previous Silver ∪ new Bronze versions)."""
    new = mirror(bronze_increment(bronze, silver).filter(F.col("date").isNotNull()), bronze_schema)
    both = silver.select(*new.columns).unionByName(new)
    return dedup_latest(both, list(spec.key), silver_order(both, spec, total))


def silver_schema(bronze_schema: T.StructType) -> T.StructType:
    """Declared schema of the Silver mirror of a Bronze table."""
    return T.StructType([T.StructField(SILVER_RENAMES.get(f.name, f.name), f.dataType) for f in bronze_schema.fields])


def silver_table(spark, base: str, spec: EntitySpec, bronze_schema, buckets: int | None = None):
    """The bucketed Silver table at ``base``."""
    from strata.sinks.buckets import BUCKETS, BucketTable

    return BucketTable(spark, base, silver_schema(bronze_schema), spec.key, buckets or BUCKETS)


def refresh(spark, bronze: DataFrame | str, base: str, spec: EntitySpec, bronze_schema, buckets: int | None = None,
            full: bool = False, slices: int = 1):
    """Bring a bucketed Silver table up to its Bronze rows; returns its manifest.
    ``bronze`` is the table's path (a look-back then opens only the folders that
    came in since) or a frame of it.

    The manifest keeps the newest ingestion time taken in (``lookback``), so the
    look-back reads no Silver row.  The first refresh, or a ``full`` one, builds
    every bucket.  Otherwise the Bronze rows ingested at or after the look-back
    are stored once, and only the buckets they fall in are deduplicated again
    with what they hold, in ``slices`` groups of buckets."""
    from strata.session import scratch_path
    from strata.sinks import files

    staged = scratch_path(spark, "refresh")
    table = silver_table(spark, base, spec, bronze_schema, buckets)

    def newest(rows: DataFrame) -> DataFrame:
        return dedup_latest(rows, list(spec.key), silver_order(rows, spec))

    old = None if full else table.current()
    since = old.marks["lookback"] if old else EPOCH
    if isinstance(bronze, str):
        from strata.sources.bronze import scan_bronze

        at = dt.datetime.fromisoformat(since)
        bronze = scan_bronze(spark, bronze, bronze_schema, full=True, since=at if old else None)
    rows = bronze.filter(F.col("date").isNotNull())
    if old:
        rows = bronze_increment(rows, None, since)
    rows = mirror(rows, bronze_schema)
    try:
        with freed_shuffles(spark):
            if old:
                rows = put_down(rows, staged)  # read by the bucket search, the merge and the look-back
            seen = rows.agg(F.max("ingested_at").cast("string")).first()[0]
            marks = {"lookback": max(since, seen) if seen else since}
            return table.refresh(rows, newest, marks, slices) if old else table.replace(newest(rows), marks, slices)
    finally:
        files.delete(spark, staged)


def materialize(spark, bronze_path: str, silver_base: str, spec: EntitySpec, bronze_schema,
                incremental: bool = False) -> str:
    """Build one Silver table from its Bronze table and write it as a new
    version folder (never over the path being read); returns that path.

    ``incremental`` refreshes the current version with the Bronze rows
    ingested since its newest row; otherwise a full rescan is made."""
    from strata.sinks import tables
    from strata.sources.bronze import scan_bronze

    bronze = scan_bronze(spark, bronze_path, bronze_schema, full=True)
    current = tables.current_version(spark, silver_base) if incremental else None
    if current is None:
        out = build_silver(bronze, spec, bronze_schema)
    else:
        previous = spark.read.parquet(current)
        out = silver_incremental(previous, bronze, spec, bronze_schema)
    return tables.write_version(out, silver_base)
