"""Data-quality checks as one-pass aggregate reports."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dq_unique(df: DataFrame, key: Sequence[str] | str, table: str) -> DataFrame:
    """One row: rows, distinct keys and keys held by more than one row.
    Partial aggregation map-side; only one count per key crosses the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("row_count"),
        F.count(F.lit(1)).cast("long").alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).cast("long").alias("duplicate_keys"),
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "*")


def dq_not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """One row per column: its NULL count (all columns in a single pass,
    then the one-row result is unpivoted)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "column_name", "null_count")
    return long.select(F.lit(table).alias("table_name"), "column_name", "null_count")


def dq_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str = "id") -> DataFrame:
    """Child rows whose reference has no parent (must be empty)."""
    p = parent.select(F.col(pk).alias("_pk"))
    return child.join(p, child[fk] == p["_pk"], "left_anti")


def dq_passed(report: DataFrame, column: str) -> bool:
    return report.filter(F.col(column) > 0).isEmpty()
