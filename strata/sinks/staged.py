"""Large frames put down as compressed Parquet, slice by slice.

A checkpoint keeps rows as Spark holds them in memory, several times the size of
compressed columns, and the shuffle files of a query stay until the driver
happens to collect garbage.  Here a frame is written in slices of its key, each a
query of its own whose shuffle files go when it ends, so the disk holds the rows
written so far and one slice's shuffles.  Every slice reads the sources anew.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import input_size

CODEC = "zstd"
#: A table is written in one slice per ``SLICE_BYTES`` of source files, ``SLICES`` at most, as each one scans them.
SLICE_BYTES, SLICES = 16 << 20, 4
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def slices_for(spark: SparkSession, paths: list[str]) -> int:
    return max(1, min(SLICES, -(-input_size(spark, paths) // SLICE_BYTES)))


def sliced(df: DataFrame, key: Sequence[str] | str, slices: int) -> Iterator[DataFrame]:
    """``df`` in parts by hash of ``key``; rows of one key share a part.  Catalyst
    carries the filter below windows and joins on the key, down to the scans."""
    keys = [key] if isinstance(key, str) else list(key)
    if slices <= 1:
        yield df
        return
    for i in range(slices):
        yield df.filter(F.pmod(F.xxhash64(*keys), F.lit(slices)) == i)


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Writes begun within drop their shuffle files when they end.  (A frame that
    is run again makes its shuffles again, as every query has its own.)"""
    was = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, was)


def put_down(df: DataFrame, path: str, slices: int = 1, key: Sequence[str] | str = "id") -> DataFrame:
    """Write ``df`` at ``path``, which must be new, and return it as read from there."""
    spark = df.sparkSession
    with freed_shuffles(spark):
        for i, part in enumerate(sliced(df, key, slices)):
            part.write.mode("append" if i else "errorifexists").option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
