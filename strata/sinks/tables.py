"""Versioned table directories: write a new version, then read the newest.

Overwriting a path that is being read fails once its files are gone, so a
materialised table is never rewritten in place: each build goes to a new
``v=<stamp>`` folder and readers take the newest complete one (``_SUCCESS``).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_version(df: DataFrame, base: str, partition_by: list[str] | None = None) -> str:
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    path = f"{base.rstrip('/')}/v={stamp}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    p, fs = _fs(df.sparkSession, path)
    return fs.makeQualified(p).toString()


def versions(spark: SparkSession, base: str) -> list[str]:
    p, fs = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
            if fs.exists(done):
                out.append(st.getPath().toString())
    return sorted(out)


def current_version(spark: SparkSession, base: str) -> str | None:
    vs = versions(spark, base)
    return vs[-1] if vs else None


def read_current(spark: SparkSession, base: str, schema=None) -> DataFrame:
    path = current_version(spark, base)
    if path is None:
        raise FileNotFoundError(f"no complete version under {base}")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)
