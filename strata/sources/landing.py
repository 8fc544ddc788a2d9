"""Landing-zone scans of raw source records (JSON lines or Parquet).

The source's RPC reads become file scans with a declared schema and a fixed
field projection; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.transform import CORRUPT, SOURCE_FILE
from strata.schemas import LINE_FIELDS, MOVE_FIELDS, RAW_LINE, RAW_MOVE, RAW_MOVE_NESTED


def read_landing(spark: SparkSession, path: str, schema, fmt: str = "json") -> DataFrame:
    if fmt != "json":
        return spark.read.schema(schema).format(fmt).load(path)
    # a record that cannot be parsed keeps its row, with its text and file, and is rejected later
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(whole).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path)
            .withColumn(SOURCE_FILE, F.input_file_name()))


def project(df: DataFrame, fields: list[str]) -> DataFrame:
    """Declared field projection, in the declared order."""
    return df.select(*fields)


def scan_raw_headers(df: DataFrame) -> DataFrame:
    return project(df, MOVE_FIELDS)


def scan_raw_lines(df: DataFrame) -> DataFrame:
    return project(df, [*LINE_FIELDS, *(c for c in (CORRUPT, SOURCE_FILE) if c in df.columns)])


def read_raw_headers(spark: SparkSession, path: str, fmt: str = "json", nested: bool = False) -> DataFrame:
    return read_landing(spark, path, RAW_MOVE_NESTED if nested else RAW_MOVE, fmt)


def read_raw_lines(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return scan_raw_lines(read_landing(spark, path, RAW_LINE, fmt))
