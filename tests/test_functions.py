"""Scalar helpers: cursor parsing, local dates, tabular normalisation."""

import datetime as dt

from strata.functions.dates import parse_naive_utc, utc_to_local_date
from strata.functions.tabular import normalize_tabular


def one(spark, col_fn, value):
    return spark.createDataFrame([(value,)], "s string").select(col_fn("s").alias("v")).first()["v"]


def test_parse_naive_utc(spark):
    assert one(spark, parse_naive_utc, "2024-03-15 10:30:00") == dt.datetime(2024, 3, 15, 10, 30)
    assert one(spark, parse_naive_utc, "2024-03-15 10:30:00.123456") == dt.datetime(2024, 3, 15, 10, 30)
    assert one(spark, parse_naive_utc, None) is None
    assert one(spark, parse_naive_utc, "") is None
    assert one(spark, parse_naive_utc, "not-a-date") is None
    assert one(spark, parse_naive_utc, "2024-03-15") is None


def test_utc_to_local_date(spark):
    assert one(spark, utc_to_local_date, "2024-03-15 10:00:00") == "2024-03-15"
    assert len(one(spark, utc_to_local_date, "2024-03-15 10:00:00")) == 10
    assert one(spark, utc_to_local_date, "2024-03-15 02:00:00") == "2024-03-14"  # UTC-3 in March
    assert one(spark, utc_to_local_date, "2024-03-15") == "2024-03-15"
    assert one(spark, utc_to_local_date, "") == ""
    assert one(spark, utc_to_local_date, "not-a-date-at-all") == "not-a-date"


def test_normalize_tabular(spark):
    df = spark.createDataFrame(
        [("'12.0", "3.14159", "'abc", " 7 ", "", "1e400", "x")],
        "Cantidad string, precio string, Nota string, total string, descuento string, monto string, extra string")
    r = normalize_tabular(df).first()
    assert r["Cantidad"] == "12"      # quote stripped, integral -> no fraction
    assert r["precio"] == "3.14"      # rounded to 2 places
    assert r["Nota"] == "abc"         # not a numeric header: only the quote goes
    assert r["total"] == "7"
    assert r["descuento"] == ""       # blank stays blank
    assert r["monto"] == "1e400"      # overflow stays as it is
    assert r["extra"] == "x"
