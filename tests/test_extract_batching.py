"""Incremental predicates, caps, batches, ledger and running watermark."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import extract as ex
from strata.operators.batching import batch_ledger, batch_slices, global_index, running_watermark
from strata.sources.search import read_by_ids, search

T = dt.datetime


def headers(spark, rows):
    return spark.createDataFrame(rows, "id long, write_date string")


def test_inclusive_boundary_and_order(spark):
    h = headers(spark, [(10, "2024-03-15 08:00:00"), (20, "2024-03-15 09:00:00"), (30, "2024-03-15 07:00:00"),
                        (40, "2024-03-15 09:00:00"), (50, "2024-03-15 10:00:00"), (60, "2024-03-15 11:00:00")])
    got = ex.fetch_new_ids(h, T(2024, 3, 15, 9, 0, 0, 500000), h.select(F.col("id").alias("account_move_id")))
    # the watermark is floored to the second: both 09:00 records come back
    assert sorted(r.id for r in got.collect()) == [20, 40, 50, 60]


def test_cold_start_takes_everything_with_lines(spark):
    h = headers(spark, [(1, None), (2, "2024-01-01 00:00:00"), (3, "")])
    parents = spark.createDataFrame([(1,), (2,)], "account_move_id long")
    assert sorted(r.id for r in ex.fetch_new_ids(h, None, parents).collect()) == [1, 2]


def test_cap_includes_ties_on_the_boundary_second(spark):
    h = headers(spark, [(i, "2024-01-01 00:00:01") for i in range(5)] + [(9, "2024-01-01 00:00:02")])
    got = ex.fetch_new_ids(h, T(2024, 1, 1), h.select(F.col("id").alias("account_move_id")), cap=2)
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4]


def test_capped_cold_start_keeps_null_cursor_rows(spark):
    h = headers(spark, [(1, None), (2, "2024-01-02 00:00:00"), (3, "2024-01-01 00:00:00")])
    got = ex.fetch_new_ids(h, None, h.select(F.col("id").alias("account_move_id")), cap=1)
    assert sorted(r.id for r in got.collect()) == [1, 3]


def test_max_cursor_skips_null_and_empty(spark):
    h = headers(spark, [(1, "2024-01-01 00:00:00"), (2, None), (3, ""), (4, "2024-02-01 00:00:00")])
    assert ex.max_cursor(h, "write_date").first()[0] == T(2024, 2, 1)
    assert ex.max_cursor(headers(spark, [(1, None)]), "write_date").first()[0] is None


def test_batches_250_by_100(spark):
    ids = spark.range(250).select(F.col("id"))
    out = batch_slices(ids, ["id asc"], 100)
    sizes = {r.batch_no: r.n for r in out.groupBy("batch_no").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 100, 1: 100, 2: 50}
    assert out.filter("batch_no = 2").agg(F.min("id")).first()[0] == 200


def test_global_index_is_a_total_order_position(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    idx = global_index(df, ["k asc"], num_partitions=7)
    assert idx.filter(F.col("_idx") != F.col("k")).count() == 0


def test_ledger_counts_and_running_watermark(spark):
    slices = spark.createDataFrame([(1, T(2024, 1, 1), 0), (2, T(2024, 1, 2), 0), (3, T(2024, 1, 3), 1)],
                                   "id long, write_date timestamp_ntz, batch_no long")
    saved = spark.createDataFrame([(1,), (3,)], "id long")
    led = {r.batch_no: r for r in batch_ledger(slices, saved, cursor="write_date").collect()}
    assert (led[0].records_processed, led[0].records_inserted, led[0].records_failed) == (2, 1, 1)
    rw = {r.batch_no: r.watermark for r in running_watermark(batch_ledger(slices, saved, cursor="write_date"),
                                                                 previous=T(2024, 1, 2, 12)).collect()}
    assert rw == {0: T(2024, 1, 2, 12), 1: T(2024, 1, 3)}


def test_search_domain_and_read_by_ids(spark):
    h = spark.createDataFrame([(1, "posted", "2024-01-01 00:00:00"), (2, "draft", "2024-02-01 00:00:00"),
                               (3, "posted", "2024-03-01 00:00:00")], "id long, state string, write_date string")
    lines = spark.createDataFrame([(1,), (3,)], "account_move_id long")
    got = search(h, [("write_date", ">", T(2024, 1, 1)), ("line_ids", "!=", False)], order=["id asc"],
                 relations={"line_ids": (lines, "account_move_id")})
    assert [r.id for r in got.collect()] == [3]
    got = read_by_ids(h, spark.createDataFrame([(2,), (99,)], "id long"))
    assert [r.id for r in got.collect()] == [2]
