"""Reuse for other entities: events (timestamp cursor), conversations (integer cursor)."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.dedup import dedup_latest, full_order
from strata.plans.entity_sync import EntitySync, current_state
from strata.plans.runlog import RunLog
from strata.schemas import EntitySpec

EVENTS = EntitySpec("events", key=("user_id",), cursor="ts")
CONVERSATIONS = EntitySpec("conversations", key=("conv_id",), cursor="turn")


def run_twice(spark, tmp_path, sf_dir, spec, table, first_part, cursor_type="timestamp"):
    src = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    log = RunLog(spark, str(tmp_path / "control" / "events"))
    bronze = str(tmp_path / "raw" / table)
    ticks = iter([dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 2)])
    sources = iter([src.filter(first_part), src])

    job = EntitySync(spark, spec, lambda s, wm: next(sources), bronze, log, clock=lambda: next(ticks),
                     cursor_type=cursor_type)
    r1 = job.run()
    r2 = job.run()
    return src, spark.read.parquet(bronze), log, r1, r2


def expected(src, spec):
    return dedup_latest(src, list(spec.key), full_order(src, spec.key, [f"{spec.cursor} desc"]))


def test_events_entity_sync(spark, tmp_path, sf_dir):
    src, bronze, log, r1, r2 = run_twice(spark, tmp_path, sf_dir, EVENTS, "events",
                                         F.col("ts") < F.lit(dt.datetime(2024, 1, 2)))
    assert r1.watermark < r2.watermark == src.agg(F.max("ts")).first()[0]
    assert log.get_watermark("events") == r2.watermark
    got = current_state(bronze, EVENTS).select(*src.columns)
    assert got.exceptAll(expected(src, EVENTS)).isEmpty() and expected(src, EVENTS).exceptAll(got).isEmpty()


def test_integer_cursor_entity_sync(spark, tmp_path, sf_dir):
    src, bronze, log, r1, r2 = run_twice(spark, tmp_path, sf_dir, CONVERSATIONS, "conversations",
                                         F.col("turn") <= 2, cursor_type="bigint")
    assert r1.watermark == 2 and log.get_watermark("conversations", "bigint") == r2.watermark
    # run 2 re-reads the boundary turn (inclusive cursor), Silver absorbs it
    assert bronze.filter("turn = 2").count() == 2 * src.filter("turn = 2").count()
    got = current_state(bronze, CONVERSATIONS).select(*src.columns)
    assert got.exceptAll(expected(src, CONVERSATIONS)).isEmpty()
    assert got.count() == src.select("conv_id").distinct().count()
