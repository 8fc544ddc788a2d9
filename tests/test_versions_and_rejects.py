"""Several landed versions of a record, and records that cannot be read."""

import datetime as dt
import json

from strata.functions.tabular import normalize_number_text
from strata.operators import transform as tr
from strata.operators.dedup import dedup_latest, full_order
from strata.plans.runlog import RunLog
from strata.plans.sync_run import SyncJob
from strata.schemas import TAX, LayerPaths
from strata.sources import landing
from strata.streaming.landing_stream import run_landing_stream

LINE = {"id": 10, "quantity": 1.0, "price_subtotal": 5.0, "price_total": 6.0, "tax_ids": [1],
        "write_date": "2024-01-01 10:00:00"}
LANDED = [
    {"id": 1, "date": "2024-02-01", "state": "draft", "write_date": "2024-01-01 10:00:00", "_lines": [LINE]},
    {"id": 1, "date": "2024-03-01", "state": "posted", "write_date": "2024-01-09 10:00:00", "_lines": [LINE]},
    {"id": 2, "date": "2024-02-01", "write_date": "2024-01-02 10:00:00", "_lines": []},
    {"id": 3, "date": "2024-13-45", "write_date": "2024-01-03 10:00:00", "_lines": [LINE | {"id": 30}]},
    {"id": 4, "date": "2024-02-02", "write_date": "05/01/2024 10:00", "_lines": [LINE | {"id": 40}]},
]


def land(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(map(json.dumps, LANDED)) + "\n{broken\n")
    return str(folder)


def layers(tmp_path, name):
    return LayerPaths(raw=str(tmp_path / name), silver=str(tmp_path / name / "silver"), control=str(tmp_path / name / "ctl"))


def tax(spark):
    return spark.createDataFrame([(1, 19.0)], TAX)


def business(spark, lay):
    heads = [(r.id, str(r.date), r.state) for r in spark.read.parquet(lay.bronze_moves).collect()]
    lines = [(r.id, r.account_move_id, str(r.date)) for r in spark.read.parquet(lay.bronze_lines).collect()]
    return sorted(heads), sorted(lines)


def test_batch_and_stream_keep_the_newest_version_once(spark, tmp_path):
    path = land(tmp_path)
    batch, stream = layers(tmp_path, "b"), layers(tmp_path, "s")
    job = SyncJob(spark, "m", batch, tax=tax,
                  source=lambda s: (landing.read_raw_headers(s, path, nested=True), None))
    done = job.run()
    run_landing_stream(spark, path, str(tmp_path / "ck"), "m", stream, tax)
    assert business(spark, batch) == business(spark, stream) == ([(1, "2024-03-01", "posted")], [(10, 1, "2024-03-01")])
    # the bad date, the bad cursor and the broken line are counted as failed
    assert (done.processed, done.inserted, done.failed) == (4, 1, 3)
    row = RunLog(spark, stream.run_events).runs("m").first()
    assert (row.records_processed, row.records_inserted, row.records_failed) == (4, 1, 3)


def test_every_reject_has_a_reason(spark, tmp_path):
    raw = landing.read_raw_headers(spark, land(tmp_path), nested=True).cache()
    reasons = sorted(r.reject_reason for r in tr.rejected_records(raw).collect())
    assert reasons == ["bad_cursor", "bad_date", "corrupt_record"]


def test_a_run_is_finished_by_another_process(spark, tmp_path):
    path = str(tmp_path / "ev")
    first = RunLog(spark, path)
    run = first.start("m")
    first.checkpoint(run, "m", dt.datetime(2024, 1, 5), 3, 3, 0)
    RunLog(spark, path).finish(run, "m", "success", dt.datetime(2024, 1, 5))
    assert RunLog(spark, path).runs("m").first().status == "success"
    assert RunLog(spark, path).get_watermark("m") == dt.datetime(2024, 1, 5)


def test_large_decimals_stay_plain(spark):
    cells = ["12345678.91", "99999999999.25", "5.5", "0.001", "-0.004", "1e400", "7.0", "x"]
    frame = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r[0] for r in frame.select(normalize_number_text(frame.c)).collect()]
    assert got == ["12345678.91", "99999999999.25", "5.5", "0.0", "-0.0", "1e400", "7", "x"]


def test_versions_that_differ_only_in_an_array(spark):
    frame = spark.createDataFrame([(1, 5, [1]), (1, 5, [2])], "id long, v int, tax_ids array<int>")
    order = full_order(frame, "id", ["v desc"])
    assert order[-1] == "tax_ids desc"
    assert dedup_latest(frame, "id", order).first().tax_ids == [2]
