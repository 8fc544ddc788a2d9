"""What a query leaves on disk: compressed columns once, and one slice's shuffle files at a time."""

import datetime as dt
import os

import pytest

from strata.plans import catalog
from strata.plans import fixtures as fx
from strata.plans import silver as sv
from strata.session import shared_root
from strata.sinks import bronze, landed, staged

DAY = dt.datetime(1996, 1, 2)


@pytest.fixture
def tables(spark, tmp_path):
    """Driver tables of a few hundred orders, with versions of lines on both sides of the queries' dates."""
    lines = [(o, o % 7, o % 5, n, float(n), 10.0 + o, 0.1, 0.02 * (v % 3), "N", "O", day)
             for o in range(1, 301) for n in (1, 2)
             for v, day in enumerate((DAY, dt.datetime(2000, 3, 1), dt.datetime(2001, 2, 1))) if (o + n + v) % 3]
    rows = {
        "nation": ([(1, "CHILE")], "n_nationkey int, n_name string"),
        "customer": ([(1, "c", 1, 5.0, "HOUSEHOLD")],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": ([(k, 1, "OFP"[k % 3], 10.0, DAY + dt.timedelta(days=k * 7), "1-URGENT") for k in range(1, 291)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                   "o_orderpriority string"),
        "lineitem": (lines + lines[:3], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp_ntz"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.fixture
def three_slices(monkeypatch):
    monkeypatch.setattr(catalog, "slices_for", lambda spark, paths: 3)


def files_under(root, part):
    root = root.removeprefix("file:").replace("///", "/")
    return {f"{d}/{f}" for d, _, names in os.walk(root) for f in names if part in f"{d}/{f}" and not f.endswith(".crc")}


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in files_under(d.getPath(), "/shuffle_")}


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_silver_materialize_keeps_compressed_columns_only(spark, tables, three_slices):
    root = shared_root(spark)
    checkpoints, shuffles = files_under(root, "/rdd-"), shuffle_files(spark)
    out = catalog.q_silver_materialize(spark, tables)
    assert not files_under(root, "/rdd-") - checkpoints
    assert not shuffle_files(spark) - shuffles
    base = out.inputFiles()[0].split("/data/")[0].removeprefix("file://")
    assert {f.rsplit("/", 2)[0] for f in files_under(base, "/bucket=")} == \
        {f.removeprefix("file://").rsplit("/", 2)[0] for f in out.inputFiles()}  # replaced builds are gone
    assert rows_of(out) == rows_of(catalog.q_silver_lines(spark, tables))


def test_slices_hold_every_row_once(spark, tmp_path):
    rows = [(None,), (None,), (0,), *[(i % 40,) for i in range(100)]]
    df = spark.createDataFrame(rows, "id long")
    got = staged.put_down(df, str(tmp_path / "x"), 4)
    assert rows_of(got) == rows_of(df) and got.schema == df.schema
    by_slice = [{r[0] for r in part.collect()} for part in staged.sliced(df, "id", 4)]
    assert sum(map(len, by_slice)) == len(set().union(*by_slice)) == 41


def test_a_run_writes_its_lines_in_slices(spark, tables, three_slices, monkeypatch):
    asked, append = [], bronze.append

    def seen(df, path, *args):
        asked.append((path.rsplit("/", 1)[1], args[-1]))
        return append(df, path, *args)

    root = shared_root(spark)
    checkpoints = files_under(root, "/rdd-")
    monkeypatch.setattr(bronze, "append", seen)
    got = catalog.q_incremental_run(spark, tables)
    assert [n for name, n in asked if name == "account_move_lines"] == [3, 3]
    new = {os.path.dirname(f) for f in files_under(root, "/rdd-") - checkpoints}
    assert len(new) == 4  # a run's ids in their order and its ledger, no whole header
    assert rows_of(got) == rows_of(catalog.q_append_versions(spark, tables))


def test_landed_records_leave_no_shuffle(spark, tables, tmp_path):
    shuffles, raw = shuffle_files(spark), fx.raw_lines(spark, tables)
    assert landed.land(raw, str(tmp_path / "landed"), grain=landed.MONTHLY, slices=3) == raw.count()
    got = landed.scan(spark, str(tmp_path / "landed"), raw.schema).select(*raw.columns)
    assert rows_of(got) == rows_of(raw)
    assert not [f for f in shuffle_files(spark) - shuffles if os.path.getsize(f) > 5000]


def test_lookback_moves_ingestion_times_only(spark, tables, three_slices, monkeypatch):
    frames, value = [], sv.lookback_value
    monkeypatch.setattr(sv, "lookback_value", lambda silver: frames.append(silver) or value(silver))
    shuffles = shuffle_files(spark)
    out = catalog.q_silver_lookback(spark, tables)
    assert not shuffle_files(spark) - shuffles
    assert "price_total" not in sv.lookback(frames[0])._jdf.queryExecution().executedPlan().toString()
    lines = catalog.bronze_lines(spark, tables)
    whole = value(sv.silver_lines(lines.filter(lines.synced_at < catalog.SILVER_SNAPSHOT_AT)))
    assert {r.lookback_ts for r in out.collect()} == {whole}
    assert out.count() == lines.filter(lines.synced_at >= whole).count() > 0


def test_bronze_roundtrip_leaves_no_shuffle(spark, tables, three_slices):
    shuffles = shuffle_files(spark)
    out = catalog.q_bronze_roundtrip(spark, tables)
    assert not shuffle_files(spark) - shuffles
    want = catalog.present(catalog.bronze_lines(spark, tables)).select(*[c for c in out.columns if c != "date_month"])
    assert rows_of(out.drop("date_month")) == rows_of(want)


@pytest.mark.parametrize("name", ["silver_incremental", "replay_idempotent"])
def test_silver_leaves_compressed_columns_only(spark, tables, three_slices, name):
    root = shared_root(spark)
    checkpoints, shuffles = files_under(root, "/rdd-"), shuffle_files(spark)
    out = catalog.QUERIES[name](spark, tables)
    assert not files_under(root, "/rdd-") - checkpoints
    assert not shuffle_files(spark) - shuffles
    assert rows_of(out) == rows_of(catalog.q_silver_lines(spark, tables).select(*out.columns))
