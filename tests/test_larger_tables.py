"""Work that grows with the tables: what moves, how often, and with the same rows."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from strata.operators import transform as tr
from strata.schemas import RAW_LINE, RAW_MOVE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def orders_by(df, column: str) -> bool:
    return re.search(rf"\b{column}#\d+ DESC", plan(df)) is not None


def raw_lines(spark, rows):
    """(id, parent, name, cursor) rows as raw lines."""
    df = spark.createDataFrame(rows, "id long, p string, name string, write_date string")
    df = df.select("id", F.when(F.col("p").isNotNull(), F.array("p", F.lit("x"))).alias("move_id"), "name", "write_date")
    return spark.createDataFrame([], RAW_LINE).unionByName(df, allowMissingColumns=True)


def test_nested_lines_move_once(spark):
    heads = spark.createDataFrame([], RAW_MOVE).unionByName(
        spark.createDataFrame([(1,), (2,), (3,), (None,)], "id long"), allowMissingColumns=True)
    lines = raw_lines(spark, [(12, "1", "b", None), (11, "1", "a", None), (21, "2", "c", None), (21, "2", "d", None),
                              (41, "0", "e", None), (51, None, "f", None), (61, "9", "g", None),
                              (None, "3", "h", None), (34, "3", "i", None), (None, "3", "j", None), (31, "3", "k", None)])
    nested = tr.nest_lines(heads, lines)
    assert plan(nested).count("Exchange hashpartitioning(_parent") == 1
    got = {r.id: [x.id for x in r._lines] for r in nested.collect()}
    assert got == {1: [11, 12], 2: [21, 21], 3: [31, 34, None, None], None: []}


def test_a_cell_is_parsed_once(spark):
    from strata.functions.tabular import normalize_tabular

    rows = [("'12.0",), (" 7 ",), ("",), (None,), ("1e400",), ("-0.004",), ("-0.005",), ("2.50",), ("2.505",), ("NaN",),
            ("1e20",), ("12345678901234.567",), ("''3",), ("-0.0",), (".5",), ("x",), ("1e39",), ("1234567890123456.125",)]
    df = normalize_tabular(spark.createDataFrame(rows, "monto string"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1
    got = [r[0] for r in df.collect()]
    assert got == ["12", "7", "", None, "1e400", "-0.0", "-0.01", "2.5", "2.51", "NaN", "1" + "0" * 20, "12345678901234.57",
                   "'3", "0", "0.5", "x", "1e39", "1234567890123456"]


def test_parents_are_those_of_the_newest_versions(spark):
    from strata.plans.sync_run import parents_only

    at = "2024-01-01 00:00:00"
    lines = raw_lines(spark, [
        (1, "7", "a", at), (1, "8", "z", at), (1, "9", "b", "2023-01-01 00:00:00"),      # one cursor: the higher parent
        (2, "7", "a", None), (2, "5", "b", at), (3, None, "c", at), (3, "4", "d", "2025-01-01 00:00:00"),
        (4, "6", "a", at), (4, "6", "b", at), (None, "3", "n", at), (None, "2", "n", at), (5, "x", "q", "no date"),
        (6, None, "a", at), (6, "1", "b", at)])
    whole, narrow = (tr.latest_landed(x) for x in (lines, parents_only(lines)))
    assert orders_by(whole, "price_total") and not orders_by(narrow, "price_total")
    rows = [sorted(x.select("id", tr.line_parent_id(x).alias("p")).collect(), key=str) for x in (whole, narrow)]
    assert rows[0] == rows[1] and len(rows[0]) == 8


def test_a_run_orders_its_headers_once(spark, tmp_path):
    """Batches, lines and groups read the newest headers from one staged copy."""
    from strata.plans.sync_run import FrameSource, SyncJob
    from strata.schemas import TAX, LayerPaths

    heads = spark.createDataFrame([], RAW_MOVE).unionByName(
        spark.createDataFrame([(1, "2024-01-01", "2024-01-02 00:00:00"), (1, "2024-01-03", "2024-01-05 00:00:00"),
                               (2, None, "2024-01-04 00:00:00"), (0, "2024-01-01", None), (None, "2024-01-01", None)],
                              "id long, date string, write_date string"), allowMissingColumns=True)
    lines = raw_lines(spark, [(11, "1", "a", None), (21, "2", "b", None), (1, "0", "c", None)])
    job = SyncJob(spark, "account", LayerPaths(*(str(tmp_path / x) for x in ("raw", "silver", "control"))),
                  source=lambda s: (heads, lines), tax=lambda s: s.createDataFrame([(1, 19.0)], TAX))
    for since, ids in ((None, [0, 1, 2]), (dt.datetime(2024, 1, 3), [1, 2])):
        path = str(tmp_path / f"scope-{len(ids)}")
        scoped, whole, parents = job._scope(FrameSource(job.source), since, path)
        assert "Window" not in plan(scoped)
        assert orders_by(whole, "price_total") and not orders_by(parents, "price_total")
        assert sorted(r.id for r in scoped.collect()) == ids
        assert scoped.filter("id = 1").first().write_date == "2024-01-05 00:00:00"
        assert {r[0] for r in parents.collect()} >= {1, 2}
    out = job.run()
    assert (out.processed, out.inserted, out.failed, out.lines) == (4, 1, 3, 1)
    left = [d for d, _, _ in os.walk(spark.conf.get("spark.checkpoint.dir")) if d.endswith("-scope")]
    assert all(not os.listdir(d) for d in left)


def test_tax_amount_is_put_on_after_the_join(spark):
    heads = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "id long, date date")
    rows = spark.createDataFrame([(11, "1", 100.0, 119.0), (12, "1", 0.0, 5.0), (13, "1", None, 7.0), (14, "1", 10.0, None),
                                  (15, "2", 1.0, 2.0)], "id long, p string, price_subtotal double, price_total double")
    raw = rows.select("id", F.array("p").alias("move_id"), "price_subtotal", "price_total")
    raw = spark.createDataFrame([], RAW_LINE).unionByName(raw, allowMissingColumns=True)
    lines = tr.normalize_lines(raw, heads, spark.createDataFrame([(1, 19.0)], "id long, amount double"), True)
    text = lines._jdf.queryExecution().optimizedPlan().toString()
    assert " AS tax_amount#" in text and " AS tax_amount#" not in text[text.index("Join Inner"):]
    assert {r.id: r.tax_amount for r in lines.collect()} == {11: 19.0, 12: 0.0, 13: 0.0, 14: -10.0}
    assert lines.columns == tr.LINE_COLS


def test_unique_keys_move_keys_only(spark, tmp_path):
    from strata.plans.catalog import q_dq_unique

    day, key = dt.datetime(1996, 1, 2), "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    tables = {
        "nation": ([(1, "CHILE")], "n_nationkey int, n_name string"),
        "customer": ([(1, "c", 1, 5.0, "HOUSEHOLD")],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": ([(k, 1, s, 10.0, day, "1-URGENT") for k, s in ((1, "O"), (2, "F"))],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                   "o_orderpriority string"),
        "lineitem": ([(o, 1, 1, n, q, 10.0, 0.1, 0.02, "N", "O", day) for o, n, q in
                      ((1, 1, 1.0), (1, 1, 2.0), (1, 2, 1.0), (2, 1, 1.0), (2, 1, 1.0), (9, 1, 1.0))],
                     key + "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                     "l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    report = q_dq_unique(spark, str(tmp_path))
    assert "price_total" not in report._jdf.queryExecution().optimizedPlan().toString()
    got = {r.table_name: (r.row_count, r.distinct_keys, r.duplicate_keys) for r in report.collect()}
    assert got == {"stg_account_move_lines": (3, 3, 0), "stg_account_moves": (2, 2, 0),
                   "account_move_lines": (5, 3, 2), "account_moves": (4, 2, 2)}  # the watermark is inclusive
