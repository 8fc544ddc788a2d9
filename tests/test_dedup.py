"""Latest-version dedup: golden cases of the Silver layer."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.dedup import dedup_latest
from strata.plans import silver as sv
from strata.schemas import BRONZE_LINE, BRONZE_MOVE

T = dt.datetime


def move(id_, state, write_date, synced_at, batch):
    return dict(id=id_, name=f"INV/{id_}", move_type="out_invoice", date=dt.date(2026, 1, 15), partner_id=10,
                partner_name="Acme Corp", company_id=1, company_name="My Company", journal_id=5,
                journal_name="Customer Invoices", currency_name="USD", amount_untaxed=1000.0, amount_tax=190.0,
                amount_total=1190.0, state=state, payment_state="not_paid", ref=None, write_date=write_date,
                synced_at=synced_at, sync_batch_id=batch)


def line(id_, qty, write_date, synced_at, product=42, tax_ids=(1,)):
    return dict(id=id_, product_id=product, description="Widget A", date=dt.date(2026, 2, 1), quantity=qty,
                price_unit=500.0, discount=0.0, price_subtotal=1000.0, price_total=1190.0, account_id=100,
                account_name="Revenue", debit=0.0, credit=1190.0, tax_ids=list(tax_ids), tax_rate=19.0,
                tax_amount=190.0, write_date=write_date, synced_at=synced_at, sync_batch_id="b",
                account_move_id=1)


def test_latest_cursor_wins(spark):
    rows = [move(1, "draft", T(2026, 1, 1, 10), T(2026, 1, 1, 11), "batch-001"),
            move(1, "posted", T(2026, 2, 1, 10), T(2026, 2, 1, 11), "batch-002")]
    out = sv.silver_headers(spark.createDataFrame(rows, BRONZE_MOVE)).collect()
    assert len(out) == 1
    assert out[0]["state"] == "posted"
    assert out[0]["source_modified_at"] == T(2026, 2, 1, 10)
    assert out[0]["ingested_at"] == T(2026, 2, 1, 11)


def test_tie_on_cursor_latest_ingestion_wins(spark):
    rows = [move(7, "posted", T(2026, 3, 5, 9), T(2026, 3, 5, 10), "batch-010"),
            move(7, "posted", T(2026, 3, 5, 9), T(2026, 3, 5, 12), "batch-011")]
    out = sv.silver_headers(spark.createDataFrame(rows, BRONZE_MOVE)).collect()
    assert [(r["ingested_at"], r["sync_batch_id"]) for r in out] == [(T(2026, 3, 5, 12), "batch-011")]


def test_line_latest_cursor_wins(spark):
    rows = [line(201, 2.0, T(2026, 2, 1, 8), T(2026, 2, 1, 9)), line(201, 3.0, T(2026, 2, 15, 14, 30), T(2026, 2, 15, 15))]
    out = sv.silver_lines(spark.createDataFrame(rows, BRONZE_LINE)).collect()
    assert [r["quantity"] for r in out] == [3.0]


def test_line_tie_with_null_product_and_empty_taxes(spark):
    rows = [line(300, 1.0, T(2026, 4, 1, 8), T(2026, 4, 1, 9), product=None, tax_ids=()),
            line(300, 1.0, T(2026, 4, 1, 8), T(2026, 4, 1, 11), product=None, tax_ids=())]
    out = sv.silver_lines(spark.createDataFrame(rows, BRONZE_LINE)).collect()
    assert [r["ingested_at"] for r in out] == [T(2026, 4, 1, 11)]
    assert out[0]["tax_ids"] == [] and out[0]["product_id"] is None


def test_null_cursor_falls_back_to_ingestion(spark):
    rows = [line(99, 1.0, None, T(2025, 6, 1, 8)), line(99, 2.0, None, T(2025, 6, 1, 12))]
    out = sv.silver_lines(spark.createDataFrame(rows, BRONZE_LINE)).collect()
    assert [(r["ingested_at"], r["source_modified_at"]) for r in out] == [(T(2025, 6, 1, 12), None)]


def test_null_cursor_sorts_last(spark):
    rows = [line(5, 1.0, None, T(2026, 9, 1)), line(5, 2.0, T(2020, 1, 1), T(2020, 1, 1, 1))]
    out = sv.silver_lines(spark.createDataFrame(rows, BRONZE_LINE)).collect()
    assert [r["quantity"] for r in out] == [2.0]


def test_rows_without_date_are_not_in_silver(spark):
    r = move(3, "posted", T(2026, 1, 1), T(2026, 1, 1, 1), "b")
    r["date"] = None
    assert sv.silver_headers(spark.createDataFrame([r], BRONZE_MOVE)).count() == 0


def test_dedup_plan_cuts_map_side(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    out = dedup_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate desc"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "Partial" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_hot_key_gives_one_row(spark):
    df = spark.range(0, 50000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    out = dedup_latest(df, "k", ["v desc"]).collect()
    assert [r["v"] for r in out] == [49999]


def test_incremental_equals_full_rebuild(spark):
    rows = [line(i, float(v), T(2026, 1, 1 + v), T(2026, 1, 1 + v, 1)) for i in range(1, 30) for v in range(1, 4)]
    bronze = spark.createDataFrame(rows, BRONZE_LINE)
    earlier = sv.silver_lines(bronze.filter(F.col("synced_at") < F.lit(T(2026, 1, 3))))
    inc = sv.silver_incremental(earlier, bronze, sv.LINES, BRONZE_LINE)
    full = sv.silver_lines(bronze)
    assert sorted(map(tuple, inc.select("id", "quantity").collect())) == \
        sorted(map(tuple, full.select("id", "quantity").collect()))


def test_late_older_version_does_not_win(spark):
    # a late-arriving commit of an OLDER version must not replace the newer row
    newer = line(1, 5.0, T(2026, 2, 1), T(2026, 2, 1, 1))
    older_late = line(1, 1.0, T(2026, 1, 1), T(2026, 3, 1))
    silver = sv.silver_lines(spark.createDataFrame([newer], BRONZE_LINE))
    inc = sv.silver_incremental(silver, spark.createDataFrame([newer, older_late], BRONZE_LINE), sv.LINES, BRONZE_LINE)
    assert [r["quantity"] for r in inc.collect()] == [5.0]
