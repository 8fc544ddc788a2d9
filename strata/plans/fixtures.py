"""Mapping of the driver's TPC-H-style tables onto the source record shape.

The engine works on ERP-style records: headers with many2one ``[id, label]``
pairs, text cursors and attached lines.  These functions derive such records
from ``orders`` / ``lineitem`` / ``customer`` / ``nation`` with DataFrame
expressions, so every query's work grows with the given tables.

Mapping (all derived per row, no sampling):
  header  <- orders: id=o_orderkey, date=o_orderdate, partner=customer,
             company=customer's nation, journal=o_orderpriority,
             state from o_orderstatus, amount_total from o_totalprice.
  line    <- lineitem: id=l_orderkey*10+l_linenumber, parent=l_orderkey,
             product=l_partkey, account=l_suppkey, cursor=l_shipdate.  Repeated
             (l_orderkey, l_linenumber) rows are successive versions.
  tax     <- distinct l_tax of lineitem: id=round(l_tax*100), all of them; lines
             of every UNKNOWN_TAX_EVERY-th order name an id that no registry has.
  Amounts use plain double arithmetic (no decimal rounding), so the values
  are bit-identical in any IEEE-754 engine.
  version 2 of a header: every draft order ('O') is posted later; its cursor
             moves by SECOND_VERSION_SHIFT_DAYS.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import RAW_LINE, RAW_MOVE
from strata.session import sf_path

# Fixed fixture parameters (shared with the oracle SQL).
CURSOR_ERA_START = "1995-02-01"        # headers dated before this carry no write_date
SECOND_VERSION_SHIFT_DAYS = 2500       # draft orders are posted this many days later
TAX_PERCENT_MAX = 100                  # a tax id is its rate in whole percent: at most this many rows
UNKNOWN_TAX_EVERY = 50                 # lines of orders with such a key name the id TAX_PERCENT_MAX higher
INGEST_LAG_HOURS = 1                   # a version is ingested one hour after it changed
INITIAL_LOAD_AT = "2001-09-01 00:00:00"  # ingestion time of rows without a cursor


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; ``spark.sql.files.maxPartitionBytes`` decides its splits."""
    return spark.read.parquet(sf_path(sf_dir, name))


def _pair(id_col, label_col):
    return F.array(id_col.cast("string"), label_col)


def raw_headers(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    """Source snapshot of headers.  ``version=2`` is the later snapshot in
    which every draft order has been posted (new state, later cursor)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation has a fixed 25 rows: a proven bound, broadcast it.  The customer
    # key is unique; stating it (dropDuplicates) lets Catalyst remove the
    # whole label join from plans that use no label column.
    cust = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"], "left").dropDuplicates(["c_custkey"])
    j = o.join(cust, o["o_custkey"] == cust["c_custkey"], "left")

    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    posted_later = F.lit(version >= 2) & (status == "O")
    tax = F.col("o_totalprice") * 0.19
    cursor_v1 = F.when(
        F.col("o_orderdate") >= F.lit(CURSOR_ERA_START).cast("timestamp_ntz"),
        F.col("o_orderdate") + F.expr("INTERVAL 9 HOURS"),
    )
    cursor_v2 = F.col("o_orderdate") + F.expr(f"INTERVAL {SECOND_VERSION_SHIFT_DAYS} DAYS 10 HOURS")
    cursor = F.when(posted_later, cursor_v2).otherwise(cursor_v1)
    state = (
        F.when(posted_later, F.lit("posted"))
        .when(status == "F", F.lit("posted"))
        .when(status == "O", F.lit("draft"))
    )
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("SO/"), F.col("o_orderkey").cast("string")).alias("name"),
        F.lit("out_invoice").alias("move_type"),
        F.when(~((status == "P") & (prio == "4-NOT SPECIFIED")),
               F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        _pair(F.col("o_custkey"), F.col("c_name")).alias("partner_id"),
        F.when(prio != "1-URGENT", F.concat(F.lit("PO-"), F.col("o_custkey").cast("string"))).alias("ref"),
        F.when(prio == "5-LOW", F.array(F.substring(prio, 1, 1)))
        .otherwise(F.array(F.substring(prio, 1, 1), F.substring(prio, 3, 40))).alias("journal_id"),
        state.alias("state"),
        F.when(status == "F", F.lit("paid")).otherwise(F.lit("not_paid")).alias("payment_state"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", _pair(F.col("c_nationkey"), F.col("n_name"))).alias("company_id"),
        F.when(F.col("c_acctbal") < 0, F.array(F.lit("2"), F.lit("USD"))).alias("currency_id"),
        F.col("o_totalprice").alias("amount_untaxed"),
        F.when(status != "P", tax).alias("amount_tax"),
        F.when(status != "P", F.col("o_totalprice") + tax).otherwise(F.col("o_totalprice")).alias("amount_total"),
        F.lit(None).cast(RAW_MOVE["line_ids"].dataType).alias("line_ids"),
        F.date_format(cursor, "yyyy-MM-dd HH:mm:ss").alias("write_date"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row as one landed line version."""
    li = table(spark, sf_dir, "lineitem")
    ext, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    net = ext * (1 - disc)
    total = net * (1 + tax)
    returned = F.col("l_returnflag") == "R"
    unknown = F.col("l_orderkey") % UNKNOWN_TAX_EVERY == 0
    tax_id = (F.round(tax * 100) + F.when(unknown, TAX_PERCENT_MAX).otherwise(0)).cast("long")
    out = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("id"),
        _pair(F.col("l_orderkey"), F.concat(F.lit("SO/"), F.col("l_orderkey").cast("string"))).alias("move_id"),
        _pair(F.col("l_partkey"), F.concat(F.lit("part-"), F.col("l_partkey").cast("string"))).alias("product_id"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("name"),
        F.col("l_quantity").alias("quantity"),
        (ext / F.col("l_quantity")).alias("price_unit"),
        (disc * 100).alias("discount"),
        F.when(returned, F.lit(0.0)).otherwise(net).alias("price_subtotal"),
        total.alias("price_total"),
        F.when(tax > 0, F.array(tax_id)).otherwise(F.array().cast("array<bigint>")).alias("tax_ids"),
        _pair(F.col("l_suppkey"), F.concat(F.lit("ACC-"), F.col("l_suppkey").cast("string"))).alias("account_id"),
        F.when(returned, F.lit(0.0)).otherwise(total).alias("debit"),
        F.when(returned, total).otherwise(F.lit(0.0)).alias("credit"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("write_date"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in RAW_LINE.fields])


def tax_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tax registry ``(id, amount)``: the percent rates of all lines.

    At most TAX_PERCENT_MAX rows, as rates are whole percents from 1 to 100, so
    callers may broadcast it unchecked."""
    li = table(spark, sf_dir, "lineitem").select("l_tax").filter(F.col("l_tax") > 0)
    ids = li.select(F.round(F.col("l_tax") * 100).cast("long").alias("id")).distinct()
    return ids.filter(F.col("id") <= TAX_PERCENT_MAX).select("id", F.col("id").cast("double").alias("amount"))


# Fixed fixture parameters of the landed text: the first rule that an order's key meets holds.
DEFECTS = (("corrupt_record", 101, 0), ("missing_id", 103, 1), ("bad_date", 107, 2), ("bad_cursor", 109, 3),
           ("missing_date", 113, 4))
BAD_DATE, BAD_CURSOR, LANDED_CURSOR = "2024-13-45", "05/01/2024 10:00", "2000-01-02 03:04:05"


def landed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON line per order as a source might land it, some of them defect."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    kind = F.lit("none")
    for reason, every, rest in reversed(DEFECTS):
        kind = F.when(F.col("o_orderkey") % every == rest, reason).otherwise(kind)
    key = F.col("o_orderkey").cast("string")
    o = o.withColumn("_kind", kind)
    whole = F.to_json(F.struct(
        F.concat(F.lit("SO/"), key).alias("name"),
        F.when(F.col("_kind") != "missing_id", F.col("o_orderkey")).alias("id"),
        F.when(F.col("_kind") == "bad_date", BAD_DATE)
        .when(F.col("_kind") != "missing_date", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(F.col("_kind") == "bad_cursor", BAD_CURSOR).otherwise(LANDED_CURSOR).alias("write_date"),
        F.col("o_totalprice").alias("amount_total"),
        F.array(F.struct((F.col("o_orderkey") * 10).alias("id"), F.col("o_totalprice").alias("price_total"))).alias("_lines")))
    broken = F.concat(F.lit('{"name": "SO/'), key, F.lit('", broken'))
    return o.select(F.when(F.col("_kind") == "corrupt_record", broken).otherwise(whole).alias("value"))


def ingest_stamp(df: DataFrame) -> DataFrame:
    """History of hourly syncs: each version was ingested INGEST_LAG_HOURS
    after it changed, rows without a cursor in the initial load; the batch id
    names the hour of the sync."""
    synced = F.coalesce(
        F.col("write_date") + F.expr(f"INTERVAL {INGEST_LAG_HOURS} HOURS"),
        F.lit(INITIAL_LOAD_AT).cast("timestamp_ntz"),
    )
    return df.withColumn("synced_at", synced.cast("timestamp_ntz")).withColumn(
        "sync_batch_id", F.concat(F.lit("sync-"), F.date_format(synced, "yyyyMMddHH")))


# Fixed fixture parameters of the derived sync history.
MAX_REJECT_RATIO = 0.07   # a run whose rejected share exceeds this fails
FAILED_MESSAGE = "reject ratio above limit"


def sync_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run events of a history of syncs derived from the data.

    Module ``account``: one run per calendar month of header cursors (headers
    without a cursor are not in any run); rejects are headers without id or
    date.  Module ``events``: one run per day of ``events.ts``; every event is
    valid.  Each run has a start, a checkpoint (counters, max cursor) and a
    finish event 1 and 2 minutes apart, starting one hour after its period;
    the newest run of each module is still running (no finish).  A run whose
    reject share exceeds MAX_REJECT_RATIO fails."""
    from strata.functions.dates import parse_naive_utc
    from strata.operators.transform import validity  # local: avoid a cycle

    h = raw_headers(spark, sf_dir, 1)
    ok, _ = validity(h)
    cur = parse_naive_utc("write_date")
    acc = (h.select(F.lit("account").alias("module_name"), cur.alias("cursor"), ok.alias("ok"))
           .filter(F.col("cursor").isNotNull())
           .withColumn("period", F.date_trunc("month", "cursor").cast("timestamp_ntz"))
           .withColumn("period_end", F.col("period") + F.expr("INTERVAL 1 MONTH")))
    ev = (table(spark, sf_dir, "events")
          .select(F.lit("events").alias("module_name"), F.col("ts").alias("cursor"), F.lit(True).alias("ok"))
          .withColumn("period", F.date_trunc("day", "cursor").cast("timestamp_ntz"))
          .withColumn("period_end", F.col("period") + F.expr("INTERVAL 1 DAY")))
    runs = acc.unionByName(ev).groupBy("module_name", "period", "period_end").agg(
        F.count(F.lit(1)).cast("long").alias("records_processed"),
        F.count_if("ok").cast("long").alias("records_inserted"),
        F.max("cursor").alias("max_cursor"),
    )
    newest = runs.groupBy("module_name").agg(F.max("period").alias("_newest"))
    runs = (runs.join(F.broadcast(newest), "module_name")  # one row per module
            .withColumn("records_failed", F.col("records_processed") - F.col("records_inserted"))
            .withColumn("sync_id", F.concat_ws("-", "module_name", F.date_format("period", "yyyyMMdd")))
            .withColumn("started_at", (F.col("period_end") + F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz"))
            .withColumn("failed", F.col("records_failed") > F.col("records_processed") * F.lit(MAX_REJECT_RATIO)))
    null_s, null_l, null_t = F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast("timestamp_ntz")

    def event(seq, kind, sync_type, minutes, status, cursor, counters, error):
        return F.struct(
            F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"), sync_type.alias("sync_type"),
            (F.col("started_at") + F.expr(f"INTERVAL {minutes} MINUTES")).cast("timestamp_ntz").alias("event_at"),
            status.alias("status"), cursor.alias("last_processed_ts"),
            *[(F.col(c) if counters else null_l).alias(c)
              for c in ("records_processed", "records_inserted", "records_failed")],
            error.alias("error_message"), null_s.alias("last_processed_cursor"))

    finished = F.col("period") < F.col("_newest")
    evs = F.array(
        event(0, "start", F.lit("incremental"), 0, F.lit("running"), null_t, False, null_s),
        event(1, "checkpoint", null_s, 1, F.lit("running"), F.col("max_cursor"), True, null_s),
        event(2, "finish", null_s, 2, F.when(F.col("failed"), F.lit("failed")).otherwise(F.lit("success")),
              F.col("max_cursor"), False, F.when(F.col("failed"), F.lit(FAILED_MESSAGE))),
    )
    # one pass over the runs: every run emits its events; the newest run of a
    # module has no finish yet
    out = runs.select("sync_id", "module_name", finished.alias("_finished"), F.explode(evs).alias("e"))
    out = out.filter((F.col("e.kind") != "finish") | F.col("_finished"))
    return out.select("sync_id", "e.seq", "e.kind", "module_name", "e.sync_type", "e.event_at", "e.status",
                      "e.last_processed_ts", "e.records_processed", "e.records_inserted", "e.records_failed",
                      "e.error_message", "e.last_processed_cursor")
