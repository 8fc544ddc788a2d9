"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (or frames Spark derives from them);
array columns are rendered as comma-joined text by ``present`` so results
compare with the SQL oracle value by value.  Queries that exercise a sink
write to a fresh folder under the session's shared root and read it back.
"""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import parse_naive_utc, utc_to_local_date
from strata.functions.tabular import normalize_tabular
from strata.operators import extract as ex
from strata.operators import transform as tr
from strata.operators.batching import batch_slices, global_index
from strata.operators.dedup import dedup_latest, full_order
from strata.operators.quality import dq_not_null, dq_orphans, dq_unique
from strata.plans import fixtures as fx
from strata.plans import runlog as rl
from strata.plans import silver as sv
from strata.plans.sync_run import SyncJob, read_ledger
from strata.schemas import BRONZE_LINE, BRONZE_MOVE, RAW_LINE, RAW_MOVE, LayerPaths
from strata.session import scratch_path, sf_path
from strata.sinks import bronze as sink
from strata.sinks import landed
from strata.sinks.staged import put_down, slices_for
from strata.sources import bronze as bronze_src
from strata.sources import control as control_src
from strata.sources import landing
from strata.sources.search import read_by_ids, search, search_read

# Fixed query parameters (shared with the oracle SQL).
WATERMARK = dt.datetime(2000, 1, 1)          # incremental pulls start here
BATCH_SIZE = 1000
CAP = 500
RANGE_FROM, RANGE_TO = "1997-03-15", "1998-06-30"
SEARCH_MIN_TOTAL = 400000.0
REREAD_SINCE = dt.datetime(2001, 1, 1)       # headers of lines changed since then are re-read
SILVER_SNAPSHOT_AT = dt.datetime(2000, 1, 1)  # an earlier Silver build: Bronze ingested before this
REPLAY_FROM = dt.datetime(2001, 1, 1)        # a crashed run re-appends versions from here
REPLAY_LAG_MINUTES = 30
SILVER_BUCKETS = 16
RUN1_AT = dt.datetime(2001, 9, 1)            # the two sync runs of the append / run queries
RUN2_AT = dt.datetime(2008, 6, 1)
STAMP_AT = dt.datetime(2026, 1, 1)
STAMP_BATCH = "run-0001"


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.array_join(F.col(f.name).cast("array<string>"), ",").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# -- shared fixture chain -----------------------------------------------------

def tax_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.tax_dimension(spark, sf_dir)


def parents(raw_lines: DataFrame) -> DataFrame:
    return raw_lines.select(tr.line_parent_id(raw_lines).alias("account_move_id"))


def domain(spark: SparkSession, sf_dir: str, version: int = 1):
    """(headers, lines, rejects) of a source snapshot."""
    return tr.transform(fx.raw_headers(spark, sf_dir, version), tax_dim(spark, sf_dir),
                        fx.raw_lines(spark, sf_dir), tax_bounded=True)


def bronze_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lines, _ = domain(spark, sf_dir)
    return fx.ingest_stamp(lines)


def line_slices(spark: SparkSession, sf_dir: str) -> int:
    """In how many slices the lines are written."""
    return slices_for(spark, [sf_path(sf_dir, "lineitem")])


def stored_bronze_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze lines as a stored table would serve them to several readers:
    written once, as compressed columns in the shared folder."""
    return put_down(bronze_lines(spark, sf_dir), scratch_path(spark, "bronze_lines"), line_slices(spark, sf_dir))


def two_runs_bronze_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze headers after a cold-start run on snapshot 1 and an incremental
    run on snapshot 2 (from run 1's watermark, inclusive)."""
    from strata.session import shared_root

    shared_root(spark)
    tax = tax_dim(spark, sf_dir)
    rl_ = fx.raw_lines(spark, sf_dir)
    # both runs ask the same line table: its (narrow) parent set is materialised
    # once, and so is run 1's id set, which feeds the watermark and the read
    par = parents(rl_).distinct().checkpoint(eager=True)
    v1 = fx.raw_headers(spark, sf_dir, 1)
    ids1 = ex.fetch_new_ids(v1, None, par).checkpoint(eager=True)
    wm1 = ids1.agg(F.max("write_date")).first()[0]
    h1, _, _ = tr.transform(read_by_ids(v1, ids1), tax, rl_, tax_bounded=True)
    v2 = fx.raw_headers(spark, sf_dir, 2)
    ids2 = ex.fetch_new_ids(v2, wm1, par)
    h2, _, _ = tr.transform(read_by_ids(v2, ids2), tax, rl_, tax_bounded=True)
    return tr.stamp(h1, RUN1_AT, "run-1").unionByName(tr.stamp(h2, RUN2_AT, "run-2"))


def sync_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl.fold_runs(fx.sync_history(spark, sf_dir))


# -- sources and scans --------------------------------------------------------

def q_scan_raw_headers(spark, sf_dir):
    return present(landing.scan_raw_headers(fx.raw_headers(spark, sf_dir)))


def q_scan_raw_lines(spark, sf_dir):
    return present(landing.scan_raw_lines(fx.raw_lines(spark, sf_dir)))


def q_search_domain(spark, sf_dir):
    rl_ = fx.raw_lines(spark, sf_dir)
    return search(fx.raw_headers(spark, sf_dir),
                  [("write_date", ">=", WATERMARK), ("line_ids", "!=", False)],
                  order=["write_date asc", "id asc"], relations={"line_ids": (parents(rl_), "account_move_id")})


def q_search_read(spark, sf_dir):
    return search_read(fx.raw_headers(spark, sf_dir),
                       [("state", "=", "posted"), ("amount_total", ">", SEARCH_MIN_TOTAL)],
                       ["id", "name", "state", "amount_total", "write_date"])


def q_tax_dimension(spark, sf_dir):
    return tax_dim(spark, sf_dir)


def q_scan_bronze_range(spark, sf_dir):
    path = scratch_path(spark, "bronze_lines")
    sink.append(bronze_lines(spark, sf_dir), path, BRONZE_LINE, sink.LINE_CLUSTER, slices=line_slices(spark, sf_dir))
    return present(bronze_src.scan_bronze(spark, path, BRONZE_LINE, RANGE_FROM, RANGE_TO))


def q_control_runs(spark, sf_dir):
    """From a written control table; the module's folder alone is read."""
    log = rl.RunLog(spark, scratch_path(spark, "sync_events"))
    rl.write_events(fx.sync_history(spark, sf_dir), log.path)
    return control_src.control_runs(log.runs("account"), "account", "success").select(
        "sync_id", "module_name", "status", "started_at", "last_processed_ts")


# -- projections and filters --------------------------------------------------

def q_flatten_many2one(spark, sf_dir):
    return tr.flatten_headers(fx.raw_headers(spark, sf_dir)).select(
        "id", "partner_id", "partner_name", "company_id", "company_name", "journal_id", "journal_name",
        "currency_name")


def q_default_fill(spark, sf_dir):
    return tr.flatten_headers(fx.raw_headers(spark, sf_dir)).select(
        "id", "name", "move_type", "state", "payment_state", "ref", "amount_untaxed", "amount_tax", "amount_total")


def q_line_inherits_header(spark, sf_dir):
    _, lines, _ = domain(spark, sf_dir)
    return lines.select("id", "account_move_id", "date", "description", "write_date")


def q_line_tax_amount(spark, sf_dir):
    return tr.flatten_lines(fx.raw_lines(spark, sf_dir)).select(
        "id", "price_subtotal", "price_total", "tax_amount", "write_date")


def q_line_tax_rate(spark, sf_dir):
    lines = tr.attach_tax_rate(tr.flatten_lines(fx.raw_lines(spark, sf_dir)), tax_dim(spark, sf_dir), True)
    return present(lines.select("id", "tax_ids", "tax_rate", "write_date"))


def q_stamp_metadata(spark, sf_dir):
    headers, _, _ = domain(spark, sf_dir)
    return tr.stamp(headers, STAMP_AT, STAMP_BATCH).select("id", "write_date", "synced_at", "sync_batch_id")


def q_split_aggregate(spark, sf_dir):
    nested = tr.nest_lines(fx.raw_headers(spark, sf_dir), fx.raw_lines(spark, sf_dir))
    _, lines, _ = tr.transform(nested, tax_dim(spark, sf_dir), tax_bounded=True)
    return lines.select("id", "account_move_id", "date", "quantity", "price_total", "tax_rate", "tax_amount",
                        "write_date")


def q_incremental_filter(spark, sf_dir):
    """With each id's place in the order of the pull (cursor, id)."""
    rl_ = fx.raw_lines(spark, sf_dir)
    ids = ex.fetch_new_ids(fx.raw_headers(spark, sf_dir), WATERMARK, parents(rl_))
    return global_index(ids, ["write_date asc", "id asc"], index_col="position")


def q_cold_start_pull(spark, sf_dir):
    """With each id's place in the order of the pull (id)."""
    rl_ = fx.raw_lines(spark, sf_dir)
    ids = ex.fetch_new_ids(fx.raw_headers(spark, sf_dir), None, parents(rl_))
    return global_index(ids, ["id asc"], index_col="position")


def q_headers_with_lines(spark, sf_dir):
    headers, _, _ = domain(spark, sf_dir)
    rl_ = fx.raw_lines(spark, sf_dir)
    return ex.has_children(headers, parents(rl_)).select("id", "date", "state")


def q_valid_records(spark, sf_dir):
    return tr.valid_records(fx.raw_headers(spark, sf_dir)).select("id", "date", "write_date")


def q_rejected_records(spark, sf_dir):
    return tr.rejected_records(fx.raw_headers(spark, sf_dir)).select("id", "date", "reject_reason")


def q_max_cursor(spark, sf_dir):
    h = fx.raw_headers(spark, sf_dir).withColumn("period", F.substring("date", 1, 7))
    return ex.max_cursor(h, "write_date", by=["period"])


# -- joins --------------------------------------------------------------------

def q_nest_lines(spark, sf_dir):
    nested = tr.nest_lines(fx.raw_headers(spark, sf_dir), fx.raw_lines(spark, sf_dir))
    ids = F.transform("_lines", lambda x: x["id"])
    return nested.select("id", F.size("_lines").cast("long").alias("n_lines"),
                         F.array_min(ids).alias("first_line_id"), F.array_max(ids).alias("last_line_id"),
                         F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("line_ids"))


def q_missing_tax_ids(spark, sf_dir):
    used = fx.raw_lines(spark, sf_dir).select(F.explode("tax_ids").alias("id")).distinct()
    return used.join(tax_dim(spark, sf_dir), "id", "left_anti")


def q_read_by_ids(spark, sf_dir):
    rl_ = fx.raw_lines(spark, sf_dir)
    changed = rl_.filter(parse_naive_utc("write_date") >= F.lit(REREAD_SINCE)) \
        .select(tr.line_parent_id(rl_).alias("id"))
    return read_by_ids(fx.raw_headers(spark, sf_dir), changed).select("id", "name", "state", "write_date")


def q_dq_orphan_lines(spark, sf_dir):
    headers, _, _ = domain(spark, sf_dir)
    lines = tr.flatten_lines(fx.raw_lines(spark, sf_dir))
    return dq_orphans(lines, headers, "account_move_id").select("id", "account_move_id", "write_date")


# -- batching, aggregates, windows ------------------------------------------

def _layers(spark: SparkSession) -> LayerPaths:
    root = scratch_path(spark, "layers")
    return LayerPaths(raw=f"{root}/raw", silver=f"{root}/silver", control=f"{root}/control")


def _headers_only(headers: DataFrame, lines: DataFrame, layers: LayerPaths) -> tuple[int, int]:
    """A repository that keeps headers: lines then only say which headers count."""
    return sink.append(headers, layers.bronze_moves, BRONZE_MOVE, sink.MOVE_CLUSTER), 0


def _slices(spark, sf_dir):
    """Batches of a cold start: every header with lines, by id."""
    rl_ = fx.raw_lines(spark, sf_dir)
    ids = ex.fetch_new_ids(fx.raw_headers(spark, sf_dir), None, parents(rl_))
    return batch_slices(ids, ["id asc"], BATCH_SIZE)


def _cold_start_ledger(spark, sf_dir) -> DataFrame:
    """The ledger that a cold-start run of the job has written."""
    layers = _layers(spark)
    SyncJob(spark, "account", layers, source=lambda s: (fx.raw_headers(s, sf_dir), fx.raw_lines(s, sf_dir)),
            tax=lambda s: tax_dim(s, sf_dir), batch_size=BATCH_SIZE, sink=_headers_only).run()
    return read_ledger(spark, layers)


def q_batch_slices(spark, sf_dir):
    return _slices(spark, sf_dir)


def q_batch_ledger(spark, sf_dir):
    return _cold_start_ledger(spark, sf_dir).select(
        "batch_no", "records_processed", "records_inserted", "batch_max_cursor", "records_failed")


def q_batch_write_counts(spark, sf_dir):
    headers, lines, _ = domain(spark, sf_dir)
    sl = _slices(spark, sf_dir)
    h = sl.join(headers.select("id"), "id", "left_semi")
    hc = h.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_headers"))
    lc = lines.join(h.select(F.col("id").alias("account_move_id"), "batch_no"), "account_move_id") \
        .groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_lines"))
    return hc.join(lc, "batch_no", "left").select(
        "batch_no", "n_headers", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"))


def q_run_totals(spark, sf_dir):
    runs = sync_runs(spark, sf_dir)
    return runs.groupBy("module_name").agg(
        F.count(F.lit(1)).cast("long").alias("runs"),
        F.count_if(F.col("status") == "success").cast("long").alias("successful_runs"),
        F.sum("records_inserted_total").cast("long").alias("records_inserted"),
        F.sum("records_processed").cast("long").alias("records_processed"))


def q_distinct_tax_ids(spark, sf_dir):
    return fx.raw_lines(spark, sf_dir).select(F.explode("tax_ids").alias("id")).distinct()


def earlier_silver(bronze: DataFrame, slices: int = 1) -> DataFrame:
    """The Silver build of an earlier day, written like the table it stands for
    (compressed columns in the shared folder)."""
    built = sv.silver_lines(bronze.filter(F.col("synced_at") < F.lit(SILVER_SNAPSHOT_AT)))
    return put_down(built, scratch_path(bronze.sparkSession, "silver_lines"), slices)


def q_silver_lookback(spark, sf_dir):
    """The Bronze rows that a refresh of an earlier Silver has to read, out of a
    stored table whose folders say when their rows came in.

    Only the earlier Silver's ingestion times are asked, which versions that tie on
    the spec's order share: no other column of a line moves."""
    path = scratch_path(spark, "bronze_lines")
    sink.append(bronze_lines(spark, sf_dir), path, BRONZE_LINE, sink.LINE_CLUSTER, "ingest_year",
                line_slices(spark, sf_dir))
    bronze = bronze_src.scan_bronze(spark, path, BRONZE_LINE, full=True)
    earlier = bronze.filter(F.col("synced_at") < F.lit(SILVER_SNAPSHOT_AT))
    since = sv.lookback_value(sv.silver_lines(earlier, total=False))
    return bronze_src.scan_bronze(spark, path, BRONZE_LINE, since=since).select(
        "id", "write_date", "synced_at", "sync_batch_id", F.lit(since).cast("timestamp_ntz").alias("lookback_ts"))


def q_running_watermark(spark, sf_dir):
    return _cold_start_ledger(spark, sf_dir).select("batch_no", "batch_max_cursor", "watermark")


def q_capped_extract(spark, sf_dir):
    rl_ = fx.raw_lines(spark, sf_dir)
    return ex.fetch_new_ids(fx.raw_headers(spark, sf_dir), WATERMARK, parents(rl_), cap=CAP)


def q_latest_success_run(spark, sf_dir):
    return rl.latest_success(sync_runs(spark, sf_dir)).select(
        "module_name", "sync_id", "started_at", "last_processed_ts")


def q_get_watermark(spark, sf_dir):
    return rl.watermarks(sync_runs(spark, sf_dir))


def q_run_state(spark, sf_dir):
    return sync_runs(spark, sf_dir)


def q_append_versions(spark, sf_dir):
    return two_runs_bronze_moves(spark, sf_dir).select("id", "state", "write_date", "synced_at", "sync_batch_id")


def q_dedup_latest_lines(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    return dedup_latest(li, key, full_order(li, key, ["l_shipdate desc"]))


def q_dedup_latest_events(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return dedup_latest(ev, "user_id", full_order(ev, "user_id", ["ts desc"]))


def q_dedup_latest_conversations(spark, sf_dir):
    cv = fx.table(spark, sf_dir, "conversations")
    return dedup_latest(cv, "conv_id", full_order(cv, "conv_id", ["turn desc"]))


# -- Silver, incremental semantics, sinks ---------------------------------------

def q_silver_headers(spark, sf_dir):
    return sv.silver_headers(two_runs_bronze_moves(spark, sf_dir))


def q_silver_lines(spark, sf_dir):
    return present(sv.silver_lines(bronze_lines(spark, sf_dir)))


def q_silver_incremental(spark, sf_dir):
    bronze = stored_bronze_lines(spark, sf_dir)
    slices = line_slices(spark, sf_dir)
    earlier = earlier_silver(bronze, slices)
    silver = sv.silver_incremental(earlier, bronze, sv.LINES, BRONZE_LINE)
    return present(put_down(silver, scratch_path(spark, "silver_lines"), slices))


def q_replay_idempotent(spark, sf_dir):
    bronze = stored_bronze_lines(spark, sf_dir)
    replay = (bronze.filter(F.col("synced_at") >= F.lit(REPLAY_FROM))
              .withColumn("synced_at", F.col("synced_at") + F.expr(f"INTERVAL {REPLAY_LAG_MINUTES} MINUTES"))
              .withColumn("sync_batch_id", F.lit("replay")))
    silver = sv.silver_lines(bronze.unionByName(replay)).drop("ingested_at", "sync_batch_id")
    return present(put_down(silver, scratch_path(spark, "silver_lines"), line_slices(spark, sf_dir)))


def q_bronze_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bronze_lines")
    sink.append(bronze_lines(spark, sf_dir), path, BRONZE_LINE, sink.LINE_CLUSTER, slices=line_slices(spark, sf_dir))
    return present(bronze_src.scan_bronze(spark, path, BRONZE_LINE, full=True))


def q_incremental_run(spark, sf_dir):
    """Two real runs of the sync job (cold start on snapshot 1, incremental
    on snapshot 2) into fresh layers; returns Bronze headers read back."""
    layers = _layers(spark)
    clock = iter([RUN1_AT, RUN2_AT])
    ids = (f"run-{i}" for i in itertools.count(1))
    for version in (1, 2):
        job = SyncJob(spark, "account", layers,
                      source=lambda s, v=version: (fx.raw_headers(s, sf_dir, v), fx.raw_lines(s, sf_dir)),
                      tax=lambda s: tax_dim(s, sf_dir), batch_size=BATCH_SIZE, clock=lambda: next(clock),
                      slices=line_slices(spark, sf_dir))
        job.runlog.id_factory = lambda: next(ids)
        job.run()
    moves = bronze_src.scan_bronze(spark, layers.bronze_moves, BRONZE_MOVE, full=True)
    return moves.select("id", "state", "write_date", "synced_at", "sync_batch_id")


def q_sync_multi_version(spark, sf_dir):
    """Both snapshots landed in one typed landing table: an increment from
    WATERMARK takes the newest version of each id that has one since then."""
    layers = _layers(spark)
    heads, lines = f"{layers.raw}/landed_moves", f"{layers.raw}/landed_lines"
    slices = line_slices(spark, sf_dir)
    for version in (1, 2):
        landed.land(fx.raw_headers(spark, sf_dir, version), heads, grain=landed.MONTHLY, slices=slices)
    landed.land(fx.raw_lines(spark, sf_dir), lines, grain=landed.MONTHLY, slices=slices)
    job = SyncJob(spark, "account", layers, landed.LandedSource(heads, lines, RAW_MOVE, RAW_LINE, landed.MONTHLY),
                  tax=lambda s: tax_dim(s, sf_dir), batch_size=BATCH_SIZE, sink=_headers_only)
    earlier = job.runlog.start("account")
    job.runlog.finish(earlier, "account", "success", WATERMARK)
    job.run()
    moves = bronze_src.scan_bronze(spark, layers.bronze_moves, BRONZE_MOVE, full=True)
    return moves.select("id", "state", "date", "amount_total", "write_date")


def q_quarantined_records(spark, sf_dir):
    """Defect records of a landed folder, after two runs that both met them."""
    layers = _layers(spark)
    folder = f"{layers.raw}/landing"
    fx.landed_text(spark, sf_dir).write.text(folder)
    job = SyncJob(spark, "account", layers, source=lambda s: (landing.read_raw_headers(s, folder, nested=True), None),
                  tax=lambda s: tax_dim(s, sf_dir), batch_size=BATCH_SIZE, sink=_headers_only)
    job.run()
    job.run()
    return job.quarantine.read().select("kind", "reason", F.regexp_extract("record", "SO/[0-9]+", 0).alias("name"))


def q_silver_materialize(spark, sf_dir):
    """The bucketed Silver of lines: built from the earlier Bronze, then brought
    up to date by refreshes of the buckets that later rows fall in.  Builds that a
    refresh has replaced are removed."""
    bronze = stored_bronze_lines(spark, sf_dir)
    base = scratch_path(spark, "silver_lines")
    table = sv.silver_table(spark, base, sv.LINES, BRONZE_LINE, SILVER_BUCKETS)
    for until in (SILVER_SNAPSHOT_AT, REPLAY_FROM, None):
        part = bronze if until is None else bronze.filter(F.col("synced_at") < F.lit(until))
        sv.refresh(spark, part, base, sv.LINES, BRONZE_LINE, buckets=SILVER_BUCKETS, slices=line_slices(spark, sf_dir))
        table.expire(keep=1)
    return present(table.read())


def _event_text(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    text = (F.when(F.col("event_type") == "error", F.col("props"))
            .when(F.col("event_type") == "view", F.lit(""))
            .when(F.col("event_type") == "signup", F.date_format("ts", "yyyy-MM-dd"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    return ev.select("event_id", text.alias("text"))


def q_parse_naive_utc(spark, sf_dir):
    t = _event_text(spark, sf_dir)
    return t.select("event_id", "text", parse_naive_utc("text").alias("parsed"))


def q_utc_to_local_date(spark, sf_dir):
    t = _event_text(spark, sf_dir)
    return t.select("event_id", "text", utc_to_local_date("text").alias("local_date"))


def q_normalize_tabular(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    sheet = li.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("'"), F.col("l_quantity").cast("string")).alias("cantidad"),
        F.col("l_extendedprice").cast("string").alias("precio_bruto"),
        F.when(F.col("l_discount") > 0, F.col("l_discount").cast("string")).otherwise(F.lit("")).alias("descuento"),
        (F.col("l_tax") * 100).cast("string").alias("impuesto"),
        F.concat(F.lit("'"), F.col("l_returnflag"), F.col("l_linestatus")).alias("nota"),
    )
    return normalize_tabular(sheet, ["cantidad", "precio_bruto", "descuento", "impuesto", "nota"])


def q_dq_unique(spark, sf_dir):
    """Silver keys are unique; Bronze holds versions, so its keys are not.

    Only keys are counted, so equal versions need no order beyond the spec's, and
    Bronze is not stored: every check then moves the columns it looks at alone."""
    bronze_l = bronze_lines(spark, sf_dir)
    bronze_m = two_runs_bronze_moves(spark, sf_dir)
    return (dq_unique(sv.silver_lines(bronze_l, total=False), "id", "stg_account_move_lines")
            .unionByName(dq_unique(sv.silver_headers(bronze_m, total=False), "id", "stg_account_moves"))
            .unionByName(dq_unique(bronze_l, "id", "account_move_lines"))
            .unionByName(dq_unique(bronze_m, "id", "account_moves")))


def q_dq_not_null(spark, sf_dir):
    lines = sv.silver_lines(bronze_lines(spark, sf_dir))
    moves = sv.silver_headers(two_runs_bronze_moves(spark, sf_dir))
    return dq_not_null(lines, ["id", "account_move_id", "ingested_at", "source_modified_at"],
                       "stg_account_move_lines").unionByName(
        dq_not_null(moves, ["id", "date", "ingested_at", "source_modified_at"], "stg_account_moves"))


QUERIES = {
    "scan_raw_headers": q_scan_raw_headers,
    "scan_raw_lines": q_scan_raw_lines,
    "search_domain": q_search_domain,
    "search_read": q_search_read,
    "tax_dimension": q_tax_dimension,
    "scan_bronze_range": q_scan_bronze_range,
    "control_runs": q_control_runs,
    "flatten_many2one": q_flatten_many2one,
    "default_fill": q_default_fill,
    "line_inherits_header": q_line_inherits_header,
    "line_tax_amount": q_line_tax_amount,
    "line_tax_rate": q_line_tax_rate,
    "stamp_metadata": q_stamp_metadata,
    "split_aggregate": q_split_aggregate,
    "incremental_filter": q_incremental_filter,
    "cold_start_pull": q_cold_start_pull,
    "headers_with_lines": q_headers_with_lines,
    "valid_records": q_valid_records,
    "rejected_records": q_rejected_records,
    "max_cursor": q_max_cursor,
    "nest_lines": q_nest_lines,
    "missing_tax_ids": q_missing_tax_ids,
    "read_by_ids": q_read_by_ids,
    "dq_orphan_lines": q_dq_orphan_lines,
    "batch_slices": q_batch_slices,
    "batch_ledger": q_batch_ledger,
    "batch_write_counts": q_batch_write_counts,
    "run_totals": q_run_totals,
    "distinct_tax_ids": q_distinct_tax_ids,
    "silver_lookback": q_silver_lookback,
    "running_watermark": q_running_watermark,
    "capped_extract": q_capped_extract,
    "latest_success_run": q_latest_success_run,
    "get_watermark": q_get_watermark,
    "run_state": q_run_state,
    "append_versions": q_append_versions,
    "dedup_latest_lines": q_dedup_latest_lines,
    "dedup_latest_events": q_dedup_latest_events,
    "dedup_latest_conversations": q_dedup_latest_conversations,
    "silver_headers": q_silver_headers,
    "silver_lines": q_silver_lines,
    "silver_incremental": q_silver_incremental,
    "replay_idempotent": q_replay_idempotent,
    "bronze_roundtrip": q_bronze_roundtrip,
    "incremental_run": q_incremental_run,
    "sync_multi_version": q_sync_multi_version,
    "quarantined_records": q_quarantined_records,
    "silver_materialize": q_silver_materialize,
    "parse_naive_utc": q_parse_naive_utc,
    "utc_to_local_date": q_utc_to_local_date,
    "normalize_tabular": q_normalize_tabular,
    "dq_unique": q_dq_unique,
    "dq_not_null": q_dq_not_null,
}
