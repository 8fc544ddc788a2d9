"""Oracle SQL per registered query (see ``strata.plans.oracle``)."""

from __future__ import annotations

from strata.functions.dates import LOCAL_TZ
from strata.plans import catalog as c
from strata.plans import fixtures as fx
from strata.plans import oracle as o
from strata.schemas import BRONZE_LINE, LINE_FIELDS, MOVE_FIELDS

P = o.parse_ts


def ts(v) -> str:
    return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"


FLAT_LINES = f"""
SELECT coalesce(CAST(id AS BIGINT), 0) AS id,
  coalesce(TRY_CAST(product_id[1] AS BIGINT), 0) AS product_id,
  coalesce(nullif(name, 'false'), '') AS description,
  coalesce(quantity, 0.0) AS quantity, coalesce(price_unit, 0.0) AS price_unit,
  coalesce(discount, 0.0) AS discount, coalesce(price_subtotal, 0.0) AS price_subtotal,
  coalesce(price_total, 0.0) AS price_total,
  coalesce(TRY_CAST(account_id[1] AS BIGINT), 0) AS account_id, coalesce(account_id[2], '') AS account_name,
  coalesce(debit, 0.0) AS debit, coalesce(credit, 0.0) AS credit,
  coalesce(tax_ids, CAST([] AS BIGINT[])) AS tax_ids,
  CASE WHEN coalesce(price_subtotal, 0.0) <> 0
       THEN coalesce(price_total, 0.0) - coalesce(price_subtotal, 0.0) ELSE 0.0 END AS tax_amount,
  {P('write_date')} AS write_date,
  TRY_CAST(move_id[1] AS BIGINT) AS account_move_id
FROM raw_lines WHERE coalesce(TRY_CAST(move_id[1] AS BIGINT) <> 0, FALSE)"""

HIST_EVENTS = f"""
hist_src AS (
  SELECT 'account' AS module_name, {P('write_date')} AS cursor, ({o.HEADER_VALID}) AS ok,
         date_trunc('month', {P('write_date')}) AS period,
         date_trunc('month', {P('write_date')}) + INTERVAL 1 MONTH AS period_end
  FROM raw_headers WHERE {P('write_date')} IS NOT NULL
  UNION ALL
  SELECT 'events', ts, TRUE, date_trunc('day', ts), date_trunc('day', ts) + INTERVAL 1 DAY FROM events
),
hist_runs0 AS (
  SELECT module_name, period, period_end, count(*) AS records_processed,
         count(*) FILTER (WHERE ok) AS records_inserted, max(cursor) AS max_cursor
  FROM hist_src GROUP BY module_name, period, period_end
),
hist_runs AS (
  SELECT *, records_processed - records_inserted AS records_failed,
         module_name || '-' || strftime(period, '%Y%m%d') AS sync_id,
         period_end + INTERVAL 1 HOUR AS started_at,
         (records_processed - records_inserted) > records_processed * CAST({fx.MAX_REJECT_RATIO} AS DOUBLE) AS failed,
         max(period) OVER (PARTITION BY module_name) AS newest
  FROM hist_runs0
),
hist_events AS (
  SELECT sync_id, CAST(0 AS BIGINT) AS seq, 'start' AS kind, module_name, 'incremental' AS sync_type,
         started_at AS event_at, 'running' AS status, CAST(NULL AS TIMESTAMP) AS last_processed_ts,
         CAST(NULL AS BIGINT) AS records_processed, CAST(NULL AS BIGINT) AS records_inserted,
         CAST(NULL AS BIGINT) AS records_failed, CAST(NULL AS VARCHAR) AS error_message,
         CAST(NULL AS VARCHAR) AS last_processed_cursor FROM hist_runs
  UNION ALL
  SELECT sync_id, 1, 'checkpoint', module_name, NULL, started_at + INTERVAL 1 MINUTE, 'running', max_cursor,
         records_processed, records_inserted, records_failed, NULL, NULL FROM hist_runs
  UNION ALL
  SELECT sync_id, 2, 'finish', module_name, NULL, started_at + INTERVAL 2 MINUTE,
         CASE WHEN failed THEN 'failed' ELSE 'success' END, max_cursor, NULL, NULL, NULL,
         CASE WHEN failed THEN '{fx.FAILED_MESSAGE}' END, NULL FROM hist_runs WHERE period < newest
),
runs0 AS (
  SELECT sync_id,
    arg_max_null(module_name, seq) AS module_name,
    arg_max_null(sync_type, CASE WHEN kind = 'start' THEN seq END) AS sync_type,
    min(CASE WHEN kind = 'start' THEN event_at END) AS started_at,
    max(CASE WHEN kind = 'finish' THEN event_at END) AS completed_at,
    arg_max_null(status, seq) AS status,
    arg_max_null(last_processed_ts, CASE WHEN kind IN ('checkpoint', 'finish') THEN seq END) AS last_processed_ts,
    arg_max_null(records_processed, CASE WHEN kind = 'checkpoint' THEN seq END) AS records_processed,
    arg_max_null(records_inserted, CASE WHEN kind = 'checkpoint' THEN seq END) AS records_inserted,
    arg_max_null(records_failed, CASE WHEN kind = 'checkpoint' THEN seq END) AS records_failed,
    arg_max_null(error_message, CASE WHEN kind = 'finish' THEN seq END) AS error_message,
    arg_max_null(last_processed_cursor, CASE WHEN kind IN ('checkpoint', 'finish') THEN seq END)
      AS last_processed_cursor,
    CAST(count(*) FILTER (WHERE kind = 'checkpoint') AS BIGINT) AS source_calls,
    CAST(sum(CASE WHEN kind = 'checkpoint' THEN records_inserted END) AS BIGINT) AS records_inserted_total
  FROM hist_events GROUP BY sync_id
),
runs AS (
  SELECT *, CAST((epoch_us(completed_at) - epoch_us(started_at)) / CAST(1000000.0 AS DOUBLE) AS DOUBLE)
            AS execution_time_seconds FROM runs0
),
latest_ok AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY module_name
                                 ORDER BY started_at DESC NULLS LAST, sync_id DESC NULLS LAST) AS _rn
    FROM runs WHERE status = 'success') WHERE _rn = 1
)"""

SEL_IDS = f"SELECT id, {P('write_date')} AS write_date FROM raw_headers WHERE id IN (SELECT account_move_id FROM parents)"

EXTRA = f"""
parents AS (SELECT TRY_CAST(move_id[1] AS BIGINT) AS account_move_id FROM raw_lines),
flat_lines AS ({FLAT_LINES}),
raw_headers2 AS ({o.raw_headers_sql(2)}),
ids1 AS ({SEL_IDS}),
wm1 AS (SELECT max(write_date) AS wm FROM ids1),
ids2 AS (SELECT id, {P('write_date')} AS write_date FROM raw_headers2
         WHERE id IN (SELECT account_move_id FROM parents)
           AND {P('write_date')} >= (SELECT wm FROM wm1)),
headers2 AS ({o.headers_sql('(SELECT * FROM raw_headers2 WHERE id IN (SELECT id FROM ids2))')}),
bronze_moves AS (
  SELECT *, {ts(c.RUN1_AT)} AS synced_at, 'run-1' AS sync_batch_id FROM headers WHERE id IN (SELECT id FROM ids1)
  UNION ALL
  SELECT *, {ts(c.RUN2_AT)}, 'run-2' FROM headers2
),
inc AS (SELECT * FROM ({SEL_IDS}) WHERE write_date >= {ts(c.WATERMARK)}),
slices AS (
  SELECT id, write_date, CAST((row_number() OVER (ORDER BY id) - 1) // {c.BATCH_SIZE} AS BIGINT) AS batch_no
  FROM ({SEL_IDS})
),
ledger AS (
  SELECT batch_no, count(*) AS records_processed, count(h.id) AS records_inserted,
         max(s.write_date) AS batch_max_cursor, count(*) - count(h.id) AS records_failed
  FROM slices s LEFT JOIN (SELECT DISTINCT id FROM headers) h ON s.id = h.id GROUP BY batch_no
),
{HIST_EVENTS}"""


def fx_sql(body: str) -> str:
    return o.with_fixture(body).replace("\nbronze_lines AS (", "\n" + EXTRA.strip() + ",\nbronze_lines AS (", 1)


def render(cols, arrays) -> str:
    return ", ".join(f"array_to_string({x}, ',') AS {x}" if x in arrays else x for x in cols)


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
CONV_COLS = ["conv_id", "turn", "role", "text"]
SILVER_LINE_COLS = o.silver_cols(BRONZE_LINE)
BRONZE_LINE_COLS = [f.name for f in BRONZE_LINE.fields]


def dedup_table(table, cols, key, order):
    return o.dedup_sql(table, cols, key, o.full_order_sql(cols, key, order))


def silver_lines_from(bronze: str) -> str:
    return f"SELECT {o.render(SILVER_LINE_COLS)} FROM ({o.silver_lines_sql(bronze)})"


EVENT_TEXT = """(SELECT event_id, CASE WHEN event_type = 'error' THEN props WHEN event_type = 'view' THEN ''
  WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d')
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS text FROM events)"""


# blanks, sign, digits with an optional fraction (or a fraction alone), optional exponent, blanks
DECIMAL = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def norm_text(x: str) -> str:
    s = f"regexp_replace({x}, '^''', '')"
    num = (f"CASE WHEN regexp_matches({s}, '{DECIMAL}') AND abs(TRY_CAST(trim({s}) AS DOUBLE)) < CAST('inf' AS DOUBLE) "
           f"THEN TRY_CAST(trim({s}) AS DOUBLE) END")
    canon = (f"CASE WHEN round({num}, 0) = {num} THEN CAST(TRY_CAST({num} AS DECIMAL(38,0)) AS VARCHAR) "
             f"ELSE CAST(round({num}, 2) AS VARCHAR) END")
    return f"coalesce(CASE WHEN ({num}) IS NOT NULL THEN {canon} END, {s})"


SHEET = """(SELECT l_orderkey, l_linenumber, '''' || CAST(l_quantity AS VARCHAR) AS cantidad,
  CAST(l_extendedprice AS VARCHAR) AS precio_bruto,
  CASE WHEN l_discount > 0 THEN CAST(l_discount AS VARCHAR) ELSE '' END AS descuento,
  CAST(l_tax * 100 AS VARCHAR) AS impuesto, '''' || l_returnflag || l_linestatus AS nota FROM lineitem)"""


def dq_unique_sql(src: str, table: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'id' AS key_columns, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count, "
            f"CAST(count(*) AS BIGINT) AS distinct_keys, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_keys "
            f"FROM (SELECT id, count(*) AS n FROM ({src}) GROUP BY id)")


def dq_null_sql(src: str, table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{x}' AS column_name, "
        f"CAST(count(*) FILTER (WHERE {x} IS NULL) AS BIGINT) AS null_count FROM ({src})" for x in cols)


SILVER_LINES_RAW = o.silver_lines_sql("bronze_lines")
SILVER_MOVES_RAW = o.silver_moves_sql("bronze_moves")
APPEND = "SELECT id, state, write_date, synced_at, sync_batch_id FROM bronze_moves"
LOCAL = (f"CASE WHEN coalesce(text, '') = '' THEN '' "
         f"WHEN length(text) = 10 AND substr(text, 5, 1) = '-' AND substr(text, 8, 1) = '-' THEN text "
         f"ELSE coalesce(strftime(timezone('{LOCAL_TZ}', timezone('UTC', {P('text')})), '%Y-%m-%d'), "
         f"substr(text, 1, 10)) END")

SQL = {
    "scan_raw_headers": fx_sql(
        f"SELECT {render(MOVE_FIELDS, {'partner_id', 'journal_id', 'company_id', 'currency_id', 'line_ids'})} "
        f"FROM raw_headers"),
    "scan_raw_lines": fx_sql(
        f"SELECT {render(LINE_FIELDS, {'move_id', 'product_id', 'tax_ids', 'account_id'})} FROM raw_lines"),
    "search_domain": fx_sql(f"SELECT id FROM raw_headers WHERE coalesce({P('write_date')} >= {ts(c.WATERMARK)}, FALSE) "
                            f"AND id IN (SELECT account_move_id FROM parents)"),
    "search_read": fx_sql("SELECT id, name, state, amount_total, write_date FROM raw_headers "
                          f"WHERE coalesce(state = 'posted', FALSE) AND coalesce(amount_total > {c.SEARCH_MIN_TOTAL}, FALSE)"),
    "tax_dimension": fx_sql("SELECT id, amount FROM tax"),
    "scan_bronze_range": fx_sql(
        f"SELECT {o.render(BRONZE_LINE_COLS)}, strftime(date, '%Y-%m') AS date_month FROM bronze_lines "
        f"WHERE date >= DATE '{c.RANGE_FROM}' AND date <= DATE '{c.RANGE_TO}'"),
    "control_runs": fx_sql("SELECT sync_id, module_name, status, started_at, last_processed_ts FROM runs "
                           "WHERE module_name = 'account' AND status = 'success'"),
    "flatten_many2one": fx_sql("SELECT id, partner_id, partner_name, company_id, company_name, journal_id, "
                               f"journal_name, currency_name FROM ({o.flat_headers_sql('raw_headers')})"),
    "default_fill": fx_sql("SELECT id, name, move_type, state, payment_state, ref, amount_untaxed, amount_tax, "
                           f"amount_total FROM ({o.flat_headers_sql('raw_headers')})"),
    "line_inherits_header": fx_sql("SELECT id, account_move_id, date, description, write_date FROM lines"),
    "line_tax_amount": fx_sql("SELECT id, price_subtotal, price_total, tax_amount, write_date FROM flat_lines"),
    "line_tax_rate": fx_sql("SELECT f.id, array_to_string(f.tax_ids, ',') AS tax_ids, coalesce(t.amount, 0.0) AS tax_rate, "
                            "f.write_date FROM flat_lines f LEFT JOIN tax t ON t.id = f.tax_ids[1]"),
    "stamp_metadata": fx_sql(f"SELECT id, write_date, {ts(c.STAMP_AT)} AS synced_at, '{c.STAMP_BATCH}' AS sync_batch_id "
                             f"FROM headers"),
    "split_aggregate": fx_sql("SELECT id, account_move_id, date, quantity, price_total, tax_rate, tax_amount, "
                              "write_date FROM lines"),
    "incremental_filter": fx_sql("SELECT id, write_date, row_number() OVER (ORDER BY write_date, id) - 1 AS position FROM inc"),
    "cold_start_pull": fx_sql(f"SELECT id, write_date, row_number() OVER (ORDER BY id) - 1 AS position FROM ({SEL_IDS})"),
    "headers_with_lines": fx_sql("SELECT id, date, state FROM headers WHERE id IN (SELECT account_move_id FROM parents)"),
    "valid_records": fx_sql(f"SELECT id, date, write_date FROM raw_headers WHERE {o.HEADER_VALID}"),
    "rejected_records": fx_sql(
        "SELECT id, date, CASE WHEN NOT coalesce(id <> 0, FALSE) THEN 'missing_id' "
        f"WHEN NOT {o.truthy_text('date')} THEN 'missing_date' END AS reject_reason "
        f"FROM raw_headers WHERE NOT ({o.HEADER_VALID})"),
    "max_cursor": fx_sql(f"SELECT substr(date, 1, 7) AS period, max({P(chr(110) + 'ullif(write_date, ' + chr(39) * 2 + ')')}) "
                         "AS max_cursor FROM raw_headers GROUP BY 1"),
    "nest_lines": fx_sql(
        "SELECT h.id, CAST(count(l.id) AS BIGINT) AS n_lines, min(l.id) AS first_line_id, max(l.id) AS last_line_id, "
        "coalesce(string_agg(CAST(l.id AS VARCHAR), ',' ORDER BY l.id), '') AS line_ids "
        "FROM raw_headers h LEFT JOIN (SELECT * FROM raw_lines WHERE coalesce(TRY_CAST(move_id[1] AS BIGINT) <> 0, FALSE)) l "
        "ON TRY_CAST(l.move_id[1] AS BIGINT) = h.id GROUP BY h.id"),
    "missing_tax_ids": fx_sql("SELECT DISTINCT id FROM (SELECT unnest(tax_ids) AS id FROM raw_lines) "
                              "WHERE id NOT IN (SELECT id FROM tax)"),
    "read_by_ids": fx_sql(
        "SELECT id, name, state, write_date FROM raw_headers WHERE id IN ("
        f"SELECT TRY_CAST(move_id[1] AS BIGINT) FROM raw_lines WHERE {P('write_date')} >= {ts(c.REREAD_SINCE)})"),
    "dq_orphan_lines": fx_sql("SELECT id, account_move_id, write_date FROM flat_lines "
                              "WHERE account_move_id NOT IN (SELECT id FROM headers)"),
    "batch_slices": fx_sql("SELECT id, write_date, batch_no FROM slices"),
    "batch_ledger": fx_sql("SELECT * FROM ledger"),
    "batch_write_counts": fx_sql(
        "SELECT hc.batch_no, hc.n_headers, CAST(coalesce(lc.n_lines, 0) AS BIGINT) AS n_lines FROM "
        "(SELECT batch_no, count(*) AS n_headers FROM slices WHERE id IN (SELECT id FROM headers) GROUP BY batch_no) hc "
        "LEFT JOIN (SELECT s.batch_no, count(*) AS n_lines FROM lines l JOIN slices s ON l.account_move_id = s.id "
        "WHERE s.id IN (SELECT id FROM headers) GROUP BY s.batch_no) lc ON hc.batch_no = lc.batch_no"),
    "run_totals": fx_sql(
        "SELECT module_name, CAST(count(*) AS BIGINT) AS runs, "
        "CAST(count(*) FILTER (WHERE status = 'success') AS BIGINT) AS successful_runs, "
        "CAST(sum(records_inserted_total) AS BIGINT) AS records_inserted, "
        "CAST(sum(records_processed) AS BIGINT) AS records_processed FROM runs GROUP BY module_name"),
    "distinct_tax_ids": fx_sql("SELECT DISTINCT unnest(tax_ids) AS id FROM raw_lines"),
    "silver_lookback": fx_sql(
        f"SELECT b.id, b.write_date, b.synced_at, b.sync_batch_id, lb.lookback_ts FROM bronze_lines b, "
        f"(SELECT coalesce(max(ingested_at), TIMESTAMP '1970-01-01 00:00:00') AS lookback_ts FROM "
        f"({o.silver_lines_sql(f'(SELECT * FROM bronze_lines WHERE synced_at < {ts(c.SILVER_SNAPSHOT_AT)})')})) lb "
        f"WHERE b.synced_at >= lb.lookback_ts"),
    "running_watermark": fx_sql(
        "SELECT batch_no, batch_max_cursor, max(batch_max_cursor) OVER "
        "(ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS watermark FROM ledger"),
    "capped_extract": fx_sql(
        "SELECT id, write_date FROM inc WHERE write_date <= (SELECT max(write_date) FROM ("
        f"SELECT write_date FROM inc WHERE write_date IS NOT NULL ORDER BY write_date, id LIMIT {c.CAP}))"),
    "latest_success_run": fx_sql("SELECT module_name, sync_id, started_at, last_processed_ts FROM latest_ok"),
    "get_watermark": fx_sql("SELECT module_name, last_processed_ts AS watermark FROM latest_ok"),
    "run_state": fx_sql("SELECT * FROM runs"),
    "append_versions": fx_sql(APPEND),
    "dedup_latest_lines": dedup_table("lineitem", LINEITEM_COLS, ["l_orderkey", "l_linenumber"], ["l_shipdate desc"]),
    "dedup_latest_events": dedup_table("events", EVENT_COLS, ["user_id"], ["ts desc"]),
    "dedup_latest_conversations": dedup_table("conversations", CONV_COLS, ["conv_id"], ["turn desc"]),
    "silver_headers": fx_sql(SILVER_MOVES_RAW),
    "silver_lines": fx_sql(silver_lines_from("bronze_lines")),
    "silver_incremental": fx_sql(silver_lines_from("bronze_lines")),
    "replay_idempotent": fx_sql(
        f"SELECT {o.render([x for x in SILVER_LINE_COLS if x not in ('ingested_at', 'sync_batch_id')])} "
        f"FROM ({SILVER_LINES_RAW})"),
    "bronze_roundtrip": fx_sql(f"SELECT {o.render(BRONZE_LINE_COLS)}, strftime(date, '%Y-%m') AS date_month "
                               f"FROM bronze_lines"),
    "incremental_run": fx_sql(APPEND),
    # every version of either snapshot; the newest of an id counts if it is at or after the watermark
    "sync_multi_version": fx_sql(
        "SELECT id, state, date, amount_total, write_date FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY id ORDER BY write_date DESC NULLS LAST) AS nth FROM ("
        f"{o.headers_sql('raw_headers')} UNION ALL {o.headers_sql('raw_headers2')})) "
        f"WHERE nth = 1 AND write_date >= {ts(c.WATERMARK)} AND id IN (SELECT account_move_id FROM parents)"),
    "quarantined_records": (
        "SELECT 'header' AS kind, reason, 'SO/' || CAST(o_orderkey AS VARCHAR) AS name FROM (SELECT o_orderkey, "
        "CASE WHEN o_orderkey % 101 = 0 THEN 'corrupt_record' WHEN o_orderkey % 103 = 1 THEN 'missing_id' "
        "WHEN o_orderkey % 107 = 2 THEN 'bad_date' WHEN o_orderkey % 109 = 3 THEN 'bad_cursor' "
        "WHEN o_orderkey % 113 = 4 THEN 'missing_date' END AS reason FROM orders) WHERE reason IS NOT NULL"),
    "silver_materialize": fx_sql(silver_lines_from("bronze_lines")),
    "parse_naive_utc": f"SELECT event_id, text, {P('text')} AS parsed FROM {EVENT_TEXT}",
    "utc_to_local_date": f"SELECT event_id, text, {LOCAL} AS local_date FROM {EVENT_TEXT}",
    "normalize_tabular": (f"SELECT l_orderkey, l_linenumber, {norm_text('cantidad')} AS cantidad, "
                          f"{norm_text('precio_bruto')} AS precio_bruto, {norm_text('descuento')} AS descuento, "
                          f"{norm_text('impuesto')} AS impuesto, regexp_replace(nota, '^''', '') AS nota FROM {SHEET}"),
    "dq_unique": fx_sql(dq_unique_sql(SILVER_LINES_RAW, "stg_account_move_lines") + " UNION ALL "
                        + dq_unique_sql(SILVER_MOVES_RAW, "stg_account_moves") + " UNION ALL "
                        + dq_unique_sql("SELECT id FROM bronze_lines", "account_move_lines") + " UNION ALL "
                        + dq_unique_sql("SELECT id FROM bronze_moves", "account_moves")),
    "dq_not_null": fx_sql(
        dq_null_sql(SILVER_LINES_RAW, "stg_account_move_lines", ["id", "account_move_id", "ingested_at", "source_modified_at"])
        + " UNION ALL "
        + dq_null_sql(SILVER_MOVES_RAW, "stg_account_moves", ["id", "date", "ingested_at", "source_modified_at"])),
}
