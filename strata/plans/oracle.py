"""DuckDB SQL for the correctness oracle (one statement per query).

Each statement re-derives the fixture records from the driver's tables with
the same rules as ``strata.plans.fixtures`` and then states the operator's
semantics in plain SQL.  Array columns are rendered as comma-joined text on
both sides (``catalog.present``) so the comparison never depends on how a
list value is hashed.
"""

from __future__ import annotations

from strata.plans import fixtures as fx
from strata.schemas import BRONZE_LINE, BRONZE_MOVE, SILVER_RENAMES

# -- fixture derivation -------------------------------------------------------


def raw_headers_sql(version: int = 1) -> str:
    v2 = "TRUE" if version >= 2 else "FALSE"
    return f"""
SELECT o_orderkey AS id,
  'SO/' || CAST(o_orderkey AS VARCHAR) AS name,
  'out_invoice' AS move_type,
  CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED')
       THEN strftime(o_orderdate, '%Y-%m-%d') END AS date,
  [CAST(o_custkey AS VARCHAR), c_name] AS partner_id,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN 'PO-' || CAST(o_custkey AS VARCHAR) END AS ref,
  CASE WHEN o_orderpriority = '5-LOW' THEN [substr(o_orderpriority, 1, 1)]
       ELSE [substr(o_orderpriority, 1, 1), substr(o_orderpriority, 3, 40)] END AS journal_id,
  CASE WHEN {v2} AND o_orderstatus = 'O' THEN 'posted'
       WHEN o_orderstatus = 'F' THEN 'posted'
       WHEN o_orderstatus = 'O' THEN 'draft' END AS state,
  CASE WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'not_paid' END AS payment_state,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN [CAST(c_nationkey AS VARCHAR), n_name] END AS company_id,
  CASE WHEN c_acctbal < 0 THEN ['2', 'USD'] END AS currency_id,
  o_totalprice AS amount_untaxed,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * CAST(0.19 AS DOUBLE) END AS amount_tax,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + o_totalprice * CAST(0.19 AS DOUBLE)
       ELSE o_totalprice END AS amount_total,
  CAST(NULL AS BIGINT[]) AS line_ids,
  strftime(CASE WHEN {v2} AND o_orderstatus = 'O'
                THEN o_orderdate + INTERVAL {fx.SECOND_VERSION_SHIFT_DAYS} DAY + INTERVAL 10 HOUR
                WHEN o_orderdate >= TIMESTAMP '{fx.CURSOR_ERA_START}'
                THEN o_orderdate + INTERVAL 9 HOUR END, '%Y-%m-%d %H:%M:%S') AS write_date
FROM orders
LEFT JOIN (customer LEFT JOIN nation ON c_nationkey = n_nationkey) ON o_custkey = c_custkey"""


RAW_LINES = """
SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id,
  [CAST(l_orderkey AS VARCHAR), 'SO/' || CAST(l_orderkey AS VARCHAR)] AS move_id,
  [CAST(l_partkey AS VARCHAR), 'part-' || CAST(l_partkey AS VARCHAR)] AS product_id,
  'line ' || CAST(l_linenumber AS VARCHAR) AS name,
  l_quantity AS quantity,
  l_extendedprice / l_quantity AS price_unit,
  l_discount * 100 AS discount,
  CASE WHEN l_returnflag = 'R' THEN CAST(0.0 AS DOUBLE) ELSE l_extendedprice * (1 - l_discount) END AS price_subtotal,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS price_total,
  CASE WHEN l_tax > 0 THEN [CAST(round(l_tax * 100) AS BIGINT)
    + CASE WHEN l_orderkey % 50 = 0 THEN 100 ELSE 0 END] ELSE CAST([] AS BIGINT[]) END AS tax_ids,
  [CAST(l_suppkey AS VARCHAR), 'ACC-' || CAST(l_suppkey AS VARCHAR)] AS account_id,
  CASE WHEN l_returnflag = 'R' THEN CAST(0.0 AS DOUBLE)
       ELSE l_extendedprice * (1 - l_discount) * (1 + l_tax) END AS debit,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice * (1 - l_discount) * (1 + l_tax)
       ELSE CAST(0.0 AS DOUBLE) END AS credit,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS write_date
FROM lineitem"""

TAX = """
SELECT DISTINCT CAST(round(l_tax * 100) AS BIGINT) AS id,
       CAST(CAST(round(l_tax * 100) AS BIGINT) AS DOUBLE) AS amount
FROM lineitem WHERE l_tax > 0"""


def parse_ts(expr: str) -> str:
    return f"CAST(try_strptime(substr({expr}, 1, 19), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)"


def truthy_text(expr: str) -> str:
    return f"coalesce({expr} <> '' AND {expr} <> 'false', FALSE)"


HEADER_VALID = f"coalesce(id <> 0, FALSE) AND {truthy_text('date')}"


def flat_headers_sql(src: str = "raw_headers") -> str:
    return f"""
SELECT CAST(id AS BIGINT) AS id,
  coalesce(nullif(name, 'false'), '') AS name,
  coalesce(nullif(move_type, 'false'), '') AS move_type,
  CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date,
  coalesce(TRY_CAST(partner_id[1] AS BIGINT), 0) AS partner_id,
  coalesce(partner_id[2], '') AS partner_name,
  coalesce(TRY_CAST(company_id[1] AS BIGINT), 0) AS company_id,
  coalesce(company_id[2], '') AS company_name,
  coalesce(TRY_CAST(journal_id[1] AS BIGINT), 0) AS journal_id,
  coalesce(journal_id[2], '') AS journal_name,
  coalesce(currency_id[2], 'CLP') AS currency_name,
  coalesce(TRY_CAST(amount_untaxed AS DOUBLE), 0.0) AS amount_untaxed,
  coalesce(TRY_CAST(amount_tax AS DOUBLE), 0.0) AS amount_tax,
  coalesce(TRY_CAST(amount_total AS DOUBLE), 0.0) AS amount_total,
  coalesce(nullif(state, 'false'), '') AS state,
  coalesce(nullif(payment_state, 'false'), '') AS payment_state,
  coalesce(nullif(ref, 'false'), '') AS ref,
  {parse_ts('write_date')} AS write_date
FROM {src}"""


def headers_sql(src: str = "raw_headers") -> str:
    return flat_headers_sql(f"(SELECT * FROM {src} WHERE {HEADER_VALID})")


LINES = f"""
SELECT coalesce(CAST(l.id AS BIGINT), 0) AS id,
  coalesce(TRY_CAST(l.product_id[1] AS BIGINT), 0) AS product_id,
  coalesce(nullif(l.name, 'false'), '') AS description,
  h.date AS date,
  coalesce(l.quantity, 0.0) AS quantity,
  coalesce(l.price_unit, 0.0) AS price_unit,
  coalesce(l.discount, 0.0) AS discount,
  coalesce(l.price_subtotal, 0.0) AS price_subtotal,
  coalesce(l.price_total, 0.0) AS price_total,
  coalesce(TRY_CAST(l.account_id[1] AS BIGINT), 0) AS account_id,
  coalesce(l.account_id[2], '') AS account_name,
  coalesce(l.debit, 0.0) AS debit,
  coalesce(l.credit, 0.0) AS credit,
  coalesce(l.tax_ids, CAST([] AS BIGINT[])) AS tax_ids,
  coalesce(t.amount, 0.0) AS tax_rate,
  CASE WHEN coalesce(l.price_subtotal, 0.0) <> 0
       THEN coalesce(l.price_total, 0.0) - coalesce(l.price_subtotal, 0.0) ELSE 0.0 END AS tax_amount,
  {parse_ts('l.write_date')} AS write_date,
  TRY_CAST(l.move_id[1] AS BIGINT) AS account_move_id
FROM raw_lines l
JOIN headers h ON TRY_CAST(l.move_id[1] AS BIGINT) = h.id
LEFT JOIN tax t ON t.id = coalesce(l.tax_ids, CAST([] AS BIGINT[]))[1]
WHERE coalesce(TRY_CAST(l.move_id[1] AS BIGINT) <> 0, FALSE)"""

SYNCED = (f"coalesce(write_date + INTERVAL {fx.INGEST_LAG_HOURS} HOUR, "
          f"TIMESTAMP '{fx.INITIAL_LOAD_AT}')")


def stamped(src: str) -> str:
    return (f"SELECT *, {SYNCED} AS synced_at, 'sync-' || strftime({SYNCED}, '%Y%m%d%H') AS sync_batch_id "
            f"FROM {src}")


def with_fixture(body: str, headers_version: int = 1) -> str:
    """Prefix a statement with the fixture CTEs (unused CTEs cost nothing)."""
    return f"""WITH raw_headers AS ({raw_headers_sql(headers_version)}),
raw_lines AS ({RAW_LINES}),
tax AS ({TAX}),
headers AS ({headers_sql()}),
lines AS ({LINES}),
bronze_lines AS ({stamped('lines')})
{body}"""


# -- Silver -------------------------------------------------------------------

ARRAY_COLS = {"tax_ids"}


def silver_cols(schema) -> list[str]:
    return [SILVER_RENAMES.get(f.name, f.name) for f in schema.fields]


def full_order_sql(cols: list[str], key: list[str], order: list[str]) -> str:
    named = {t.split()[0] for t in order}
    rest = [f"{c} DESC" for c in cols if c not in key and c not in named and c not in ARRAY_COLS]
    terms = [f"{t.split()[0]} {t.split()[1].upper()}" for t in order]
    return ", ".join(f"{t} NULLS LAST" for t in [*terms, *rest])


SILVER_ORDER = ["source_modified_at desc", "ingested_at desc", "sync_batch_id desc"]


def mirror_sql(schema, src: str) -> str:
    sel = ", ".join(f"{f.name} AS {SILVER_RENAMES.get(f.name, f.name)}" for f in schema.fields)
    return f"SELECT {sel} FROM {src} WHERE date IS NOT NULL"


def dedup_sql(src: str, cols: list[str], key: list[str], order_sql: str) -> str:
    return f"""SELECT {', '.join(cols)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {order_sql}) AS _rn FROM {src}
) WHERE _rn = 1"""


def silver_lines_sql(bronze: str = "bronze_lines") -> str:
    cols = silver_cols(BRONZE_LINE)
    return dedup_sql(f"({mirror_sql(BRONZE_LINE, bronze)})", cols, ["id"],
                     full_order_sql(cols, ["id"], SILVER_ORDER))


def silver_moves_sql(bronze: str = "bronze_moves") -> str:
    cols = silver_cols(BRONZE_MOVE)
    return dedup_sql(f"({mirror_sql(BRONZE_MOVE, bronze)})", cols, ["id"],
                     full_order_sql(cols, ["id"], SILVER_ORDER))


def render(cols: list[str]) -> str:
    """Select list that renders array columns as comma-joined text."""
    return ", ".join(f"array_to_string({c}, ',') AS {c}" if c in ARRAY_COLS else c for c in cols)
