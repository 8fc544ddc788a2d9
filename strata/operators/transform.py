"""Raw source records -> domain header and line rows (+ rejects).

Mirrors the source's transform: many2one pairs are flattened, absent values
get their defaults, lines inherit their header's id and date, tax rate is
looked up on the first tax id and tax amount derived.  Headers without an id
or a date are rejected (with a reason) together with their lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import (
    first_tax_id,
    m2o_id,
    m2o_name,
    tax_amount,
    tax_id_list,
    text_default,
    to_double,
    truthy,
)
from strata.functions.dates import parse_date, parse_naive_utc
from strata.operators.dedup import dedup_latest, full_order
from strata.operators.joins import dimension_join

# Fixed value: the currency label used when a record carries none.
DEFAULT_CURRENCY = "CLP"
# Where the JSON reader puts a record that it cannot parse.
CORRUPT = "_corrupt_record"
# The file a record was landed in, where the reader knows it.
SOURCE_FILE = "_source_file"

HEADER_COLS = [
    "id", "name", "move_type", "date", "partner_id", "partner_name", "company_id",
    "company_name", "journal_id", "journal_name", "currency_name", "amount_untaxed",
    "amount_tax", "amount_total", "state", "payment_state", "ref", "write_date",
]
LINE_COLS = [
    "id", "product_id", "description", "date", "quantity", "price_unit", "discount",
    "price_subtotal", "price_total", "account_id", "account_name", "debit", "credit",
    "tax_ids", "tax_rate", "tax_amount", "write_date", "account_move_id",
]


def _col_or_null(df: DataFrame, name: str, dtype: T.DataType):
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def validity(raw: DataFrame) -> tuple:
    """(is_valid, reject_reason) columns for raw headers: an unreadable record,
    no id, no date, or a date or cursor that is there but cannot be parsed."""
    has_id = truthy(raw, "id") if "id" in raw.columns else F.lit(False)
    has_date = truthy(raw, "date") if "date" in raw.columns else F.lit(False)
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    bad_date = has_date & parse_date(F.col("date")).isNull() if "date" in raw.columns else F.lit(False)
    reason = (F.when(corrupt, F.lit("corrupt_record")).when(~has_id, F.lit("missing_id"))
              .when(~has_date, F.lit("missing_date")).when(bad_date, F.lit("bad_date"))
              .when(bad_cursor(raw), F.lit("bad_cursor")))
    return reason.isNull(), reason


def bad_cursor(raw: DataFrame):
    """A cursor text that is there but is no timestamp."""
    if "write_date" not in raw.columns:
        return F.lit(False)
    return truthy(raw, "write_date") & parse_naive_utc(F.col("write_date").cast("string")).isNull()


def unreadable(raw: DataFrame):
    """Records that no cursor search can find: broken JSON, no id, or a cursor
    text that is no timestamp.  (An id of 0 is found, and rejected in its batch.)"""
    has_id = F.col("id").isNotNull() if "id" in raw.columns else F.lit(False)
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    return corrupt | ~has_id | bad_cursor(raw)


def rejected_lines(raw_lines: DataFrame) -> DataFrame:
    """Lines that cannot belong to any header, with the reason."""
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw_lines.columns else F.lit(False)
    orphan = ~F.coalesce(line_parent_id(raw_lines) != 0, F.lit(False))
    reason = F.when(corrupt, F.lit("corrupt_record")).when(orphan, F.lit("missing_parent"))
    return raw_lines.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull())


def valid_records(raw: DataFrame) -> DataFrame:
    ok, _ = validity(raw)
    return raw.filter(ok)


def rejected_records(raw: DataFrame) -> DataFrame:
    ok, reason = validity(raw)
    return raw.filter(~ok).withColumn("reject_reason", reason)


def latest_landed(raw: DataFrame, key: str = "id", cursor: str = "write_date") -> DataFrame:
    """The newest landed version of each record (landing folders gather
    versions): newest cursor, then every other column.  Records without a key
    all stay, to be rejected and counted."""
    known = raw.filter(F.col(key).isNotNull())
    if cursor not in raw.columns:
        return dedup_latest(known, key, full_order(known, key, [])).unionByName(raw.filter(F.col(key).isNull()))
    marked = known.withColumn("_cursor", parse_naive_utc(F.col(cursor).cast("string")))
    newest = dedup_latest(marked, key, full_order(marked, key, ["_cursor desc"])).drop("_cursor")
    return newest.unionByName(raw.filter(F.col(key).isNull()))


def flatten_headers(raw: DataFrame, default_currency: str = DEFAULT_CURRENCY) -> DataFrame:
    """Raw header columns -> flat domain header columns (no validity filter)."""
    s = T.StringType()
    m2o = T.ArrayType(T.StringType())
    partner = _col_or_null(raw, "partner_id", m2o)
    company = _col_or_null(raw, "company_id", m2o)
    journal = _col_or_null(raw, "journal_id", m2o)
    currency = _col_or_null(raw, "currency_id", m2o)
    return raw.select(
        F.col("id").cast("long").alias("id"),
        text_default(_col_or_null(raw, "name", s)).alias("name"),
        text_default(_col_or_null(raw, "move_type", s)).alias("move_type"),
        parse_date(F.col("date")).alias("date"),
        m2o_id(partner).alias("partner_id"),
        m2o_name(partner).alias("partner_name"),
        m2o_id(company).alias("company_id"),
        m2o_name(company).alias("company_name"),
        m2o_id(journal).alias("journal_id"),
        m2o_name(journal).alias("journal_name"),
        m2o_name(currency, default_currency).alias("currency_name"),
        to_double(_col_or_null(raw, "amount_untaxed", T.DoubleType())).alias("amount_untaxed"),
        to_double(_col_or_null(raw, "amount_tax", T.DoubleType())).alias("amount_tax"),
        to_double(_col_or_null(raw, "amount_total", T.DoubleType())).alias("amount_total"),
        text_default(_col_or_null(raw, "state", s)).alias("state"),
        text_default(_col_or_null(raw, "payment_state", s)).alias("payment_state"),
        text_default(_col_or_null(raw, "ref", s)).alias("ref"),
        parse_naive_utc(_col_or_null(raw, "write_date", s)).alias("write_date"),
    )


def normalize_headers(raw: DataFrame, default_currency: str = DEFAULT_CURRENCY) -> DataFrame:
    """Valid raw headers -> domain headers."""
    return flatten_headers(valid_records(raw), default_currency)


def line_parent_id(raw_lines: DataFrame):
    return F.try_element_at(F.col("move_id"), F.lit(1)).try_cast("long")


def flatten_lines(raw_lines: DataFrame) -> DataFrame:
    """Raw line columns -> flat line columns keyed by their parent id.

    Lines whose parent reference is falsy are dropped.  Tax rate and the
    header's date are attached later (they need joins)."""
    return flatten_lines_with(raw_lines)


def flatten_lines_with(raw_lines: DataFrame, extra: list | None = None) -> DataFrame:
    """``flatten_lines`` carrying ``extra`` columns through the projection."""
    m2o = T.ArrayType(T.StringType())
    product = _col_or_null(raw_lines, "product_id", m2o)
    account = _col_or_null(raw_lines, "account_id", m2o)
    parent = line_parent_id(raw_lines)
    return (
        raw_lines.filter(F.coalesce(parent != 0, F.lit(False)))
        .select(
            F.coalesce(F.col("id").cast("long"), F.lit(0).cast("long")).alias("id"),
            m2o_id(product).alias("product_id"),
            text_default(_col_or_null(raw_lines, "name", T.StringType())).alias("description"),
            to_double(_col_or_null(raw_lines, "quantity", T.DoubleType())).alias("quantity"),
            to_double(_col_or_null(raw_lines, "price_unit", T.DoubleType())).alias("price_unit"),
            to_double(_col_or_null(raw_lines, "discount", T.DoubleType())).alias("discount"),
            to_double(_col_or_null(raw_lines, "price_subtotal", T.DoubleType())).alias("price_subtotal"),
            to_double(_col_or_null(raw_lines, "price_total", T.DoubleType())).alias("price_total"),
            m2o_id(account).alias("account_id"),
            m2o_name(account).alias("account_name"),
            to_double(_col_or_null(raw_lines, "debit", T.DoubleType())).alias("debit"),
            to_double(_col_or_null(raw_lines, "credit", T.DoubleType())).alias("credit"),
            tax_id_list(_col_or_null(raw_lines, "tax_ids", T.ArrayType(T.LongType()))).alias("tax_ids"),
            tax_amount(_col_or_null(raw_lines, "price_subtotal", T.DoubleType()),
                       _col_or_null(raw_lines, "price_total", T.DoubleType())).alias("tax_amount"),
            parse_naive_utc(_col_or_null(raw_lines, "write_date", T.StringType())).alias("write_date"),
            parent.alias("account_move_id"),
            *(extra or []),
        )
    )


def attach_tax_rate(lines: DataFrame, tax: DataFrame, tax_bounded: bool | None = None) -> DataFrame:
    """Rate of the first tax id; unknown id or empty list -> 0.0.

    The registry is broadcast when the caller knows it is bounded
    (``tax_bounded``); otherwise Spark's size check decides."""
    t = tax.select(F.col("id").alias("_tax_id"), F.col("amount").alias("_tax_amount"))
    keyed = lines.withColumn("_first_tax", first_tax_id("tax_ids"))
    joined = dimension_join(keyed, t, keyed["_first_tax"] == t["_tax_id"], "left", bounded=bool(tax_bounded))
    return (
        joined.withColumn("tax_rate", F.coalesce(F.col("_tax_amount"), F.lit(0.0)))
        .drop("_first_tax", "_tax_id", "_tax_amount")
    )


def inherit_header(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines take their header's date; lines of unknown/rejected headers drop out.

    Equi-join on the header id: shuffle (sort-merge) at scale, both sides
    hash-partitioned on the move id; AQE splits skewed move ids."""
    h = headers.select(F.col("id").alias("_hid"), F.col("date").alias("_hdate"))
    return (
        lines.join(h, lines["account_move_id"] == h["_hid"], "inner")
        .withColumn("date", F.col("_hdate"))
        .drop("_hid", "_hdate")
    )


def normalize_lines(raw_lines: DataFrame, headers: DataFrame, tax: DataFrame,
                    tax_bounded: bool | None = None) -> DataFrame:
    """Raw lines -> domain lines for the given (valid, normalised) headers.  What
    derives from a line's own columns is put on after the join, which moves less."""
    lines = inherit_header(flatten_lines(raw_lines).drop("tax_amount"), headers)
    lines = lines.withColumn("tax_amount", tax_amount("price_subtotal", "price_total"))
    return attach_tax_rate(lines, tax, tax_bounded).select(*LINE_COLS)


def nest_lines(raw_headers: DataFrame, raw_lines: DataFrame) -> DataFrame:
    """Attach raw lines to their header as ``_lines``, in id order (left outer:
    a header without lines keeps ``[]``; lines with a falsy parent are dropped).

    A nested record holds all lines of its header, so it is only made on
    request; the jobs keep lines flat (``inherit_header``), where AQE splits a
    hot header.  Every map task gathers its lines of a header into one array
    before the one shuffle, so a hot header's rows meet as arrays."""
    parent = line_parent_id(raw_lines)
    lines = raw_lines.filter(F.coalesce(parent != 0, F.lit(False))).withColumn("_parent", parent)
    line_struct = F.struct(*[F.col(c) for c in raw_lines.columns])
    grouped = (
        lines.groupBy("_parent")
        .agg(F.collect_list(line_struct).alias("_lines"))
        .withColumn("_lines", F.array_sort("_lines", lambda a, b: F.when(a["id"] < b["id"], -1)
                                           .when(a["id"] > b["id"], 1)
                                           # without an id: last, so that the order is one
                                           .otherwise(a["id"].isNull().cast("int") - b["id"].isNull().cast("int"))))
    )
    empty = F.array().cast(T.ArrayType(raw_lines.select(line_struct.alias("s")).schema["s"].dataType))
    nested = raw_headers.join(grouped, raw_headers["id"] == grouped["_parent"], "left")
    return nested.withColumn("_lines", F.coalesce(F.col("_lines"), empty)).drop("_parent")


def explode_nested_lines(raw_nested: DataFrame) -> DataFrame:
    """Nested aggregate (header with ``_lines``) -> raw line rows.

    A line inherits its parent from the aggregate it sits in, so the parent
    reference is rebuilt from the header id."""
    lines = raw_nested.select(F.col("id").alias("_parent"), F.explode("_lines").alias("l"))
    cols = [F.col(f"l.{n}").alias(n) for n in lines.select("l.*").columns if n != "move_id"]
    return lines.select(
        *cols, F.array(F.col("_parent").cast("string")).alias("move_id")
    )


def normalize_nested_lines(raw_nested: DataFrame, tax: DataFrame, tax_bounded: bool | None = None) -> DataFrame:
    """Lines of nested aggregates -> domain lines, without a join: a line
    takes its header's id and date from the record it sits in, and lines of
    rejected headers are dropped with them."""
    ok, _ = validity(raw_nested)
    lines = (raw_nested.filter(ok)
             .select(F.col("id").alias("_parent"), parse_date(F.col("date")).alias("_hdate"),
                     F.explode("_lines").alias("l")))
    cols = [F.col(f"l.{n}").alias(n) for n in lines.select("l.*").columns if n != "move_id"]
    raw = lines.select(*cols, F.array(F.col("_parent").cast("string")).alias("move_id"), "_hdate")
    flat = flatten_lines_with(raw, extra=[F.col("_hdate").alias("date")])
    return attach_tax_rate(flat, tax, tax_bounded).select(*LINE_COLS)


def transform(raw_headers: DataFrame, tax: DataFrame, raw_lines: DataFrame | None = None,
              default_currency: str = DEFAULT_CURRENCY,
              tax_bounded: bool | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """-> (headers, lines, rejects).  Lines come from ``raw_lines`` or, when
    None, from the ``_lines`` array nested in each header.

    Every record counts, versions included: choosing one per id is the job's
    business (``latest_landed``), never the transform's."""
    if raw_lines is None:
        lines = normalize_nested_lines(raw_headers, tax, tax_bounded)
        raw_headers = raw_headers.drop("_lines")
        headers = normalize_headers(raw_headers, default_currency).select(*HEADER_COLS)
        return headers, lines, rejected_records(raw_headers)
    headers = normalize_headers(raw_headers, default_currency).select(*HEADER_COLS)
    lines = normalize_lines(raw_lines, headers, tax, tax_bounded)
    return headers, lines, rejected_records(raw_headers)


def stamp(df: DataFrame, synced_at, sync_batch_id: str) -> DataFrame:
    """Audit stamp: one ``synced_at`` per write call and the run's batch id.

    Both are driver-side literals, so a retried task writes the same values."""
    if not sync_batch_id:
        raise ValueError("sync_batch_id is required to stamp Bronze rows")
    return df.withColumn("synced_at", F.lit(synced_at).cast("timestamp_ntz")).withColumn(
        "sync_batch_id", F.lit(sync_batch_id)
    )
