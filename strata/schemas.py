"""Declared schemas for every layer, plus the entity and layer descriptors.

Schemas are fixed and declared; nothing is inferred on read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

M2O = T.ArrayType(T.StringType())  # many2one pair [id, label] as read from JSON; `false` reads as NULL


def _s(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    out = []
    for f in fields:
        name, dtype = f[0], f[1]
        nullable = f[2] if len(f) > 2 else True
        out.append(T.StructField(name, dtype, nullable))
    return T.StructType(out)


# --- raw landing records (source shape) -------------------------------------
RAW_MOVE = _s(
    ("id", T.LongType()),
    ("name", T.StringType()),
    ("move_type", T.StringType()),
    ("date", T.StringType()),
    ("partner_id", M2O),
    ("ref", T.StringType()),
    ("journal_id", M2O),
    ("state", T.StringType()),
    ("payment_state", T.StringType()),
    ("company_id", M2O),
    ("currency_id", M2O),
    ("amount_untaxed", T.DoubleType()),
    ("amount_tax", T.DoubleType()),
    ("amount_total", T.DoubleType()),
    ("line_ids", T.ArrayType(T.LongType())),
    ("write_date", T.StringType()),
)
# Declared source projection, in the order the source is asked for it.
MOVE_FIELDS = [f.name for f in RAW_MOVE.fields]

RAW_LINE = _s(
    ("id", T.LongType()),
    ("move_id", M2O),
    ("product_id", M2O),
    ("name", T.StringType()),
    ("quantity", T.DoubleType()),
    ("price_unit", T.DoubleType()),
    ("discount", T.DoubleType()),
    ("price_subtotal", T.DoubleType()),
    ("price_total", T.DoubleType()),
    ("tax_ids", T.ArrayType(T.LongType())),
    ("account_id", M2O),
    ("debit", T.DoubleType()),
    ("credit", T.DoubleType()),
    ("write_date", T.StringType()),
)
LINE_FIELDS = [f.name for f in RAW_LINE.fields]

# Nested aggregate: a header with its lines attached.
RAW_MOVE_NESTED = T.StructType(RAW_MOVE.fields + [T.StructField("_lines", T.ArrayType(RAW_LINE))])

TAX = _s(("id", T.LongType()), ("amount", T.DoubleType()))

# --- Bronze (append-only versions, grain (id, synced_at)) --------------------
BRONZE_MOVE = _s(
    ("id", T.LongType(), False),
    ("name", T.StringType()),
    ("move_type", T.StringType()),
    ("date", T.DateType()),
    ("partner_id", T.LongType()),
    ("partner_name", T.StringType()),
    ("company_id", T.LongType()),
    ("company_name", T.StringType()),
    ("journal_id", T.LongType()),
    ("journal_name", T.StringType()),
    ("currency_name", T.StringType()),
    ("amount_untaxed", T.DoubleType()),
    ("amount_tax", T.DoubleType()),
    ("amount_total", T.DoubleType()),
    ("state", T.StringType()),
    ("payment_state", T.StringType()),
    ("ref", T.StringType()),
    ("write_date", T.TimestampNTZType()),
    ("synced_at", T.TimestampNTZType(), False),
    ("sync_batch_id", T.StringType()),
)

BRONZE_LINE = _s(
    ("id", T.LongType(), False),
    ("product_id", T.LongType()),
    ("description", T.StringType()),
    ("date", T.DateType()),
    ("quantity", T.DoubleType()),
    ("price_unit", T.DoubleType()),
    ("discount", T.DoubleType()),
    ("price_subtotal", T.DoubleType()),
    ("price_total", T.DoubleType()),
    ("account_id", T.LongType()),
    ("account_name", T.StringType()),
    ("debit", T.DoubleType()),
    ("credit", T.DoubleType()),
    ("tax_ids", T.ArrayType(T.LongType())),
    ("tax_rate", T.DoubleType()),
    ("tax_amount", T.DoubleType()),
    ("write_date", T.TimestampNTZType()),
    ("synced_at", T.TimestampNTZType(), False),
    ("sync_batch_id", T.StringType()),
    ("account_move_id", T.LongType(), False),
)

# Audit renames from Bronze to Silver; business names are unchanged.
SILVER_RENAMES = {"write_date": "source_modified_at", "synced_at": "ingested_at"}
# Physical partition column of Bronze (month of `date`).
PARTITION_COL = "date_month"
# Second level of a Bronze table that look-backs read: when its rows came in (by `synced_at`).  Jobs use
# days; a long history that is loaded at once takes a coarser one.  Spark's and Python's date patterns.
INGEST_COLS = {"ingest_day": ("yyyy-MM-dd", "%Y-%m-%d"), "ingest_year": ("yyyy", "%Y")}

# --- control plane ------------------------------------------------------------
# One event per state change of a run (start / checkpoint / finish).  The
# current state of a run is a fold over its events (Parquet has no UPDATE).
RUN_EVENT = _s(
    ("sync_id", T.StringType(), False),
    ("seq", T.LongType(), False),
    ("kind", T.StringType(), False),
    ("module_name", T.StringType()),
    ("sync_type", T.StringType()),
    ("event_at", T.TimestampNTZType()),
    ("status", T.StringType()),
    ("last_processed_ts", T.TimestampNTZType()),
    ("records_processed", T.LongType()),
    ("records_inserted", T.LongType()),
    ("records_failed", T.LongType()),
    ("error_message", T.StringType()),
    # cursor progress of entities whose cursor is not a timestamp (text form)
    ("last_processed_cursor", T.StringType()),
)

# One row per committed batch of a run; the rows of a group are its commit record.
BATCH_LEDGER = _s(
    ("sync_id", T.StringType(), False),
    ("module_name", T.StringType()),
    ("group_no", T.IntegerType()),
    ("batch_no", T.LongType()),
    ("records_processed", T.LongType()),
    ("records_inserted", T.LongType()),
    ("records_failed", T.LongType()),
    ("batch_max_cursor", T.TimestampNTZType()),
    ("watermark", T.TimestampNTZType()),
    # whether batches were numbered in cursor order (a run may resume after them)
    ("in_cursor_order", T.BooleanType()),
)


@dataclass(frozen=True)
class LayerPaths:
    """Where each layer lives.  The engine never hard-codes a path."""

    raw: str
    silver: str
    control: str

    @property
    def bronze_moves(self) -> str:
        return f"{self.raw}/account_moves"

    @property
    def bronze_lines(self) -> str:
        return f"{self.raw}/account_move_lines"

    @property
    def run_events(self) -> str:
        return f"{self.control}/sync_events"

    @property
    def batch_ledger(self) -> str:
        return f"{self.control}/batch_ledger"

    @property
    def quarantine(self) -> str:
        return f"{self.control}/quarantine"

    def silver_table(self, name: str) -> str:
        return f"{self.silver}/{name}"


@dataclass(frozen=True)
class EntitySpec:
    """What makes one entity syncable: its key, its cursor and its dedup order.

    A new module (another source entity) is a new spec, not new engine code.
    """

    name: str
    key: tuple[str, ...]
    cursor: str
    order: tuple[str, ...] = ()  # extra dedup order terms after the cursor, e.g. "ingested_at desc"
    tiebreak: tuple[str, ...] = field(default_factory=tuple)

    def dedup_order(self) -> list[str]:
        return [f"{self.cursor} desc", *self.order, *self.tiebreak]
