"""Rendezvous hashing of stable record keys over weighted shards.

Every shard scores a key with weight / -ln(u), u from the hash of key and
shard; the highest score takes the record (ties to the smaller shard). The
shards do not depend on each other, so one more shard takes records only into
itself, about its share of the weight, and a removed one gives up only its own.

Slots number a shard's rows without gaps. Rows that are alike in all returned
columns are counted first (a partial aggregate, so a hot key does not meet in
one task), numbered as one and written out again; a shard is numbered in
``buckets`` of its keys, whose offsets come from their counts.

Defined results: key null counts as one key of its own; null text has size 8
and crc32 0. Repeated rows get slots of their own. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import land

#: Rows numbered together, about; and rows written from one counted row at a time.
ROWS_PER_BUCKET = 100_000
COPIES = 1 << 16


def _key_text(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit("null"))


def _unit(key: Column, salt: str) -> Column:
    """A number in (0, 1) from 52 bits of the md5 of key and salt."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"/{salt}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0, 1, ...) of a text key under the given weights."""
    scores = [F.struct((F.lit(float(w)) / -F.ln(_unit(key, str(s)))).alias("score"), F.lit(-s).alias("s"))
              for s, w in enumerate(weights) if w > 0]
    return (-(F.greatest(*scores) if len(scores) > 1 else scores[0])["s"]).cast("int")


def grow(key: Column, shard: Column, weights: Sequence[float], added: float) -> Column:
    """The shard after one more of weight ``added``: only the new score is compared."""
    new = len(weights)
    score = F.lit(float(added)) / -F.ln(_unit(key, str(new)))
    old = F.element_at(F.array(*[F.lit(float(w)) / -F.ln(_unit(key, str(s))) for s, w in enumerate(weights)]), shard + 1)
    return F.when(score > old, F.lit(new)).otherwise(shard).cast("int")


def assign(docs: DataFrame, weights: Sequence[float], added: float | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per input row: id, size (UTF-8 bytes of the text plus 8),
    text_crc32, shard, slot, and grown_shard (with one more shard)."""
    kind = docs.schema[id_col].dataType
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    keyed = (docs.select(F.col(id_col).alias("_id"), (F.octet_length(raw) + 8).cast("long").alias("size"),
                         F.crc32(raw).alias("text_crc32"))
             .groupBy("_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("_key", _key_text("_id"))
             .withColumn("shard", rendezvous(F.col("_key"), weights))
             .withColumn("grown_shard", grow(F.col("_key"), F.col("shard"), weights, added) if added
                         else F.lit(None).cast("int"))
             .withColumn("_place", _unit(F.col("_key"), "bucket")))
    keyed = land(keyed.drop("_key"), "sharding-keys")
    rows = keyed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, -(-rows // (ROWS_PER_BUCKET * len(weights))))
    keyed = keyed.withColumn("_bucket", F.floor(F.col("_place") * buckets).cast("int")).drop("_place")
    before = (Window.unboundedPreceding, -1)
    # one row for each shard and bucket
    offsets = keyed.groupBy("shard", "_bucket").agg(F.sum("n").alias("rows")).select(
        "shard", "_bucket", F.coalesce(F.sum("rows").over(
            Window.partitionBy("shard").orderBy("_bucket").rowsBetween(*before)), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "_bucket").orderBy("_id", "text_crc32", "size")
    first = F.coalesce(F.sum("n").over(inside.rowsBetween(*before)), F.lit(0))
    placed = keyed.withColumn("first", first).join(offsets, ["shard", "_bucket"]) \
        .withColumn("first", F.col("first") + F.col("offset"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))).alias("part")
    copies = F.explode(F.sequence(F.col("part") * COPIES,
                                  F.least(F.col("n"), (F.col("part") + 1) * COPIES) - 1)).alias("copy")
    return (placed.select("*", part).select("*", copies)
            .select(F.col("_id").cast(kind).alias(id_col), "size", "text_crc32", "shard",
                    (F.col("first") + F.col("copy")).alias("slot"), "grown_shard"))

