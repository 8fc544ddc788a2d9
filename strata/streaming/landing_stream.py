"""Landing folder -> Bronze as a Structured Streaming query.

``readStream`` over landed nested records (JSON lines, header with its
``_lines``), ``foreachBatch`` doing the same transform + append as the batch
job, ``trigger(availableNow=True)`` to drain what is there and stop.

Appends are replay-safe.  Before a micro-batch writes, it claims an *intent*
for its (stream, epoch) with the batch id and the ingestion time it will stamp;
after all its data it claims a *commit*.  The stream checkpoint gives a replayed
epoch the same files, so a replay finds the intent, uses the same stamps, and
appends only rows that the broken-off attempt has not left; an epoch with a
commit is skipped.  A stream is known by the id in its checkpoint's metadata, so
a new checkpoint starts anew.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import transform as tr
from strata.plans.runlog import RunLog, utc_now
from strata.plans.sync_run import INGEST
from strata.schemas import BRONZE_LINE, BRONZE_MOVE, PARTITION_COL, RAW_MOVE_NESTED, LayerPaths
from strata.sinks import bronze as sink
from strata.sinks import files
from strata.sinks.quarantine import Quarantine
from strata.sources.bronze import with_partition_col


class EpochLog:
    """Intent and commit marks of a stream's micro-batches, one small file each."""

    def __init__(self, spark: SparkSession, folder: str, checkpoint: str):
        self.spark, self.folder, self.checkpoint = spark, folder, checkpoint

    def _path(self, epoch: int, kind: str) -> str:
        meta = f"{self.checkpoint}/metadata"
        stream = json.loads(files.read_text(self.spark, meta))["id"] if files.exists(self.spark, meta) else "stream"
        return f"{self.folder}/{stream}/{epoch:012d}.{kind}"

    def committed(self, epoch: int) -> bool:
        return files.exists(self.spark, self._path(epoch, "commit"))

    def intend(self, epoch: int, batch_id: str, at: dt.datetime) -> tuple[str, dt.datetime, bool]:
        """(batch id, ingestion time, whether an earlier attempt had claimed the epoch)."""
        path = self._path(epoch, "intent")
        mine = files.create_text(self.spark, path, json.dumps({"batch_id": batch_id, "at": at.isoformat()}))
        d = json.loads(files.read_text(self.spark, path))
        return d["batch_id"], dt.datetime.fromisoformat(d["at"]), not mine

    def commit(self, epoch: int, rows: int) -> None:
        files.create_text(self.spark, self._path(epoch, "commit"), json.dumps({"rows": rows}))


def append_missing(df: DataFrame, path: str, schema: T.StructType, cluster, batch_id: str) -> int:
    """Append the rows of a batch that an earlier attempt of it has not left in the
    table; returns the batch's rows now there.  Only the batch's months are
    read, and of them the rows with its batch id."""
    spark = df.sparkSession
    if not files.exists(spark, path):
        return sink.append(df, path, schema, cluster, INGEST)
    months = [r[0] for r in df.select(F.date_format("date", "yyyy-MM")).distinct().collect()]
    there = (spark.read.schema(with_partition_col(schema)).parquet(path)
             .filter(F.col(PARTITION_COL).isin(months) & (F.col("sync_batch_id") == batch_id)))
    # a batch may hold equal rows: they are told apart by their number
    key = [f.name for f in schema.fields]
    number = lambda x: x.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    left = (number(df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]))
            .withColumnRenamed("_n", "_want"))
    have = number(there.select(*key)).withColumnsRenamed({c: f"_t_{c}" for c in key})
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    short = F.col("_want") - F.coalesce("_n", F.lit(0))
    found = there.count()
    missing = (left.join(have, same, "left").withColumn("_short", short).filter("_short > 0")
               .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_short")))))
    return sink.append(missing, path, schema, cluster, INGEST) + found


def make_batch_writer(spark: SparkSession, module: str, layers: LayerPaths, tax: Callable[[SparkSession], DataFrame],
                      runlog: RunLog, clock: Callable[[], dt.datetime] = utc_now,
                      fail_after_write: Callable[[int], bool] | None = None, checkpoint: str = ""):
    epochs = EpochLog(spark, f"{layers.control}/stream_epochs/{module}", checkpoint)
    quarantine = Quarantine(spark, layers.quarantine)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if epochs.committed(epoch_id):
            return
        prev = runlog.get_watermark(module)
        run_id = runlog.start(module)
        try:
            # one pass over the files: the micro-batch is kept until it is written
            batch.persist()
            batch_id, synced, again = epochs.intend(epoch_id, f"{run_id}:{epoch_id}", clock())
            unread = tr.unreadable(batch)
            failed = quarantine.add(tr.rejected_records(batch.filter(unread)), "header", batch_id, synced)
            # the newest version per id in this micro-batch, of records that have lines
            landed = tr.latest_landed(batch.filter(~unread)).filter(F.size("_lines") > 0)
            ok, _ = tr.validity(landed)
            landed = landed.filter(ok).unionByName(quarantine.unknown(landed.filter(~ok), "header"))
            stats = landed.agg(F.count(F.lit(1)).alias("n"),
                               F.max(tr.parse_naive_utc(F.col("write_date"))).alias("m")).first()
            headers, lines, rejects = tr.transform(landed, tax(spark))
            save = append_missing if again else lambda df, path, schema, cluster, _: sink.append(df, path, schema, cluster, INGEST)
            n_h = save(tr.stamp(headers, synced, batch_id), layers.bronze_moves, BRONZE_MOVE, sink.MOVE_CLUSTER, batch_id)
            save(tr.stamp(lines, synced, batch_id), layers.bronze_lines, BRONZE_LINE, sink.LINE_CLUSTER, batch_id)
            if fail_after_write and fail_after_write(epoch_id):
                raise RuntimeError(f"injected failure after write of epoch {epoch_id}")
            quarantine.add(rejects, "header", batch_id, synced)
            wm = stats["m"] if prev is None or (stats["m"] is not None and stats["m"] > prev) else prev
            processed = stats["n"] + failed
            runlog.checkpoint(run_id, module, wm, processed, n_h, processed - n_h)
            epochs.commit(epoch_id, n_h)
            runlog.finish(run_id, module, "success", wm)
        except Exception as exc:
            runlog.finish(run_id, module, "failed", prev, error_message=str(exc))
            raise
        finally:
            batch.unpersist()

    return write_batch


def run_landing_stream(spark: SparkSession, landing: str, checkpoint: str, module: str, layers: LayerPaths,
                       tax: Callable[[SparkSession], DataFrame], fmt: str = "json",
                       max_files_per_trigger: int = 100, runlog: RunLog | None = None,
                       clock: Callable[[], dt.datetime] = utc_now, fail_after_write=None) -> None:
    runlog = runlog or RunLog(spark, layers.run_events, clock=clock)
    schema = T.StructType([*RAW_MOVE_NESTED.fields, T.StructField(tr.CORRUPT, T.StringType())])
    stream = (spark.readStream.schema(schema).format(fmt).option("columnNameOfCorruptRecord", tr.CORRUPT)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(landing)
              .withColumn(tr.SOURCE_FILE, F.input_file_name()))
    q = (stream.writeStream
         .foreachBatch(make_batch_writer(spark, module, layers, tax, runlog, clock, fail_after_write, checkpoint))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
