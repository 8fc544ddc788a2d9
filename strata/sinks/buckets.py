"""Keyed tables in hash buckets, of which a refresh rewrites only what it touches.

Rows live in ``bucket = pmod(xxhash64(key), B)``. A build writes some buckets
under ``data/<build>/bucket=<b>``; a manifest names, for every bucket, the
build whose files are current, so a refresh of a few buckets leaves the files
of all others as they are. The manifest with the highest number is the table;
numbers are claimed by an atomic rename, so of two concurrent refreshes one
fails and readers never see half of one. Builds that no kept manifest names are
removed by ``expire``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sinks import files
from strata.sinks.staged import CODEC, freed_shuffles

BUCKET = "bucket"
BUCKETS = 64


@dataclass(frozen=True)
class Manifest:
    """What a table is: bucket count, key, the build of each bucket, and marks
    of the caller (such as the newest ingestion time it has taken in)."""

    number: int
    buckets: int
    key: tuple[str, ...]
    builds: dict[int, str] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)
    made_at: str = ""

    def text(self) -> str:
        return json.dumps({"buckets": self.buckets, "key": list(self.key), "marks": self.marks, "made_at": self.made_at,
                           "builds": {str(b): x for b, x in sorted(self.builds.items())}})


def bucket_of(key: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class BucketTable:
    """A bucketed table at ``base`` with a declared schema."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, key: Sequence[str],
                 buckets: int = BUCKETS):
        self.spark, self.base, self.schema = spark, base.rstrip("/"), schema
        self.key, self.buckets = tuple(key), buckets

    # -- manifests ------------------------------------------------------------
    def _numbers(self) -> list[int]:
        return [int(n[1:-5]) for n in files.names(self.spark, f"{self.base}/manifest")
                if n.startswith("m") and n.endswith(".json")]

    def _manifest(self, number: int) -> Manifest:
        d = json.loads(files.read_text(self.spark, f"{self.base}/manifest/m{number:010d}.json"))
        return Manifest(number, d["buckets"], tuple(d["key"]), {int(b): x for b, x in d["builds"].items()},
                        d["marks"], d["made_at"])

    def current(self) -> Manifest | None:
        numbers = self._numbers()
        return self._manifest(max(numbers)) if numbers else None

    # -- reads ----------------------------------------------------------------
    def _paths(self, manifest: Manifest, only: Sequence[int] | None = None) -> list[str]:
        return [f"{self.base}/data/{x}/{BUCKET}={b}" for b, x in sorted(manifest.builds.items())
                if only is None or b in only]

    def read(self, manifest: Manifest | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The table (or some of its buckets); empty before the first build."""
        manifest = manifest or self.current()
        paths = self._paths(manifest, only) if manifest else []
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    # -- writes ---------------------------------------------------------------
    def _write(self, rows: DataFrame) -> dict[int, str]:
        """A new build; returns its name for each of the buckets that got files."""
        build = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f") + "-" + uuid.uuid4().hex[:8]
        path = f"{self.base}/data/{build}"
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        # rebalance: a bucket's rows meet in a task, and AQE splits large buckets and joins small ones
        with freed_shuffles(self.spark):
            (rows.select(*cols, bucket_of(self.key, self.buckets).alias(BUCKET)).hint("rebalance", BUCKET)
             .sortWithinPartitions(BUCKET, *self.key).write.mode("errorifexists").option("compression", CODEC)
             .partitionBy(BUCKET).parquet(path))
        return {int(n.split("=")[1]): build for n in files.names(self.spark, path) if n.startswith(f"{BUCKET}=")}

    def _only(self, rows: DataFrame, some: Sequence[int]) -> DataFrame:
        return rows.filter(bucket_of(self.key, self.buckets).isin(list(some)))

    @staticmethod
    def _parted(numbers: Sequence[int], slices: int) -> list[list[int]]:
        """Buckets in up to ``slices`` groups, each of which is a build of its own."""
        return [part for i in range(max(1, slices)) if (part := sorted(numbers)[i::max(1, slices)])]

    def _publish(self, manifest: Manifest) -> Manifest:
        made = Manifest(manifest.number, manifest.buckets, manifest.key, manifest.builds, manifest.marks,
                        dt.datetime.now(dt.timezone.utc).isoformat())
        if not files.create_text(self.spark, f"{self.base}/manifest/m{made.number:010d}.json", made.text()):
            raise RuntimeError(f"manifest {made.number} of {self.base} was published by another writer")
        return made

    def replace(self, rows: DataFrame, marks: dict[str, str] | None = None, slices: int = 1) -> Manifest:
        """A full build: every bucket comes from ``rows``, written in ``slices``
        groups of buckets, which hold a group's shuffle files on disk at a time."""
        builds: dict[int, str] = {}
        groups = self._parted(range(self.buckets), slices)
        for some in groups:
            builds |= self._write(self._only(rows, some) if len(groups) > 1 else rows)
        number = max(self._numbers(), default=0) + 1
        return self._publish(Manifest(number, self.buckets, self.key, builds, marks or {}))

    def refresh(self, new: DataFrame, merge: Callable[[DataFrame], DataFrame],
                marks: dict[str, str] | None = None, slices: int = 1) -> Manifest:
        """Rewrite the buckets that ``new`` rows fall in, as ``merge(their present
        rows and the new ones)``, in ``slices`` groups; the other buckets keep
        their files. ``new`` is read several times, so hand in a stored frame."""
        old = self.current()
        if old is None:
            return self.replace(merge(new), marks, slices)
        if (old.buckets, old.key) != (self.buckets, self.key):
            raise ValueError(f"{self.base} has {old.buckets} buckets of {old.key}: rebuild it to change that")
        # at most B numbers
        touched = [r[0] for r in new.select(bucket_of(self.key, self.buckets).alias("b")).distinct().collect()]
        builds = dict(old.builds)
        names = [f.name for f in self.schema.fields]
        groups = self._parted(touched, slices)
        for some in groups:
            part = new.select(*names)
            both = self.read(old, some).select(*names).unionByName(self._only(part, some) if len(groups) > 1 else part)
            got = self._write(merge(both))
            for b in some:
                builds.pop(b, None)
            builds |= got
        return self._publish(Manifest(old.number + 1, old.buckets, old.key, builds, old.marks | (marks or {})))

    # -- retention ------------------------------------------------------------
    def expire(self, keep: int = 2, older_than: dt.timedelta = dt.timedelta(0)) -> list[str]:
        """Remove manifests beyond the newest ``keep`` that were replaced at least
        ``older_than`` ago, and the builds that no manifest left names and that
        are older than the newest manifest. Returns the builds removed."""
        manifests = [self._manifest(n) for n in sorted(self._numbers())]
        now = dt.datetime.now(dt.timezone.utc)
        go = [m for m, after in zip(manifests[:-max(1, keep)], manifests[1:])
              if now - dt.datetime.fromisoformat(after.made_at) >= older_than]
        stay = [m for m in manifests if m not in go]
        named = {x for m in stay for x in m.builds.values()}
        newest = max((x for x in (manifests[-1].builds.values() if manifests else [])), default="")
        gone = [x for x in files.names(self.spark, f"{self.base}/data") if x not in named and x < newest]
        for m in go:
            files.delete(self.spark, f"{self.base}/manifest/m{m.number:010d}.json")
        for x in gone:
            files.delete(self.spark, f"{self.base}/data/{x}")
        return gone
