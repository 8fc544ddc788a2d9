"""Vector code compression: integer product quantisation over Hilbert-sorted flat blocks.

Vectors become integers floor(scale * x), are cut into ``parts`` equal pieces,
and every piece is replaced by the number of the nearest entry of its
position's codebook. Rows are gathered into segments (bounded, inside one task,
no shuffle). In a segment the pieces of each position are sorted along a
Hilbert curve and cut into flat blocks of ``BLOCK`` pieces; a block keeps its
min/max box and its sum, and segments are written once as a table.

Each round reads the segments and compares boxes with entries first: an entry
whose least distance to a box is over the smallest greatest distance of any
entry is nearest to nothing in it. What is left is the block's shortlist. A
shortlist of one takes the whole block by its stored sum; else a small exact
integer kernel compares the block's pieces with the shortlist. Entries then move
to the componentwise floor(sum / count), from at most
``entries`` x vector-length totals (all that the driver gets); unused entries
stay. The last assignment writes codes and squared errors.

All arithmetic is exact: int64 where no distance can leave 62 bits, Python
integers beyond.

Defined results: null vectors and vectors with null or non-finite components
are dropped. The length in use is that of the smallest id's vector among those
whose length is a positive multiple of ``parts``; rows of another length stay,
with null code and error. Codebooks start from the ``entries`` smallest rows by
id (null ids last, equal ids by vector), fewer if there are fewer. Repeated
rows are each coded. Components beyond 64 bits saturate, as do errors. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import discard, land, ship
from strata.llm.voronoi import quantised

BLOCK = 16
SEGMENT_VALUES = 1 << 22  # components of one segment
KERNEL_VALUES = 1 << 20   # distances held at once
TOP = (1 << 63) - 1


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Place of each point on a Hilbert curve through the box of all points
    (Skilling's transform: exchange and invert bits from the top, then Gray code)."""
    n, d = points.shape
    d = min(d, 63)
    bits = max(1, min(8, 63 // d))
    p = points[:, :d].astype(float)
    low, high = p.min(axis=0), p.max(axis=0)
    x = ((p - low) * ((1 << bits) - 1) / np.where(high > low, high - low, 1.0)).astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(d):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(up, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(n, np.int64), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def exact(points: np.ndarray, entries: np.ndarray) -> type:
    """The number type in which no squared distance can overflow."""
    d = max(1, points.shape[-1])
    most = max(int(abs(int(f(x)))) for x in (points, entries) if x.size for f in (np.min, np.max))
    return np.int64 if 4 * d * most * most < 1 << 62 else object


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which entries (columns) can be nearest to a point of each box (rows).
    Every nearest entry, ties included, stays."""
    least = most = 0
    for k in range(entries.shape[1]):
        e = entries[None, :, k]
        below, above = low[:, None, k] - e, e - high[:, None, k]
        out = np.maximum(np.maximum(below, above), 0)
        far = np.maximum(abs(below), abs(above))
        least, most = least + out * out, most + far * far
    return least <= most.min(axis=1)[:, None]


def kernel(points: np.ndarray, some: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest shortlisted entry (ties to the lower) and squared distance;
    ``points`` (blocks, rows, components), ``some`` (blocks, shortlist), ascending."""
    d = 0
    for k in range(points.shape[2]):
        gap = points[:, :, None, k] - entries[some][:, None, :, k]
        d = d + gap * gap
    best = d.argmin(axis=2)
    return np.take_along_axis(some, best, axis=1) if some.shape[1] > 1 else np.broadcast_to(some, best.shape), \
        np.take_along_axis(d, best[:, :, None], axis=2)[:, :, 0]


class Blocks:
    """The flat blocks of one position of a segment."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.heads = np.arange(0, self.n, BLOCK)
        self.size = np.diff(np.append(self.heads, self.n))
        self.points = points
        self.low = np.minimum.reduceat(points, self.heads, axis=0)
        self.high = np.maximum.reduceat(points, self.heads, axis=0)
        self.sum = np.add.reduceat(points.astype(np.int64 if exact(points, points) is np.int64 else object),
                                   self.heads, axis=0)

    def nearest(self, entries: np.ndarray, wanted: np.ndarray | None = None):
        """Yields (blocks, rows of the segment, entry of each row, distance)."""
        kind = exact(self.points, entries)
        e = entries.astype(kind)
        keep = self.short if hasattr(self, "short") else shortlists(self.low.astype(kind), self.high.astype(kind), e)
        length = keep.sum(axis=1)
        for s in np.unique(length if wanted is None else length[wanted]):
            these = np.flatnonzero(length == s) if wanted is None else np.flatnonzero((length == s) & wanted)
            step = max(1, KERNEL_VALUES // (BLOCK * int(s)))
            for lo in range(0, len(these), step):
                b = these[lo:lo + step]
                some = np.nonzero(keep[b])[1].reshape(len(b), s)
                row = self.heads[b][:, None] + np.minimum(np.arange(BLOCK)[None, :], self.size[b][:, None] - 1)
                real = np.arange(BLOCK)[None, :] < self.size[b][:, None]
                best, distance = kernel(self.points[row].astype(kind), some, e)
                yield row[real], best[real], distance[real]

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the pieces nearest to each entry."""
        kind = exact(self.points, entries)
        self.short = shortlists(self.low.astype(kind), self.high.astype(kind), entries.astype(kind))
        one = self.short.sum(axis=1) == 1
        total = np.zeros(entries.shape, dtype=object)
        count = np.zeros(len(entries), dtype=np.int64)
        whole = self.short[one].argmax(axis=1)
        np.add.at(total, whole, self.sum[one].astype(object))
        np.add.at(count, whole, self.size[one])
        for row, best, _ in self.nearest(entries, ~one):
            order = np.argsort(best, kind="stable")
            seen, head = np.unique(best[order], return_index=True)
            total[seen] += np.add.reduceat(self.points[row[order]].astype(self.sum.dtype), head, axis=0).astype(object)
            count += np.bincount(best, minlength=len(entries))
        del self.short
        return total, count


# -- segments ---------------------------------------------------------------------


def _smallest(x: np.ndarray) -> np.ndarray:
    return x.astype(np.result_type(np.min_scalar_type(int(x.min())), np.min_scalar_type(int(x.max())), np.int8))


def _segments(dim: int, parts: int):
    """Packs rows into segments: ids, labels, and per position the Hilbert order and the sorted pieces."""
    most = max(1, SEGMENT_VALUES // dim)

    def packed(ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        x = np.concatenate(vectors)
        pieces = x.reshape(len(x), parts, dim // parts)
        order = np.stack([np.argsort(hilbert_keys(pieces[:, p]), kind="stable") for p in range(parts)])
        laid = _smallest(np.stack([pieces[order[p], p] for p in range(parts)]))
        ids, labels = pa.chunked_array(ids).combine_chunks(), pa.chunked_array(labels).combine_chunks()
        whole = pa.array([0, len(x)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(whole, ids), pa.ListArray.from_arrays(whole, labels),
             pa.array([order.astype("<i4").tobytes()], pa.binary()), pa.array([laid.tobytes()], pa.binary()),
             pa.array([laid.dtype.str])], names=["ids", "labels", "place", "pieces", "kind"])

    def run(batches):
        ids, labels, vectors, n = [], [], [], 0
        for batch in batches:
            v = batch.column("v")
            x = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(v), dim)
            for lo in range(0, len(x), most):
                some = x[lo:lo + most]
                if n and n + len(some) > most:
                    yield packed(ids, labels, vectors)
                    ids, labels, vectors, n = [], [], [], 0
                ids.append(batch.column("id").slice(lo, len(some)))
                labels.append(batch.column("label").slice(lo, len(some)))
                vectors.append(some)
                n += len(some)
        if n:
            yield packed(ids, labels, vectors)
    return run


def _unpack(batch: pa.RecordBatch, r: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.frombuffer(batch.column("place")[r].as_py(), dtype="<i4").reshape(parts, -1)
    pieces = np.frombuffer(batch.column("pieces")[r].as_py(), dtype=batch.column("kind")[r].as_py())
    return order, pieces.reshape(parts, order.shape[1], -1)


def _round(books: np.ndarray):
    """Totals of one task's segments: position, entry, number, and sums as decimal texts."""
    parts, entries, width = books.shape

    def run(batches):
        total = np.zeros(books.shape, dtype=object)
        count = np.zeros(books.shape[:2], dtype=np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                _, pieces = _unpack(batch, r, parts)
                for p in range(parts):
                    t, c = Blocks(pieces[p]).totals(books[p])
                    total[p] += t
                    count[p] += c
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
             pa.array([[str(v) for v in total[p, e]] for p, e in zip(part, entry)], pa.list_(pa.string()))],
            names=["part", "entry", "n", "total"])
    return run


def _codes(books: np.ndarray):
    parts = len(books)

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                order, pieces = _unpack(batch, r, parts)
                n = order.shape[1]
                code, error = np.zeros((n, parts), np.uint8), np.zeros(n, dtype=np.int64)
                for p in range(parts):
                    for row, best, distance in Blocks(pieces[p]).nearest(books[p]):
                        at = order[p][row]
                        code[at, p] = best
                        if distance.dtype == object:
                            error = error.astype(object)
                        error[at] += distance
                if error.dtype == object:
                    error = np.array([min(int(e), TOP) for e in error], dtype=np.int64)
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * 2 * parts).buffers()[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[r].values, batch.column("labels")[r].values,
                     pa.StringArray.from_buffers(n, ends, pa.py_buffer(code.tobytes().hex().encode())),
                     pa.array(error)], names=["id", "label", "code", "error"])
    return run


def learn(spark: SparkSession, segments: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks after ``rounds`` assignments and updates."""
    for _ in range(rounds):
        sums = segments.mapInArrow(_round(books), "part int, entry int, n bigint, total array<string>")
        rows = (sums.select("part", "entry", "n", F.posexplode("total").alias("place", "total"))
                .groupBy("part", "entry", "place")
                .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
        books = books.copy()
        for r in rows:
            books[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return books


def compress(vectors: DataFrame, id_col: str = "vec_id", embedding: str = "embedding", label_col: str = "label",
             scale: float = 256.0, parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[DataFrame, np.ndarray]:
    """(``id``, ``label``, ``code``, ``error`` of every kept row; the codebooks,
    as (part, entry, component) integers). ``entries`` is at most 256."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part")
    spark = ship(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                          quantised(embedding, scale).alias("v")).where("v IS NOT NULL")
    by_id = [F.col("id").asc_nulls_last(), F.col("v").asc()]
    first = rows.where(F.size("v") % parts == 0).where("size(v) > 0").orderBy(*by_id).select(F.size("v").alias("n")).first()
    kinds = (rows.schema["id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString())
    if first is None:
        none = rows.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return none, np.zeros((parts, 0, 0), np.int64)
    dim = first["n"]
    fit = rows.where(F.size("v") == dim)
    seeds = np.array([r["v"] for r in fit.orderBy(*by_id).select("v").limit(entries).collect()], dtype=np.int64)
    books = seeds.reshape(len(seeds), parts, dim // parts).transpose(1, 0, 2).copy()
    segments = land(fit.mapInArrow(_segments(dim, parts), f"ids array<{kinds[0]}>, labels array<{kinds[1]}>, "
                                   "place binary, pieces binary, kind string"), "code-segments")
    books = learn(spark, segments, books, rounds)
    coded = segments.mapInArrow(_codes(books), f"id {kinds[0]}, label {kinds[1]}, code string, error bigint")
    other = rows.where(F.size("v") != dim).select("id", "label", F.lit(None).cast("string").alias("code"),
                                                  F.lit(None).cast("long").alias("error"))
    out = land(coded.unionByName(other), "codes")
    discard(segments)
    return out, books


def book_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in books.reshape(-1)).encode()).hexdigest()


def with_label_error(coded: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """id, code, error and the error summed over the rows of the same label
    (nulls are one label); sums beyond 64 bits saturate."""
    total = F.coalesce(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    total = F.least(total, F.lit(TOP).cast("decimal(38,0)")).cast("long")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
            .select(F.col("id").alias(id_col), "code", "error", "label_error"))
