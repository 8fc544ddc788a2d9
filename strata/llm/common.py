"""Helpers shared by the operators: intermediate tables and vectorised word work.

The word helpers run inside Arrow tasks on whole batches: a block of texts is
one byte array plus document offsets, and words, hashes and word windows are
numpy arrays over it, so no Python object is made per word.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path, sf_path

#: Separators of the words `[^\x20\x09-\x0D]+`.
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of text handled at once inside a task (a longer document is one block).
BLOCK_BYTES = 4 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.full(256, _BASE, dtype=np.uint64))


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per context (as --py-files
    would), so tasks can import it wherever they run."""
    import strata

    sc = spark.sparkContext
    if not getattr(sc, "_strata_shipped", False):
        top = os.path.dirname(strata.__file__)
        archive = os.path.join(tempfile.mkdtemp(prefix="strata-code-"), "strata_package.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.join("strata", os.path.relpath(full, top)))
        sc.addPyFile(archive)
        sc._strata_shipped = True
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, "documents"))


def land(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage
    is cut, and every later use sees the same rows on any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._landed_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a landed table that nothing reads any more."""
    path = getattr(df, "_landed_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def replaced(docs: DataFrame, text_col: str, text: Column) -> list[Column]:
    """The columns of ``docs`` out of a struct ``_row``, with ``text`` where it is
    not null in place of the text, and ``n_chars`` counted anew there."""
    out = []
    for c in docs.columns:
        old = F.col("_row").getField(c)
        new = text if c == text_col else F.length(text).cast(docs.schema[c].dataType) if c == "n_chars" else None
        out.append((old if new is None else F.when(text.isNotNull(), new).otherwise(old)).alias(c))
    return out


# -- byte blocks ----------------------------------------------------------------


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    if len(column) == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    data, offsets = byte_view(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def lower_az(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


# -- words ------------------------------------------------------------------------


def word_spans(data: np.ndarray, offsets: np.ndarray,
               separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, end byte and document number of every word of a block."""
    if len(data) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    gap = separator[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= gap[:-1]
    before[0] = True
    after[:-1] |= gap[1:]
    after[-1] = True
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(~gap & after) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, doc


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on an uint64 array."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    return _POWERS[:n] if n <= len(_POWERS) else np.multiply.accumulate(np.full(n, _BASE, dtype=np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    length = ends - starts
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
    value = data[place + np.repeat(starts, length)].astype(np.uint64) + np.uint64(1)
    value *= powers(int(length.max()))[place]
    return mix(np.add.reduceat(value, first) + length.astype(np.uint64))


def grams(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of the k words from each word on (the last k - 1 entries are left out)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = mix(np.arange(1, k + 1, dtype=np.uint64) + np.uint64(seed << 8)) | np.uint64(1)
    out = h[:n] * factor[0]
    for j in range(1, k):
        out += h[j:j + n] * factor[j]
    return mix(out)


def whole_grams(doc: np.ndarray, k: int) -> np.ndarray:
    """Positions whose k words all lie in one document."""
    n = len(doc) - k + 1
    return np.flatnonzero(doc[:n] == doc[k - 1:]) if n > 0 else np.zeros(0, np.int64)


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from concatenated values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
