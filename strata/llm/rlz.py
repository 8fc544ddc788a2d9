"""Substring dedup by relative Lempel-Ziv parsing over an indexed corpus.

The reference is the whole corpus, in hash-partitioned blocks. Its index names
every phrase (``window`` consecutive words) and where it starts first. Each
document is parsed from left to right against all blocks: a factor begins at
the first phrase with an earlier copy and grows greedily while the phrase one
word on has one too; phrases over a factor's boundary are looked up like any
other, so a passage in which the source changes loses nothing. Factors have at
least ``window`` words and are the duplicate spans; other words are literals.

Two steps keep the index small. Every phrase has an anchor: the smallest hash
of the ``ANCHOR``-word grams inside it, about one distinct anchor per seven
words. Equal phrases have equal anchors, so a phrase whose anchor occurs once
in the corpus has no copy; only the others are indexed, by anchor and phrase
hash (two independent 64-bit hashes). Anchors combine on the map side; phrases
travel in runs of one anchor, of equal ones one per block of texts, so a passage
that repeats everywhere is as many rows as there are blocks. Both steps send
back, per document, what is unique or first: bounded by the document's length.

Defined results: "earlier" is a smaller id, or an earlier start in the same
document, in the input (not in what is left). Null or short texts lose
nothing. A row without id has no place in this order: it is neither changed
nor a source. Rows that share an id and a text count as the same document at
the same place, so a repeated row loses only what an earlier place holds; other
texts of the id are documents of their own, in the order of their text's hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strata.llm.common import (blocks, grams, ragged, ship, text_or_empty, whole_grams, word_hashes,
                               word_spans)

ANCHOR = 8


def _smallest(value: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of ``width`` values from each place on (leftmost of equals)."""
    place = np.arange(len(value))
    span = 1
    while span < width:
        step = min(span, width - span)
        a, b = place[:len(place) - step], place[step:]
        place = np.where(value[b] < value[a], b, a)
        span += step
    return place


class _Block:
    """Words, phrases and anchors of one block of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        self.n = len(offsets) - 1
        self.starts, self.ends, self.doc = word_spans(data, offsets)
        h = word_hashes(data, self.starts, self.ends)
        self.count = np.bincount(self.doc, minlength=self.n)
        self.first = np.cumsum(self.count) - self.count
        at = whole_grams(self.doc, window)  # words that begin a phrase
        self.at = at
        self.owner = self.doc[at]
        if len(at):
            gram = grams(h, ANCHOR, 3)
            place = _smallest(gram, window - ANCHOR + 1)[at]
            self.place, self.anchor = place, gram[place]
            self.phrase = grams(h, window, 5)[at]
        else:
            self.place, self.anchor, self.phrase = at, np.zeros(0, np.uint64), np.zeros(0, np.uint64)


def _anchors(window: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column("_text")):
                b = _Block(data, offsets, window)
                new = np.ones(len(b.at), dtype=bool)
                new[1:] = (b.place[1:] != b.place[:-1]) | (b.owner[1:] != b.owner[:-1])
                ids = batch.column("_id").slice(lo, hi - lo)
                hashes = batch.column("_hash").slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(b.owner[new])), hashes.take(pa.array(b.owner[new])),
                     pa.array(b.anchor[new].view(np.int64))], names=["_id", "_hash", "anchor"])
    return run


def _members(b: _Block, lists: pa.ListArray, values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether each value is in its own document's list."""
    out = np.zeros(len(values), dtype=bool)
    bounds = np.searchsorted(owner, np.arange(b.n + 1))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    size = np.array(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    end = np.cumsum(size)
    for d in np.flatnonzero((size > 0) & (np.diff(bounds) > 0)):
        i, j = bounds[d], bounds[d + 1]
        out[i:j] = np.isin(values[i:j], flat[end[d] - size[d]:end[d]])
    return out


def _repeated(b: _Block, unique: pa.ListArray) -> np.ndarray:
    """Phrases whose anchor occurs more than once in the corpus."""
    return np.flatnonzero(~_members(b, unique, b.anchor.view(np.int64), b.owner))


def _place(batch: pa.RecordBatch) -> np.ndarray:
    """The place of each row in the order of (id, text hash); equal ones share a place."""
    table = pa.table([batch.column("_id"), batch.column("_hash")], names=["_id", "_hash"])
    order = pc.sort_indices(table, sort_keys=[("_id", "ascending"), ("_hash", "ascending")])
    table = table.take(order)
    new = np.zeros(len(order), dtype=np.int64)
    if len(order) > 1:
        same = pc.and_(*[pc.equal(table.column(c).slice(1), table.column(c).slice(0, len(order) - 1))
                         for c in ("_id", "_hash")])
        new[1:] = ~np.array(same.to_numpy(), dtype=bool)
    out = np.zeros(len(order), dtype=np.int64)
    out[order.to_numpy()] = np.cumsum(new)
    return out


def _phrases(window: int):
    """Phrases with a repeated anchor, in runs that share it: a row has the run's first
    word and its phrase hashes in order. Of equal phrases a block sends the first one."""
    def run(batches):
        for batch in batches:
            place = _place(batch)
            for lo, hi, data, offsets in blocks(batch.column("_text")):
                b = _Block(data, offsets, window)
                at = _repeated(b, batch.column("unique").slice(lo, hi - lo))
                order = at[np.lexsort((at, place[lo:hi][b.owner[at]], b.phrase[at]))]
                again = np.zeros(len(order), dtype=bool)
                again[1:] = (b.phrase[order[1:]] == b.phrase[order[:-1]]) & (b.anchor[order[1:]] == b.anchor[order[:-1]])
                at = np.sort(order[~again])
                new = np.ones(len(at), dtype=bool)
                new[1:] = (b.place[at[1:]] != b.place[at[:-1]]) | (at[1:] != at[:-1] + 1) | \
                    (b.owner[at[1:]] != b.owner[at[:-1]])
                head = np.flatnonzero(new)
                first = at[head]
                owner = pa.array(b.owner[first])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo).take(owner),
                     batch.column("_hash").slice(lo, hi - lo).take(owner),
                     pa.array((b.at[first] - b.first[b.owner[first]]).astype(np.int32)),
                     pa.array(b.anchor[first].view(np.int64)),
                     ragged(b.phrase[at].view(np.int64), np.diff(np.append(head, len(at))), pa.int64())],
                    names=["_id", "_hash", "start", "anchor", "phrases"])
    return run


def parse(b: _Block, unique: pa.ListArray, first: pa.ListArray, window: int) -> tuple[np.ndarray, ...]:
    """Greedy factors of each document: owner, first word and word count."""
    at = _repeated(b, unique)
    owner = b.owner[at]
    start = b.at[at] - b.first[owner]
    copied = ~_members(b, first, start, owner)
    word, owner = b.at[at][copied], owner[copied]
    if not len(word):
        return word, word, word
    # a factor goes on while the next phrase begins before its end
    new = np.ones(len(word), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (word[1:] > word[:-1] + window)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(word)) - 1
    return owner[head], word[head] - b.first[owner[head]], word[tail] + window - word[head]


def _factors(window: int, with_text: bool, named: bool):
    def run(batches):
        for batch in batches:
            rest = [batch.column("_rest")] if "_rest" in batch.schema.names else []
            for lo, hi, data, offsets in blocks(batch.column("_text")):
                b = _Block(data, offsets, window)
                if named:
                    owner, start, length = parse(b, batch.column("unique").slice(lo, hi - lo),
                                                 batch.column("first").slice(lo, hi - lo), window)
                else:
                    owner = start = length = np.zeros(0, np.int64)
                size = np.bincount(owner, minlength=b.n)
                step = np.zeros(len(b.doc) + 1, dtype=np.int64)
                np.add.at(step, b.first[owner] + start, 1)
                np.add.at(step, b.first[owner] + start + length, -1)
                gone = np.cumsum(step) > 0
                removed = np.where(b.count > 0, np.add.reduceat(gone.astype(np.int64), b.first), 0)
                left, digest, raw = [], [], data.tobytes()
                for d in range(b.n):
                    whole = raw[offsets[d]:offsets[d + 1]]
                    i, j = b.first[d], b.first[d] + b.count[d]
                    keep = ~gone[i:j]
                    words = whole.split() if not size[d] else \
                        [raw[s:e] for s, e in zip(b.starts[i:j][keep], b.ends[i:j][keep])]
                    digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    if with_text:
                        left.append(_cut(whole, b.starts[i:j] - offsets[d], keep) if size[d] else whole)
                offs = np.zeros(b.n + 1, np.int32)
                np.cumsum(size, out=offs[1:])
                spans = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64))], ["start", "length"]))
                text = pa.nulls(b.n, pa.string())
                if with_text:
                    there = batch.column("_text").slice(lo, hi - lo).is_valid().to_pylist()
                    text = pa.array([x.decode() if t else None for x, t in zip(left, there)], pa.string())
                names = ["_id", "_hash", "n_words", "n_removed", "factors", "_left", "kept_sha256", "_rest"]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo), batch.column("_hash").slice(lo, hi - lo),
                     pa.array(b.count.astype(np.int64)),
                     pa.array(removed.astype(np.int64)), spans, text, pa.array(digest, pa.string()),
                     *(c.slice(lo, hi - lo) for c in rest)], names=names[:7 + len(rest)])
    return run


def _cut(whole: bytes, starts: np.ndarray, keep: np.ndarray) -> bytes:
    """The text without its dropped words; a kept run keeps its own separators."""
    turn = np.flatnonzero(np.diff(np.concatenate([[False], keep, [False]])))
    parts = [whole[(0 if s == 0 else starts[s]):(len(whole) if e == len(keep) else starts[e])]
             for s, e in zip(turn[::2], turn[1::2])]
    return b"".join(parts)


def parse_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20,
                    with_text: bool = True) -> DataFrame:
    """One row per input row: id, n_words, n_removed, factors (start and length
    in words), ``text_left`` (the text without its factors; null unless
    ``with_text``) and the digest of the kept words joined by one space."""
    return _parsed(docs, id_col, text_col, window, with_text).drop("_hash") \
        .withColumnsRenamed({"_id": id_col, "_left": "text_left"})


def _parsed(docs: DataFrame, id_col: str, text_col: str, window: int, with_text: bool,
            carried: Sequence[str] = ()) -> DataFrame:
    """The parse of each row; ``carried`` columns ride along in a struct ``_rest``, so the
    rows need not be joined to it again (what is left of a null text is null then)."""
    if window < ANCHOR:
        raise ValueError(f"window must have at least {ANCHOR} words")
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rest = [F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_rest")] if carried else []
    text = F.col(f"`{text_col}`") if carried else text_or_empty(text_col)
    pairs = docs.select(F.col(id_col).alias("_id"), text.alias("_text"),
                        F.xxhash64(text_or_empty(text_col)).alias("_hash"), *rest)
    named = pairs.where(F.col("_id").isNotNull())
    node = ["_id", "_hash"]
    unique = (named.select("_id", "_text", "_hash").mapInArrow(_anchors(window), f"_id {kind}, _hash bigint, anchor bigint")
              .groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("_id"),
                                     F.min("_hash").alias("_hash")).where("n = 1")
              .groupBy(*node).agg(F.collect_list("anchor").alias("unique")))
    known = named.join(unique, node, "left")
    # a run's phrases go to the task of their anchor together, which is where equal phrases meet
    first = (known.mapInArrow(_phrases(window), f"_id {kind}, _hash bigint, start int, anchor bigint, "
                              "phrases array<bigint>").repartition("anchor")
             .select("_id", "_hash", "start", "anchor", F.posexplode("phrases").alias("i", "phrase"))
             .select("_id", "_hash", (F.col("start") + F.col("i")).alias("start"), "anchor", "phrase")
             .groupBy("anchor", "phrase").agg(F.min(F.struct("_id", "_hash", "start")).alias("f"))
             .select("f.*").groupBy(*node).agg(F.collect_list(F.col("start").cast("long")).alias("first")))
    schema = StructType.fromDDL(f"_id {kind}, _hash bigint, n_words bigint, n_removed bigint, factors "
                                "array<struct<start:bigint,length:bigint>>, _left string, kept_sha256 string")
    if carried:
        schema = schema.add(StructField("_rest", StructType([docs.schema[c] for c in carried]), False))
    parsed = known.join(first, node, "left").mapInArrow(_factors(window, with_text, True), schema)
    nameless = pairs.where(F.col("_id").isNull()).mapInArrow(_factors(window, with_text, False), schema)
    return parsed.union(nameless)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """The input with its repeated spans cut out of the text (columns as they
    were, ``n_chars`` counted anew where there is one); a document of which
    nothing is left goes. Rows that share an id are each cut by their own text."""
    others = [c for c in docs.columns if c != text_col]
    parsed = _parsed(docs, id_col, text_col, window, True, others).where("n_removed = 0 OR n_removed < n_words")
    out = []
    for c in docs.columns:
        col = F.col("_left") if c == text_col else F.col("_rest").getField(c)
        if c == "n_chars":
            col = F.when(F.col("n_removed") > 0, F.length("_left").cast(docs.schema[c].dataType)).otherwise(col)
        out.append(col.alias(c))
    return parsed.select(*out)
