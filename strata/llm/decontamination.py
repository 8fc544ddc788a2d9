"""Benchmark decontamination with suffix arrays over shards of training text.

Training documents are worked on in shards of whole documents (a few MB each,
inside Arrow tasks). A shard's words, with an end mark after every document,
get a suffix array by prefix doubling, as deep as the longest test item. Every
suffix of every test item is then binary-searched in it: the neighbours of its
place give its longest verbatim match, and two more searches the interval of
all places that begin with its window. A window is ``window`` consecutive words
of an item (a shorter item is one window); every training word inside an
occurrence is hit, and documents with a hit word are removed.

Common prefixes in the search are found by bisection over prefix sums of word
hashes, so one comparison costs log(item length) and not the length. Words are
64-bit hashes throughout. No end mark equals another word, so no match runs
over the end of a document or an item.

The test side is cut into pieces of at most ``PIECE`` words that overlap by a
window, and pieces are dealt into blocks of about ``BLOCK_WORDS`` words. One
block at a time goes to the driver and is broadcast (at most about 8 bytes a
word); each further block is one more pass, chained behind the one before in
the same task, so that memory stays bounded and no training text is shuffled.

Defined results: null texts and texts without a word have no words, no windows
and no hits; test rows that share an id are one item with the windows of all;
a null item id is reported as the empty text; repeated training rows and null
document ids are judged row by row; extra columns are ignored (``remove`` keeps
them). An empty test table hits nothing, an empty training table is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import blocks, discard, land, lower_az, mix, ship, text_or_empty, word_hashes, word_spans

PIECE = 1 << 16
BLOCK_WORDS = 1 << 22

#: Bytes that part words: all of ASCII but digits and (lower-cased) letters.
_PART = np.zeros(256, dtype=bool)
_PART[:128] = True
_PART[48:58] = False
_PART[97:123] = False

_B = np.uint64(0x9E3779B97F4A7C15)
_B_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of every word of a block of texts."""
    data = lower_az(data)
    starts, ends, doc = word_spans(data, offsets, _PART)
    return word_hashes(data, starts, ends), doc


class _Sums:
    """Hashes of word stretches from prefix sums: the sum of word j times B^j."""

    def __init__(self, value: np.ndarray):
        up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(value), _B)]))
        self.down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(value), _B_INV)]))
        self.sum = np.concatenate([[np.uint64(0)], np.cumsum(value * up[:-1], dtype=np.uint64)])
        self.n = len(value)

    def of(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sum[np.minimum(at + length, self.n)] - self.sum[at]) * self.down[at]


class Items:
    """A block of test pieces: their words, and the window that starts at each word."""

    def __init__(self, item: np.ndarray, offset: np.ndarray, whole: np.ndarray, hashes: list[np.ndarray], window: int):
        size = np.array([len(h) for h in hashes], dtype=np.int64)
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.item = np.repeat(item, size)
        first = np.repeat(np.cumsum(size) - size, size)
        place = np.arange(len(self.words))
        self.start = np.repeat(offset, size) + place - first  # in the item
        self.left = first + np.repeat(size, size) - place
        short = (np.repeat(whole, size)) & (np.repeat(size, size) < window)
        self.window = np.where(self.left >= window, window, np.where(short & (place == first), self.left, 0))
        self.sums = _Sums(mix(self.words))
        self.longest = int(self.left.max(initial=0))


class Shard:
    """Suffix array of a block of documents, ``depth`` words deep."""

    def __init__(self, words: np.ndarray, doc: np.ndarray, n_docs: int, depth: int):
        self.n_docs, self.n = n_docs, len(words) + n_docs
        self.known, rank = np.unique(words, return_inverse=True)
        count = np.bincount(doc, minlength=n_docs)
        self.first = np.cumsum(count) - count + np.arange(n_docs)  # of each document, end marks counted
        at = np.arange(len(words)) + doc
        self.code = np.empty(self.n, dtype=np.int64)
        self.code[at] = n_docs + rank
        ends = self.first + count
        self.code[ends] = np.arange(n_docs)
        value = np.empty(self.n, dtype=np.uint64)
        value[at] = mix(words)
        value[ends] = mix(np.arange(n_docs, dtype=np.uint64) ^ np.uint64(0xD6E8FEB86659FD93))
        self.sums = _Sums(value)
        self.order = self._sorted(depth)
        self.heads = self.code[self.order]

    def _sorted(self, depth: int) -> np.ndarray:
        order = np.argsort(self.code)
        rank, slot, key, reach = np.empty(self.n, np.int64), np.arange(self.n), self.code[order], 1
        while True:
            new = np.ones(len(slot), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            rank[order[slot]] = np.maximum.accumulate(np.where(new, slot, 0))
            tied = ~new
            tied[:-1] |= ~new[1:]
            slot = slot[tied]  # tied suffixes stand together and change places only there
            if not len(slot) or reach >= depth:
                return order
            some = order[slot]
            key = rank[some] * np.int64(self.n + 1) + rank[some + reach]
            by = np.argsort(key)
            order[slot], key, reach = some[by], key[by], 2 * reach

    def common(self, items: Items, i: np.ndarray, at: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that item suffixes ``i`` and shard suffixes ``at`` have in common, up to ``most``."""
        low, high = np.zeros(len(i), np.int64), np.minimum(most, self.n - at)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = items.sums.of(i, middle) == self.sums.of(at, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def bound(self, items: Items, i, code, most, low, high, after: bool) -> np.ndarray:
        """First slot whose suffix does not stand before (``after``: stands after) the first ``most`` words of ``i``."""
        low, high = low.copy(), high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            k, m = i[open_], most[open_]
            middle = (low[open_] + high[open_]) >> 1
            at = self.order[middle]
            n = self.common(items, k, at, m)
            equal = n == m
            rest = np.where(equal, 0, n)
            before = np.where(equal, after, 2 * self.code[at + rest] + 1 < code[k + rest])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        return low

    def search(self, items: Items):
        """(item words, longest match, its place) of every item suffix whose first word
        the shard has, and (item words, first slot, end slot) of the windows that occur."""
        empty = np.zeros(0, np.int64)
        if not len(items.words) or not len(self.known):
            return (empty,) * 3, (empty,) * 3
        near = np.minimum(np.searchsorted(self.known, items.words), len(self.known) - 1)
        here = self.known[near] == items.words
        # odd: the shard's own words; an absent word stands just before the next larger one
        place = np.searchsorted(self.known, items.words)
        code = 2 * (self.n_docs + place) + here
        i = np.flatnonzero(here)
        low = np.searchsorted(self.heads, self.n_docs + near[i], side="left")
        high = np.searchsorted(self.heads, self.n_docs + near[i], side="right")
        slot = self.bound(items, i, code, items.left[i], low, high, False)
        length, where = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for side in (slot - 1, slot):
            ok = np.flatnonzero((side >= low) & (side < high))
            n = self.common(items, i[ok], self.order[side[ok]], items.left[i[ok]])
            more = n > length[ok]
            length[ok[more]], where[ok[more]] = n[more], self.order[side[ok[more]]]
        w = items.window[i]
        hit = np.flatnonzero((w > 0) & (length >= w))
        k = i[hit]
        a = self.bound(items, k, code, w[hit], low[hit], high[hit], False)
        b = self.bound(items, k, code, w[hit], a, high[hit], True)
        return (i, length, where), (k, a, b)


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the range and every slot of it."""
    size = high - low
    owner = np.repeat(np.arange(len(low)), size)
    return owner, np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + low[owner]


def hits(shard: Shard, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each place of the shard is hit, and the distinct (document, item) pairs."""
    _, (k, a, b) = shard.search(items)
    mask = np.zeros(shard.n, dtype=bool)
    if not len(k):
        return mask, k, k
    # equal windows of several items share one interval
    keys, group = np.unique(np.stack([a, b, items.window[k]]), axis=1, return_inverse=True)
    group = group.reshape(-1)
    owner, slot = _expand(keys[0], keys[1])
    at = shard.order[slot]
    step = np.zeros(shard.n + 1, dtype=np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + keys[2][owner], -1)
    mask = np.cumsum(step)[:-1] > 0
    doc = np.searchsorted(shard.first, at, side="right") - 1
    in_doc = np.unique(np.stack([owner, doc]), axis=1)
    of_item = np.unique(np.stack([group, items.item[k]]), axis=1)
    low = np.searchsorted(of_item[0], in_doc[0], side="left")
    high = np.searchsorted(of_item[0], in_doc[0], side="right")
    row, place = _expand(low, high)
    pairs = np.unique(np.stack([in_doc[1][row], of_item[1][place]]), axis=1)
    return mask, pairs[0], pairs[1]


# -- the test side ----------------------------------------------------------------


def _pieces(window: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column("_text")):
                words, doc = words_of(data, offsets)
                names = batch.column("item").slice(lo, hi - lo).to_pylist()
                ends = np.searchsorted(doc, np.arange(hi - lo), side="right")
                out = []
                for d, name in enumerate(names):
                    own = words[(ends[d - 1] if d else 0):ends[d]]
                    for s in range(0, len(own), PIECE - window + 1):
                        if s and len(own) - s < window:
                            break
                        out.append((name, s, len(own) <= PIECE, len(own[s:s + PIECE]), own[s:s + PIECE].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.bool_(), pa.int64(),
                                                                    pa.binary()))],
                        names=["item", "offset", "whole", "n", "hashes"])
    return run


def _test_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int):
    """Broadcasts of the test pieces, about ``BLOCK_WORDS`` words each."""
    spark = ship(benchmark.sparkSession)
    pieces = land(benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"),
                                   text_or_empty(text_col).alias("_text"))
                  .mapInArrow(_pieces(window), "item string, offset bigint, whole boolean, n bigint, hashes binary"),
                  "decontamination-pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    n = -(-total // BLOCK_WORDS)
    out = []
    for b in range(n):
        some = pieces.where(F.pmod(F.xxhash64("item", "offset", "hashes"), F.lit(n)) == b).toArrow()
        out.append(spark.sparkContext.broadcast(some.to_pydict()))
    discard(pieces)
    return out


def _load(value: dict, window: int) -> tuple[list[str], Items]:
    names = sorted(set(value["item"]))
    number = {x: i for i, x in enumerate(names)}
    return names, Items(np.array([number[x] for x in value["item"]], dtype=np.int64),
                        np.array(value["offset"], dtype=np.int64), np.array(value["whole"], dtype=bool),
                        [np.frombuffer(h, dtype=np.uint64) for h in value["hashes"]], window)


# -- passes over the training text -------------------------------------------------

_SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64())])


def _pass(block, window: int):
    """Adds one block's hits to the spans and items that earlier passes found."""
    def run(batches):
        names, items = _load(block.value, window) if block is not None else ([], None)
        for batch in batches:
            rest = [batch.column(c) for c in batch.schema.names if c not in ("n_words", "spans", "items")]
            kept = [c for c in batch.schema.names if c not in ("n_words", "spans", "items")]
            counts, spans, found = [], [], []
            old_spans, old_items = batch.column("spans"), batch.column("items")
            for lo, hi, data, offsets in blocks(batch.column("_text")):
                words, doc = words_of(data, offsets)
                count = np.bincount(doc, minlength=hi - lo)
                counts += count.tolist()
                mine = [x or [] for x in old_items.slice(lo, hi - lo).to_pylist()]
                before = [x or [] for x in old_spans.slice(lo, hi - lo).to_pylist()]
                if items is not None and len(words):
                    shard = Shard(words, doc, hi - lo, items.longest)
                    mask, d, i = hits(shard, items)
                    for x, y in zip(d.tolist(), i.tolist()):
                        mine[x].append(names[y])
                    for x in np.unique(d).tolist():
                        own = mask[shard.first[x]:shard.first[x] + count[x]].copy()
                        for s in before[x]:
                            own[s["start"]:s["start"] + s["length"]] = True
                        turn = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                        before[x] = [{"start": int(s), "length": int(e - s)} for s, e in zip(turn[::2], turn[1::2])]
                spans += before
                found += [sorted(set(x)) for x in mine]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(counts, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(found, pa.list_(pa.string()))],
                names=[*kept, "n_words", "spans", "items"])
    return run


def _judged(rows: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``rows`` (with a column ``_text``) and n_words, spans, items."""
    rows = rows.withColumns({"n_words": F.lit(0).cast("long"),
                             "spans": F.array().cast("array<struct<start:bigint,length:bigint>>"),
                             "items": F.array().cast("array<string>")})
    for block in _test_blocks(benchmark, item_col, text_col, window) or [None]:
        rows = rows.mapInArrow(_pass(block, window), rows.schema)
    return rows


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per training row: id, n_words, ``spans`` (start and length, in
    words, of every stretch of hit words), ``items`` (ids of the items with an
    occurring window, as texts, sorted) and contaminated."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(text_col).alias("_text"))
    out = _judged(rows, benchmark, item_col, item_text, window).drop("_text")
    return out.withColumn("contaminated", F.size("spans") > 0).withColumnRenamed("_id", id_col)


def remove(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The training rows, with all their columns, that hold no window of any item."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       text_or_empty(text_col).alias("_text"))
    clean = _judged(rows, benchmark, item_col, item_text, window).where(F.size("spans") == 0)
    return clean.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """Per item suffix that any training text holds the first word of: item,
    item_start, length of its longest verbatim match, and one place of it
    (training id, start; of several, the smallest). All in words."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(text_col).alias("_text"))

    def search(block):
        def run(batches):
            names, items = _load(block.value, window)
            for batch in batches:
                for lo, hi, data, offsets in blocks(batch.column("_text")):
                    words, doc = words_of(data, offsets)
                    shard = Shard(words, doc, hi - lo, items.longest)
                    (i, length, at), _ = shard.search(items)
                    d = np.searchsorted(shard.first, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[x] for x in items.item[i]], pa.string()), pa.array(items.start[i]),
                         pa.array(length), batch.column("_id").slice(lo, hi - lo).take(pa.array(d)),
                         pa.array(at - shard.first[d])], names=["item", "item_start", "length", "_id", "start"])
        return run

    out = None
    for block in _test_blocks(benchmark, item_col, item_text, window):
        some = rows.mapInArrow(search(block), f"item string, item_start bigint, length bigint, _id {kind}, start bigint")
        out = some if out is None else out.union(some)
    if out is None:
        return docs.sparkSession.createDataFrame(
            [], f"item string, item_start bigint, length bigint, {id_col} {kind}, start bigint")
    best = F.min(F.struct((-F.col("length")).alias("n"), "_id", "start")).alias("b")
    return out.groupBy("item", "item_start").agg(best).select(
        "item", "item_start", (-F.col("b.n")).alias("length"), F.col("b._id").alias(id_col), F.col("b.start").alias("start"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and a digest of ``contaminated``."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select(id_col, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
