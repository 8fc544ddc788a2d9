"""Probabilistic suffix tree over the tokens of texts, scoring whole texts.

A text is its words and one end mark, after a start mark that is never
predicted. The context of a token is a suffix of what stands before it in the
text, up to ``depth`` tokens (the start mark counts as one), so a score depends
on the order of the words.

Learning counts (context, next token) over every training token, level by
level. A context is a candidate when it occurs ``least_count`` times in the
training texts, an absolute number, so what is kept on a small input is kept on
a larger one and the tree grows with the corpus. A candidate is retained when
its next-token distribution diverges from its parent's (the context without its
first token) by at least ``divergence`` nats; suffixes of a retained context
are retained too. Every token is scored by its longest retained suffix x with
P(w | x) = max(n(xw) - discount, 0) / n(x) + discount * kinds(x) / n(x) *
P(w | parent of x). The root does the same with the counts of single words and
gives its discounted mass to the spelling, so all texts share one unit of
probability.

The spelling is a suffix tree too, over the bytes of a word between a start and
an end mark. It is only what an unseen word falls back to, so it counts each
distinct training word once, as a new word would come. Its contexts of up to
``spelling_depth`` bytes are retained by the same absolute count and divergence,
and smoothed towards the parent's with weight ``smoothing``, the root's towards
the uniform one.

No state passes through the driver. Documents are first packed into blocks of
about ``BLOCK`` bytes (a longer document is a block of its own), whose texts are
kept as numbers of the block's own words. A block sends its distinct words and,
for each level, its distinct (context, token) pairs to be counted, one row of
squeezed arrays for each bucket of them, and gets the counts back in the order
it sent them: frequent words and pairs cost one entry per block, not one per
occurrence. Words and candidates get their numbers where they are counted (place
in the bucket times the number of buckets, plus the bucket), so pairs go by exact
numbers. A frequent context's pairs are dealt to several buckets. The spelling's
states are joined by context to the buckets of distinct words.

Defined results: null text is empty (one token, the end mark). Repeated rows
count as often as they occur. With nothing to train on, all counts are zero and
the model is uniform. A null id counts as the empty text for ``held_out``.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_view, discard, land, mix, ship, whole_grams, word_hashes

BLOCK = 8 << 20
START, WORD_END, TEXT_END = 0xFF, 0xFE, 0xFD  # bytes that UTF-8 never uses
SYMBOLS = 256
#: Bytes of distinct words counted together inside a task.
_BATCH_BYTES = 1 << 20
#: Distinct words spelled at once in a task.
_SPELLED_WORDS = 30_000
#: Entries of all blocks in a bucket, and from _BUCKETS buckets on.
_ENTRIES, _MOST_ENTRIES, _BUCKETS = 250_000, 2_000_000, 200
#: Bits of a word's hash that tell its bucket.
_PART_BITS = 14
#: A context's pairs go to one bucket more for each so many of its occurrences.
_SPREAD = 100_000
#: The start mark as a word (no word has a space); the end mark is the empty word.
_START_NAME = b" "
#: Hash of the empty word.
_EMPTY = np.uint64(0x9AE16A3B2F90404F)
#: Level numbers in what a block gets back: of its words' log10 probabilities, of retained contexts.
_LOGP, _RETAINED = 50, 100
#: In place of a block's number, on the rows that hold what a bucket counted.
_ALL = -1
_SENT = "block bigint, bucket bigint, data binary"
_BACK = "block bigint, level bigint, bucket bigint, data binary"


def crc_held_out(id_col: str, folds: int = 7, fold: int = 2) -> Column:
    """The rows left out of training: crc32 of the id as text modulo ``folds``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds, F.lit(0)) == fold


# -- squeezed arrays ----------------------------------------------------------------


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of floats, bytes and integers from 0 as bytes: the first bytes of all
    values, then the second ones, and so on, compressed."""
    head, body = [], []
    for a in arrays:
        kind = b"f" if a.dtype.kind == "f" else b"b" if a.dtype == np.uint8 else b"i"
        most = int(a.max()) if kind != b"f" and len(a) else 0
        width = 8 if kind == b"f" else next(w for w in (1, 2, 4, 8) if w == 8 or most < 1 << 8 * w)
        a = np.ascontiguousarray(a, dtype="<f8" if kind == b"f" else f"<u{width}")
        head.append(struct.pack("<cBQ", kind, width, len(a)))
        body.append(a.view(np.uint8).reshape(-1, width).T.tobytes())
    whole = b"".join(body)
    return (struct.pack("<BQ", len(arrays), len(whole)) + b"".join(head)
            + (pa.compress(whole, "zstd", asbytes=True) if whole else b""))


def _unsqueeze(data: bytes) -> list[np.ndarray]:
    """The arrays of ``_squeeze``: float64, uint8 or int64."""
    k, size = struct.unpack_from("<BQ", data)
    head = [struct.unpack_from("<cBQ", data, 9 + 10 * i) for i in range(k)]
    whole = np.frombuffer(pa.decompress(data[9 + 10 * k:], size, "zstd", asbytes=True), np.uint8) if size \
        else np.zeros(0, np.uint8)
    out, at = [], 0
    for kind, width, n in head:
        planes = whole[at:at + n * width].reshape(width, n)
        at += n * width
        a = np.ascontiguousarray(planes.T).view("<f8" if kind == b"f" else f"<u{width}").reshape(-1)
        out.append(a.astype(np.int64) if kind == b"i" else a)
    return out


def _rows(block, level, bucket, data) -> pa.Table:
    """Rows of what blocks get back."""
    n = len(data)
    full = lambda x: pa.array(np.full(n, x, dtype=np.int64) if np.isscalar(x) else x, pa.int64())
    return pa.table([full(block), full(level), full(bucket), pa.array(data, pa.binary())],
                    names=["block", "level", "bucket", "data"])


def _words(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _buckets(entries: int) -> int:
    return 1 + max(min(entries // _ENTRIES, _BUCKETS), entries // _MOST_ENTRIES)


# -- blocks -------------------------------------------------------------------------


def _parts(words: pa.Array) -> np.ndarray:
    """The first bits of each word's hash."""
    data, offsets = byte_view(words)
    some = np.flatnonzero(np.diff(offsets))
    h = np.full(len(words), _EMPTY, dtype=np.uint64)
    h[some] = word_hashes(data, offsets[some], offsets[some + 1])
    return (h >> np.uint64(64 - _PART_BITS)).astype(np.int64)


def _number(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One block: ids and folds of its texts; their sizes, tokens by number of the block's words
    (the most frequent first) and these words' parts; the words by part with their training counts."""
    table = pa.Table.from_batches(rows).combine_chunks()
    data, offsets = byte_view(table.column("_text"))
    raw = data.tobytes().lower()  # of bytes: A-Z only
    number: dict[bytes, int] = {}
    size, token = np.zeros(table.num_rows, dtype=np.int64), []
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        text = [_START_NAME, *raw[a:b].split(), b""]
        size[i] = len(text) - 1
        token.append(np.fromiter([number.setdefault(w, len(number)) for w in text], np.int32, len(text)))
    token = np.concatenate(token)
    words = pa.array(list(number), pa.binary())
    order = np.argsort(-np.bincount(token), kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    token, words = rank[token], words.take(pa.array(order))
    part = _parts(words)
    sent = np.argsort(part, kind="stable")
    train = np.repeat(np.logical_not(table.column("_held_out").to_numpy()), size + 1)
    n = np.bincount(token[train], minlength=len(order))
    sink = pa.BufferOutputStream()
    table = table.select(["_id", "_held_out"])
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    text, ends = byte_view(words.take(pa.array(sent)))
    return pa.RecordBatch.from_arrays(
        [pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([len(order)], pa.int64()),
         pa.array([len(token)], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
         pa.array([_squeeze(size, token, part)], pa.binary()),
         pa.array([_squeeze(np.diff(ends), text, n[sent])], pa.binary())],
        names=["block", "n_words", "n_tokens", "rows", "tokens", "words"])


def _pack(batches):
    """Rows into blocks of whole documents."""
    rows, size = [], 0
    for batch in batches:
        at, n = 0, batch.num_rows
        offsets = byte_view(batch.column("_text"))[1]
        while at < n:
            to = int(np.searchsorted(offsets, offsets[at] + BLOCK - size, side="right")) - 1
            to = min(max(to, at + (not rows)), n)
            if to > at:
                rows.append(batch.slice(at, to - at))
                size += int(offsets[to] - offsets[at])
            if to < n:
                yield _number(rows)
                rows, size = [], 0
            at = to
    if rows:
        yield _number(rows)


# -- words --------------------------------------------------------------------------


def _send_words(n_buckets: int):
    """A block's words with their training counts, a row for each bucket (a range of parts)."""
    def run(batches):
        for batch in batches:
            for block, squeezed in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist()):
                lengths, data, n = _unsqueeze(squeezed)
                words = _words(lengths, data)
                ends = byte_view(words)[1]
                bucket = _parts(words) * n_buckets >> _PART_BITS
                edge = np.searchsorted(bucket, np.arange(n_buckets + 1))
                some = np.flatnonzero(np.diff(edge))
                out = [_squeeze(lengths[a:b], data[ends[a]:ends[b]], n[a:b])
                       for a, b in zip(edge[some], edge[some + 1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), block)), pa.array(some.astype(np.int64)), pa.array(out, pa.binary())],
                    names=["block", "bucket", "data"])
    return run


def _count_words(table: pa.Table) -> pa.Table:
    """For each block the counts and places of its words in a bucket, and the bucket's
    distinct words with their counts, the most frequent first."""
    parts = list(map(_unsqueeze, table.column("data").to_pylist()))
    lengths, data, n = (np.concatenate(x) for x in zip(*parts))
    coded = _words(lengths, data).dictionary_encode()
    code = coded.indices.to_numpy()
    c = np.bincount(code, weights=n).astype(np.int64)
    order = np.argsort(-c, kind="stable")
    place = np.empty(len(c), dtype=np.int64)
    place[order] = np.arange(len(c))
    text, ends = byte_view(coded.dictionary.take(pa.array(order)))
    cut = np.cumsum([0, *(len(p[0]) for p in parts)])
    out = [_squeeze(c[x], place[x]) for x in (code[a:b] for a, b in zip(cut[:-1], cut[1:]))]
    out.append(_squeeze(np.diff(ends), text, c[order]))
    predicted = np.array([w != _START_NAME for w in coded.dictionary.to_pylist()])
    back = _rows(np.append(table.column("block").to_numpy(), _ALL), 0, table.column("bucket")[0].as_py(), out)
    zeros = np.zeros(len(out), dtype=np.int64)
    total, kinds = zeros.copy(), zeros
    total[-1], kinds[-1] = c[predicted].sum(), (c[predicted] > 0).sum()
    return back.append_column("total", pa.array(total)).append_column("kinds", pa.array(kinds))


def _known_words(batches):
    """The words seen in training, out of the buckets' own rows."""
    for batch in batches:
        for squeezed in batch.column("data").to_pylist():
            lengths, data, c = _unsqueeze(squeezed)
            words = _words(lengths, data)
            known = words.filter(pa.array(c > 0))
            for a in range(0, len(known), _SPELLED_WORDS):
                part = known.slice(a, _SPELLED_WORDS)
                part = part.filter(pa.array([w != _START_NAME for w in part.to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.cast(pa.string())], names=["word"])


# -- the spelling -------------------------------------------------------------------


def _spelled(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marked bytes of all words in a row, each symbol's depth in its word, its word."""
    length = np.diff(offsets)
    n = len(length)
    size = np.where(length > 0, length + 2, 2)
    begin = np.cumsum(size) - size
    out = np.full(int(size.sum()), WORD_END, dtype=np.uint8)
    out[begin] = START
    out[begin[length == 0] + 1] = TEXT_END
    place = np.arange(len(out)) - np.repeat(begin, size)
    owner = np.repeat(np.arange(n), size)
    inner = (place > 0) & (place <= length[owner])
    out[inner] = data
    return out, place, owner


def _codes(symbols: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
    """Context plus symbol as one number, for all places with ``depth`` bytes of context."""
    at = np.flatnonzero(place >= max(depth, 1))
    code = np.full(len(at), depth + 1, dtype=np.int64) << 8 * (depth + 1)
    for back in range(depth, -1, -1):
        code |= symbols[at - back].astype(np.int64) << 8 * back
    return code


def _count_contexts(depth: int):
    def run(batches):
        held, size = [], 0

        def flush():
            words = pa.concat_arrays([b.column("word") for b in held])
            symbols, place, _ = _spelled(*byte_view(words))
            for d in range(depth + 1):
                code = np.sort(_codes(symbols, place, d))
                if not len(code):
                    continue  # no word is this long
                first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                n = np.diff(np.append(first, len(code)))
                yield pa.RecordBatch.from_arrays([pa.array(code[first]), pa.array(n)], names=["code", "n"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.column("word").nbytes
            if size >= _BATCH_BYTES:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
    return run


def _depth_of(code: Column, depth: int) -> Column:
    """Context length of a code (its leading number tells)."""
    out = F.lit(depth)
    for d in range(depth - 1, -1, -1):
        out = F.when(code < F.lit((d + 2) << 8 * (d + 1)).cast("long"), F.lit(d)).otherwise(out)
    return out


def _bytes(depth: Column) -> Column:
    """256 to the power of ``depth``."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (depth * 8).cast("int"))


def _key(context: Column, depth: Column) -> Column:
    """The context as a number that also tells its length."""
    return context + _bytes(depth)


class Tree:
    """Retained contexts by depth, with smoothed log10 distributions."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, totals: np.ndarray, depth: int, smoothing: float):
        """codes: context and symbol (leading number: depth + 1) of retained contexts; counts of
        both together, totals of the context. It may be any part of a tree that holds with a
        code its shorter ones."""
        self.states, self.entries = [], []
        for d in range(depth + 1):
            low = (d + 1) << 8 * (d + 1)
            mine = (codes >= low) & (codes < low + (1 << 8 * (d + 1)))
            order = np.argsort(codes[mine])
            code, n = codes[mine][order] - low, counts[mine][order].astype(float)
            context, at, inverse = np.unique(code >> 8, return_index=True, return_inverse=True)
            total = totals[mine][order][at].astype(float)
            backoff = smoothing / (total + smoothing)
            if d == 0:
                below = np.full(len(code), 1.0 / SYMBOLS)
            else:
                below = 10.0 ** self._of(d - 1, code & ((1 << 8 * d) - 1))
            prob = (n + smoothing * below) / (total[inverse] + smoothing)
            self.states.append((context, np.log10(backoff)))
            self.entries.append((code, np.log10(prob)))

    def _of(self, d: int, code: np.ndarray) -> np.ndarray:
        known, value = self.entries[d]
        return value[np.searchsorted(known, code)]

    def score(self, words: pa.Array) -> np.ndarray:
        """log10 probability of each word (the empty one: the end of the text)."""
        symbols, place, owner = _spelled(*byte_view(words))
        total = np.zeros(len(words))
        todo = np.flatnonzero(place > 0)
        value = np.zeros(len(symbols))
        for d in range(len(self.states) - 1, -1, -1):
            if not len(todo):
                break
            at = todo[place[todo] >= d]
            code = np.zeros(len(at), dtype=np.int64)
            for back in range(d, -1, -1):
                code |= symbols[at - back].astype(np.int64) << 8 * back
            context, backoff = self.states[d]
            if not len(context):
                continue
            s = np.minimum(np.searchsorted(context, code >> 8), len(context) - 1)
            state = context[s] == code >> 8
            at, code, s = at[state], code[state], s[state]
            known, logp = self.entries[d]
            e = np.minimum(np.searchsorted(known, code), len(known) - 1)
            seen = known[e] == code
            value[at[seen]] += logp[e[seen]]
            value[at[~seen]] += backoff[s[~seen]]
            left = np.ones(len(symbols), dtype=bool)
            left[at[seen]] = False
            todo = todo[left[todo]]
        value[todo] -= np.log10(SYMBOLS)
        return np.bincount(owner, weights=value, minlength=len(words)) + total


def contexts(words: DataFrame, depth: int = 4, least_mass: float = 0.0, divergence: float = 0.01,
             least_count: int = 4) -> DataFrame:
    """The spelling of a frame of distinct words (column ``word``): code, n, key and total of every
    (context, symbol) of the retained contexts. ``least_mass`` may ask for a share of all places too."""
    if depth > 6:
        raise ValueError("a context and its symbol must fit in 56 bits")
    landed = land(words.select("word").mapInArrow(_count_contexts(depth), "code bigint, n bigint")
                 .groupBy("code").agg(F.sum("n").alias("n")), "pst-contexts")
    code = F.col("code")
    d = _depth_of(code, depth)
    body = code - (d + 1) * _bytes(d + 1)
    grams = landed.withColumn("d", d).withColumn("symbol", body.bitwiseAND(F.lit(255))) \
        .withColumn("context", F.shiftright(body, 8)) \
        .withColumn("key", _key(F.col("context"), F.col("d")))
    places = grams.where("d = 0").agg(F.sum("n")).first()[0] or 0
    totals = grams.groupBy("key", "d", "context").agg(F.sum("n").alias("total")) \
        .where((F.col("d") == 0) | (F.col("total") >= max(least_mass * places, least_count)))
    candidate = land(grams.join(totals.select("key", "total"), "key"), "pst-candidates")
    tail = F.col("context").bitwiseAND(_bytes(F.col("d") - 1) - 1)
    child = candidate.where("d > 0").withColumn("parent", _key(tail, F.col("d") - 1))
    parent = candidate.select(F.col("key").alias("parent"), "symbol", F.col("n").alias("pn"),
                              F.col("total").alias("ptotal"))
    gain = F.col("n") / F.col("total") * F.log((F.col("n") / F.col("total")) / (F.col("pn") / F.col("ptotal")))
    kept = (child.join(parent, ["parent", "symbol"]).groupBy("key", "d", "context").agg(F.sum(gain).alias("kl"))
            .where(F.col("kl") >= divergence))
    suffixes = F.transform(F.sequence(F.lit(0), F.col("d")), lambda k: F.col("context").bitwiseAND(
        _bytes(k) - 1) + _bytes(k))
    closed = kept.select(F.explode(suffixes).alias("key")).distinct() \
        .union(candidate.where("d = 0").select("key").distinct()).distinct()
    found = land(candidate.join(closed, "key", "left_semi").select("code", "n", "key", "total"), "pst-spelling")
    discard(candidate)
    discard(landed)
    return found


def learn(words: DataFrame, depth: int = 4, least_mass: float = 0.0, divergence: float = 0.01,
          smoothing: float = 2.0, least_count: int = 1) -> Tree:
    """The whole spelling tree of a small frame of distinct words, on the driver."""
    found = contexts(words, depth, least_mass, divergence, least_count).toArrow()
    return Tree(*(found.column(c).to_numpy() for c in ("code", "n", "total")), depth, smoothing)


def _wanted_codes(depth: int, n_parts: int):
    """The codes of a bucket's words, out of its own row, a row for each part of the contexts."""
    def run(batches):
        for batch in batches:
            for bucket, squeezed in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist()):
                lengths, data, _ = _unsqueeze(squeezed)
                words, found = _words(lengths, data), [[] for _ in range(depth + 1)]
                for a in range(0, len(words), _SPELLED_WORDS):
                    symbols, place, _ = _spelled(*byte_view(words.slice(a, _SPELLED_WORDS)))
                    for d in range(depth + 1):
                        found[d].append(np.unique(_codes(symbols, place, d)))
                code = np.concatenate([np.unique(np.concatenate(x)) for x in found])
                part = (code >> 8) % n_parts
                code = code[np.argsort(part, kind="stable")]
                some, n = np.unique(part, return_counts=True)
                out = [_squeeze(np.diff(x, prepend=0)) for x in np.split(code, np.cumsum(n)[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), bucket, dtype=np.int64)), pa.array(some), pa.array(out, pa.binary())],
                    names=["bucket", "part", "data"])
    return run


def _give_states(left: pa.Table, right: pa.Table) -> pa.Table:
    """The wanted codes whose contexts are retained, with their counts and the contexts'."""
    code, n, total = (right.column(c).to_numpy() for c in ("code", "n", "total"))
    order = np.argsort(code)
    code, n, total = code[order], n[order], total[order]
    context, first = np.unique(code >> 8, return_index=True)
    out = []
    for squeezed in left.column("data").to_pylist() if len(code) else []:
        wanted = np.cumsum(_unsqueeze(squeezed)[0])
        at = np.minimum(np.searchsorted(context, wanted >> 8), len(context) - 1)
        some = context[at] == wanted >> 8
        wanted, at = wanted[some], first[at[some]]
        exact = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
        out.append(_squeeze(np.diff(wanted, prepend=0), np.where(code[exact] == wanted, n[exact], 0), total[at]))
    return pa.table({"bucket": left.column("bucket").slice(0, len(out)), "data": pa.array(out, pa.binary())})


def _spell(depth: int, smoothing: float, discount: float, n_all: int, spread: float):
    """For each block the log10 probabilities of its words in a bucket."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block, data = left.column("block").to_numpy(), left.column("data").to_pylist()
        states = [(np.cumsum(code), n, total) for code, n, total in map(_unsqueeze, right.column("data").to_pylist())]
        tree = Tree(*(map(np.concatenate, zip(*states)) if states else np.zeros((3, 0), np.int64)), depth, smoothing)
        own = int(np.flatnonzero(block == _ALL)[0])
        lengths, text, c = _unsqueeze(data[own])
        words = _words(lengths, text)
        spelled = np.concatenate([tree.score(words.slice(a, _SPELLED_WORDS))
                                  for a in range(0, len(words), _SPELLED_WORDS)])
        with np.errstate(invalid="ignore", divide="ignore"):  # where a word is not known
            logp = np.where(c > 0, np.log10((c - discount) / max(n_all, 1) + spread * 10.0 ** spelled),
                            np.log10(spread) + spelled)
        out, bucket = [], left.column("bucket")[0].as_py()
        for i, squeezed in enumerate(data):
            if i != own:
                out.append(_squeeze(logp[_unsqueeze(squeezed)[1]]))
        return _rows(np.delete(block, own), _LOGP, bucket, out)
    return run


def spell(counts: DataFrame, states: DataFrame, n_buckets: int, depth: int, run) -> DataFrame:
    """What ``run`` makes of each bucket of ``counts`` and the states of its words' contexts."""
    n_parts = n_buckets | 1
    wanted = counts.where(F.col("block") == _ALL).select("bucket", "data") \
        .mapInArrow(_wanted_codes(depth, n_parts), "bucket bigint, part bigint, data binary")
    part = (F.shiftright("code", 8) % n_parts).alias("part")
    got = wanted.groupBy("part").cogroup(states.select(part, "code", "n", "total").groupBy("part")) \
        .applyInArrow(_give_states, "bucket bigint, data binary")
    return counts.groupBy("bucket").cogroup(got.groupBy("bucket")).applyInArrow(run, _BACK)


# -- the tree -------------------------------------------------------------------------


class _Block:
    """Tokens of one block's texts in a row, with the counts that came back for them.

    Words and contexts have numbers of the block's own, in the order of those they
    were given where they were counted."""

    def __init__(self, tokens: bytes, back: pa.Table, levels: int, n_buckets: tuple[int, int], least_count: int):
        """levels: those of pairs that came back. n_buckets: of words, of pairs."""
        self.back, self.n_buckets, self.least_count = back, n_buckets[1], least_count
        self.level, self.bucket = back.column("level").to_numpy(), back.column("bucket").to_numpy()
        self.size, token, part = _unsqueeze(tokens)
        self.doc = np.repeat(np.arange(len(self.size)), self.size + 1)
        c, given = self.returned(0, n_buckets[0])
        self.order = np.argsort(given)
        rank = np.empty(len(given), dtype=np.int64)
        rank[self.order] = np.arange(len(given))
        number = np.empty(len(given), dtype=np.int64)
        number[np.argsort(part, kind="stable")] = rank
        self.token, self.given, self.c = number[token], given[self.order], c[self.order]
        self.counts = {1: self.c[self.token]}
        #: By length: each place's context, the contexts' given numbers, counts, and their own numbers as sent.
        self.contexts = {1: (np.where(self.counts[1] >= least_count, self.token, -1), self.given, self.c,
                             rank[np.flatnonzero(c >= least_count)])}
        for d in range(1, levels + 1):
            self.learn(d)

    def returned(self, level: int, n_buckets: int = 1) -> list[np.ndarray]:
        """What came back on this level, in the order of what was sent. Places in one of
        ``n_buckets`` come second, as numbers that tell the bucket too."""
        mine = np.flatnonzero(self.level == level)
        mine = mine[np.argsort(self.bucket[mine])]
        parts = list(map(_unsqueeze, self.back.column("data").take(pa.array(mine)).to_pylist()))
        if n_buckets > 1:
            parts = [[n, *(place * n_buckets + bucket for place in places)]
                     for (n, *places), bucket in zip(parts, self.bucket[mine])]
        return [np.concatenate(x) for x in zip(*parts)]

    def pairs(self, d: int):
        """Places of (context of d tokens, token) whose context is a candidate, the distinct
        pairs there, each one's first place, the pair of each place, and the pairs' buckets."""
        context, given, total, _ = self.contexts[d]
        at = whole_grams(self.doc, d + 1)
        at = at[context[at] >= 0]
        key, first, pair = np.unique(context[at] * len(self.given) + self.token[at + d],
                                     return_index=True, return_inverse=True)
        context, word = np.divmod(key, len(self.given))
        spread = (1 + total[context] // _SPREAD).astype(np.uint64)
        bucket = (mix(given[context].astype(np.uint64)) + mix(self.given[word].astype(np.uint64)) % spread) \
            % np.uint64(self.n_buckets)
        return at, context, word, at[first], pair, bucket.astype(np.int64)

    def learn(self, d: int) -> None:
        """Take in the counts of the pairs of contexts of d tokens."""
        at, _, _, _, pair, bucket = self.pairs(d)
        order = np.argsort(bucket, kind="stable")
        sent, *given = self.returned(d, self.n_buckets) if len(order) else [np.zeros(0, np.int64)] * 2
        n = np.zeros(len(order), dtype=np.int64)
        n[order] = sent
        count, place = np.zeros(len(self.token), dtype=np.int64), np.full(len(self.token), -1)
        count[at] = n[pair]
        self.counts[d + 1] = count
        if not given:  # the last level
            return
        given = given[0]
        candidate = np.flatnonzero(sent >= self.least_count)
        rank = np.empty(len(given), dtype=np.int64)
        rank[np.argsort(given)] = np.arange(len(given))
        own, total = np.full(len(order), -1), np.zeros(len(given), dtype=np.int64)
        own[order[candidate]] = rank
        total[rank] = sent[candidate]
        place[at] = own[pair]
        self.contexts[d + 1] = place, np.sort(given), total, rank

    def kinds(self, d: int) -> np.ndarray:
        """By context of d tokens how many tokens follow it; 0 where it is not retained."""
        out = np.zeros(len(self.contexts[d][1]), dtype=np.int64)
        if (self.level == _RETAINED + d).any():
            out[self.contexts[d][3]] = self.returned(_RETAINED + d)[0]
        return out


def _pairs(d: int, n_all: int, n_buckets: tuple[int, int], least_count: int):
    """A block's distinct (context of d tokens, token) with their training counts, a row for each
    bucket. Each context comes with its parent, the parent's count, and the sum of n log(token's
    count after the parent)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for block, rows, tokens in zip(*(left.column(c).to_pylist() for c in ("block", "rows", "tokens"))):
            b = _Block(tokens, right, d - 1, n_buckets, least_count)
            at, context, word, first, pair, bucket = b.pairs(d)
            train = np.logical_not(_folds(rows).column("_held_out").to_numpy())
            n = np.bincount(pair, weights=train[b.doc[at]], minlength=len(context)).astype(np.int64)
            part = n * np.log(np.maximum(b.counts[d][first + 1], 1))
            if not len(at):
                continue
            order = np.argsort(bucket, kind="stable")
            bucket, context, n, part, first = bucket[order], context[order], n[order], part[order], first[order]
            given = b.given[word[order]]
            run_at = np.flatnonzero(np.append(True, (np.diff(bucket) != 0) | (np.diff(context) != 0)))
            if d > 1:
                place, numbers, total, _ = b.contexts[d - 1]
                parent = place[first[run_at] + 1]
                parent, above = numbers[parent], total[parent]
            else:
                parent, above = np.zeros(len(run_at), np.int64), np.full(len(run_at), max(n_all, 1))
            length = np.diff(np.append(run_at, len(order)))
            part, number = np.add.reduceat(part, run_at), b.contexts[d][1][context[run_at]]
            some = np.unique(bucket)
            lo, hi = np.searchsorted(bucket, some), np.searchsorted(bucket, some, side="right")
            data = [_squeeze(np.diff(number[x:y], prepend=0), length[x:y], parent[x:y], above[x:y], part[x:y],
                             given[a:z], n[a:z])
                    for a, z, x, y in zip(lo, hi, np.searchsorted(run_at, lo), np.searchsorted(run_at, hi))]
            out.append(_rows(block, d, some, data).drop_columns("level"))
        return pa.concat_tables(out) if out else _rows(0, d, 0, []).drop_columns("level")
    return run


def _folds(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def _count_pairs(d: int, last: bool, least_count: int):
    """For each block the counts of its pairs in a bucket and, but for the last level, the places
    of those that are candidates, and the bucket's share of its contexts' counts."""
    def run(table: pa.Table) -> pa.Table:
        parts = []
        for squeezed in table.column("data").to_pylist():
            p = _unsqueeze(squeezed)
            parts.append([np.cumsum(p[0]), *p[1:]])
        context, length, parent, above, part, word, n = (np.concatenate(x) for x in zip(*parts))
        known, first, own = np.unique(context, return_index=True, return_inverse=True)
        wide = int(word.max()) + 1
        key, pair = np.unique(np.repeat(own, length) * wide + word, return_inverse=True)
        total = np.bincount(pair, weights=n).astype(np.int64)
        candidate = np.flatnonzero(total >= least_count)
        bucket = table.column("bucket")[0].as_py()
        place = np.zeros(len(key), dtype=np.int64)
        place[candidate[np.argsort(-total[candidate], kind="stable")]] = np.arange(len(candidate))
        cut, out = np.cumsum([0, *(len(p[5]) for p in parts)]), []
        for a, b in zip(cut[:-1], cut[1:]):
            mine = total[pair[a:b]]
            out.append(_squeeze(mine) if last else _squeeze(mine, place[pair[a:b]][mine >= least_count]))
        share = lambda of, x: np.bincount(of, weights=x, minlength=len(known))
        of = key // wide
        out.append(_squeeze(known, parent[first], above[first], share(of, total).astype(np.int64),
                            share(of, total > 0).astype(np.int64),
                            share(of, total * np.log(np.maximum(total, 1))) - share(own, part)))
        return _rows(np.append(table.column("block").to_numpy(), _ALL), d, bucket, out)
    return run


def _shares(batches):
    """The buckets' shares of contexts as rows."""
    for batch in batches:
        for squeezed in batch.column("data").to_pylist():
            yield pa.RecordBatch.from_arrays(list(map(pa.array, _unsqueeze(squeezed))),
                                             names=["context", "parent", "above", "total", "kinds", "gain"])


def _retained(d: int, n_buckets: int, least_count: int):
    """For each block how many tokens follow its candidates of a bucket; 0 where one is not retained."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known, kinds = (right.column(c).to_numpy() for c in ("context", "kinds"))
        order = np.argsort(known)
        known, kinds, out = known[order] // n_buckets, kinds[order], []
        for squeezed in left.column("data").to_pylist():
            n, place = _unsqueeze(squeezed)
            place = place[n >= least_count] if d == 1 else place
            got = np.zeros(len(place), dtype=np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, place), len(known) - 1)
                got = np.where(known[at] == place, kinds[at], 0)
            out.append(_squeeze(got))
        return _rows(left.column("block").to_numpy(), _RETAINED + d, left.column("bucket").to_numpy(), out)
    return run


def _score_block(n_all: int, n_distinct: int, depth: int, discount: float, n_buckets: tuple[int, int], least_count: int,
                 id_type: pa.DataType):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for rows, tokens in zip(left.column("rows").to_pylist(), left.column("tokens").to_pylist()):
            b = _Block(tokens, right, depth, n_buckets, least_count)
            base = np.log10((b.c + 1) / (n_all + n_distinct + 1))
            logp = b.returned(_LOGP)[0][b.order][b.token]
            for d in range(1, depth + 1):
                at = whole_grams(b.doc, d + 1)
                at = at[b.contexts[d][0][at] >= 0]
                kinds = b.kinds(d)[b.contexts[d][0][at]]
                at, kinds = at[kinds > 0], kinds[kinds > 0]
                total, n, below = b.counts[d][at], b.counts[d + 1][at], logp[at + d]
                spread = discount * kinds / total
                # also where 10 ** below is too small for a float
                logp[at + d] = np.where(n > 0, np.log10(np.maximum(n - discount, 1e-300) / total
                                                        + spread * 10.0 ** below), np.log10(spread) + below)
            seen = np.flatnonzero(np.append(False, b.doc[1:] == b.doc[:-1]))  # all but the start marks
            doc, m = b.doc[seen], len(b.size)
            token = b.token[seen]
            per_text = lambda x: np.bincount(doc, weights=x, minlength=m)
            folds = _folds(rows)
            out.append(pa.table({
                "_id": folds.column("_id").cast(id_type), "held_out": folds.column("_held_out"),
                "n_tokens": pa.array(b.size), "n_known": pa.array(per_text(b.c[token] > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(m, n_all, np.int64)),
                "base_score": pa.array(per_text(base[token])), "score": pa.array(per_text(logp[seen]))}))
        return pa.concat_tables(out)
    return run


def _release(spark) -> None:
    """Spark deletes the shuffle files of finished steps when the driver's heap is collected."""
    spark.sparkContext._jvm.java.lang.System.gc()


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    held_out: Column | None = None, discount: float = 0.75, depth: int = 2, least_count: int = 4,
                    divergence: float = 0.01, spelling_depth: int = 4, smoothing: float = 2.0) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams) and score (the suffix tree). Rows for which
    ``held_out`` is true are not learnt from."""
    spark = ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    held = crc_held_out(id_col) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_col).alias("_id"), held.alias("_held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    read = land(rows.mapInArrow(_pack, "block bigint, n_words bigint, n_tokens bigint, rows binary, "
                                         "tokens binary, words binary"), "pst-read")
    n_words, n_tokens = (n or 0 for n in read.agg(F.sum("n_words"), F.sum("n_tokens")).first())
    n_buckets = n_word_buckets, n_pair_buckets = min(_buckets(n_words), 1 << _PART_BITS), _buckets(n_tokens)
    own = F.col("block") == _ALL
    counts = land(read.select("block", "words").mapInArrow(_send_words(n_word_buckets), _SENT)
                  .groupBy("bucket").applyInArrow(_count_words, _BACK + ", total bigint, kinds bigint"), "pst-words")
    n_all, n_distinct = (int(n or 0) for n in counts.agg(F.sum("total"), F.sum("kinds")).first())
    known = land(counts.where(own).select("data").mapInArrow(_known_words, "word string"), "pst-known")
    states = contexts(known, spelling_depth, 0.0, divergence, least_count)
    discard(known)
    _release(spark)
    spread = discount * n_distinct / n_all if n_all else 1.0
    root = land(spell(counts.select("block", "bucket", "data"), states, n_word_buckets, spelling_depth,
                      _spell(spelling_depth, smoothing, discount, n_all, spread)), "pst-root")
    discard(states)
    _release(spark)
    blocks = land(read.select("block", "rows", "tokens"), "pst-blocks")
    discard(read)
    levels = {0: counts.where(~own).drop("total", "kinds")}
    found = {}
    for d in range(1, depth + 1):
        back = levels[0]
        for k in range(1, d):
            back = back.union(levels[k])
        level = land(blocks.groupBy("block").cogroup(back.groupBy("block"))
                     .applyInArrow(_pairs(d, n_all, n_buckets, least_count), _SENT)
                     .groupBy("bucket").applyInArrow(_count_pairs(d, d == depth, least_count), _BACK),
                     f"pst-level-{d}")
        levels[d] = level.where(~own)
        # each occurrence of a context in training has one next token, so its pairs add up to its count
        shares = level.where(own).select("data").mapInArrow(
            _shares, "context bigint, parent bigint, above bigint, total bigint, kinds bigint, gain double") \
            .groupBy("context", "parent", "above").agg(
                F.sum("gain").alias("gain"), F.sum("total").alias("total"), F.sum("kinds").alias("kinds"))
        diverges = F.col("gain") / F.col("total") - F.log("total") + F.log("above") >= divergence
        found[d] = land(shares.where("total > 0").select("context", "parent", "kinds", diverges.alias("diverges")),
                        f"pst-contexts-{d}")
        _release(spark)
    back, kept = root, None
    for d in range(depth, 0, -1):
        retained = found[d].where("diverges")
        if kept is not None:  # suffixes of what is retained
            longer = kept.select(F.col("parent").alias("context")).distinct()
            retained = retained.unionByName(
                found[d].where("not diverges").join(longer, "context", "left_semi"))
        kept = retained
        n = n_word_buckets if d == 1 else n_pair_buckets
        told = kept.select((F.col("context") % n).alias("bucket"), "context", "kinds")
        back = back.union(levels[d - 1].groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(
            _retained(d, n, least_count), _BACK)).union(levels[d - 1])
    back = back.union(levels[depth])
    from pyspark.sql.pandas.types import to_arrow_type

    schema = (f"_id {kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double")
    return blocks.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        _score_block(n_all, n_distinct, depth, discount, n_buckets, least_count, to_arrow_type(kind)),
        schema).withColumnRenamed("_id", id_col)
