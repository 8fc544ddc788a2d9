"""Cost-balanced packing of tokenised documents into training sequences.

A document is its token ids and an end id. Pieces as long as a whole sequence
fill one each. The rest of every document goes to a pool; a pool is packed
when it holds ``POOL`` tokens (or its task ends): documents in descending
length, each to the sequence of lowest estimated cost (linear in tokens plus
quadratic in each piece, as attention does not cross documents) that has room
for all of it. A document that fits nowhere whole is cut at the roomiest
sequence's end. A pool's sequences hold exactly its tokens: as many full ones as
there are, then one for each power of two of the remainder, which need no
padding.

Each task packs its own partition, so there is no shuffle, and all pieces of a
document come from one task. Tokens are made word by word through a bounded
per-worker cache, as the tokenizer never joins across ASCII white space.

Defined results: null text counts as empty, a piece holding just the end id.
Rows are packed one by one, whatever ids they carry (null and repeated ids
too). Extra columns are ignored.
"""

from __future__ import annotations

import string
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import blocks, ragged, ship

CAPACITY = 2048
#: Tokens gathered before a pool is packed.
POOL = 1 << 20
#: Words a worker remembers.
CACHED_WORDS = 600_000
#: ASCII symbols and digits: none joins the letters before it.
SYMBOLS = string.punctuation + string.digits
#: Estimated cost of a token, and of a pair of tokens in one piece.
LINEAR, QUADRATIC = 1.0, 1.0 / 6144


class WordIds(dict):
    """Token ids of a word (white-space free bytes) as little-endian uint16."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.model = self.whole.model
        self.spell = {b: chr(b) for b in range(256)} | {b: chr(256 + i) for i, b in enumerate(
            b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))}

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        core = text.rstrip(SYMBOLS)
        # a Latin-1 letter run is one unit for the model: no need for the whole chain. What follows
        # it starts anew, and as neither case nor symbols change it, a run is worked out once
        if core.isalpha() and (core.isascii() or ord(max(core)) < 256 and unicodedata.is_normalized("NFC", core)):
            low = core.lower()
            if len(core) < len(text):
                out = self[low.encode()] + self[text[len(core):].encode()]
            elif low != core:
                out = self[low.encode()]
            else:
                spelled = low if low.isascii() else low.encode().decode("latin-1").translate(self.spell)
                ids = [t.id for t in self.model.tokenize(spelled)]
                out = struct.pack(f"<{len(ids)}H", *ids)
        else:
            ids = self.whole.encode(text, add_special_tokens=False).ids
            out = struct.pack(f"<{len(ids)}H", *ids)
        self[word] = out
        return out


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def capacities(tokens: int, capacity: int) -> np.ndarray:
    """Full sequences, then a power of two for each bit of the remainder."""
    rest = tokens % capacity
    small = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([capacity] * (tokens // capacity) + small, dtype=np.int64)


def balance(lengths: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one pool."""
    room = capacities(int(lengths.sum()), capacity)
    size = room.copy()
    cost = np.zeros(len(room))
    out = []
    for doc in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[doc])
        while left:
            fits = np.flatnonzero(room >= left)
            seq = fits[np.argmin(cost[fits])] if len(fits) else int(np.argmax(room))
            n = min(left, int(room[seq]))
            out.append((int(doc), start, n, int(seq), int(size[seq] - room[seq])))
            room[seq] -= n
            cost[seq] += LINEAR * n + QUADRATIC * n * n
            start, left = start + n, left - n
    return out


def _run(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        words = word_ids(path)
        next_id = TaskContext.get().partitionId() << 33
        end = np.array([end_id], dtype="<u2").tobytes()
        pool_id, pool, held = [], [], 0
        rows: list[tuple] = []
        names = ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

        def piece(ident, ids, skip, start, n, seq, offset):
            """skip: ids of the document before the first of ``ids``."""
            part = ids[start - skip:start - skip + n]
            rows.append((ident, start, n, zlib.crc32(part.astype("<u4").tobytes()), skip + len(ids), seq, offset,
                         part if with_ids else None))

        def pack_pool():
            nonlocal next_id, pool, pool_id, held
            lengths = np.array([len(ids) for _, ids in pool], dtype=np.int64)
            placed = balance(lengths, capacity)
            for doc, start, n, seq, offset in placed:
                skip, ids = pool[doc]
                piece(pool_id[doc], ids, skip, skip + start, n, next_id + seq, offset)
            next_id += len(capacities(int(lengths.sum()), capacity))
            pool, pool_id, held = [], [], 0

        def flush(kind):
            cols = list(zip(*rows))
            out = [pa.array([x.as_py() for x in cols[0]], kind)] + [pa.array(c, pa.int64()) for c in cols[1:7]]
            out.append(ragged(np.concatenate(cols[7]).astype(np.int32), np.array(cols[2]), pa.int32())
                       if with_ids else pa.nulls(len(rows), pa.list_(pa.int32())))
            rows.clear()
            return pa.RecordBatch.from_arrays(out, names=names)

        kind = None
        for batch in batches:
            idents = batch.column("_id")
            kind = idents.type
            for lo, hi, data, offsets in blocks(batch.column("_text")):
                raw = data.tobytes()
                for d in range(hi - lo):
                    joined = b"".join(map(words.__getitem__, raw[offsets[d]:offsets[d + 1]].split())) + end
                    ids = np.frombuffer(joined, dtype="<u2")
                    whole = len(ids) // capacity * capacity
                    for start in range(0, whole, capacity):
                        piece(idents[lo + d], ids, 0, start, capacity, next_id, 0)
                        next_id += 1
                    if whole < len(ids):
                        pool.append((whole, ids[whole:].copy()))
                        pool_id.append(idents[lo + d])
                        held += len(ids) - whole
                    if held >= POOL:
                        pack_pool()
                if len(words) > CACHED_WORDS:
                    words.clear()
                if len(rows) >= 4096:
                    yield flush(kind)
        if pool:
            pack_pool()
        if rows:
            yield flush(kind)
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and (``with_ids``) its ids. ``tokenizer`` is a file of the
    tokenizers library, readable on every executor."""
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    out = rows.mapInArrow(_run(tokenizer, capacity, end_id, with_ids),
                          f"_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                          "sequence_id bigint, offset bigint, ids array<int>").withColumnRenamed("_id", id_col)
    return out if with_ids else out.drop("ids")
