"""Byte-level BPE in DuckDB, inside Spark tasks: encoding and decoding.

Each task keeps one small DuckDB. Its texts are split into pre-tokens, and the
distinct new ones become token-position rows. A recursive query joins
neighbouring positions with the merge table, picks each word's leftmost pair of
minimum rank and contracts it, until no pair is left. A recursion is stopped
after ``STEPS`` contractions, so what it keeps stays small; words that are not
done go on from their state in the next one. Decoding joins (document,
position, id) rows with the vocabulary and joins the bytes in position order.

A per-worker cache of bounded size keeps the ids of pieces, so a worker runs
the recursion once for a piece. Pieces longer than ``LONG`` bytes (no such
pre-token occurs in prose) would need as many recursions as they have bytes;
they are contracted by the same rule with a heap.

Defined results: null text counts as empty, no ids. Any text is encoded whole;
ids decode to exactly its bytes. Rows are handled one by one (repeated or null
ids too); extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import blocks, ragged, ship

STEPS = 48
LONG = 400
#: Words in one recursion, tokens in one decoding query, pieces a worker remembers.
WORDS, TOKENS, CACHED = 30_000, 1_000_000, 300_000

_CONTRACT = """
WITH RECURSIVE state(step, word, toks) AS (
  SELECT 0::INT, word, toks FROM start
  UNION ALL
  SELECT step + 1, word, toks[:place - 1] || [made] || toks[place + 2:] FROM (
    SELECT step, word, toks, (best & 4294967295)::INT AS place, (best >> 32)::INT AS made
    FROM state JOIN (
      SELECT word, min((rank::BIGINT << 32) | pos) AS best FROM (
        SELECT word, unnest(range(1, len(toks))) AS pos, unnest(toks[:-2]) AS a, unnest(toks[2:]) AS b
        FROM state WHERE step < {steps}) AS pairs
      JOIN merges ON pair = (a::BIGINT << 20) | b GROUP BY word) AS lowest USING (word)))
SELECT step, word, toks FROM state"""

# the subquery's order is the order in which one thread aggregates
_DECODE = """
SELECT doc, sha256(unhex(string_agg(hex, ''))) AS digest
FROM (SELECT doc, hex FROM ids JOIN vocab USING (id) ORDER BY doc, pos) GROUP BY doc"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec(dict):
    """Ids of pieces (as little-endian uint32 bytes), filled by DuckDB."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        rows = [(a << 20 | b, rank) for token, rank in self.ranks.items() for i in range(1, len(token))
                if (a := self.ranks.get(token[:i])) is not None and (b := self.ranks.get(token[i:])) is not None]
        pair, rank = np.array(rows, dtype=np.int64).reshape(-1, 2).T
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        merges = pa.table({"pair": pair, "rank": rank.astype(np.int32)})
        vocab = pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()),
                          "hex": [t.hex() for t in self.ranks]})
        for name, table in (("merges", merges), ("vocab", vocab)):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    # -- encoding

    def learn(self, pieces: list[str]) -> None:
        """Make every piece of the list known."""
        parts = [self._pretokens(p) for p in pieces]
        words = list({w: None for part in parts for w in part if w not in self})
        for lo in range(0, len(words), WORDS):
            self._contract(words[lo:lo + WORDS])
        for piece, part in zip(pieces, parts):
            if len(part) > 1:
                self[piece] = b"".join(map(self.__getitem__, part))

    def _pretokens(self, piece: str) -> list[str]:
        core = piece[1:] if piece[0] == " " else piece
        if core.isalpha():  # with its space, one run of letters
            return [piece]
        if piece[-1] in ".," and core[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return self.split(piece)

    def _contract(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        whole = list(map(self.ranks.get, raw))  # a word that is a token is that token
        for word, b, rank in zip(words, raw, whole):
            if rank is not None:
                self[word] = rank.to_bytes(4, "little")
            elif len(b) > LONG:
                self[word] = np.array(self._heap(b), dtype="<u4").tobytes()
        at = np.array([i for i, rank in enumerate(whole) if rank is None and len(raw[i]) <= LONG], dtype=np.int32)
        size = np.array([len(raw[i]) for i in at], dtype=np.int64)
        tok = self.byte_id[np.frombuffer(b"".join([raw[i] for i in at]), dtype=np.uint8)]
        while len(at):
            self.db.register("start", pa.table({"word": at, "toks": ragged(tok, size, pa.int32())}))
            out = self.db.sql(_CONTRACT.format(steps=STEPS)).to_arrow_table().combine_chunks()
            self.db.unregister("start")
            word, step = out.column("word").to_numpy(), out.column("step").to_numpy()
            last = np.lexsort((step, word))
            last = last[np.append(word[last][1:] != word[last][:-1], True)]
            lists = out.column("toks").chunk(0).take(pa.array(last))
            size = lists.value_lengths().to_numpy().astype(np.int64)
            tok = lists.flatten().to_numpy().astype(np.int32)
            at, done = word[last], step[last] < STEPS
            end = np.cumsum(size) * 4
            made = tok.astype("<u4").tobytes()
            for w, i, j in zip(at[done].tolist(), (end - size * 4)[done].tolist(), end[done].tolist()):
                self[words[w]] = made[i:j]
            tok = tok[np.repeat(~done, size)]
            at, size = at[~done], size[~done]

    def _heap(self, word: bytes) -> list[int]:
        ranks, n = self.ranks, len(word)
        part = [word[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[word[i:i + 2]], i, 1, 1) for i in range(n - 1) if word[i:i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or len(part[i]) != a or j >= n or len(part[j]) != b:
                continue
            part[i], part[j] = part[i] + part[j], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if x >= 0 and y < n and (rank := ranks.get(part[x] + part[y])) is not None:
                    heapq.heappush(heap, (rank, x, len(part[x]), len(part[y])))
        return [ranks[p] for p in part if p is not None]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self) > CACHED:  # what the next texts use comes back from the older half
            self.older = dict(self)
            self.clear()
        split = [pieces(t) for t in texts]
        found = [list(map(self.get, part)) for part in split]
        gaps = [[i for i, ids in enumerate(row) if ids is None] for row in found]
        new = []
        for piece in {part[i] for part, gap in zip(split, gaps) for i in gap}:
            known = self.older.get(piece)
            if known is None:
                new.append(piece)
            else:
                self[piece] = known
        self.learn(new)
        for part, row, gap in zip(split, found, gaps):
            for i in gap:
                row[i] = self[part[i]]
        return [b"".join(row) for row in found]

    # -- decoding

    def digests(self, ids: np.ndarray, size: np.ndarray) -> list[str]:
        """sha256 of the decoded bytes of each id list."""
        out = [hashlib.sha256(b"").hexdigest()] * len(size)
        end = np.cumsum(size)
        lo = 0
        while lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(end, end[lo] - size[lo] + TOKENS, side="right")))
            mine, some = size[lo:hi], ids[end[lo] - size[lo]:end[hi - 1]]
            first = np.cumsum(mine) - mine
            rows = pa.table({"doc": np.repeat(np.arange(lo, hi, dtype=np.int32), mine), "id": some.astype(np.int32),
                             "pos": (np.arange(len(some)) - np.repeat(first, mine)).astype(np.int32)})
            self.db.register("ids", rows)
            for doc, digest in self.db.sql(_DECODE).fetchall():
                out[doc] = digest
            self.db.unregister("ids")
            lo = hi
        return out


#: Between two pieces; a text that holds this mark goes the longer way.
_MARK = chr(0xE000)
_CUT = re.compile(r"(?<=\S)(?= \S)")


def pieces(text: str) -> list[str]:
    """The text in pieces whose pre-tokens can be found piece by piece: a single
    space or line feed between two other characters always begins a pre-token."""
    words = text.split()
    gaps = text.count(" ") + text.count("\n")
    if len(words) == gaps + 1 and sum(map(len, words)) + gaps == len(text) and _MARK not in text:
        return text.replace(" ", _MARK + " ").replace("\n", _MARK + "\n" + _MARK).split(_MARK)
    # white space in runs, at the ends or of other kinds: cut only at single spaces between other characters
    return _CUT.split(text) if text else []


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _run(path: str, pattern: str, with_ids: bool):
    def run(batches):
        coder = codec(path, pattern)
        for batch in batches:
            for lo, hi, _, _ in blocks(batch.column("_text")):
                raw = coder.encode(batch.column("_text").slice(lo, hi - lo).to_pylist())
                size = np.array([len(r) // 4 for r in raw], dtype=np.int64)
                ids = np.frombuffer(b"".join(raw), dtype="<u4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo), pa.array(size),
                     pa.array([hashlib.sha256(r).hexdigest() for r in raw]), pa.array(coder.digests(ids, size)),
                     ragged(ids.astype(np.int32), size, pa.int32()) if with_ids
                     else pa.nulls(hi - lo, pa.list_(pa.int32()))],
                    names=["_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])
    return run


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """One row per input row: id, n_tokens, digests of the ids and of the bytes
    they decode to, and (``with_ids``) the ids. ``ranks`` is a tiktoken file
    readable on every executor, ``pattern`` its pre-token pattern."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    out = rows.mapInArrow(_run(ranks, pattern, with_ids), f"_id {kind}, n_tokens bigint, ids_sha256 string, "
                          "decoded_sha256 string, ids array<int>").withColumnRenamed("_id", id_col)
    return out if with_ids else out.drop("ids")
