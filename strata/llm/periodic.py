"""Periodic run detection by a sparse diagonal dynamic programme over words.

A diagonal is a lag q; its match length grows by one with every word that
equals the word q before it, and ends at the first that does not. A word counts
up the diagonals of its earlier occurrences, but only those that a run can
stand on: a run is at least ``times`` periods long, so a whole context of s words
before its end, with q <= s < 2q, repeats at lag q, and q is the lag to that
context's **latest** earlier occurrence (were a nearer one there, the run would
have a shorter period). So for each power of two s every word has one active
lag, that of the latest earlier occurrence of the s words from it on, and a
word that stands a thousand times costs no more than a rare one: n log n steps
where all earlier occurrences would be n^2.

Going along a text, a diagonal is active while successive words name the same
lag; when it ends with enough words it emits its run at once. Contexts of 2s
words are made from two repeated ones of s words, so few positions are left
after the first steps. Texts are worked on in blocks of whole documents inside
Arrow tasks, without a shuffle; a document's cost is its own length.

Defined results: a null text has no words and no runs; null ids and repeated
ids are rows like any other, each judged by its own text; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import blocks, mix, ship, text_or_empty, word_hashes, word_spans

WORD = r"[^\x20\x09-\x0D]+"
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def runs_of(words: np.ndarray, doc: np.ndarray, times: int = 4, least: int = 6) -> tuple[np.ndarray, ...]:
    """Document, first word (in the block), length and smallest period of every
    maximal run of at least ``max(least, times * period)`` words; ``words`` are
    equal numbers for equal words, ``doc`` ascends. Sorted by first word, period."""
    if times < 3:
        raise ValueError("a run must hold at least three periods")
    n = len(words)
    count = np.bincount(doc, minlength=1) if n else np.zeros(1, np.int64)
    end = np.cumsum(count)[doc] if n else np.zeros(0, np.int64)  # first place after the document
    own = mix(doc.astype(np.uint64) + np.uint64(1))
    found = []
    at, gram, s = np.arange(n), words.astype(np.uint64) ^ own, 1
    while len(at):
        lag, again = _latest(gram)
        lag = np.where(lag >= 0, at - at[lag], 0)
        lag[~((lag > s // 2) & (lag <= s))] = 0
        found += _ended(at, lag, doc, s, times, least)
        # the next contexts: two repeated ones side by side, in documents that can hold such a run
        at, gram = at[again], gram[again]
        right = np.searchsorted(at, at + s)
        both = np.flatnonzero(right < len(at))
        both = both[at[right[both]] == at[both] + s]
        both = both[(at[both] + 2 * s <= end[at[both]]) & (count[doc[at[both]]] >= max(least, times * (s + 1)))]
        gram = mix(mix(gram[both]) + np.uint64(3) * gram[right[both]])
        at, s = at[both], 2 * s
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return doc[start[order]], start[order], length[order], period[order]


def _latest(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the latest earlier equal entry (-1: none), and whether an equal one is anywhere."""
    order = np.argsort(gram, kind="stable")
    same = gram[order[1:]] == gram[order[:-1]]
    before = np.full(len(gram), -1, dtype=np.int64)
    before[order[1:][same]] = order[:-1][same]
    again = np.zeros(len(gram), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return before, again


def _ended(at: np.ndarray, lag: np.ndarray, doc: np.ndarray, s: int, times: int, least: int) -> list:
    """Runs of the diagonals of contexts of ``s`` words: stretches of one lag."""
    on = np.flatnonzero(lag)
    if not len(on):
        return []
    place, q = at[on], lag[on]
    new = np.ones(len(on), dtype=bool)
    new[1:] = (place[1:] != place[:-1] + 1) | (q[1:] != q[:-1]) | (doc[place[1:]] != doc[place[:-1]])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(on)) - 1
    q = q[head]
    length = place[tail] - place[head] + s + q
    good = length >= np.maximum(least, times * q)
    return [(place[head][good] - q[good], length[good], q[good])] if good.any() else []


def _find(times: int, least: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column("_text")):
                starts, ends, doc = word_spans(data, offsets)
                count = np.bincount(doc, minlength=hi - lo)
                first = np.cumsum(count) - count
                owner, start, length, period = runs_of(word_hashes(data, starts, ends), doc, times, least)
                step = np.zeros(len(doc) + 1, dtype=np.int64)
                np.add.at(step, start + period, 1)
                np.add.at(step, start + length, -1)
                keep = np.cumsum(step)[:-1] == 0
                number, raw, left = np.bincount(owner, minlength=hi - lo), data.tobytes(), []
                for d in range(hi - lo):
                    i, j = first[d], first[d] + count[d]
                    left.append(b" ".join(
                        raw[offsets[d]:offsets[d + 1]].split() if not number[d] else
                        [raw[s:e] for s, e in zip(starts[i:j][keep[i:j]], ends[i:j][keep[i:j]])]))
                runs = pa.StructArray.from_arrays([pa.array(x) for x in (start - first[owner], length, period)],
                                                  ["start", "length", "period"])
                offs = pa.array(np.concatenate([[0], np.cumsum(number)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo), pa.array(count.astype(np.int64)),
                     pa.ListArray.from_arrays(offs, runs),
                     pa.array(left, pa.binary()).cast(pa.string(), safe=False)],
                    names=["_id", "n_words", "runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text", times: int = 4,
              least: int = 6) -> DataFrame:
    """One row per input row: id, n_words, ``runs`` (start, length and smallest
    period in words, by start and period) and ``collapsed``: the words, joined by
    one space, without those that a run holds after its first period."""
    ship(docs.sparkSession)
    text = text_or_empty(text_col) if isinstance(text_col, str) else F.coalesce(text_col, F.lit(""))
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("_text"))
            .mapInArrow(_find(times, least), f"_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
            .withColumnRenamed("_id", id_col))


def tail_repeated(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text, in one document of ten with its tail turned into a repetition.

    With h the CRC-32 of the id's decimal text and g = floor(h / 10): where h
    ends in 0, the words from a = g mod n on become the first p of them over and
    over, p = 1 + floor((n - a) / (3 + g mod 8)). Other texts, and those of null
    ids, stay."""
    g = F.floor(F.crc32(F.col(id_col).cast("string")) / 10).cast("long")
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))
    s = F.struct(words.alias("w"), F.size(words).cast("long").alias("n"))

    def rewritten(x: Column) -> Column:
        a = F.pmod(g, x["n"])
        p = F.lit(1) + F.floor((x["n"] - a) / (F.lit(3) + g % 8)).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), x["n"] - 1),
                                        lambda i: F.get(x["w"], place(i))), " ")

    chosen = F.crc32(F.col(id_col).cast("string")) % 10 == 0
    has_word = F.col(text_col).rlike(WORD)
    return F.when(chosen & has_word, F.get(F.transform(F.array(s), rewritten), F.lit(0))).otherwise(F.col(text_col))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the run of greatest length / period and digests of ``find_runs``.

    Fractions are compared by cross products; the first of equal ones stays,
    so ties go to the smallest start, then period."""
    best = F.aggregate(
        "runs", F.get(F.col("runs"), F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    row = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                             r["period"].cast("string"), F.lit("\n"))
    return (found.withColumn("_best", best)
            .select(id_col, F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
                    F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
                    F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform("runs", row), ""), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")))
