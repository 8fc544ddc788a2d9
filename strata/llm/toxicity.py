"""Toxicity severity by cumulative-link ordinal regression on sparse words.

Features are the distinct lower-cased words of a text (letters, digits and
bytes beyond ASCII), hashed into ``2 ** BITS`` places: weights are shared by
all thresholds, and P(grade <= k) = sigmoid(threshold_k - w . x) with ordered
thresholds. The expected severity is the sum over k of P(grade > k).

x gives each word the same value, not diluted by the text's length: severe
words add up, however long the text around them is. Training is proximal
gradient descent with an L1 penalty, which leaves the weight of ordinary words
at zero, over a bounded sample of labelled rows (``sample`` rows, the smallest
hashes of the id; a row is its word places, no text moves), in one task; the model that scoring reads is at most
``2 ** BITS`` weights. Scoring covers every row and whole texts.

Defined results: null text has no words and the severity of an empty text. Rows
without a grade are not learnt from. With no graded rows every severity is 0.
Extra columns are ignored; repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import blocks, lower_az, ragged, ship, text_or_empty, word_hashes, word_spans

BITS = 20
_OTHER = np.ones(256, dtype=bool)
_OTHER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of each text's distinct words, sorted, and how many there are."""
    data = lower_az(data)
    starts, ends, doc = word_spans(data, offsets, _OTHER)
    n = len(offsets) - 1
    place = (word_hashes(data, starts, ends) >> np.uint64(64 - BITS)).astype(np.int64)
    both = np.unique(doc << BITS | place)
    return both & ((1 << BITS) - 1), np.bincount(both >> BITS, minlength=n)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit(place: np.ndarray, size: np.ndarray, grade: np.ndarray, grades: int, rounds: int = 200,
        penalty: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places with weight, weights, thresholds) by proximal gradient steps with
    momentum. Each feature's step is the inverse of a bound on its curvature.
    After ``rounds`` the chosen features go on under a twentieth of the penalty,
    so that what it shrank grows back."""
    n, every = len(size), np.arange(len(size))
    used, column = np.unique(place, return_inverse=True)
    row = np.repeat(every, size)
    above = np.array([(grade > k).mean() for k in range(grades - 1)]).clip(1e-4, 1 - 1e-4)
    cut = np.maximum.accumulate(-np.log(above / (1 - above)) + np.arange(grades - 1) * 1e-6)
    threshold = penalty * n

    def passed(z):
        p = sigmoid(cut[None, :] - z[:, None])  # P(grade <= k)
        return np.concatenate([np.zeros((n, 1)), p, np.ones((n, 1))], axis=1)

    def slope(full, column, row, width):
        # d log P(grade = g) / dz = F(g) + F(g - 1) - 1 for the logistic link
        error = full[every, grade + 1] + full[every, grade] - 1.0
        return np.bincount(column, weights=error[row], minlength=width)

    # features whose slope at zero is far below the penalty stay at zero
    live = np.abs(slope(passed(np.zeros(n)), column, row, len(used))) >= 0.5 * threshold
    number = np.cumsum(live) - 1
    row, column, used = row[live[column]], number[column[live[column]]], used[live]
    w = y = np.zeros(len(used))
    scale = 4.0 / np.maximum(np.bincount(column, weights=np.bincount(row, minlength=n)[row], minlength=len(used)), 1)
    momentum = 1.0
    for turn in range(2 * rounds):
        if turn == rounds:
            live = w != 0
            number = np.cumsum(live) - 1
            row, column = row[live[column]], number[column[live[column]]]
            used, w, y, scale = used[live], w[live], w[live], scale[live]
            momentum, threshold = 1.0, threshold / 20
        full = passed(np.bincount(row, weights=y[column], minlength=n))
        step = y + scale * slope(full, column, row, len(used))
        new = np.sign(step) * np.maximum(np.abs(step) - scale * threshold, 0.0)
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        y = new + (momentum - 1) / following * (new - w)
        w, momentum = new, following
        inside = np.maximum(full[every, grade + 1] - full[every, grade], 1e-12)
        for k in range(grades - 1):  # a damped Newton step on each threshold
            spread = full[:, k + 1] * (1 - full[:, k + 1])
            pull = ((grade == k) * spread / inside - (grade == k + 1) * spread / inside).sum()
            cut[k] += np.clip(pull / max(spread.sum(), 1e-6), -0.5, 0.5) * 0.5
        cut = np.maximum.accumulate(cut + np.arange(grades - 1) * 1e-6)
    return used[w != 0], w[w != 0], cut


def severe(place: np.ndarray, size: np.ndarray, grade: np.ndarray, options: dict) -> np.ndarray:
    """Three grades from labels that know two: a toxic row is severe when it
    holds more words of positive weight (of the two-grade fit) than the median
    toxic row does."""
    used, w, _ = fit(place, size, grade, 2, **options)
    bad = np.zeros(1 << BITS)
    bad[used[w > 0]] = 1
    hits = np.bincount(np.repeat(np.arange(len(size)), size), weights=bad[place], minlength=len(size))
    if not (grade == 1).any():
        return grade
    return np.where((grade == 1) & (hits > np.median(hits[grade == 1])), 2, grade)


def _featured(batches):
    for batch in batches:
        for lo, hi, data, offsets in blocks(batch.column("_text")):
            place, size = features(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").slice(lo, hi - lo), batch.column("_grade").slice(lo, hi - lo),
                 ragged(place.astype(np.int32), size, pa.int32())], names=["_id", "_grade", "place"])


def _learn(grades: int, options: dict):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_id")  # the same order whatever task a row came from
        lists = table.column("place").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        place = lists.flatten().to_numpy().astype(np.int64)
        grade = table.column("_grade").to_numpy().astype(np.int64)
        if grades == 3 and grade.max(initial=0) < 2:
            grade = severe(place, size, grade, options)
        used, w, cut = fit(place, size, grade, grades, **options)
        return pa.table({"place": pa.array(np.concatenate([np.full(len(cut), -1), used]).astype(np.int64)),
                         "value": pa.array(np.concatenate([cut, w]))})
    return run


def fitting_rows(docs: DataFrame, grades: int, sample: int = 20_000, id_col: str = "doc_id", text_col: str = "text",
                 grade_col: str = "grade", labels: DataFrame | None = None) -> DataFrame:
    """``_id``, ``_grade`` and word places of at most ``sample`` graded documents.

    The ids are drawn by hash from ids and grades alone; at most ``sample`` of
    them are broadcast to the documents, whose texts become word places before
    they move."""
    known = (docs if labels is None else labels).where(F.col(grade_col).between(0, grades - 1)) \
        .select(F.col(id_col).alias("_id"), F.col(grade_col).cast("int").alias("_grade")).where("_id IS NOT NULL")
    if labels is not None:
        known = known.join(docs.select(F.col(id_col).alias("_have")).distinct(), F.col("_id") == F.col("_have"), "left_semi")
    picked = known.groupBy("_id").agg(F.max("_grade").alias("_grade")) \
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_doc"), text_or_empty(text_col).alias("_text"))
    return (texts.join(F.broadcast(picked), F.col("_doc") == F.col("_id")).select("_id", "_grade", "_text")
            .mapInArrow(_featured, f"_id {kind}, _grade int, place array<int>")
            .groupBy("_id", "_grade").agg(F.min("place").alias("place")))


def learn(docs: DataFrame, grades: int, sample: int = 20_000, id_col: str = "doc_id", text_col: str = "text",
          grade_col: str = "grade", labels: DataFrame | None = None, **options) -> tuple[np.ndarray, np.ndarray]:
    """(weights by place, thresholds) from at most ``sample`` graded documents.
    Grades stand in ``docs`` or in ``labels``; of several for an id the highest
    counts, of several texts one. Rows without an id are not learnt from."""
    ship(docs.sparkSession)
    rows = fitting_rows(docs, grades, sample, id_col, text_col, grade_col, labels)
    model = (rows.withColumn("_one", F.lit(0)).groupBy("_one")
             .applyInArrow(_learn(grades, options), "place bigint, value double").toArrow())
    place, value = model.column("place").to_numpy(), model.column("value").to_numpy()
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[place[place >= 0]] = value[place >= 0]
    return weights, value[place < 0]


def _score(shared):
    def run(batches):
        weights, cut = shared.value
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column("_text")):
                place, size = features(data, offsets)
                z = np.bincount(np.repeat(np.arange(hi - lo), size), weights=weights[place], minlength=hi - lo)
                over = sigmoid(z[:, None] - cut[None, :])  # P(grade > k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo), pa.array(over.sum(axis=1)),
                     pa.array((over >= 0.5).sum(axis=1).astype(np.int32))], names=["_id", "severity", "grade"])
    return run


def score_documents(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: id, severity (the expected grade) and grade (the
    number of thresholds more likely passed than not)."""
    spark = ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(_score(spark.sparkContext.broadcast(model)), f"_id {kind}, severity double, grade int") \
        .withColumnRenamed("_id", id_col)
