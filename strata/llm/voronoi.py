"""Exact top-k inner-product search as a Voronoi kNN join.

Pivots are chosen far apart from a bounded sample; queries and data go to their
nearest pivots (queries to the first few of them). A cell's summary is its row
count and radius. For a query cell i and a data cell j all inner products lie in
  p_i . p_j  +-  (|p_i| r_j + u_i |p_j| + u_i r_j).
The lower bounds, taken from the best cell down until k + 1 rows are passed,
give a score that every query of cell i reaches; data cells whose upper bound is
below it cannot hold a result and are not sent there. The summaries are at most
``pivots`` rows a side.

Data go only to the query blocks that need their cell, in blocks of bounded
size, are solved there by matrix products, and each query's best of all blocks
are merged. Equal vectors are reduced to their k + 1 smallest ids first (no
query can use more, as ties go to the smaller id), so a hot vector costs k + 1
rows.

Defined results: null vectors, and vectors with null or non-finite components,
and null ids take no part; vectors of unequal length are never compared.
Repeated ids count once, with their smallest vector. Scores beyond 64 bits
saturate. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import land, ship

PIVOTS = 16
SAMPLE = 2000
DATA_BLOCK, QUERY_BLOCK, ROWS_AT_ONCE = 8192, 2048, 256


def quantised(embedding: str, scale: float) -> Column:
    """floor(scale * x) of every component; null where the vector takes no part."""
    inf = float("inf")
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(inf)))
    return F.when(F.col(embedding).isNotNull() & ~F.coalesce(bad, F.lit(True)),
                  F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Far-apart rows of the sample: each is the farthest from those before."""
    first = int(np.argmin(((sample - sample.mean(axis=0)) ** 2).sum(axis=1)))
    out = [first]
    distance = ((sample - sample[first]) ** 2).sum(axis=1)
    while len(out) < count and distance.max() > 0:
        out.append(int(np.argmax(distance)))
        distance = np.minimum(distance, ((sample - sample[out[-1]]) ** 2).sum(axis=1))
    return sample[out]


def _assign(pivots: np.ndarray):
    """Cell and distance to its pivot."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v")).astype(float)
            if not len(x):
                continue
            d = (x ** 2).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots ** 2).sum(axis=1)[None, :]
            cell = d.argmin(axis=1)
            far = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(cell.astype(np.int32)),
                                              pa.array(far)], names=["id", "v", "cell", "far"])
    return run


def needed_cells(qp: np.ndarray, u: np.ndarray, dp: np.ndarray, r: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """Which data cells (columns) each query cell (rows) must see."""
    middle = qp @ dp.T
    spread = (np.linalg.norm(qp, axis=1)[:, None] * r[None, :] + u[:, None] * np.linalg.norm(dp, axis=1)[None, :]
              + u[:, None] * r[None, :])
    slack = 1.0 + 1e-9 * (np.abs(middle) + spread)  # rounding
    low, high = middle - spread - slack, middle + spread + slack
    out = np.ones_like(low, dtype=bool)
    for i in range(len(qp)):
        order = np.argsort(-low[i])
        passed = np.searchsorted(np.cumsum(n[order]), k + 1)  # one of them may be the query itself
        if passed < len(order):
            out[i] = high[i] >= low[i][order[passed]]
    return out & (n > 0)[None, :]


def _solve(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q_id, x_id = left.column("id").to_numpy(), right.column("id").to_numpy()
        order = np.argsort(x_id, kind="stable")
        x_id = x_id[order]
        q, x = _matrix(left.column("v")), _matrix(right.column("v"))
        if not len(q) or not len(x):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.int64())})
        x = x[order]
        top = float(np.abs(q.astype(float)).max()) * float(np.abs(x.astype(float)).max()) * max(1, x.shape[1])
        exact = top < 2.0 ** 53  # the float product is exact
        x = x.astype(float if exact else object)
        parts = []
        for lo in range(0, len(q), ROWS_AT_ONCE):
            some = q[lo:lo + ROWS_AT_ONCE].astype(float if exact else object) @ x.T
            if not exact:
                some = np.clip(some, -(1 << 63), (1 << 63) - 1).astype(np.int64)
            for row, ident in zip(some, q_id[lo:lo + ROWS_AT_ONCE]):
                at = np.flatnonzero(x_id != ident)
                score = row[at]
                if len(at) > k:
                    least = np.partition(score, len(score) - k)[len(score) - k]
                    good = np.flatnonzero(score >= least)
                    good = good[np.argsort(-score[good], kind="stable")[:k]]  # ids ascend: ties to the smaller
                    at, score = at[good], score[good]
                parts.append((np.full(len(at), ident), x_id[at], score.astype(np.int64)))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(np.concatenate(c)) for c in zip(*parts)))))
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", embedding: str = "embedding",
          scale: float = 64.0, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every query row its k best
    other rows by inner product of the quantised vectors, ties to smaller ids.
    The pivots come from at most ``sample`` rows; every row is searched."""
    spark = ship(vectors.sparkSession)
    whole = land(vectors.select(F.col(id_col).cast("long").alias("id"), quantised(embedding, scale).alias("v"),
                                F.coalesce(is_query, F.lit(False)).alias("is_query"))
                 .where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
                 .groupBy("id").agg(F.min("v").alias("v"), F.max("is_query").alias("is_query")), "knn-vectors")
    out = None
    for (dim,) in whole.groupBy(F.size("v").alias("dim")).count().select("dim").collect():
        some = _top_k(spark, whole.where(F.size("v") == dim), k, pivots, sample)
        out = some if out is None else out.union(some)
    if out is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return out


def _top_k(spark, rows: DataFrame, k: int, pivots: int, sample: int) -> DataFrame:
    picked = rows.select("v", F.xxhash64("id").alias("h")).orderBy("h").limit(sample).select("v").toArrow()
    seeds = choose_pivots(_matrix(picked.column("v")).astype(float), pivots)
    schema = "id bigint, v array<bigint>, cell int, far double"
    # a query can use at most k + 1 rows of one vector, those of smallest id
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    data = land(rows.select("id", "v").withColumn("nth", rank).where(F.col("nth") <= k + 1).drop("nth")
                .mapInArrow(_assign(seeds), schema), "knn-data")
    n_queries = rows.where("is_query").count()
    q_seeds = seeds[:max(1, min(len(seeds), -(-n_queries // QUERY_BLOCK)))]
    queries = land(rows.where("is_query").select("id", "v").mapInArrow(_assign(q_seeds), schema), "knn-queries")

    def summary(frame, count):
        got = {r["cell"]: (r["n"], r["far"]) for r in
               frame.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
        return np.array([got.get(c, (0, 0.0))[0] for c in range(count)]), \
            np.array([got.get(c, (0, 0.0))[1] for c in range(count)])

    n, r = summary(data, len(seeds))
    m, u = summary(queries, len(q_seeds))
    need = needed_cells(q_seeds, u, seeds, r, n, k)
    # at most pivots * pivots rows, with how many blocks each side has
    plan = [(int(i), int(j), math.ceil(m[i] / QUERY_BLOCK), math.ceil(n[j] / DATA_BLOCK))
            for i, j in zip(*np.nonzero(need)) if m[i]]
    pairs = spark.createDataFrame(plan, "qc int, dc int, q_blocks int, d_blocks int")
    salt = lambda blocks: F.pmod(F.xxhash64("id"), blocks).cast("int")
    left = (queries.withColumnRenamed("cell", "qc").join(F.broadcast(pairs), "qc")
            .select("id", "v", "qc", "dc", salt(F.col("q_blocks")).alias("qb"),
                    F.explode(F.sequence(F.lit(0), F.col("d_blocks") - 1)).alias("db")))
    right = (data.withColumnRenamed("cell", "dc").join(F.broadcast(pairs), "dc")
             .select("id", "v", "qc", "dc", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("qb"),
                     salt(F.col("d_blocks")).alias("db")))
    keys = ["qc", "dc", "qb", "db"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _solve(k), "query_id bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place.cast("int")).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
