"""Exact top-k search by inner product over a pivot table.

Each vector's distances to some pivots are computed once and stored. For a query, the triangle
inequality turns them into a lower bound of each distance, |d(q, p) - d(x, p)| at its largest
pivot, and so into an upper bound of each score, as 2 q.x = |q|^2 + |x|^2 - d(q, x)^2. A task
evaluates its candidates in the order of that bound and stops when no bound left can reach the
k-th score found so far; ties are evaluated, so the result is exact.

Queries are packed into blocks and vectors into chunks of fixed sizes, one row each. A join of the
blocks with the chunks gives each task some of both; it keeps the k best of each query of a block
over its chunks, so a task's state and what it returns don't grow with the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import keep

PIVOTS = 24
QUERY_BLOCK = 1024
CHUNK_VALUES = 1 << 18  # numbers in a chunk
_SLACK = 1e-2
_NONE = np.iinfo(np.int64).min
_EXACT = float(1 << 53)  # integers in doubles below this are exact


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """(id, v, dims) with v = floor(scale * x) in doubles; rows whose vector is null or empty, or has a component that is null or not finite once scaled, are left out, as are null ids."""
    x = F.col(vector_col)
    scaled = lambda e: e.cast("double") * float(scale)
    good = (F.size(x) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(scaled(e)) < float("inf")))
    # Doubles from 2**52 on are integers, and may be too large for the long that floor gives.
    v = F.transform(x, lambda e: F.when(F.abs(scaled(e)) < float(1 << 52), F.floor(scaled(e)).cast("double")).otherwise(scaled(e)))
    return vectors.filter(F.col(id_col).isNotNull() & good).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(x).alias("dims"))


@np.errstate(over="ignore", invalid="ignore")  # vectors too large for their squares get bounds that are not numbers
def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * x @ p.T
    return np.sqrt(np.maximum(square, 0))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _packed(points: DataFrame, pivots: np.ndarray, rows: int, name: str) -> DataFrame:
    """(n, ids, v, d) of points (id, v) of one number of dimensions: up to so many vectors a row, with their distances to the pivots; n tells rows apart; stored."""
    dims = pivots.shape[1]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                x = _matrix(part.column("v"), dims)
                out = [ids, x.ravel(), _distances(x, pivots).ravel()]
                yield pa.RecordBatch.from_arrays([pa.array([[*a]], pa.list_(kind)) if len(a) < 2 else pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a, kind)) for a, kind in zip(out, (pa.int64(), pa.float64(), pa.float64()), strict=True)], ["ids", "v", "d"])

    return keep(points.select("id", "v").mapInArrow(run, "ids array<long>, v array<double>, d array<double>"), name)


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The integer inner products; where doubles could round, by Python's integers, held to the range of a long."""
    if np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * len(q) < _EXACT:
        return (x @ q).astype(np.int64)
    own = [int(e) for e in q]
    exact = (sum(int(a) * b for a, b in zip(row, own, strict=True)) for row in x)
    return np.array([min(max(s, -(1 << 63) + 1), (1 << 63) - 1) for s in exact], dtype=np.int64)


def _search(k: int):
    """A mapInArrow function: the k best of a task's chunks for each query of its blocks."""

    def search(batches):
        np.seterr(over="ignore", invalid="ignore")
        best: dict[int, tuple] = {}
        for b in batches:
            for r in range(b.num_rows):
                ids, qv, qd, xid, xv, xd = (b.column(c)[r].values.to_numpy(zero_copy_only=False) for c in ("q_ids", "q_v", "q_d", "ids", "v", "d"))
                q, x = qv.reshape(len(ids), -1), xv.reshape(len(xid), -1)
                qd, xd = qd.reshape(len(ids), -1), np.ascontiguousarray(xd.reshape(len(xid), -1).T)
                block = b.column("n")[r].as_py()
                if block not in best:
                    best[block] = (ids, np.full((len(ids), k), _NONE), np.full((len(ids), k), np.iinfo(np.int64).max))
                _, best_score, best_id = best[block]
                norms, square = (q * q).sum(1), (x * x).sum(1)
                for i in range(len(ids)):
                    bound = np.zeros(len(x))
                    for p in range(len(xd)):
                        np.maximum(bound, np.abs(xd[p] - qd[i, p]), out=bound)
                    # Rounding may put a bound some 1e-12 of itself too high: give as much back.
                    bound *= 1 - 1e-9
                    most = (norms[i] + square - bound * bound) / 2 + _SLACK + 1e-12 * (norms[i] + square)
                    # Not below, so that bounds that are not numbers, of vectors too large for squares, count as able.
                    able = np.flatnonzero(~(most < best_score[i, -1]))
                    able = able[np.argsort(-most[able])]
                    at, step = 0, 4 * k
                    while at < len(able) and not most[able[at]] < best_score[i, -1]:
                        take = able[at : at + step]
                        take = take[xid[take] != ids[i]]
                        score = np.concatenate([best_score[i], _scores(x[take], q[i])])
                        who = np.concatenate([best_id[i], xid[take]])
                        order = np.lexsort((who, ~score))[:k]  # ~ turns the order of integers round without an overflow
                        best_score[i], best_id[i] = score[order], who[order]
                        at, step = at + step, step * 4
        for ids, best_score, best_id in best.values():
            found = best_score != _NONE
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, found.sum(1)), pa.int64()), pa.array(best_id[found], pa.int64()), pa.array(best_score[found], pa.int64())], ["query_id", "vec_id", "score"])

    return search


def exact_topk(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, scale: int = 1024, pivots: int = PIVOTS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of queries its k highest integer inner products with the other rows of vectors, ties to the smaller id.

    Queries need the same columns, and are compared with vectors of as many dimensions. Vectors
    that are null, empty or hold a null or non-finite component, and rows without an id, take no
    part; a query with fewer than k candidates gets them all, one without any has no row. Rows with
    equal ids count as one vector each, but never for a query of that id; of queries with equal ids
    the smallest vector is asked. Scores are exact at any size and held to the range of a long.
    Further columns of the inputs are not read.
    """
    spark = vectors.sparkSession
    points, wanted = quantized(vectors, id_col, vector_col, scale), quantized(queries, id_col, vector_col, scale)
    found = None
    for r in wanted.groupBy("dims").count().orderBy("dims").collect():
        dims = r["dims"]
        own = points.filter(F.col("dims") == dims)
        picked = own.orderBy(F.xxhash64("id"), "id", "v").limit(pivots).select("v").collect()
        if not picked:
            continue
        chosen = np.array([x.v for x in picked], dtype=np.float64).reshape(len(picked), dims)
        chunks = _packed(own, chosen, max(16, CHUNK_VALUES // (dims + len(picked))), "chunks")
        asked = wanted.filter(F.col("dims") == dims).groupBy("id").agg(F.min("v").alias("v"))
        blocks = _packed(asked, chosen, query_block, "queries").select(F.monotonically_increasing_id().alias("n"), *[F.col(c).alias(f"q_{c}") for c in ("ids", "v", "d")])
        part = blocks.crossJoin(chunks).mapInArrow(_search(k), "query_id long, vec_id long, score long")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
