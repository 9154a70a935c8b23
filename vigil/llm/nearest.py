"""Approximate nearest neighbours by collision-counting hashing.

Every hash function is one random projection, kept as a sorted array of the
projected vectors.  A query takes a window around its own projection in each
array and counts, per vector, in how many windows it lies.  *Virtual rehashing*
widens all windows together by the search radius; a vector that lies in enough
windows is verified by its exact inner product.  A vector at the radius or nearer
lies in a window with probability 0.68, so among 24 functions it passes the
threshold of 0.45 with probability 0.99 and more.  The search ends when the k-th
best verified vector is within the radius: all better ones had that chance.

Largest inner product becomes smallest distance by one more coordinate that fills
every vector up to the largest norm.  Vectors are dealt to blocks and queries to
chunks, both of bounded size; every chunk searches every block in a task of its
own, and a query's best of all blocks are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.llm.common import materialize

FUNCTIONS = 24
THRESHOLD = 0.45
#: Half a window's width in units of the radius (P(|N(0,1)| <= 1) = 0.683).
HALF_WINDOW = 1.0
#: First radius (of distances between 0 and 2) and its growth per round.
RADIUS, GROWTH = 0.25, 1.3
#: What two sums of the same products can differ by, in units of the vectors' norms.
ROUNDING = 1e-9
BLOCK_VECTORS, CHUNK_QUERIES = 16_384, 2_048


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The inner products of the rows of ``x`` with ``q``, each summed from its first component to
    its last: a row's product depends on nothing but the row, so equal vectors tie."""
    return np.cumsum(x * q, axis=1)[:, -1]


class _Index:
    """Sorted projections of one block's vectors (rows of ``x``, padded to norm ``top``)."""

    def __init__(self, x: np.ndarray, top: float, seed: int = 7):
        fill = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1) / top**2))
        self.x, self.top, unit = x, top, np.column_stack([x / top, fill])
        self.a = np.random.default_rng(seed).standard_normal((unit.shape[1], FUNCTIONS))
        projected = unit @ self.a
        self.order = np.ascontiguousarray(np.argsort(projected, axis=0).T)
        self.sorted = np.take_along_axis(projected.T, self.order, axis=1)

    def search(self, queries: np.ndarray, k: int, skip: np.ndarray):
        """Per query (row of ``queries``) its verified rows and their inner products; ``skip`` is
        the query's own row here, or -1.

        All queries go through the rounds together: a round finds the windows' ends of all of
        them by one search per array, then every query counts what its windows have gained.
        """
        n, norms = len(self.x), np.linalg.norm(queries, axis=1)
        at = queries / norms[:, None] @ self.a[:-1]  # a query's own filling coordinate is zero
        where = lambda values, side: np.stack(
            [np.searchsorted(s, values[:, j], side) for j, s in enumerate(self.sorted)], axis=1)
        left = where(at, "left")
        right = left.copy()
        states = [_State(n, int(own)) for own in skip]
        active, radius = list(range(len(queries))), RADIUS
        while active:
            half = HALF_WINDOW * radius
            lo = np.minimum(where(at[active] - half, "left"), left[active])
            hi = np.maximum(where(at[active] + half, "right"), right[active])
            still = []
            for i, begin, end in zip(active, lo, hi):
                spans = zip(self.order, begin.tolist(), left[i].tolist(), right[i].tolist(), end.tolist())
                gained = np.concatenate([part for s, a, b, c, d in spans for part in (s[a:b], s[c:d])])
                if not states[i].count(self, gained, queries[i], norms[i], k, radius):
                    still.append(i)
            left[active], right[active] = lo, hi
            active, radius = still, radius * GROWTH
        return [state.best(self, q, k) for state, q in zip(states, queries)]


class _State:
    """What one query has counted and verified in a block."""

    def __init__(self, n: int, own: int):
        self.counts, self.known = np.zeros(n, np.int16), np.zeros(n, bool)
        if own >= 0:
            self.known[own] = True
        self.candidates = n - (own >= 0)
        self.rows, self.scores, self.every = np.empty(0, np.int64), np.empty(0), None

    def _verify(self, index: _Index, fresh: np.ndarray, q: np.ndarray) -> None:
        self.known[fresh] = True
        if self.every is None and 8 * len(fresh) > len(self.known):  # cheaper than gathering so many rows
            self.every = index.x @ q
        scores = index.x[fresh] @ q if self.every is None else self.every[fresh]
        self.rows, self.scores = np.append(self.rows, fresh), np.append(self.scores, scores)

    def best(self, index: _Index, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The verified rows that can be among the ``k`` best, with their exact products: all whose
        quick product is within rounding of the k-th."""
        rows = self.rows
        if len(rows) > k:
            kth = np.partition(self.scores, len(rows) - k)[len(rows) - k]
            rows = rows[self.scores >= kth - ROUNDING * index.top * np.linalg.norm(q)]
        return rows, products(index.x[rows], q)

    def count(self, index, gained, q, norm, k, radius) -> bool:
        """Count the rows that the windows have gained and verify those over the threshold; whether
        the search is over: the k-th best is within the radius, or no row is left."""
        self.counts += np.bincount(gained, minlength=len(self.counts)).astype(np.int16)
        self._verify(index, np.flatnonzero((self.counts >= THRESHOLD * FUNCTIONS) & ~self.known), q)
        wanted = min(k, self.candidates)
        if len(self.rows) >= wanted:
            near = np.partition(self.scores, len(self.rows) - wanted)[len(self.rows) - wanted] if wanted else np.inf
            if np.sqrt(max(0.0, 2 - 2 * near / (index.top * norm))) <= radius:
                return True
        if radius > 2:  # everything within reach has been seen
            self._verify(index, np.flatnonzero(~self.known), q)
        return len(self.rows) == self.candidates


def nearest(vectors: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, <id>, score): for every row that satisfies the SQL predicate
    ``is_query``, its ``k`` nearest rows found, by largest inner product in double
    precision, ties to the smaller id (null ids last).

    Every row but the query's own is a candidate, rows with equal ids or vectors too.
    Null vectors, zero vectors and those with null or non-finite components take no
    part; vectors of different lengths are not compared.  With fewer than ``k``
    candidates all are returned.  Extra columns are ignored.  An empty table gives an
    empty table.
    """
    spark = vectors.sparkSession
    v = F.col("_v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = materialize(
        vectors.select(
            F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"),
            F.coalesce(F.expr(is_query), F.lit(False)).alias("_query"),
        )
        .where(v.isNotNull()).where(finite).where(F.exists(v, lambda x: x != 0))
        .withColumn("_norm", F.sqrt(F.aggregate("_v", F.lit(0.0), lambda s, x: s + x * x)))
        .withColumn("_row", F.monotonically_increasing_id()).withColumn("_dim", F.size("_v")),
        "vectors",
    )
    sizes = rows.agg(F.count(F.lit(1)), F.coalesce(F.count_if("_query"), F.lit(0)), F.max("_norm")).first()
    blocks, chunks = max(1, -(-sizes[0] // BLOCK_VECTORS)), max(1, -(-sizes[1] // CHUNK_QUERIES))
    top = sizes[2] or 1.0
    deal = lambda n, seed: F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = rows.select("_id", "_v", "_row", "_dim", deal(blocks, 1).alias("_block"), every(chunks).alias("_chunk"))
    queries = rows.where("_query").select(
        "_id", "_v", "_row", "_dim", every(blocks).alias("_block"), deal(chunks, 2).alias("_chunk")
    )
    id_type = rows.schema["_id"].dataType.simpleString()

    def search(key, block, chunk):
        out = {"_qrow": [], "_qid": [], "_id": [], "score": []}
        if len(block) and len(chunk):
            block = block.sort_values("_row", ignore_index=True)
            index = _Index(np.stack(block["_v"].to_numpy()).astype(np.float64), top)
            ids = block["_id"].to_numpy()
            order = np.argsort(np.argsort(block["_id"].to_numpy(), kind="stable"), kind="stable")
            own = dict(zip(block["_row"].tolist(), range(len(block))))
            qrows = chunk["_row"].tolist()
            queries = np.stack(chunk["_v"].to_numpy()).astype(np.float64)
            answers = index.search(queries, k, np.array([own.get(r, -1) for r in qrows]))
            for qrow, qid, (found, scores) in zip(qrows, chunk["_id"].tolist(), answers):
                best = np.lexsort((order[found], -scores))[:k]
                out["_qrow"] += [qrow] * len(best)
                out["_qid"] += [qid] * len(best)
                out["_id"] += ids[found[best]].tolist()
                out["score"] += scores[best].tolist()
        return pd.DataFrame(out)

    keys = ["_dim", "_block", "_chunk"]
    found = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        search, f"_qrow long, _qid {id_type}, _id {id_type}, score double"
    )
    best = Window.partitionBy("_qrow").orderBy(F.desc("score"), F.col("_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        F.col("_qid").alias("query_id"), "rank", F.col("_id").alias(id_col), "score"
    )
