"""Operator 4: exact top-k search by no-random-access aggregation.

A block of candidates is held as one sorted list per dimension. A query reads
every list from its good end (descending values for a positive weight,
ascending for a negative one), a slice at a time. What it has read and where
the lists stand bounds each candidate's score from both sides: an unread value
is no better than the last one read and no worse than the list's end. Reading
stops when no candidate outside the k best lower bounds has an upper bound that
reaches them; only candidates that may still qualify get their final scores.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paydw.llm.common import cut

SLICES = (0.25, 0.5, 0.75, 1.0)  # depths at which bounds are compared, as parts of a list


def quantized(vector: Column) -> Column:
    """``floor(256 * x)`` of each component; null if the vector or a component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    good = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(vector.isNotNull() & F.coalesce(good, F.lit(False)),
                  F.transform(x, lambda v: F.floor(v * 256).cast("long")))


def matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows of one array, shorter ones filled with 0."""
    if all(len(v) == width for v in rows):
        return np.stack(rows.to_numpy()).astype(np.int64) if len(rows) else np.zeros((0, width), np.int64)
    out = np.zeros((len(rows), width), np.int64)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


class SortedLists:
    """The sorted lists of a block: ``lists[:, d]`` has the d-th components in ascending order."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.x, self.ids = vectors, ids
        self.lists = np.sort(vectors, axis=0)

    def bounds(self, depth: int, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores (candidates, queries) when ``depth`` values of each list are read.

        ``up`` and ``down`` hold the positive and the negative weights: the
        first read the lists from the top, the others from the bottom.
        """
        top, low = self.lists[len(self.x) - depth], self.lists[depth - 1]
        read_top, read_low = self.x >= top, self.x <= low
        upper = np.where(read_top, self.x, top) @ up + np.where(read_low, self.x, low) @ down
        lower = np.where(read_top, self.x, self.lists[0]) @ up + np.where(read_low, self.x, self.lists[-1]) @ down
        return lower, upper


def search(block: SortedLists, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """``(query, candidates, scores)`` of those that may be among a query's k best of the block.

    Rows with the query's own id take no part. All that tie with the k-th best are kept.
    """
    n, waiting = len(block.ids), np.arange(len(queries))
    weights = queries.T
    up, down = np.maximum(weights, 0), np.minimum(weights, 0)
    for part in SLICES:
        depth = max(1, int(np.ceil(n * part)))
        lower, upper = block.bounds(depth, up[:, waiting], down[:, waiting])
        own = block.ids[:, None] == query_ids[waiting][None]
        lower[own] = upper[own] = -np.inf
        least = np.sort(lower, axis=0)[max(0, n - k)] if lower.dtype == object \
            else np.partition(lower, max(0, n - k), axis=0)[max(0, n - k)]
        open_ = (upper >= least) & ~own
        # stop once few can still qualify; when the lists are read to the end bounds are scores
        ready = open_.sum(axis=0) <= 8 * k if depth < n else np.ones(len(waiting), bool)
        for at in np.flatnonzero(ready).tolist():
            some = np.flatnonzero(open_[:, at])
            yield waiting[at], some, block.x[some] @ weights[:, waiting[at]]
        waiting = waiting[~ready]
        if not len(waiting):
            return


def best_of_block(candidates: pd.DataFrame, queries: pd.DataFrame, k: int, tile: int = 256) -> pd.DataFrame:
    """``query_id, vec_id, score`` of each query's k best in a block; ties go to smaller ids."""
    found = []
    if len(candidates) and len(queries):
        width = int(max(candidates["v"].map(len).max(), queries["v"].map(len).max(), 1))
        x, q = matrix(candidates["v"], width), matrix(queries["v"], width)
        most = int(np.abs(x).max(initial=1)) * int(np.abs(q).max(initial=1)) * width
        kind = np.float64 if most < 2 ** 53 else object  # sums of whole numbers stay exact
        block = SortedLists(x.astype(kind), candidates["vec_id"].to_numpy())
        q, ids = q.astype(kind), queries["vec_id"].to_numpy()
        for lo in range(0, len(q), tile):
            for i, some, scores in search(block, q[lo:lo + tile], ids[lo:lo + tile], k):
                order = sorted(range(len(some)), key=lambda j: (-scores[j], block.ids[some[j]]))[:k]
                found += [(int(ids[lo + i]), int(block.ids[some[j]]), int(scores[j])) for j in order]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
          block_rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best for each row whose id is divisible by ``every``.

    Components are quantized by ``quantized``; rows without an id or with a
    null or non-finite component take no part; shorter vectors are filled with
    0; equal queries (id and vector) count once. Candidates and queries are dealt to blocks of about
    ``block_rows``; each pair of blocks is one task's work, and only a
    query's k best of a block leave it. A score beyond a long fails the job.
    """
    rows = cut(vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantized(F.col(vector_col)).alias("v"))
               .where("vec_id is not null and v is not null"), "vectors")
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    sizes = rows.agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    n_c, n_q = max(1, -(-sizes["c"] // block_rows)), max(1, -(-sizes["q"] // block_rows))

    def dealt(df, own, n_own, other, n_other):
        return df.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(n_own)).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    pairs = dealt(rows, "cb", n_c, "qb", n_q).groupBy("cb", "qb") \
        .cogroup(dealt(asked, "qb", n_q, "cb", n_c).groupBy("cb", "qb"))
    found = pairs.applyInPandas(lambda c, q: best_of_block(c, q, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
