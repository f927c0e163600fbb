"""Operator 11: hard negatives by a vertical scan with branch-and-bound (BOND).

A block of candidates is held by columns: one array a dimension, with the
dimension's smallest and largest value. An anchor reads the columns in the
order of its own weights, heaviest first, and adds them up. What the columns
not yet read can still add lies between two sums of those extremes, so every
candidate's score has a lower and an upper bound. After each few columns the
bitmap of candidates loses those whose bounds fall outside what is asked for;
for those that are left after the last column the bounds are the score.

Positives are asked for first (the best of the anchor's label); their scores
set the windows for the negatives of the second scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paydw.llm.common import bounded_batches, cut

STEP = 8  # columns that are read between two looks at the bounds


def quantized(vector: Column) -> Column:
    """``floor(256 * x)`` of each component; null if the vector or a component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v * 256).cast("long")))


def columns_of(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as an array of ``width`` columns, shorter ones filled with 0."""
    lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(lists)), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((width, len(lists)), np.int64)
    out[place, row] = lists.flatten().to_numpy()
    return out


class Block:
    """Candidates by columns, with each column's extremes."""

    def __init__(self, columns: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.columns, self.ids, self.labels = columns, ids, labels
        self.least, self.most = columns.min(axis=1), columns.max(axis=1)

    def scan(self, weights: np.ndarray, live: np.ndarray, shrink) -> tuple[np.ndarray, np.ndarray]:
        """Candidates that ``shrink`` left, and their scores.

        ``live`` are the places of the candidates to begin with;
        ``shrink(lower, upper)`` says which of those that are left stay.
        """
        order = np.argsort(-np.abs(weights), kind="stable")
        w = weights[order]
        one, other = w * self.least[order], w * self.most[order]
        # what the columns from a place of the order on can add, at least and at most
        rest_low = np.append(np.cumsum(np.minimum(one, other)[::-1])[::-1], 0)
        rest_high = np.append(np.cumsum(np.maximum(one, other)[::-1])[::-1], 0)
        score = np.zeros(len(live), self.columns.dtype)
        for at in range(0, len(order), STEP):
            if not len(live):
                break
            read, upto = order[at:at + STEP], min(at + STEP, len(order))
            here = self.columns[read] if len(live) == len(self.ids) else self.columns[read[:, None], live[None]]
            score = score + w[at:upto] @ here
            stay = shrink(score + rest_low[upto], score + rest_high[upto])
            if not stay.all():
                live, score = live[stay], score[stay]
        return live, score


def kth(values: np.ndarray, k: int):
    """The ``k``-th largest value, or None if there are fewer."""
    if len(values) < k:
        return None
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, len(values) - k)[len(values) - k]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k] if scores.dtype != object else \
        np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)


def positives(block: Block, weights: np.ndarray, own_id: int, label: int, k: int) -> Iterator[tuple[int, int]]:
    """``(id, score)`` of the ``k`` best rows of the anchor's label; rows with its id take no part."""
    def shrink(lower, upper):
        least = kth(lower, k)
        return np.ones(len(lower), bool) if least is None else upper >= least

    live = np.flatnonzero((block.labels == label) & (block.ids != own_id))
    live, score = block.scan(weights, live, shrink)
    for i in best(block.ids[live], score, k):
        yield int(block.ids[live[i]]), int(score[i])


def negatives(block: Block, weights: np.ndarray, label: int, windows: list[tuple[int, int]],
              k: int) -> Iterator[tuple[int, int, int]]:
    """``(window, id, score)`` of the ``k`` best rows of other labels within each window of scores, ends included."""
    def shrink(lower, upper):
        stay = np.zeros(len(lower), bool)
        for low, high in windows:
            # the k-th best of those that surely lie within bars the way for all below it
            surely = kth(lower[(lower >= low) & (upper <= high)], k)
            stay |= (upper >= (low if surely is None else surely)) & (lower <= high)
        return stay

    live, score = block.scan(weights, np.flatnonzero(block.labels != label), shrink)
    for n, (low, high) in enumerate(windows):
        some = np.flatnonzero((score >= low) & (score <= high))
        for i in some[best(block.ids[live[some]], score[some], k)]:
            yield n, int(block.ids[live[i]]), int(score[i])


def prepared(candidates: pa.Table, anchors: pa.Table) -> tuple[Block, np.ndarray]:
    """A block and the anchors' weights, in floats as long as every score is a whole number in them."""
    width = max(int(np.diff(t["v"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in (candidates, anchors))
    x, q = columns_of(candidates["v"], width), columns_of(anchors["v"], width)
    largest = [max(abs(int(m.min(initial=0))), int(m.max(initial=0))) for m in (x, q)]
    kind = np.float64 if largest[0] * largest[1] * max(width, 1) < 2 ** 52 else object
    return Block(x.astype(kind), candidates["vec_id"].to_numpy(), candidates["label"].to_numpy()), q.T.astype(kind)


POSITIVES = "anchor_id long, anchor long, positive_id long, positive_score long"
NEGATIVES = "anchor_id long, anchor long, positive_no int, positive_id long, positive_score long, " \
            "negative_id long, negative_score long"
ARROW = {"long": pa.int64(), "int": pa.int32()}


def as_table(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*(f.split() for f in schema.split(", ")))
    return pa.table({n: pa.array([r[i] for r in rows], ARROW[k]) for i, (n, k) in enumerate(zip(names, kinds))})


def mine(vectors: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 10,
         low_pct: int = 30, high_pct: int = 90, relabel_every: int = 7, n_labels: int = 10,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         block_values: int = 1 << 20, anchor_values: int = 1 << 21) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows whose id is divisible by ``every`` are anchors; where an id is
    divisible by ``relabel_every`` the label counts as
    ``(label + 1) % n_labels``. Scores are inner products of quantized
    vectors; higher ones come first, ties go to smaller ids. An anchor's
    positives are its ``n_positives`` best other rows of its label; a
    positive's negatives are the ``n_negatives`` best rows of other labels
    whose score is from ``low_pct`` to ``high_pct`` percent of the positive's.

    Rows without an id, a label or a vector, or with a null or non-finite
    component, take no part. Shorter vectors are filled with 0. Rows that
    repeat are candidates each; equal anchors (id, label and vector) count
    once, and rows with an anchor's own id are no positives of it. A positive
    below 0 has an empty window. A score beyond a long fails the job.

    Candidates and anchors are dealt to blocks of about ``block_values`` and
    ``anchor_values`` components, by row and not by id, label or vector, so no
    group of copies shares a block. A pair of blocks is one task's work; at
    most ``n_positives`` (times ``n_negatives``) rows an anchor leave it.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    own, label = F.col(id_col).cast("long"), F.col(label_col).cast("long")
    rows = cut(vectors.select(
        own.alias("vec_id"), F.when(own % relabel_every == 0, (label + 1) % n_labels).otherwise(label).alias("label"),
        quantized(F.col(vector_col)).alias("v"))
        .where("vec_id is not null and label is not null and v is not null")
        .withColumn("deal", F.xxhash64("vec_id", F.monotonically_increasing_id())), "vectors")
    is_anchor = F.col("vec_id") % every == 0
    size = rows.agg(F.count(F.lit(1)).alias("c"), F.count_if(is_anchor).alias("a"),
                    F.max(F.size("v")).alias("w")).first()
    width = max(1, size["w"] or 1)
    n_c, n_a = (max(1, -(-n * width // most)) for n, most in ((size["c"], block_values), (size["a"], anchor_values)))
    anchors = rows.where(is_anchor).select("vec_id", "label", "v").distinct() \
        .withColumn("anchor", F.xxhash64("vec_id", "label", "v"))
    blocks = rows.select("vec_id", "label", "v", F.pmod("deal", F.lit(n_c)).alias("cb"),
                         F.explode(F.sequence(F.lit(0), F.lit(n_a - 1))).alias("ab"))

    def pairs(asked: DataFrame):
        dealt = asked.withColumn("ab", F.pmod("anchor", F.lit(n_a)).cast("int")) \
            .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))))
        return blocks.groupBy("cb", "ab").cogroup(dealt.groupBy("cb", "ab"))

    def find_positives(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if candidates.num_rows and asked.num_rows:
            block, weights = prepared(candidates, asked)
            for i, (own, key, lab) in enumerate(zip(*(asked[c].to_pylist() for c in ("vec_id", "anchor", "label")))):
                found += [(own, key, *p) for p in positives(block, weights[i], own, lab, n_positives)]
        return as_table(found, POSITIVES)

    def find_negatives(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if candidates.num_rows and asked.num_rows:
            block, weights = prepared(candidates, asked)
            for i, (own, key, lab, ps) in enumerate(zip(*(asked[c].to_pylist()
                                                          for c in ("vec_id", "anchor", "label", "positives")))):
                windows = [(-(-low_pct * p["positive_score"] // 100), high_pct * p["positive_score"] // 100) for p in ps]
                for n, negative, score in negatives(block, weights[i], lab, windows, n_negatives):
                    found.append((own, key, n, ps[n]["positive_id"], ps[n]["positive_score"], negative, score))
        return as_table(found, NEGATIVES)

    def first(df: DataFrame, group: list[str], score: str, tie: str, k: int) -> DataFrame:
        w = Window.partitionBy(*group).orderBy(F.desc(score), tie)
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    found = first(pairs(anchors).applyInArrow(find_positives, POSITIVES), ["anchor_id", "anchor"],
                  "positive_score", "positive_id", n_positives)
    # one row an anchor, with at most n_positives positives in order
    listed = cut(found.groupBy("anchor").agg(F.sort_array(F.collect_list(
        F.struct("rank", "positive_id", "positive_score"))).alias("positives")), "positives")
    asked = cut(anchors.join(listed, "anchor"), "anchors")
    return first(pairs(asked).applyInArrow(find_negatives, NEGATIVES),
                 ["anchor_id", "anchor", "positive_no", "positive_id", "positive_score"],
                 "negative_score", "negative_id", n_negatives) \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                "positive_score", "negative_score")
