"""Operator 5: document fingerprints by SpotSigs.

A spot signature is an anchor (a very common word) and the chain of the next
content words behind it. The set of a text's signatures, hashed to 32 bits, is
its fingerprint; two fingerprints are compared by their Jaccard similarity.
Sets of very different length cannot be similar, so near duplicates are looked
for within bands of set length only, through an index on signatures, and
lengths are compared before any set is.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from paydw.llm.common import bounded_batches

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    "a an and are as at be by for from in is it not of on or that the this to was were with "
    "als auf auch das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au avec dans de des du en est et la le les par pour que qui sur un une "
    "al con del el es las lo los no para por se su una y".split())
EDGES = b".,;:!?\"'()[]{}|<>*_#-"
CHAIN = 3


class Words:
    """Hash and kind of words; a bounded table keeps those seen lately."""

    def __init__(self, most: int = 300_000):
        self.most, self.table = most, {}

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all words end to end, which of them are anchors, and the words of each text."""
        words = [t.lower().split() for t in texts]
        table = self.table
        for w in {w for ws in words for w in ws if w not in table}:
            bare = w.strip(EDGES)
            # the lowest bit marks an anchor; a word of marks only has no part in a chain (0)
            table[w] = (xxhash.xxh64_intdigest(bare) & ~1 | (bare.decode("utf-8", "replace") in ANCHORS)) if bare else 0
        flat = np.fromiter((table[w] for ws in words for w in ws), dtype=np.uint64)
        counts = np.array([len(ws) for ws in words], dtype=np.int64)
        if len(table) > self.most:
            table.clear()
        return flat, (flat & np.uint64(1)).astype(bool), counts


def signatures(words: Words, texts: list[bytes], chain: int = CHAIN) -> list[np.ndarray]:
    """Sorted distinct signatures of each text.

    A chain that reaches the end of its text is as long as the words last. A
    text without any chain has one signature, the hash of all its bytes.
    """
    flat, anchor, counts = words(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    content = np.flatnonzero(~anchor & (flat > 0))
    spots = np.flatnonzero(anchor)
    at = np.searchsorted(content, spots)  # the first content word behind each anchor
    value, some = flat[spots].copy(), np.zeros(len(spots), dtype=bool)
    for k in range(chain):
        place = at + k
        inside = place < len(content)
        nxt = content[np.minimum(place, max(len(content) - 1, 0))] if len(content) else np.zeros(len(spots), np.int64)
        inside &= doc[nxt] == doc[spots] if len(content) else False
        value = np.where(inside, (value ^ flat[nxt]) * np.uint64(0x9E3779B97F4A7C15), value * np.uint64(3))
        value ^= value >> np.uint64(29)
        some |= inside
    owner, value = doc[spots][some], (value[some] >> np.uint64(32)).astype(np.uint32)
    key = np.unique(owner.astype(np.uint64) << np.uint64(32) | value)
    ends = np.searchsorted(key, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    out = []
    for i, t in enumerate(texts):
        own = key[ends[i]:ends[i + 1]].astype(np.uint32)
        out.append(own if len(own) else np.array([xxhash.xxh32_intdigest(t)], dtype=np.uint32))
    return out


def as_text(sigs: np.ndarray) -> str:
    """A fingerprint as text: base64 of its sorted 32-bit signatures, little-endian."""
    return base64.b64encode(sigs.astype("<u4").tobytes()).decode()


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 without comparing if their lengths rule out ``least``."""
    small, large = sorted((len(a), len(b)))
    if small < least * large or not large:
        return 0.0
    both = small + large - len(np.union1d(a, b))
    return both / (small + large - both)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 passing: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, <passing>, n_sigs, sigs`` (sorted ints) for every row of ``docs``; null texts count as empty."""
    from paydw.llm.token_counts import slices

    bounded_batches(docs.sparkSession)
    keep = [id_col, *passing]
    narrow = docs.select(*[F.col(f"`{c}`") for c in keep],
                         F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))

    def run(batches):
        words = Words()
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for i, j in slices(texts, 2_000_000):
                sigs = signatures(words, texts[i:j])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, j - i) for c in keep],
                     pa.array([len(s) for s in sigs], pa.int32()),
                     pa.array([s.astype(np.int64) for s in sigs], pa.list_(pa.int64()))],
                    names=[*keep, "n_sigs", "sigs"])

    schema = ", ".join([f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in keep]
                       + ["n_sigs int", "sigs array<bigint>"])
    return narrow.mapInArrow(run, schema)


def similar_sets(sets: DataFrame, least: float = 0.8) -> DataFrame:
    """Pairs ``a < b`` of ids in ``sets (id, n_sigs, sigs)`` with Jaccard of at least ``least``.

    ``sets`` holds distinct sets. A set of length n lies in band
    floor(log n / log(1/least)); similar sets lie in the same or the next
    band. Each is indexed in its band by the smallest-valued signatures of
    which one must be shared, and probes its own and the next lower band.
    """
    band = F.floor(F.log("n_sigs") / math.log(1 / least) + 1e-9).cast("int")
    first = (F.col("n_sigs") - F.ceil(F.col("n_sigs") * least) + 1).cast("int")
    index = sets.select("id", "n_sigs", band.alias("band"), F.explode(F.slice("sigs", F.lit(1), first)).alias("sig"))
    probe = index.select(F.col("id").alias("pid"), F.col("n_sigs").alias("pn"),
                         F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"), "sig")
    near = index.join(probe, ["band", "sig"]).where(
        (F.col("n_sigs") < F.col("pn")) | ((F.col("n_sigs") == F.col("pn")) & (F.col("id") < F.col("pid"))))
    near = near.where(F.col("n_sigs") >= F.col("pn") * least) \
        .select(F.least("id", "pid").alias("a"), F.greatest("id", "pid").alias("b")).distinct()
    left = sets.select(F.col("id").alias("a"), F.col("sigs").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("sigs").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (near.join(left, "a").join(right, "b")
            .withColumn("likeness", both / (F.size("sa") + F.size("sb") - both))
            .where(F.col("likeness") >= least).select("a", "b", "likeness"))


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of ``following``."""
    m = len(text) // 3
    return text[:len(text) - m] + following[:m]


def fingerprints_beside_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                             part_chars: int = 8_000_000, max_parts: int = 1 << 16) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and its likeness to that and to the next text's.

    The next document is the one with the next smaller id (after the smallest:
    the largest); equal ids go by their text, null ids come last, null texts
    count as empty. Texts are dealt once, by ranges of ids that follow the
    id's distribution, and read in order; each range also gets the first text
    of the range behind it. Ranges are streamed, so a large one costs time, not
    memory; there are about ``part_chars`` of text in each, more beyond
    ``max_parts`` ranges, whose bounds the driver holds (one number a range).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chars = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(min(max_parts, max(1, -(-chars // part_chars))))
    steps = [(i + 1) / parts for i in range(parts - 1)]
    bounds = base.agg(F.percentile_approx("doc_id", steps or [0.5], max(10_000, 10 * parts))).first()[0] or []
    bounds = np.array(sorted(set(bounds)) if steps else [], dtype=np.int64)

    least = F.lit(-2 ** 63)  # a null id: below all ranges

    @pandas_udf("int")
    def part_of(ids):  # no nulls here, which would turn ids into floats
        return pd.Series(np.searchsorted(bounds, ids.to_numpy()).astype(np.int32))

    rows = base.withColumn("part", part_of(F.coalesce("doc_id", least)) if len(bounds) else F.lit(0)) \
        .withColumn("h", F.xxhash64("text"))
    firsts = rows.groupBy("part").agg(F.max(F.struct(F.coalesce("doc_id", least).alias("d"), "h")).alias("m")) \
        .orderBy("part").collect()  # a row for each range
    where = {r["part"]: firsts[i - 1]["m"] if i else firsts[-1]["m"] for i, r in enumerate(firsts)}
    sentinels = spark.createDataFrame([(p, m["d"], m["h"]) for p, m in where.items()], "part int, d long, h long") \
        if where else spark.createDataFrame([], "part int, d long, h long")
    ends = (rows.select(F.coalesce("doc_id", least).alias("d"), "h", "text")
            .join(F.broadcast(sentinels), ["d", "h"]).dropDuplicates(["part"])
            .select(F.lit(None).cast("long").alias("doc_id"), "text", "part", "h", F.lit(1).alias("last")))
    dealt = rows.withColumn("last", F.lit(0)).unionByName(ends).repartition(parts, "part") \
        .sortWithinPartitions("part", "last", F.desc_nulls_last("doc_id"), F.desc("h"), F.desc("text")) \
        .select("part", "last", "doc_id", "text")

    def work(words, ids, texts, following):
        ahead = [t.encode("utf-8", "replace") for t in (*texts, following[-1])]
        sigs = signatures(words, ahead)
        change = [edited(t, n).encode("utf-8", "replace") for t, n in zip(texts, following, strict=True)]
        other = signatures(words, change)
        # the next text is mostly the one behind; at the end of a range it is not
        after = [sigs[i + 1] if following[i] == (*texts, following[-1])[i + 1] else
                 signatures(words, [following[i].encode("utf-8", "replace")])[0] for i in range(len(texts))]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in change]),
             pa.array([as_text(s) for s in sigs[:-1]]), pa.array([as_text(s) for s in other]),
             pa.array([jaccard(a, b) for a, b in zip(sigs, other)], pa.float64()),
             pa.array([jaccard(a, b) for a, b in zip(sigs, after)], pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                   "near_edited", "near_next"])

    def run(batches):
        words, held = Words(), None
        ids, texts, following, size = [], [], [], 0
        for batch in batches:
            for last, doc_id, text in zip(batch.column("last").to_pylist(), batch.column("doc_id").to_pylist(),
                                          batch.column("text").to_pylist(), strict=True):
                if held is not None:
                    ids.append(held[0])
                    texts.append(held[1])
                    following.append(text)
                    size += len(held[1]) + len(text)
                held = None if last else (doc_id, text)
                if size > 2_000_000:
                    yield work(words, ids, texts, following)
                    ids, texts, following, size = [], [], [], 0
        if ids:
            yield work(words, ids, texts, following)

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")
