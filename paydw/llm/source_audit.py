"""Operator 12: divergence of the sources of a language, by a cube of tasks.

The table of (source, term) counts of a language is cut three ways: its
sources into blocks (twice, as rows and as columns of the result) and its terms
into blocks. A cell (source block, source block, term block) is one task's
work: it gets the slices of both source blocks, adds up the differences over
its own terms for every pair, and gives one partial sum a pair. Sums are then
added along the terms. A slice is copied to as many cells as there are source
blocks; no task sees a whole source or a whole term list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paydw.llm.common import bounded_batches, cut
from paydw.llm.token_files import text_slices

# Fixed value: what lies between terms (all of ASCII but its letters).
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
PRIOR = 5
COUNTS = "lang string, source string, term string, n long, docs long"


def batch_counts(langs: pa.Array, sources: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """Occurrences and documents of each term of each (lang, source) of a batch.

    Every (lang, source) also gets a row with the empty term, which no text holds.
    """
    lang, source = langs.dictionary_encode(), sources.dictionary_encode()
    code = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    _, first, group = np.unique(code, return_index=True, return_inverse=True)
    words = pc.split_pattern(pc.replace_substring_regex(pc.ascii_lower(texts), BETWEEN, " "), " ")
    coded = words.flatten().dictionary_encode()
    n_terms = len(coded.dictionary)
    term = coded.indices.to_numpy()
    doc = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    # one number a (document, term), then one a (group, term)
    pair, n = np.unique(doc * n_terms + term, return_counts=True)
    cell, back = np.unique(group[pair // n_terms] * n_terms + pair % n_terms, return_inverse=True)
    total = np.bincount(back, weights=n, minlength=len(cell)).astype(np.int64)
    docs = np.bincount(back, minlength=len(cell))
    of, terms = pa.array(first[cell // n_terms]), coded.dictionary.take(pa.array(cell % n_terms))
    names = ["lang", "source", "term", "n", "docs"]
    found = pa.RecordBatch.from_arrays(
        [langs.take(of), sources.take(of), terms, pa.array(total), pa.array(docs)], names=names) \
        .filter(pc.not_equal(terms, ""))
    at, none = pa.array(first), pa.array(np.zeros(len(first), np.int64))
    marks = pa.RecordBatch.from_arrays(
        [langs.take(at), sources.take(at), pa.array([""] * len(first), pa.string()), none, none], names=names)
    return pa.concat_batches([found, marks])


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                buffer_bytes: int = 8_000_000) -> DataFrame:
    """``lang, source, term, n, docs`` of all documents; one row with an empty term for every (lang, source)."""
    bounded_batches(docs.sparkSession)
    narrow = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                           for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])

    def run(batches):
        for b in batches:
            lang, source, text = (b.column(c) for c in ("lang", "source", "text"))
            for i, j in text_slices(text, buffer_bytes):
                yield batch_counts(*(c.slice(i, j - i) for c in (lang, source, text)))

    return narrow.mapInArrow(run, COUNTS).groupBy("lang", "source", "term") \
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms))`` in whole numbers."""
    whole = "decimal(20,0)"
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + PRIOR).cast(whole)
    return 1 + F.call_function("div", above, (total + PRIOR * terms).cast(whole))


def cell_sums(rows: pa.Table) -> pa.Table:
    """Partial sums of every pair of sources of one cell: ``lang, a, b, part`` with a before b."""
    width = rows["width"][0].as_py()
    slices = {}
    for side, source, base, places, shares in zip(*(rows[c].to_pylist() for c in (
            "side", "source", "base", "places", "shares"))):
        p = slices.setdefault((side, source), np.full(width, base, np.int64))
        p[places] = shares
    alone = rows["gi"][0] == rows["gj"][0]  # a source block with itself: each pair once
    left = sorted(s for side, s in slices if side == 0)
    right = left if alone else sorted(s for side, s in slices if side == 1)
    found = []
    if right:
        columns = np.stack([slices[0 if alone else 1, s] for s in right])
        for a in left:
            sums = np.abs(columns - slices[0, a]).sum(axis=1)
            found += [(a, b, n) for b, n in zip(right, sums.tolist()) if not alone or a < b]
    lang = rows["lang"][0].as_py()
    return pa.table({"lang": pa.array([lang] * len(found), pa.string()), "a": pa.array([f[0] for f in found], pa.string()),
                     "b": pa.array([f[1] for f in found], pa.string()), "part": pa.array([f[2] for f in found], pa.int64())})


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, group_block: int = 64, term_block: int = 4096,
          text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) that occurs.

    A language keeps the terms (runs of letters and of characters beyond
    ASCII, A-Z lower-cased) that at least ``least_docs`` of its documents hold.
    A source's and a language's share of a kept term is
    ``1 + floor(10^9 * (n + 5) / (N + 5 V))``: ``n`` its occurrences there,
    ``N`` those of all kept terms, ``V`` the number of kept terms. Part
    ``pair`` has every other source of the language and the sum of the
    differences of their shares over all kept terms; part ``term`` the ``top``
    terms of the source whose share exceeds the language's most. Ranks go by
    value, then by the item's bytes.

    Null texts, languages and sources count as empty texts; a source without
    terms takes part like any other, with zero counts. Without kept terms all
    pairs have value 0. Ids are not looked at and rows that repeat count each.
    An empty table gives no rows.
    """
    counts = cut(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    of_term = Window.partitionBy("lang", "term")  # at most one row a source
    kept = cut(counts.where("term <> ''").withColumn("in_docs", F.sum("docs").over(of_term))
               .withColumn("of_lang", F.sum("n").over(of_term))
               .where(F.col("in_docs") >= least_docs).select("lang", "source", "term", "n", "of_lang"), "kept-terms")
    # V of each language, and the number of its source blocks and term blocks
    groups = counts.where("term = ''").select("lang", "source")
    terms = kept.groupBy("lang", "term").agg(F.first("of_lang").alias("of_lang"))
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")) \
        .join(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("of_lang").alias("lang_total")), "lang", "left") \
        .fillna(0, ["terms", "lang_total"]) \
        .withColumn("g_blocks", F.ceil(F.col("sources") / group_block).cast("int")) \
        .withColumn("t_blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") / term_block)).cast("int"))
    langs = cut(langs, "langs")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = cut(groups.join(sums, ["lang", "source"], "left").fillna(0, ["total"]).join(langs, "lang")
                 .withColumn("base", F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
                             .otherwise(0).cast("long"))
                 .withColumn("gb", F.pmod(F.xxhash64("source"), F.col("g_blocks")).cast("int"))
                 .select("lang", "source", "total", "base", "gb"), "groups")
    # a term's block by its hash, its place in the block by its bytes
    placed = terms.join(langs.select("lang", "t_blocks"), "lang") \
        .withColumn("tb", F.pmod(F.xxhash64("term"), F.col("t_blocks")).cast("int")) \
        .withColumn("place", (F.row_number().over(Window.partitionBy("lang", "tb").orderBy("term")) - 1).cast("int")) \
        .select("lang", "term", "tb", "place")
    shares = cut(kept.join(placed, ["lang", "term"])
                 .join(groups.select("lang", "source", "total"), ["lang", "source"])
                 .join(langs.select("lang", "terms", "lang_total"), "lang")
                 .withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
                 .withColumn("q", share(F.col("of_lang"), F.col("lang_total"), F.col("terms")))
                 .select("lang", "source", "term", "tb", "place", "p", "q"), "shares")

    over = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                        (F.col("p") - F.col("q")).alias("value"))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = over.withColumn("rank", ranked).where(F.col("rank") <= top)

    # a source's slice of a term block: its shares where it has the term, its base elsewhere
    slices = shares.groupBy("lang", "source", "tb").agg(
        F.collect_list("place").alias("places"), F.collect_list(F.col("p").cast("int")).alias("shares"))
    widths = placed.groupBy("lang", "tb").agg(F.count(F.lit(1)).cast("int").alias("width"))
    every = groups.join(langs.select("lang", "g_blocks", "t_blocks"), "lang") \
        .withColumn("tb", F.explode(F.sequence(F.lit(0), F.col("t_blocks") - 1))) \
        .join(widths, ["lang", "tb"], "left").join(slices, ["lang", "source", "tb"], "left") \
        .select("lang", "source", "tb", "gb", "g_blocks", "base", F.coalesce("width", F.lit(0)).alias("width"),
                F.coalesce("places", F.array().cast("array<int>")).alias("places"),
                F.coalesce("shares", F.array().cast("array<int>")).alias("shares"))
    # cells (gi, gj, tb) with gi <= gj: as row block for gj >= gb, as column block for gi < gb
    cells = every.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g_blocks") - 1))) \
        .withColumn("side", (F.col("other") < F.col("gb")).cast("int")) \
        .withColumn("gi", F.least("gb", "other")).withColumn("gj", F.greatest("gb", "other")) \
        .drop("gb", "g_blocks", "other")
    parts = cells.groupBy("lang", "gi", "gj", "tb") \
        .applyInArrow(cell_sums, "lang string, a string, b string, part long") \
        .groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))
    both = parts.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value") \
        .select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    return both.withColumn("rank", ranked).unionByName(best).withColumn("rank", F.col("rank").cast("int"))
