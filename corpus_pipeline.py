"""A corpus pipeline of five operators: documents in, piece ids out.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and read again. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paydw.llm import lang_id, line_dedup, mixing, ngram_join, piece_lattice
from paydw.llm.common import cut, table

MIN_SCORE = 0.4  # a language at least this likely; the likeliest of four has 0.25 or more


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents without a letter, or without a likely language, go.

    Where nothing could be learned (no labelled text outside the held-out
    quarter), only documents without a letter go.
    """
    net = lang_id.fit(docs.where(~lang_id.held_out()))
    if net is None:
        return docs.where(F.coalesce(F.col("text").rlike(lang_id.LETTER), F.lit(False)))
    # the row goes along as one column, so its names meet none of the operator's
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    found = lang_id.predict(rows, net, passing=("row",))
    return found.where((F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines that repeat earlier ones, exactly or within two edits, go."""
    count = "_dropped"
    while count in docs.columns:  # a column of the documents stays
        count += "_"
    return line_dedup.dedup_lines(docs, dropped_col=count) \
        .withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8, five words and a similarity of 0.8: of linked documents the one with the smallest id stays.

    Documents are told apart by id and text; those without an id take part too.
    """
    return ngram_join.one_of_each(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: texts and parts of texts, so that sources come in their target shares."""
    return mixing.mixed(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: piece ids of every text, and the text that they decode to."""
    return piece_lattice.encode_with_text(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("language_id", identify), ("line_dedup", drop_lines), ("ngram_join", drop_copies),
          ("source_mix", mix), ("piece_lattice", encode)]

# SQL can express neither the network nor the lattice: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
