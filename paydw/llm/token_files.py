"""Operator 6: token ids in ORC files.

Documents are dealt by ranges of their id, sorted, encoded by the task that
writes them and stored as ORC: ids are integer run-length encoded, every stripe
has row indexes (minimum and maximum every 10,000 rows) and a Bloom filter on
the document id. Stripes are read in parallel, and a filter on ``doc_id`` skips
files, stripes and row groups by their metadata.
"""

from __future__ import annotations

import os
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paydw.llm.common import bounded_batches, cut

FILE_SCHEMA = T.StructType([T.StructField("part", T.LongType()), T.StructField("row", T.LongType()),
                            T.StructField("doc_id", T.LongType()),
                            T.StructField("ids", T.ArrayType(T.IntegerType()))])
# White space at which the pre-tokenizer of the vocabulary always parts.
BLANKS = " \n\t\r"
# A letter and the mark behind it never share a token; a special token's string and combining
# marks are where lower-casing first could change what the vocabulary's own rules see.
LETTER_MARK = r"(\p{L})([.,;:!?])"
AS_IT_IS = r"<\||\p{M}"


class Numbers(dict):
    """Numbers for keys, in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class WordEncoder:
    """Ids of texts by a tokenizers file; words between blanks are encoded once and kept for a while."""

    def __init__(self, path: str, most: int = 600_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a letter run or mark run
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.most = most
        self.forget()

    def forget(self) -> None:
        """Word numbers, how many ids each word has, and all their ids end to end."""
        self.index, self.counts, self.ids = Numbers(), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Counts and ids of words of letters only: each ends where an id ends a run. None if one does not."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype=np.int32)
        last = np.flatnonzero(self.ends[ids])
        return (np.diff(np.r_[-1, last]), ids) if len(last) == len(words) else None

    def others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts and ids of any words: the place of an id in the joined text tells its word."""
        e = self.tokenizer.encode_batch([" ".join(words)], add_special_tokens=False)[0]
        starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
        at = np.fromiter((o[0] for o in e.offsets), dtype=np.int64)
        return np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(words)), np.array(e.ids, dtype=np.int32)

    def learn(self, words: list[str], group: int = 256) -> None:
        """Encode new words, many in one text."""
        pure = [i for i, w in enumerate(words) if w.isalpha()]
        rest = [i for i, w in enumerate(words) if not w.isalpha()]
        counts, ids = [], []
        for places, encode in ((pure, self.letters), (rest, self.others)):
            for i in range(0, len(places), group):
                some = [words[k] for k in places[i:i + group]]
                n, found = encode(some) or self.others(some)
                counts.append(n)
                ids.append(found)
        if not words:
            return
        n, flat = np.concatenate(counts), np.concatenate(ids)
        order = np.argsort(np.array(pure + rest))  # back to the order of the words
        first = (np.cumsum(n) - n)[order]
        n = n[order]
        flat = flat[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(flat))]
        self.counts, self.ids = np.concatenate([self.counts, n]), np.concatenate([self.ids, flat])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and how many belong to each text."""
        if len(self.index) > self.most:
            self.forget()
        texts = pc.replace_substring_regex(texts, LETTER_MARK, r"\1 \2")
        texts = pc.if_else(pc.match_substring_regex(texts, AS_IT_IS), texts, pc.ascii_lower(texts))
        for blank in BLANKS[1:]:
            texts = pc.replace_substring(texts, blank, " ")
        lists = pc.split_pattern(texts, " ")
        words = lists.flatten().dictionary_encode()
        here = np.fromiter(map(self.index.__getitem__, words.dictionary.to_pylist()), dtype=np.int64)
        self.learn(list(islice(self.index, len(self.counts), None)))
        at = here[words.indices.to_numpy()]
        counts = self.counts[at]
        ends = np.r_[0, np.cumsum(counts)]
        first = (np.cumsum(self.counts) - self.counts)[at]
        ids = self.ids[np.repeat(first - ends[:-1], counts) + np.arange(ends[-1])]
        return ids, np.diff(ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()])


def text_slices(texts: pa.Array, limit: int):
    """Neighbouring texts in groups of about ``limit`` bytes, each text whole."""
    start = total = 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(texts):
        yield start, len(texts)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int, parts: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text", buffer_bytes: int = 2_000_000,
                      stripe_mb: int = 16) -> None:
    """Encode ``docs`` and write ``(part, row, doc_id, ids)`` as ORC in ascending id order.

    ``part`` and ``row`` number the rows in that order; null ids come first;
    equal ids are ordered by their text. A null text counts as empty and holds
    the end id only. Texts are shuffled once, as text; ids are never shuffled.
    ``parts`` is the number of files (by default about 64 MB of text each).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if parts is None:
        chars = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(1, -(-chars // (64 << 20)))
    order = ["doc_id", F.xxhash64("text")]
    dealt = narrow.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text") \
        .withColumn("part", F.spark_partition_id().cast("long"))

    def run(batches):
        encode, row = WordEncoder(vocabulary), 0
        for batch in batches:
            texts = batch.column("text")
            for i, j in text_slices(texts, buffer_bytes):
                ids, counts = encode(texts.slice(i, j - i))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype(np.int32)
                offsets = np.r_[0, ends + np.arange(1, len(ends) + 1)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part").slice(i, j - i),
                     pa.array(np.arange(row, row + j - i), pa.int64()),
                     batch.column("doc_id").slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                    names=["part", "row", "doc_id", "ids"])
                row += j - i

    (dealt.mapInArrow(run, FILE_SCHEMA).write
     .option("orc.compress", "ZSTD").option("orc.stripe.size", str(stripe_mb << 20))
     .option("orc.row.index.stride", "10000").option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .mode("errorifexists").orc(path))


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the files; with ``doc_ids`` only theirs, pruned by min/max and Bloom filters."""
    df = spark.read.schema(FILE_SCHEMA).orc(path)
    return df if doc_ids is None else df.where(F.col("doc_id").isin(doc_ids))


def document_index(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the rows of the files.

    ``start`` adds the totals of earlier files (one row a file) to a running
    sum within the file; no task holds more than one file's row counts.
    """
    bounded_batches(files.sparkSession)

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            ends = ids.offsets.to_numpy()
            flat = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")
            crc = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("row"), batch.column("doc_id"),
                 pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
                names=["part", "row", "doc_id", "n_tokens", "ids_crc32"])

    rows = cut(files.mapInArrow(run, "part long, row long, doc_id long, n_tokens long, ids_crc32 long"), "index")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row")) - F.col("n_tokens")
    return (rows.withColumn("within", within).join(before, "part")
            .select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"))
