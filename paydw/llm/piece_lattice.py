"""Operator 3: SentencePiece encoding and decoding over a relational lattice.

A word's lattice is a table: its substrings of at most the longest piece's
length, joined with the piece table on the text. Edges are grouped by word, and
Spark's ``aggregate`` folds them to the best path (Viterbi): the segmentation
whose pieces' scores add up highest. Characters without a piece become bytes.

Documents do not move through that join word by word. They are read in chunks
and written as word numbers. Frequent words (a bounded table) have fixed numbers;
every other word is cut where no piece can reach across. A chunk deals its distinct
parts to buckets by hash, as one compressed list a bucket; a bucket's distinct parts
are segmented once, and each list's ids go back to its chunk, again as one compressed list.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paydw.llm.common import bounded_batches, cut, doubles, give_back, let, settings
from paydw.llm.token_counts import SPACE, slices

# What the library takes from the lowest score for a character without a piece.
PENALTY = 10.0

# lists of edges are small: a task keeps many words' lists before it turns to sorting
EDGE_LISTS = {"spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000"}


class Pieces:
    """Piece texts, scores and ids of a model file (unigram or BPE: scores are read alike)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.rows = [(p.piece, float(p.score), i) for i, p in enumerate(model.pieces) if p.type == 1]
        self.byte_ids = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == 6:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        self.unknown_score = min(s for _, s, _ in self.rows) - PENALTY
        self.edges = self.useful()
        self.longest = max(len(p) for p, _, _ in self.edges)
        inner = {c for p, _, _ in self.rows if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\t\r" if c not in inner)
        joined = any(SPACE in p.lstrip(SPACE) for p, _, _ in self.rows)
        # marks that no useful piece has behind a letter part words
        held = {b for p, _, _ in self.edges for a, b in zip(p, p[1:]) if a.isalpha()}
        self.pairs = {a + b for p, _, _ in self.edges for a, b in zip(p, p[1:])}
        # characters that stand beside others in a useful piece, numbered from 1; all others are 0
        letters = sorted({c for pair in self.pairs for c in pair})
        self.kinds = np.zeros(max(map(ord, letters), default=0) + 2, dtype=np.int64)
        self.kinds[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
        for a, b in self.pairs:
            self.beside[self.kinds[ord(a)], self.kinds[ord(b)]] = True
        self.marks = "".join(c for c in ".,;:!?" if c not in held)
        # no piece reaches from another character over a space mark, or around the characters ``alone``
        self.pattern = "(?s).+" if joined else \
            f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        self.bytes = [b""] * len(model.pieces)
        for p, _, i in self.rows:
            self.bytes[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])

    def useful(self) -> list[tuple[str, float, int]]:
        """The pieces that can be on a best path: no two or more others make the same text for a higher sum."""
        score, best = {p: s for p, s, _ in self.rows}, {}
        for p in sorted(score, key=len):  # what a piece's parts are worth is known before the piece
            parts = max((best[p[:k]] + best[p[k:]] for k in range(1, len(p)) if p[:k] in best and p[k:] in best),
                        default=float("-inf"))
            best[p] = max(score[p], parts)
        return [row for row in self.rows if row[1] >= best[row[0]]]

    def table(self, spark: SparkSession) -> DataFrame:
        """The piece table: one row for each useful piece, fewer than the vocabulary has."""
        return spark.createDataFrame([(p, i) for p, _, i in self.edges], "piece string, id int")

    def split(self, text: str) -> list[str]:
        """Words of a text behind the space mark that the library puts first."""
        return re.findall(self.pattern, SPACE + text.replace(" ", SPACE)) if text else []

    def parts(self, word: str) -> list[str]:
        """A word cut wherever no useful piece has the two characters side by side: no edge crosses such a place."""
        at = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.pairs]
        return [word[i:j] for i, j in zip([0, *at], [*at, len(word)], strict=True)]

    def parts_of(self, words: list[str]) -> list[list[str] | None]:
        """``parts`` of many words, whose cuts are found in one go; None for a word that stays whole."""
        found: list[list[str] | None] = [None] * len(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        kind = self.kinds[np.minimum(code, len(self.kinds) - 1)]
        start = np.cumsum(size) - size
        apart = np.zeros(len(code), dtype=bool)
        apart[1:] = ~self.beside[kind[:-1], kind[1:]]
        apart[start[size > 0]] = False  # a word's first character has nothing before it
        at = np.flatnonzero(apart)
        owner = np.repeat(np.arange(len(words)), size)[at]
        cut_up, first = np.unique(owner, return_index=True)
        places, ends = (at - start[owner]).tolist(), [*first[1:].tolist(), len(at)]
        for k, i, j in zip(cut_up.tolist(), first.tolist(), ends):
            w, cuts = words[k], places[i:j]
            found[k] = [w[x:y] for x, y in zip([0, *cuts], [*cuts, None])]
        return found

    def decode(self, ids: pa.ListArray) -> list[bytes]:
        """The texts of lists of ids: pieces end to end, without the first space mark."""
        size = np.array([len(b) for b in self.bytes], dtype=np.int64)
        data = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        flat, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
        flat, ends = flat[ends[0]:ends[-1]], ends - ends[0]
        n = size[flat]
        done = np.r_[0, np.cumsum(n)]
        text = data[np.repeat((np.cumsum(size) - size)[flat] - done[:-1], n) + np.arange(done[-1])].tobytes()
        parts = done[ends].tolist()
        return [text[i + (text[i:i + 1] == b" " and i < j):j] for i, j in zip(parts[:-1], parts[1:], strict=True)]


def lattice(words: DataFrame, pieces: Pieces, keys: list[str]) -> DataFrame:
    """Edges ``keys, word, edge`` of each row's ``word``; every character has an edge of size 1.

    An edge is one number, its end, its size and its piece: ``end << 24 |
    (127 - size) << 17 | id + 1``, with 0 for no piece. In their order all edges
    into a place stand behind all edges into earlier places, longer ones first.
    """
    n = F.length("word")
    starts = words.where(n > 0).select(*dict.fromkeys([*keys, "word"]), F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    spans = starts.select(*dict.fromkeys([*keys, "word"]), "start", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(pieces.longest), n - F.col("start")))).alias("size"))
    spans = spans.withColumn("piece", F.expr("substring(word, start + 1, size)"))
    found = spans.join(F.broadcast(pieces.table(words.sparkSession)), "piece", "left").where("id is not null or size = 1")
    edge = F.shiftleft((F.col("start") + F.col("size")).cast("long"), 24) \
        .bitwiseOR(F.shiftleft((127 - F.col("size")).cast("long"), 17)) \
        .bitwiseOR(F.coalesce(F.col("id") + 1, F.lit(0)).cast("long"))
    return found.select(*dict.fromkeys([*keys, "word"]), edge.alias("edge"))


def viterbi(edges: Column, pieces: Pieces) -> Column:
    """The best path as its edges, last first; of equal paths the one with the longer last piece.

    One pass over the edges in order: the best way into the current place is
    kept apart and joins the earlier ones when the next place begins. No edge is
    longer than the longest piece, so only that many sums stay; of all places
    just the best edge is kept. A second fold goes back from the end.
    """
    scores = [pieces.unknown_score] * (max(i for _, _, i in pieces.rows) + 2)
    for _, score, i in pieces.rows:
        scores[i + 1] = score
    table = doubles(scores)

    def end_of(e):
        return F.shiftright(e, 24)

    def size_of(e):
        return 127 - F.shiftright(e, 17).bitwiseAND(127)

    def forward(state, e):
        # the last of ``sums`` belongs to the place before the current one, whose own best is ``sum``
        opened = end_of(e) != end_of(state["edge"])
        kept = F.when(F.size(state["sums"]) < pieces.longest, state["sums"]) \
            .otherwise(F.slice(state["sums"], 2, pieces.longest - 1))
        earlier = F.when(opened, F.concat(kept, F.array(state["sum"]))).otherwise(state["sums"])
        ways = F.when(opened, F.concat(state["ways"], F.array(state["edge"]))).otherwise(state["ways"])

        def reach(sums):
            score = F.element_at(sums, -size_of(e).cast("int")) \
                + F.element_at(table, (e.bitwiseAND((1 << 17) - 1) + 1).cast("int"))
            return let(score, lambda new: let(opened | (new > state["sum"]), lambda better: F.struct(
                sums.alias("sums"), ways.alias("ways"), F.when(better, new).otherwise(state["sum"]).alias("sum"),
                F.when(better, e).otherwise(state["edge"]).alias("edge"))))

        return let(earlier, reach)

    start = F.struct(F.array().cast("array<double>").alias("sums"), F.array().cast("array<bigint>").alias("ways"),
                     F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("edge"))
    ways = F.aggregate(F.sort_array(edges), start, forward,
                       lambda s: F.reverse(F.concat(s["ways"], F.array(s["edge"]))))

    def backward(state, e):
        on = end_of(e) == state["at"]
        return F.struct(F.when(on, state["at"] - size_of(e)).otherwise(state["at"]).alias("at"),
                        F.when(on & (e > 0), F.concat(state["path"], F.array(e))).otherwise(state["path"]).alias("path"))

    none = F.array().cast("array<bigint>")
    return let(ways, lambda w: F.aggregate(
        w, F.struct(end_of(F.element_at(w, 1)).alias("at"), none.alias("path")), backward)["path"])


def segment(words: DataFrame, pieces: Pieces, keys: list[str]) -> DataFrame:
    """``keys, ids`` of each row of ``words``; ``keys`` holds ``word`` and tells rows apart.

    If words are already dealt by ``word``, edges never move.
    """
    paths = lattice(words, pieces, keys).groupBy(*keys).agg(F.first("word").alias("text"), F.collect_list("edge").alias("edges")) \
        .select(*keys, F.col("text"), viterbi(F.col("edges"), pieces).alias("path"))
    raw = F.lit(pieces.byte_ids)

    def ids(edge):
        end = F.shiftright(edge, 24).cast("int")
        char = F.hex(F.encode(F.substring(F.col("text"), end, F.lit(1)), "UTF-8"))
        own = (edge.bitwiseAND((1 << 17) - 1) - 1).cast("int")
        return F.when(own >= 0, F.array(own)).otherwise(F.transform(
            F.sequence(F.lit(0), (F.length(char) / 2).cast("int") - 1),
            lambda i: F.element_at(raw, F.conv(F.substring(char, i * 2 + 1, F.lit(2)), 16, 10).cast("int") + 1)))

    return paths.select(*keys, F.flatten(F.transform(F.reverse("path"), ids)).alias("ids"))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, byte by byte of all numbers, compressed."""
    raw = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<u4").reshape(-1).astype(np.int64)


def packed_words(words: pa.StringArray) -> bytes:
    """A list of words, compressed: how many, the length of each in bytes, then all of them."""
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset:words.offset + len(words) + 1]
    body = data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes()
    head = np.r_[len(words), np.diff(ends)].astype("<u4")
    return zstandard.ZstdCompressor(level=3).compress(head[:1].tobytes() + head[1:].view(np.uint8).reshape(-1, 4).T.tobytes() + body)


def unpacked_words(data: bytes) -> pa.StringArray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:4], "little")
    sizes = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, 4).reshape(4, n).T).view("<u4").reshape(-1)
    ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(raw[4 + 4 * n:]))


CHUNK = ("chunk long, doc_id array<bigint>, sizes array<bigint>, digests binary, numbers binary, "
         "packs array<struct<bucket:int,words:binary>>")
CUT = "\x1f"  # stands between words while texts are split; texts that hold it are split by the pattern


def words_of(texts: list[str], pieces: Pieces) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of some texts, all words as places in that list, and the number of each text's words."""
    find, simple = re.compile(pieces.pattern).findall, pieces.pattern[0] == "[" and "\n" in pieces.pattern
    lists = []
    for t in texts:
        if not t:
            lists.append("")
        elif simple and t[0] != " " and CUT not in t and "  " not in t and "\t" not in t and "\r" not in t and SPACE not in t:
            # between single spaces and line ends, what the pattern finds is what stands between cuts
            lists.append(SPACE + t.replace(" ", CUT + SPACE).replace("\n", CUT + "\n" + CUT))
        else:
            lists.append(find(SPACE + t.replace(" ", SPACE)))
    plain = pa.array([x if isinstance(x, str) else "" for x in lists], pa.string())
    if pieces.marks:
        plain = pc.replace_substring_regex(plain, rf"(\p{{L}})([{re.escape(pieces.marks)}])", rf"\1{CUT}\2")
    fast = pc.split_pattern(plain, CUT)
    flat = fast.flatten()
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    ends = np.r_[0, np.cumsum(filled)][fast.offsets.to_numpy()]
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    distinct, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
    slow = [i for i, x in enumerate(lists) if not isinstance(x, str)]
    if not slow:
        return distinct, at, np.diff(ends)
    index = {w: k for k, w in enumerate(distinct)}
    pieces_at, sizes = [], np.diff(ends)
    for i, x in enumerate(lists):
        pieces_at.append(at[ends[i]:ends[i + 1]] if isinstance(x, str) else
                         np.fromiter((index.setdefault(w, len(index)) for w in x), dtype=np.int64, count=len(x)))
        sizes[i] = len(pieces_at[-1])
    return list(index), np.concatenate(pieces_at), sizes


def dealt(words: list[str], buckets: int) -> tuple[np.ndarray, list[dict]]:
    """The place of each word among all in the order of bucket and word, and each bucket's words as one list."""
    own = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), dtype=np.int64, count=len(words))
    table = pa.table({"bucket": own, "word": pa.array(words, pa.string())})
    order = pc.sort_indices(table, [("bucket", "ascending"), ("word", "ascending")])
    place = np.empty(len(words), dtype=np.int64)
    place[order.to_numpy()] = np.arange(len(words))
    ordered, own = table["word"].combine_chunks().take(order), np.sort(own)
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, dtype=np.int64)
    return place, [{"bucket": int(own[i]), "words": packed_words(ordered.slice(i, j - i))}
                   for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(own)])]


def chunks_of(docs: DataFrame, pieces: Pieces, known: dict[str, int], chunk_chars: int, buckets: int) -> DataFrame:
    """Documents in chunks: per document its number of words, all word numbers, and the words that ``known`` lacks, by bucket.

    A chunk's own words have the numbers behind those of ``known``, in the order of bucket and word.
    """
    def run(batches):
        # small chunk numbers pack well wherever they are shuffled; a retried task gives the same ones
        chunk_numbers = count(TaskContext.get().partitionId() << 24)
        local: dict[str, int] = {}
        rare: dict[str, list[int]] = {}  # words that are cut
        ids, sizes, digests, numbers, chars = [], [], [], [], 0

        def number(w, base=len(known)):
            n = known.get(w)
            return local.setdefault(w, base + len(local)) if n is None else n

        def numbered(words):
            """The numbers of all words end to end, and how many each word has."""
            at = np.fromiter(map(known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
            n = np.ones(len(words), dtype=np.int64)
            other = np.flatnonzero(at < 0)
            unknown = [words[i] for i in other.tolist()]
            at[other] = np.fromiter(map(local.get, unknown, repeat(-1)), dtype=np.int64, count=len(unknown))
            other = other[at[other] < 0]
            new = [w for w in (words[i] for i in other.tolist()) if w not in rare]
            for w, cut_up in zip(new, pieces.parts_of(new), strict=True):
                if cut_up:
                    rare[w] = list(map(number, cut_up))
                else:
                    number(w)
            lists = [rare.get(words[i]) or [local[words[i]]] for i in other.tolist()]
            n[other] = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            flat = np.repeat(at, n)
            flat[flat < 0] = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(n[other].sum()))
            return flat, n

        def chunk():
            place, packs = dealt(list(local), buckets)
            all_numbers = np.concatenate(numbers)
            own = all_numbers >= len(known)
            all_numbers[own] = place[all_numbers[own] - len(known)] + len(known)
            columns = [[next(chunk_numbers)], [ids], [np.concatenate(sizes)], [b"".join(digests)], [packed(all_numbers)], [packs]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(),
                     pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())]))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              names=["chunk", "doc_id", "sizes", "digests", "numbers", "packs"])

        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for i, j in slices(texts, min(chunk_chars, 500_000)):
                distinct, at, counts = words_of(texts[i:j], pieces)
                flat, n = numbered(distinct)
                ends = np.r_[0, np.cumsum(n[at])]
                numbers.append(flat[np.repeat((np.cumsum(n) - n)[at] - ends[:-1], n[at]) + np.arange(ends[-1])])
                ids += keys[i:j]
                sizes.append(np.diff(ends[np.r_[0, np.cumsum(counts)]]))
                digests += [hashlib.sha256(t.encode("utf-8", "replace")).digest() for t in texts[i:j]]
                chars += sum(map(len, texts[i:j]))
                if chars >= chunk_chars:
                    yield chunk()
                    local.clear()
                    rare.clear()
                    ids, sizes, digests, numbers, chars = [], [], [], [], 0
                    give_back()
        if ids:
            yield chunk()
        local.clear()
        rare.clear()
        numbers.clear()
        give_back()

    return docs.mapInArrow(run, CHUNK)


def frequent_words(docs: DataFrame, pieces: Pieces, total: int, most: int, sample_chars: int, longest: int = 32) -> DataFrame:
    """At most ``most`` words and parts of words, of at most ``longest`` characters, the commonest of a bounded sample of ``docs``,
    which have ``total`` bytes of text.

    Which words these are decides where a word is segmented, not how.
    """
    unit = F.pmod(F.xxhash64(F.lit("words"), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    few = docs.where(unit < sample_chars / max(total, 1))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in slices(texts, 500_000):
                distinct, at, _ = words_of(texts[i:j], pieces)
                n = np.bincount(at, minlength=len(distinct)).tolist()
                both = list(zip(distinct, n, strict=True))
                for k, cut_up in zip(n, pieces.parts_of(distinct), strict=True):
                    both += [(p, k) for p in cut_up or ()]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in both], pa.string()),
                                                  pa.array([k for _, k in both], pa.int64())], names=["word", "n"])
        give_back()

    return few.mapInArrow(run, "word string, n long").where(F.length("word") <= longest) \
        .groupBy("word").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "word").limit(most)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", most: int = 1 << 17,
           sample_chars: int = 48_000_000, chunk_chars: int = 5_000_000, part_chars: int = 16_000_000,
           max_parts: int = 1 << 16, finish=None, more: str = "") -> DataFrame:
    """``doc_id, ids, text_sha256`` for every row of ``docs``: piece ids of the best segmentation.

    ``finish(table, pieces)`` turns each chunk's rows into those of the schema
    ``more`` where their ids are put together, so ids need not come back to
    another worker. Null and empty texts have no ids; null ids and repeated rows pass through;
    other columns are ignored. A task holds one chunk: about ``chunk_chars``
    characters' word numbers and parts of words, or one longer text's. ``most`` bounds
    the table of frequent words that goes to every task (``most`` words of at
    most 32 characters, with their ids). Other parts go to four buckets for each
    ``part_chars`` of text (beyond ``max_parts`` partitions buckets grow, by the
    parts that each chunk has once); one task holds one bucket's lists. A run in which
    any two neighbours are side by side in some piece is one part, whose edges
    are one array: about 16 numbers a character.
    """
    spark = docs.sparkSession
    bounded_batches(spark, 2 << 20)
    pieces = Pieces(model)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    common = frequent_words(narrow, pieces, total, most, sample_chars).repartition("word")
    with settings(spark, EDGE_LISTS):
        often = cut(segment(common, pieces, ["word", "n"]), "frequent").toArrow() \
            .sort_by([("n", "descending"), ("word", "ascending")])  # small numbers for common words pack best
    known = dict(zip(often["word"].to_pylist(), range(len(often)), strict=True))
    counts, flat = ragged(often["ids"])

    parts = min(max_parts, max(1, -(-total // part_chars)))
    chunks = cut(chunks_of(narrow, pieces, known, chunk_chars, 4 * parts), "chunks")
    lists = chunks.select(F.col("chunk").alias("of"), F.explode("packs").alias("pack")) \
        .select("pack.bucket", "of", "pack.words").repartition(parts, "bucket")

    def distinct(own: pa.Table) -> pa.Table:
        words = pc.unique(pa.chunked_array([unpacked_words(w) for w in own["words"].to_pylist()], pa.string()))
        words = words.take(pc.sort_indices(words))  # alike words side by side, many in a row, pack well on their way
        ends = pa.array([*range(0, len(words), 4096), len(words)], pa.int32())
        return pa.table({"bucket": pa.array([own["bucket"][0].as_py()] * (len(ends) - 1), pa.int32()),
                         "words": pa.ListArray.from_arrays(ends, words)})

    def answer(own: pa.Table, found: pa.Table) -> pa.Table:
        words, out = found["word"].combine_chunks(), []
        some, ids = ragged(found["ids"])
        first = np.cumsum(some) - some
        for data in own["words"].to_pylist():
            at = pc.index_in(unpacked_words(data), words).to_numpy()
            n = some[at]
            ends = np.r_[0, np.cumsum(n)]
            out.append(packed(np.r_[len(n), n, ids[np.repeat(first[at] - ends[:-1], n) + np.arange(ends[-1])]]))
        return pa.table({"of": own["of"], "bucket": own["bucket"], "ids": pa.array(out, pa.binary())})

    # words stand by bucket from here on: edges never move, and the lists meet them on the same exchange
    words = lists.groupBy("bucket").applyInArrow(distinct, "bucket int, words array<string>").repartition(parts, "bucket") \
        .select("bucket", F.explode("words").alias("word"))
    with settings(spark, EDGE_LISTS):
        found = cut(lists.groupBy("bucket").cogroup(segment(words, pieces, ["bucket", "word"]).groupBy("bucket"))
                    .applyInArrow(answer, "of long, bucket int, ids binary"), "parts")

    def join(own: pa.Table, rest: pa.Table) -> pa.Table:
        if not len(own):
            return done(pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32())),
                                  "text_sha256": pa.array([], pa.string())}))
        back = [unpacked(data) for data in rest.sort_by("bucket")["ids"].to_pylist()]  # the order of the chunk's words
        all_counts = np.concatenate([counts, *[b[1:1 + b[0]] for b in back]])
        all_ids = np.concatenate([flat, *[b[1 + b[0]:] for b in back]])
        first = np.cumsum(all_counts) - all_counts
        at = unpacked(own["numbers"][0].as_py())
        ends = np.r_[0, np.cumsum(all_counts[at])]
        ids = all_ids[np.repeat(first[at] - ends[:-1], all_counts[at]) + np.arange(ends[-1])]
        sizes = own["sizes"][0].values.to_numpy()
        last = ends[np.r_[0, np.cumsum(sizes)]].astype(np.int32)
        digests = own["digests"][0].as_py().hex()
        return done(pa.table({"doc_id": own["doc_id"][0].values,
                              "ids": pa.ListArray.from_arrays(pa.array(last), pa.array(ids, pa.int32())),
                              "text_sha256": pa.array([digests[i:i + 64] for i in range(0, len(digests), 64)], pa.string())}))

    def done(rows: pa.Table) -> pa.Table:
        rows = finish(rows, pieces) if finish else rows
        give_back()
        return rows

    return chunks.select("chunk", "doc_id", "sizes", "digests", "numbers").groupBy("chunk") \
        .cogroup(found.groupBy("of")).applyInArrow(join, more or "doc_id long, ids array<int>, text_sha256 string")


def ragged(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of lists of ids, and all ids end to end."""
    return (pc.list_value_length(lists).to_numpy().astype(np.int64), pc.list_flatten(lists).to_numpy().astype(np.int32))


def texts_of(ids: pa.ListArray, pieces: Pieces, most: int = 200_000) -> list[bytes]:
    """``pieces.decode`` of some rows at a time, about ``most`` ids together."""
    ends, out, i = ids.offsets.to_numpy(), [], 0
    while i < len(ids):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, "right")) - 1)
        out += pieces.decode(ids.slice(i, j - i))
        i = j
    return out


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", passing: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, <passing>, text`` of rows with ``ids``. A literal space mark in a text comes back as a space."""
    bounded_batches(encoded.sparkSession, 2 << 20)
    pieces = Pieces(model)
    keep = [id_col, *passing]

    def run(batches):
        for batch in batches:
            texts = [t.decode("utf-8", "replace") for t in pieces.decode(batch.column("ids"))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string())],
                                             names=[*keep, "text"])

    schema = ", ".join([f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep] + ["text string"])
    return encoded.select(*dict.fromkeys([*keep, "ids"])).mapInArrow(run, schema)


def encode_with_text(docs: DataFrame, model: str, **options) -> DataFrame:
    """``doc_id, ids, n_pieces, text_sha256, text``: the ids and what they decode to.

    A literal space mark in a text comes back as a space.
    """
    def finish(rows: pa.Table, pieces: Pieces) -> pa.Table:
        ids = rows["ids"].combine_chunks()
        texts = [t.decode("utf-8", "replace") for t in texts_of(ids, pieces)]
        return pa.table({"doc_id": rows["doc_id"], "ids": ids, "n_pieces": pc.list_value_length(ids).cast(pa.int64()),
                         "text_sha256": rows["text_sha256"], "text": pa.array(texts, pa.string())})

    return encode(docs, model, finish=finish, more="doc_id long, ids array<int>, n_pieces long, text_sha256 string, text string",
                  **options)


def encode_and_decode(docs: DataFrame, model: str, **options) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, decoded_sha256, round_trip`` of every document's ids and decoded text."""
    def finish(rows: pa.Table, pieces: Pieces) -> pa.Table:
        ids = rows["ids"].combine_chunks()
        ends = ids.offsets.to_numpy()
        flat = np.ascontiguousarray(ids.values.to_numpy(), dtype="<u4")
        crc = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        back = [hashlib.sha256(t).hexdigest() for t in texts_of(ids, pieces)]
        same = [a == b for a, b in zip(back, rows["text_sha256"].to_pylist(), strict=True)]
        return pa.table({"doc_id": rows["doc_id"], "n_pieces": pa.array(np.diff(ends), pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                         "decoded_sha256": pa.array(back, pa.string()), "round_trip": pa.array(same, pa.bool_())})

    return encode(docs, model, finish=finish,
                  more="doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean", **options)
