"""Operator 8: n-gram Jaccard join with rare-first prefix filtering.

Word n-grams are hashed to 64 bits. Every set is ordered rare-first; two sets
that are similar enough share an n-gram within short prefixes of that order, so
prefixes are joined on their n-grams. Length, positional and suffix filters act
inside that join, the pairs that are left are verified once on the whole sets,
and links are closed to components. Equal sets are one set from the start.

Dense groups are not expanded: first every prefix n-gram joins its rows with
one pivot only, and what that links is one component; then only rows of
different components are joined, which loses no link between components. For
the number of links, all sets of a component are compared afterwards, block by
block, so that pairs are counted where they are compared and never written.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paydw.llm.common import bounded_batches, components, cut, give_back, in_buckets
from paydw.llm.token_files import text_slices

BITS = 16  # n-gram counts are kept for 2 ** BITS hash buckets
BLOCK = 512  # sets of a component that are compared with as many others at once
BLOCK_GRAMS = 1 << 20  # and about how many n-grams they have
KEY = ["nameless", "k", "t1", "t2"]  # a row by its id and text


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, words: int) -> list[np.ndarray]:
    """A sorted array of distinct hashed n-grams for each text: A-Z lower-cased, cut at ASCII white space.

    Words are hashed once for all texts of the call. A text of fewer than
    ``words`` words has one n-gram, its whole sequence.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    ends = lists.offsets.to_numpy().astype(np.int64)
    ends -= ends[0]
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves empty words
    before = np.r_[0, np.cumsum(filled)]
    ends = before[ends]
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), dtype=np.uint64,
                         count=len(coded.dictionary))
    h = hashes[coded.indices.to_numpy()] if len(hashes) else np.zeros(0, np.uint64)
    gram = h[:max(len(h) - words + 1, 0)].copy()
    for k in range(1, words):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + h[k:k + len(gram)]
    gram = mixed(gram)
    out = []
    for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if j - i >= words:
            out.append(np.unique(gram[i:j - words + 1]))
        else:
            one = h[i:j] * np.arange(3, 3 + 2 * (j - i), 2, dtype=np.uint64)
            out.append(mixed(one.sum(keepdims=True) + np.uint64(j - i)) if j > i else h[:0])
    return out


def key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """The columns ``KEY``, never null: whether a row has no id, its id, two hashes of its text (null as empty)."""
    own, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    return [own.isNull().alias("nameless"), F.coalesce(own, F.lit(0)).alias("k"), F.xxhash64(text).alias("t1"),
            F.xxhash64(F.lit("second"), text).alias("t2")]


def read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(*key(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def bucket_counts(rows: DataFrame, words: int, buffer_bytes: int = 4_000_000) -> np.ndarray:
    """In how many texts the n-grams of each hash bucket occur, over all texts.

    Each task adds up its own texts and sends one row a bucket; the sums are
    ``2 ** BITS`` numbers, whatever the input.
    """
    def run(batches):
        total = np.zeros(1 << BITS, dtype=np.int64)
        for batch in batches:
            texts = batch.column("text")
            for i, j in text_slices(texts, buffer_bytes):
                grams = np.concatenate(shingles(texts.slice(i, j - i), words))
                total += np.bincount((grams & np.uint64((1 << BITS) - 1)).astype(np.int64), minlength=1 << BITS)
        give_back()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())],
                                         names=["bucket", "n"])

    sums = rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << BITS, dtype=np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def parity_bits(grams: np.ndarray) -> np.ndarray:
    """Parities of how many n-grams fall in each of 2 n to 4 n hash buckets (a power of two), as 64-bit words.

    Two such bitmaps differ in at most as many bits as the sets differ in
    n-grams. Folding the halves of one over each other gives the bitmap of half the size.
    """
    m = max(128, 1 << int(2 * len(grams) - 1).bit_length()) if len(grams) else 128
    bits = np.bincount((grams & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def prefix_rows(rows: DataFrame, words: int, percent: int, counts: np.ndarray, buffer_bytes: int = 4_000_000) -> DataFrame:
    """A row for each text: set size, 128-bit digest of the set, parity bits (all, and folded to 128) and rare-first prefix."""
    signed = np.int64

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            for i, j in text_slices(texts, buffer_bytes):
                out = [[] for _ in range(7)]
                for grams in shingles(texts.slice(i, j - i), words):
                    n = len(grams)
                    short = n - -(-percent * n // 100) + 1 if n else 0
                    bits = parity_bits(grams)
                    p = folded(bits, 2)
                    often = counts[(grams & np.uint64((1 << BITS) - 1)).astype(np.int64)]
                    order = np.argsort(often, kind="stable")[:short]  # equally rare ones by their hash
                    for column, value in zip(out, (n, grams.sum(dtype=np.uint64).astype(signed),
                                                   np.bitwise_xor.reduce(mixed(grams)).astype(signed) if n else 0,
                                                   p[0], p[1], bits, grams[order].astype(signed)), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, j - i) for c in KEY], *[pa.array(c, pa.int64()) for c in out[:5]],
                     *[pa.array(c, pa.list_(pa.int64())) for c in out[5:]]],
                    names=[*KEY, "n", "d1", "d2", "p1", "p2", "bits", "prefix"])
        give_back()

    return rows.mapInArrow(run, "nameless boolean, k long, t1 long, t2 long, n long, d1 long, d2 long, p1 long, p2 long, "
                                "bits array<bigint>, prefix array<bigint>")


def needed(n, m, percent: int) -> Column:
    """The least size of the intersection of similar sets of sizes n and m."""
    n, m = (F.col(x) if isinstance(x, str) else x for x in (n, m))
    return F.ceil((n + m) * percent / (100 + percent))


def possible(percent: int, n, m, i, j, p1, q1, p2, q2) -> Column:
    """Whether two sets that share an n-gram at places i and j can be similar: the three filters."""
    need = needed(n, m, percent)
    length = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    positional = F.least(n - i, m - j) >= need
    # suffix: an n-gram in one set only flips a parity bit, so bits that differ bound the difference from below
    suffix = F.bit_count(p1.bitwiseXOR(q1)) + F.bit_count(p2.bitwiseXOR(q2)) <= n + m - 2 * need
    return length & positional & suffix


def differing(a: Column, b: Column) -> Column:
    """In how many bits two parity bitmaps differ; the larger is folded to the smaller one's size (half, as sizes are near)."""
    def half(x):
        n = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), n), F.slice(x, n + 1, n), lambda p, q: p.bitwiseXOR(q))

    a, b = F.when(F.size(a) > F.size(b), half(a)).otherwise(a), F.when(F.size(b) > F.size(a), half(b)).otherwise(b)
    return F.when(F.size(a) == F.size(b), F.aggregate(
        F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, x: s + x)).otherwise(F.lit(0))


def texts_of(rows: DataFrame, classes: DataFrame, reps: DataFrame) -> DataFrame:
    """``rep, text`` of the representatives in ``reps``, one row each."""
    firsts = cut(classes.select("rep", "first.*").join(reps, "rep", "left_semi"), "firsts")
    return in_buckets(rows, firsts, "t1").join(firsts, KEY).dropDuplicates(["rep"]).select("rep", "text")


def verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar.

    Whole bitmaps rule out most of the others first; sets are made only of the
    texts of pairs that are left, and compared once a pair.
    """
    maps = sets.select("rep", "n", "bits")
    near = pairs.join(maps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x")), "a") \
        .join(maps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y")), "b") \
        .where(differing(F.col("x"), F.col("y")) <= F.col("na") + F.col("nb") - 2 * needed("na", "nb", percent))
    pairs = cut(near.select("a", "b"), "near")
    few = texts_of(rows, classes, pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct())

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            for i, j in text_slices(texts, 4_000_000):
                grams = [g.astype(np.int64) for g in shingles(texts.slice(i, j - i), words)]
                yield pa.RecordBatch.from_arrays([batch.column("rep").slice(i, j - i), pa.array(grams, pa.list_(pa.int64()))],
                                                 names=["rep", "grams"])

    whole = cut(few.mapInArrow(run, "rep long, grams array<bigint>"), "sets")
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(whole.select(F.col("rep").alias("a"), F.col("grams").alias("x")), "a")
            .join(whole.select(F.col("rep").alias("b"), F.col("grams").alias("y")), "b")
            .where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b"))


def alike(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which sets numbered in ``left`` (rows) and ``right`` (columns) are similar; a set is not its own pair."""
    n = np.array([len(g) for g in sets])
    grams, code = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(code, minlength=len(grams)) > 1  # the others are in no intersection
    place = np.cumsum(often) - 1
    some = often[code]
    owner, code = np.repeat(np.arange(len(sets)), n)[some], place[code[some]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    both = np.zeros((len(left), len(right)), dtype=np.int64)
    wide = 4096  # n-grams at once: sums of so many ones are exact in 32-bit floats
    for lo in range(0, int(often.sum()), wide):
        i, j = np.searchsorted(code, (lo, lo + wide))
        has = np.zeros((len(sets), wide), dtype=np.float32)
        has[owner[i:j], code[i:j] - lo] = 1
        both += (has[left] @ has[right].T).astype(np.int64)
    out = 100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)
    return out & (left[:, None] != right[None, :])


def link_counts(found: DataFrame, classes: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """``rep, more``: how many documents with other sets link with a representative.

    ``found`` has the component of each representative that has links and
    ``classes`` how many documents share its set. Links lie inside
    components, so the sets of a component are dealt to blocks, and every two
    blocks meet once in a task that compares each pair of whole sets and gives
    one sum a set: no row is made for a pair, however dense the component.
    """
    members = cut(found.join(classes, F.col("node") == F.col("rep")).select("rep", "component", "size", "n"), "members")
    blocks = members.groupBy("component").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    dealt = members.join(blocks, "component").withColumn("own", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    texts = texts_of(rows, classes, members.select("rep"))
    meet = dealt.join(texts, "rep") \
        .select("rep", "component", "size", "own", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")) \
        .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "size", "text") \
        .repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")

    def counted(i, j, group):
        own, rep, size = (np.array([x[k] for x in group]) for k in range(3))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        if not len(left) or not len(right):
            return []
        links = alike([x[3] for x in group], left, right, percent).astype(np.int64)
        sums = [(rep[left], links @ size[right])]
        if i != j:
            sums.append((rep[right], size[left] @ links))
        return sums

    def run(batches):
        key, group = None, []
        for batch in batches:
            texts, sums = batch.column("text"), []
            for lo, hi in text_slices(texts, 4_000_000):
                part = batch.slice(lo, hi - lo)
                columns = [part.column(c).to_pylist() for c in ("component", "i", "j", "own", "rep", "size")]
                for *at, own, rep, size, grams in zip(*columns, shingles(part.column("text"), words), strict=True):
                    if at != key:
                        if group:
                            sums += counted(key[1], key[2], group)
                        key, group = at, []
                    group.append((own, rep, size, grams))
            if sums:
                yield answer(sums)
        if group and (sums := counted(key[1], key[2], group)):
            yield answer(sums)
        give_back()

    def answer(sums):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in sums]), pa.int64()) for k in (0, 1)],
                                          names=["rep", "more"])

    return meet.mapInArrow(run, "rep long, more long").groupBy("rep").agg(F.sum("more").alias("more"))


def linked_sets(rows: DataFrame, words: int, percent: int, nameless: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows by ``KEY`` with their sets' digests, the distinct sets, and ``node, component`` of those that link.

    A distinct set has a number of its own (``rep``), whatever ids its rows
    have, its smallest row (``first``) and its number of ids (``size``). Rows
    without an id take part only if ``nameless``.
    """
    counts = bucket_counts(rows, words)
    sets = cut(prefix_rows(rows, words, percent, counts), "prefixes")  # bits and prefixes take about an eighth of the sets

    full = sets.where("n > 0" if nameless else "n > 0 and not nameless")
    classes = cut(full.groupBy("n", "d1", "d2").agg(F.min(F.struct(*KEY)).alias("first"), F.countDistinct("k").alias("size"))
                  .withColumn("rep", F.monotonically_increasing_id()), "classes")
    own = cut(full.join(classes.select("rep", "first.*"), KEY).dropDuplicates(["rep"])
              .select("rep", "n", "p1", "p2", "bits", "prefix"), "own")
    grams = own.select("rep", "n", "p1", "p2", F.posexplode("prefix").alias("pos", "gram"))
    shared = grams.groupBy("gram").count().where("count > 1").select("gram")
    index = cut(grams.join(shared, "gram"), "index")
    # a text whose prefix is mostly shared is the likely origin of its group: the best pivot
    rank = index.groupBy("rep").agg((F.first("n") * (100 - percent) - 100 * F.count(F.lit(1))).alias("own"))
    index = cut(index.join(rank, "rep"), "ranked")

    def filters():
        return possible(percent, F.col("l.n"), F.col("r.n"), F.col("l.pos"), F.col("r.pos"), F.col("l.p1"),
                        F.col("r.p1"), F.col("l.p2"), F.col("r.p2"))

    # each text meets the best pivot of its n-grams: one pair a text at most
    pivots = index.groupBy("gram").agg(F.min(F.struct("own", "rep", "n", "p1", "p2", "pos")).alias("p")) \
        .select("gram", "p.*")
    first = index.alias("l").join(pivots.alias("r"), (F.col("l.gram") == F.col("r.gram"))
                                  & (F.col("l.rep") != F.col("r.rep")) & filters()) \
        .groupBy(F.col("l.rep").alias("d")).agg(F.min(F.struct("r.own", "r.rep")).alias("p")) \
        .select(F.least("d", "p.rep").alias("a"), F.greatest("d", "p.rep").alias("b")).distinct()
    first = cut(first, "first")
    linked = cut(verified(first, own, rows, classes, words, percent), "links")
    found = components(linked)
    placed = cut(index.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                 .withColumn("component", F.coalesce("component", "rep")), "placed")
    second = placed.alias("l").join(placed.alias("r"), (F.col("l.gram") == F.col("r.gram"))
                                    & (F.col("l.rep") < F.col("r.rep"))
                                    & (F.col("l.component") != F.col("r.component")) & filters()) \
        .select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b")).distinct()
    second = cut(second.join(first, ["a", "b"], "left_anti"), "second")
    linked = linked.union(verified(second, own, rows, classes, words, percent))
    return sets, classes, components(linked)


def with_smallest(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``classes`` with the smallest row of each one's component (``least``)."""
    named = classes.join(found, F.col("rep") == F.col("node"), "left").withColumn("component", F.coalesce("component", "rep"))
    return named.join(named.groupBy("component").agg(F.min("first").alias("least")), "component")


def near_components(docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id",
                    text_col: str = "text", links: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``; with ``links`` also ``n_links``.

    ``n_links`` is the number of other documents that link with a row's text,
    all links inside the component counted.

    Two texts link when 100 * intersection >= percent * union of their n-gram
    sets; a component is named by its smallest id. Null and empty texts have
    no n-gram and link with nothing. Rows without an id link with nothing and
    have no component. Rows that share an id link by their own texts; those of
    equal sets are one document.
    """
    rows = read(docs, id_col, text_col)
    sets, classes, found = linked_sets(rows, words, percent, nameless=False)
    named = with_smallest(classes, found).withColumn("component_id", F.col("least.k"))
    if links:
        more = cut(link_counts(found, classes, rows, words, percent), "more")
        named = named.join(more, "rep", "left").withColumn("n_links", F.coalesce("more", F.lit(0)) + F.col("size") - 1)
    named = named.select("n", "d1", "d2", "component_id", *["n_links"] * links)
    return sets.select("n", "d1", "d2", F.when(~F.col("nameless"), F.col("k")).alias("doc_id")) \
        .join(named, ["n", "d1", "d2"], "left") \
        .select("doc_id", F.col("n").alias("n_shingles"),
                F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
                *[F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links")] * links)


def one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``docs`` with one row of each component of linked texts: the smallest by id (null is the largest), then by text hashes.

    Rows are told apart by id and text, so rows that share an id, or have none,
    stay or go by their own texts. Equal rows are one document; other texts
    without an n-gram all stay.
    """
    sets, classes, found = linked_sets(read(docs, "doc_id", "text"), words, percent, nameless=True)
    least = with_smallest(classes, found).select("n", "d1", "d2", "least")
    gone = cut(sets.select(*KEY, "n", "d1", "d2").join(least, ["n", "d1", "d2"])
               .where(F.struct(*KEY) != F.col("least")).select(*KEY).distinct(), "copies")
    row = F.struct(*docs.columns).alias("row")
    kept = docs.select(row, *key()).join(gone, KEY, "left_anti")
    again = cut(kept.groupBy(*KEY).count().where("count > 1").select(*KEY), "again")
    return kept.join(again, KEY, "left_anti").select("row.*").union(
        kept.join(again, KEY, "left_semi").dropDuplicates(KEY).select("row.*"))
