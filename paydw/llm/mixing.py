"""Operator 1: mixing sources to target weights by Sainte-Laguë apportionment.

Every source has a target in words. Equal-token blocks are allocated to sources
by highest quotients, each source's blocks to its bins and shards in the same
way, and within a shard a seeded choice of blocks fills its integer quota. A
document takes the words of its chosen blocks, repeats counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paydw.llm.common import WORD, cut, let

WEIGHTS = (3, 1, 2)


def size_of(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def whole(a: Column, b: Column) -> Column:
    """a divided by b without the remainder, in whole numbers."""
    return F.call_function("div", a, b)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = 150, most: int = 2) -> DataFrame:
    """``target`` of each row of ``sources (source, source_size)``, one row a source.

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``share`` percent of all sizes; a target stops at ``most`` times its
    source's size and the excess goes to the others by weight. With sources in
    the order of size over weight the ones that stop come first, so a running
    sum finds them. Windows here run over one row a source.
    """
    w = Window.orderBy(F.asc_nulls_last(F.col("source").cast("binary")))
    weight = F.element_at(F.array(*[F.lit(x) for x in weights]),
                          ((F.row_number().over(w) - 1) % len(weights) + 1).cast("int"))
    full = 1
    for x in set(weights):
        full *= x
    df = sources.withColumn("weight", weight)
    order = Window.orderBy(F.col("source_size") * (F.lit(full) / F.col("weight")).cast("long"),
                           F.asc_nulls_last(F.col("source").cast("binary")))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    # all in hundredths of words: what is left for this source and those behind it
    df = df.withColumn("left", F.lit(share) * F.sum("source_size").over(every)
                       - F.lit(100 * most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) \
        .withColumn("sharing", F.sum("weight").over(onward))
    df = df.withColumn("stops", F.col("left") * F.col("weight") > 100 * most * F.col("source_size") * F.col("sharing"))
    first = F.struct((~F.col("stops")).alias("open"), "sharing", "left")
    df = df.withColumn("rate", F.max(first).over(every))
    return df.select("source", "source_size", F.when(F.col("stops"), (most * F.col("source_size")).cast("double"))
                     .otherwise((F.col("rate.left") * F.col("weight")).cast("double")
                                / (100 * F.col("rate.sharing")).cast("double")).alias("target"))


def apportion(df: DataFrame, within: list[str], key: list[Column], votes: str, seats: str, out: str) -> DataFrame:
    """Seats of each row by Sainte-Laguë: the highest of votes / (2 k + 1), k = 0, 1, ..., win.

    ``df`` has one row a party; ``seats`` is the same for all parties of a
    group ``within``. Seats that are sure are given at once: with V votes, S
    seats and n parties, rounding votes / (V / (S - n)) never gives more than
    S. At most 3 n / 2 seats are left; a party wins at most
    votes * 5 n / (2 V) + 1 of those, so about 4 n quotients are ranked.
    Ties go by ``key``.
    """
    group = Window.partitionBy(*within)
    df = df.withColumn("_v", F.sum(votes).over(group)).withColumn("_n", F.count(F.lit(1)).over(group))
    sure = F.when((F.col("_v") > 0) & (F.col(seats) > F.col("_n")),
                  F.floor(F.col(votes) / (F.col("_v") / (F.col(seats) - F.col("_n"))) + 0.5)).otherwise(F.lit(0))
    df = df.withColumn("_sure", sure.cast("long"))
    df = df.withColumn("_left", F.col(seats) - F.sum("_sure").over(group))
    more = F.least(F.col("_left"), F.ceil(F.col(votes) * (F.col("_left") + F.col("_n")) / F.col("_v")) + 1).cast("int")
    tried = df.withColumn("_k", F.explode_outer(F.when(
        (F.col("_v") > 0) & (F.col(votes) > 0) & (F.col("_left") > 0), F.sequence(F.lit(0), more - 1))))
    rank = F.row_number().over(Window.partitionBy(*within).orderBy(
        F.desc_nulls_last(F.col(votes) / (2 * (F.col("_sure") + F.col("_k")) + 1)), *key, "_k"))
    won = tried.withColumn("_won", ((rank <= F.col("_left")) & F.col("_k").isNotNull()).cast("long"))
    keep = [c for c in df.columns if c not in ("_v", "_n", "_sure", "_left")]
    return won.groupBy(*[F.col(c) for c in keep], "_sure").agg(F.sum("_won").alias("_won")) \
        .withColumn(out, F.col("_sure") + F.col("_won")).drop("_sure", "_won")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = 150, most: int = 2, seed: int = 11,
        block_words: int = 16, shard_words: int = 250_000, bin_shards: int = 1024, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", passing: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, copies, extra`` for every row of ``docs``.

    ``taken`` counts ``copies`` times the whole text and, once more, the words
    in the ranges ``extra`` (first word from 0, end exclusive).

    Null texts have size 0 and take nothing; null sources are one source;
    repeated rows count and are taken like any other. A source's documents are
    dealt to shards of about ``shard_words`` words by the seeded hash of their
    id and stand there in seeded order; a shard's words are cut into equal
    blocks of about ``block_words``. Quotas go from all blocks to sources, to
    bins of at most ``bin_shards`` shards, to shards. A quota of q blocks in a
    shard of n takes every block q div n times and q mod n of them, chosen by
    a seeded affine permutation, once more. No block is taken more than
    ``most`` times, so no document exceeds ``most`` times its size.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))

    def part(col, a, n):  # n hex digits of a hash as a number
        return F.conv(F.substring(col, a, n), 16, 10).cast("long")

    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                           size_of(F.col(text_col)).alias("size"), key.alias("h"), *passing)
               .select("doc_id", "source", "size", part(F.col("h"), 1, 15).alias("h"),
                       part(F.col("h"), 16, 12).alias("g"), *passing), "sizes")
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    # the targets add up to this share of all sizes; in whole numbers it does not depend on the order of a sum
    total = F.sum("source_size").over(Window.partitionBy()) * min(share, 100 * most)
    goals = goals.withColumn("seats", whole(total + 50 * block_words, F.lit(100 * block_words)))
    goals = apportion(goals, [], [F.asc_nulls_last(F.col("source").cast("binary"))], "target", "seats", "quota") \
        .withColumn("n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")) \
        .select("source", "source_size", "target", "quota", "n_shards")
    goals = cut(goals, "goals")

    same = rows["source"].eqNullSafe(goals["source"])
    placed = rows.join(goals, same, "left").select(
        "doc_id", rows["source"], "size", "h", "source_size", "target",
        (F.col("g") % F.col("n_shards")).alias("shard"), *passing)
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    shards = shards.withColumn("bin", F.floor(F.col("shard") / bin_shards)) \
        .withColumn("n", F.greatest(F.lit(1), F.round(F.col("words") / block_words)).cast("long"))
    bins = shards.groupBy("source", "bin").agg(F.sum("words").alias("bin_words"))
    bins = bins.join(goals, bins["source"].eqNullSafe(goals["source"])).select(bins["source"], "bin", "bin_words", "quota")
    bins = apportion(bins, ["source"], [F.col("bin")], "bin_words", "quota", "bin_quota") \
        .select(F.col("source").alias("s"), F.col("bin").alias("b"), "bin_quota")
    quotas = shards.join(bins, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))).drop("s", "b")
    quotas = cut(apportion(quotas, ["source", "bin"], [F.col("shard")], "words", "bin_quota", "q")
                 .select(F.col("source").alias("s"), F.col("shard").alias("d"), "words", "n", "q"), "quotas")

    order = Window.partitionBy("source", "shard").orderBy("h", "doc_id", "size")
    ends = placed.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    df = ends.join(quotas, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("d")), "left")
    # block j of n holds the words [j * words div n, (j + 1) * words div n)
    df = df.withColumn("start", F.col("end") - F.col("size")) \
        .withColumn("q", F.least("q", most * F.col("n"))) \
        .withColumn("base", F.floor(F.col("q") / F.col("n"))).withColumn("extra", F.col("q") % F.col("n"))
    words = F.greatest("words", F.lit(1))
    first, last = whole(F.col("start") * F.col("n"), words), whole((F.col("end") - 1) * F.col("n"), words)

    def chosen(j):  # an affine permutation of 0 .. n-1: the prime step shares no factor with a smaller n
        return (j * F.lit(999_999_937) + (F.col("shard") + 1) * F.lit(7_368_787 + seed)) % F.col("n") < F.col("extra")

    def span(j):  # the words of block j in this document, counted from its own first word
        low = F.greatest(whole(j * F.col("words"), F.col("n")), F.col("start")) - F.col("start")
        high = F.least(whole((j + 1) * F.col("words"), F.col("n")), F.col("end")) - F.col("start")
        return F.struct(low.cast("long").alias("first"), high.cast("long").alias("end"))

    near = F.sequence(F.greatest(F.lit(0).cast("long"), first - 1), F.least(F.col("n") - 1, last + 1))
    spans = F.filter(F.transform(F.filter(near, chosen), span), lambda s: s["end"] > s["first"])
    df = df.withColumn("extra", F.when((F.col("extra") > 0) & (F.col("size") > 0), spans)
                       .otherwise(F.array().cast("array<struct<first:bigint,end:bigint>>")))
    more = F.aggregate("extra", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    return df.select("doc_id", "source", "size", "source_size", "target",
                     (F.col("base") * F.col("size") + more).cast("long").alias("taken"),
                     F.col("base").cast("int").alias("copies"), "extra", *passing)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          **options) -> DataFrame:
    """The mix itself: ``docs`` with a row for each whole copy of a text and one for its extra blocks.

    All columns are kept. A text of extra blocks keeps the white space behind
    its words. Rows of which nothing is taken go; so do texts without a word.
    Rows are matched by id, hash of text and source, and their number among equal rows.
    """
    none, null_id = F.lit(""), F.lit(-2**63)
    base = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"), F.col(source_col).alias("source")) \
        .withColumn("hash", F.xxhash64(F.coalesce("text", none), F.coalesce("source", none)))
    plan = mix(base, passing=("hash",), **options)
    plan = plan.select(F.coalesce("doc_id", null_id).alias("key"), "hash", "copies", "extra") \
        .withColumn("nr", F.row_number().over(Window.partitionBy("key", "hash").orderBy("copies", "extra")))
    rows = base.select(F.coalesce("doc_id", null_id).alias("key"), "hash", "row", "text") \
        .withColumn("nr", F.row_number().over(Window.partitionBy("key", "hash").orderBy(F.lit(1)))) \
        .join(plan, ["key", "hash", "nr"])
    words = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), 0)
    blocks = let(words, lambda w: F.array_join(F.flatten(F.transform("extra", lambda s: F.slice(
        w, (s["first"] + 1).cast("int"), (s["end"] - s["first"]).cast("int")))), ""))
    texts = F.concat(F.array_repeat(F.col("text"), F.col("copies")),
                     F.when(F.size("extra") > 0, F.array(blocks)).otherwise(F.array().cast("array<string>")))
    rows = rows.select("row", F.explode(texts).alias("taken")).where(F.col("taken").rlike(WORD))
    return rows.select(*[F.col("taken").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                         for c in docs.columns])
