"""Operator 2: line dedup by a segment-partition edit join, in DataFrame functions only.

Lines within ``edits`` edits share one of ``edits + 1`` segments of the shorter
line, at a place that the lengths and the segment's number confine. Every
distinct line is indexed by its segments, probes the indexes of its own and
the next shorter lengths with the substrings at those places, and each pair
that meets is verified once by a banded bit-parallel edit distance.

Texts move only where they must: lines are cut into keys where they are read,
candidates are fetched by their hash, and documents that lose no line are
passed on as they are. Very common lines, at most ``2 ** HOT_BITS`` of them, are
known before and give keys only once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paydw.llm.common import cut, drop_tables, in_buckets, let

# Letters whose counts (modulo 4) make up a line's sketch.
COUNTED = "eanitsrohlducmgw"
BITS = 20
HOT_BITS = 18


def key_of(id_col: str, text_col: str) -> list[Column]:
    """``named, k, t1, t2``, a document: whether it has an id, the id, two hashes of the text. A null id counts as the smallest."""
    own = F.col(id_col).cast("long")
    return [own.isNotNull().alias("named"), F.coalesce(own, F.lit(0)).alias("k"), F.xxhash64(text_col).alias("t1"),
            F.xxhash64(F.lit("second"), F.col(text_col)).alias("t2")]


DOC = ["named", "k", "t1", "t2"]
PLACE = [*DOC, "pos"]


def lines_of(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """``named, k, t1, t2, pos, line, n, h1, h2`` of every line of at least ``least`` characters."""
    lines = docs.select(*key_of(id_col, text_col), F.col(text_col).alias("text")) \
        .select(*DOC, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return lines.withColumn("n", F.length("line")).where(F.col("n") >= least).select(
        *PLACE, "line", "n", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))


def sketched(lines: DataFrame) -> DataFrame:
    """``h1, line, n, s``: with s, counts of sixteen letters of ``line`` modulo 4, two bits each.

    A letter is counted by taking it out; the next is taken out of what is left.
    """
    rows = lines.select("h1", "line", "n", F.col("line").alias("r0"))
    for k, c in enumerate(COUNTED):
        rows = rows.withColumn(f"r{k + 1}", F.replace(f"r{k}", F.lit(c), F.lit("")))
    out = F.lit(0)
    for k in range(len(COUNTED)):
        n = F.octet_length(f"r{k}") - F.octet_length(f"r{k + 1}")
        out = out.bitwiseOR(F.shiftleft(n.bitwiseAND(3), 2 * k))
    return rows.select("h1", "line", "n", out.alias("s"))


def sketch_distance(a: Column, b: Column) -> Column:
    """What two sketches differ by; an edit changes it by 2 at most."""
    out = F.lit(0)
    for k in range(len(COUNTED)):
        d = F.abs(F.shiftrightunsigned(a, 2 * k).bitwiseAND(3) - F.shiftrightunsigned(b, 2 * k).bitwiseAND(3))
        out = out + F.least(d, F.lit(4) - d)
    return out


def places(edits: int, probe: bool) -> list[tuple[int, int, int]]:
    """(d, i, move): what to look for in a line, segment i of a line d characters shorter, moved by so much.

    For the index that is each of the line's own segments. Segment i of a
    similar line stands at most i places from its own place, or else too many
    edits lie to its left, and at most ``edits - i`` places from there moved by
    d, or else too many lie to its right.
    """
    if not probe:
        return [(0, i, 0) for i in range(edits + 1)]
    return [(d, i, move) for d in range(edits + 1) for i in range(edits + 1)
            for move in range(max(-i, d - (edits - i)), min(i, d + (edits - i)) + 1)]


def keyed(lines: DataFrame, edits: int, probe: bool) -> DataFrame:
    """``h1, s, key``: a row for each place of ``lines (h1, line, n, s)``; equal keys are equal substrings of equal rank.

    Lines are cut as UTF-32, in which a character's place is known without reading what is before it.
    They are cut so before they are spread over their places, and places are computed from rows, which keeps
    the generated code short enough to be compiled.
    """
    spots = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(i).alias("i"), F.lit(m).alias("move"))
                      for d, i, m in places(edits, probe)])
    rows = lines.select("h1", "s", F.encode("line", "UTF-32").alias("line"), "n") \
        .select("h1", "s", "line", F.col("n").alias("own"), F.explode(spots).alias("p")) \
        .select("h1", "s", "line", "own", (F.col("own") - F.col("p.d")).alias("n"), "p.i", "p.move")
    rows = rows.select("h1", "s", "line", "own", "n", "i", F.expr(f"int(n * i div {edits + 1})").alias("start"),
                       F.expr(f"int(n * (i + 1) div {edits + 1})").alias("end"), "move")
    return rows.where("start + move >= 0 and end + move <= own").select(
        "h1", "s", F.xxhash64("n", "i", F.expr("substring(line, (start + move) * 4 + 1, (end - start) * 4)")).alias("key"))


def trimmed(a: Column, b: Column) -> Column:
    """Texts ``a`` and ``b`` without most of what they have in common at both ends; their distance stays."""
    def step(s, part):
        size = F.floor(F.least(F.length(s["a"]), F.length(s["b"])) / F.abs(part)).cast("int")
        front = part > 0
        same = F.when(front, F.left(s["a"], size) == F.left(s["b"], size)) \
            .otherwise(F.right(s["a"], size) == F.right(s["b"], size))

        def rest(x):
            return F.when(~same, x).when(front, F.substr(x, size + 1)).otherwise(F.left(x, F.length(x) - size))

        return F.struct(rest(s["a"]).alias("a"), rest(s["b"]).alias("b"))

    parts = F.array(*[F.lit(x) for p in (2, 2, 4, 4, 8, 8) for x in (p, -p)])
    return F.aggregate(parts, F.struct(a.alias("a"), b.alias("b")), step)


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts are within ``edits`` edits: bit-parallel, in a band of diagonals.

    Bit d + edits of state k: k edits turn the characters of ``b`` read so far
    into as many characters of ``a`` plus d. Reading one more character keeps
    the diagonals where it matches; an edit keeps a diagonal (substitution) or
    moves it down (insertion) or up (deletion). All of a state's diagonals move at once.
    """
    every = (1 << (2 * edits + 1)) - 1
    start = F.struct(*[F.lit(sum(1 << (edits + d) for d in range(k + 1))).alias(f"r{k}") for k in range(edits + 1)])
    edge = F.array_repeat(F.lit(""), edits)  # before the first character nothing matches, behind the last there is none

    def step_over(x):
        def step(state, j):
            char, match = F.get(x["b"], j), None
            for d in range(2 * edits + 1):
                bit = F.when(F.get(x["a"], j + d) == char, F.lit(1 << d)).otherwise(F.lit(0))
                match = bit if match is None else match + bit
            return let(match, lambda m: states(state, m))
        return step

    def states(state, match):
        new = [state["r0"].bitwiseAND(match)]
        for k in range(1, edits + 1):
            old = state[f"r{k - 1}"]
            new.append(state[f"r{k}"].bitwiseAND(match).bitwiseOR(old).bitwiseOR(F.shiftright(old, 1))
                       .bitwiseOR(F.shiftleft(new[-1], 1)).bitwiseAND(every))
        return F.struct(*[x.cast("int").alias(f"r{k}") for k, x in enumerate(new)])

    def reached(x):
        end = F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(x["b"]) - 1, F.lit(0))), start, step_over(x))[f"r{edits}"]
        gap = F.size(x["a"]) - 2 * edits - F.size(x["b"])
        place = F.call_function("shiftright", end, F.greatest(gap, F.lit(-edits)) + edits)
        return F.when(F.size(x["b"]) == 0, F.abs(gap) <= edits).otherwise((F.abs(gap) <= edits) & (place.bitwiseAND(1) == 1))

    def chars(x):
        return F.when(F.length(x) > 0, F.split(x, "")).otherwise(F.array().cast("array<string>"))

    return let(trimmed(a, b), lambda s: let(
        F.struct(F.concat(edge, chars(s["a"]), edge).alias("a"), chars(s["b"]).alias("b")), reached))


def repeated_lines(docs: DataFrame, edits: int = 2, least: int = 20, id_col: str = "doc_id",
                   text_col: str = "text", made: list[str] | None = None) -> DataFrame:
    """``named, k, t1, t2, pos``: the lines that go, by document and place (from 0).

    Lines stand in the order of document id, hashes of the text and place. A
    line goes if an earlier line equals it or is within ``edits`` edits of it;
    lines of fewer than ``least`` characters always stay. Rows of the same id
    and text, a null id too, count as one document; other rows never do.
    ``made`` receives the paths of the tables that the result is read from.
    """
    lines = lines_of(docs, id_col, text_col, least)
    short = cut(lines.select(*PLACE, "h1", "h2"), "lines", made)
    classes = cut(short.groupBy("h1", "h2").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n")),
                  "classes", made)
    # lines with more than 1 / 2 ** HOT_BITS of all occurrences: fewer than 2 ** HOT_BITS, whatever the input
    hot = classes.where(F.col("n") > short.count() / 2 ** HOT_BITS) \
        .select("h1", "h2", "first")
    some = lines.join(F.broadcast(hot), ["h1", "h2"], "left").where(F.col("first").isNull() | (F.col("first") == F.struct(*PLACE)))
    once: list[str] = []
    some = cut(sketched(some), "sketched", once)  # read twice: for the index and for the probes
    # a line that still comes more than once is indexed once; its probes then meet it once each
    index = keyed(some, edits, False).repartition("key").dropDuplicates(["key", "h1"])
    probe = keyed(some, edits, True).select(F.col("h1").alias("g1"), F.col("s").alias("s2"), F.col("key").alias("key2"))
    met = index.join(probe, (F.col("key") == F.col("key2")) & (F.col("h1") != F.col("g1"))
                     & (sketch_distance(F.col("s"), F.col("s2")) <= 2 * edits))
    pairs = cut(met.select(F.least("h1", "g1").alias("a"), F.greatest("h1", "g1").alias("b")).distinct(), "pairs", made)
    drop_tables(docs.sparkSession, once)

    # a candidate's text is fetched from its first place alone, however often the line comes
    ids = pairs.select(F.col("a").alias("h1")).union(pairs.select("b")).distinct()
    firsts = cut(classes.join(ids, "h1", "left_semi").select("h1", "h2", "first.*", F.xxhash64("h1", "first").alias("at")),
                 "firsts", made)
    spot = ["h1", "h2", *PLACE]
    texts = in_buckets(lines.withColumn("at", F.xxhash64("h1", F.struct(*PLACE))), firsts, "at", BITS) \
        .groupBy(*spot).agg(F.first("line").alias("line")).join(firsts, spot) \
        .select("h1", "h2", "line", F.struct(*PLACE).alias("first"))
    texts = cut(texts, "candidates", made)

    def side(name, end):
        return texts.select(F.col("h1").alias(name), F.col("h2").alias(f"h2{end}"), F.col("line").alias(f"c{end}"),
                            F.col("first").alias(f"f{end}"))

    same = pairs.join(side("a", "a"), "a").join(side("b", "b"), "b") \
        .where(within_edits(F.col("ca"), F.col("cb"), edits))
    later = F.col("fa") < F.col("fb")  # whether b comes behind a
    near = same.select(F.when(later, F.col("b")).otherwise(F.col("a")).alias("h1"),
                       F.when(later, F.col("h2b")).otherwise(F.col("h2a")).alias("h2")) \
        .distinct().withColumn("near", F.lit(True))
    bad = cut(classes.join(near, ["h1", "h2"], "left").where("n > 1 or near")
              .select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")), "bad", made)
    where = in_buckets(short, bad, "h1", BITS)
    return where.join(bad, ["h1", "h2"]).where(F.col("near") | (F.col("first") != F.struct(*PLACE))).select(*PLACE)


def dedup_lines(docs: DataFrame, edits: int = 2, least: int = 20, id_col: str = "doc_id",
                text_col: str = "text", dropped_col: str = "_dropped") -> DataFrame:
    """``docs`` without repeated lines, all columns kept, and ``dropped_col``: how many lines each lost.

    See ``repeated_lines`` for the lines that go. The others stay joined by
    line ends; a text that loses all its lines is empty; null texts stay null.
    """
    made: list[str] = []
    gone = cut(repeated_lines(docs, edits, least, id_col, text_col, made).groupBy(*DOC)
               .agg(F.collect_set("pos").alias("gone")).withColumn("h", F.xxhash64("k", "t1")), "gone")
    drop_tables(docs.sparkSession, made)  # nothing reads them behind ``gone``
    buckets = gone.select(F.col("h").bitwiseAND((1 << BITS) - 1).alias("bucket")).distinct().withColumn("some", F.lit(True))
    rows = docs.select(F.struct("*").alias("row"), *key_of(id_col, text_col))
    marked = rows.withColumn("bucket", F.xxhash64("k", "t1").bitwiseAND((1 << BITS) - 1)) \
        .join(F.broadcast(buckets), "bucket", "left")  # 2 ** BITS rows at most
    same = marked.where("some is null").select("row", F.lit(None).cast("array<int>").alias("gone"))
    less = marked.where("some").join(gone.select(*DOC, "gone"), DOC, "left").select("row", "gone")
    text = F.col("row").getField(text_col)
    kept = F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("gone", i))
    return same.union(less).select(
        *[F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col
          else F.col("row").getField(c).alias(c) for c in docs.columns if c != dropped_col],
        F.coalesce(F.size("gone"), F.lit(0)).alias(dropped_col))
