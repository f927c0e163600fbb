"""Operators 11 to 13 against brute force, with nulls, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from paydw.llm import hard_negatives, source_audit, warc

CLASH = ("v", "deal", "cb", "ab", "anchor", "rank", "positives", "n", "docs", "term", "p", "q", "gb", "tb", "place",
         "side", "other", "base", "width", "payload", "digest", "key", "hot", "first_id", "copies", "frame", "value")


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH})


# -- operator 11 -----------------------------------------------------------

def mined(rows, every, low, high, k_pos, k_neg):
    """``(anchor, positive, rank, negative, positive score, negative score)`` by scoring all pairs."""
    usable = []
    for i, vector, label in rows:
        if i is not None and label is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            usable.append((i, (label + 1) % 10 if i % 7 == 0 else label,
                           tuple(int(np.floor(256 * float(np.float32(x)))) for x in vector)))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, lab, q in sorted({u for u in usable if u[0] % every == 0}):
        scored = [(-score(q, v), i, lb) for i, lb, v in usable]
        best = sorted((s, i) for s, i, lb in scored if lb == lab and i != a)[:k_pos]
        for ps, p in best:
            some = sorted((s, i) for s, i, lb in scored if lb != lab and low * -ps <= 100 * -s <= high * -ps)[:k_neg]
            out += [(a, p, r + 1, i, -ps, -s) for r, (s, i) in enumerate(some)]
    return sorted(out)


@pytest.mark.parametrize("block,anchors", [(1 << 20, 1 << 21), (70, 30)])
def test_hard_negatives_by_brute_force(spark, block, anchors):
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 0.4, (4, 13))
    rows = [(i, [float(x) for x in np.float32(centres[i % 4] + rng.normal(0, 0.3, 13))], int(rng.integers(0, 4))) for i in range(160)]
    rows += [(i, rows[8][1], 2) for i in range(160, 190)]  # copies: ties everywhere
    rows += [(i, [0.0] * 13, 1) for i in range(190, 196)]
    rows += [rows[20], rows[20], rows[33], (5, rows[6][1], 3)]  # equal anchors, equal candidates, an id with two vectors
    rows += [(None, rows[1][1], 1), (300, None, 1), (310, rows[2][1], None), (320, [0.1, None] + [0.2] * 11, 2),
             (330, [float("nan")] * 13, 2), (340, [float("inf")] * 13, 2), (350, [0.5, -0.5, 0.25], 1), (360, [], 0)]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    got = hard_negatives.mine(df.repartition(5), every=10, block_values=block, anchor_values=anchors)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows, 10, 30, 90, 5, 10)
    assert len(want) > 300 and sorted(map(tuple, got.collect())) == want


def test_hard_negatives_of_large_numbers_and_empty_tables(spark):
    rng = random.Random(3)
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(i, [rng.uniform(-1e6, 1e6) for _ in range(6)], i % 2) for i in range(60)]
    got = hard_negatives.mine(spark.createDataFrame(rows, schema), every=10).collect()

    def quantized(rows):  # doubles, not rounded to floats
        return [(i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * x)) for x in v]) for i, v, label in rows]
    q = {i: (label, v) for i, label, v in quantized(rows)}
    assert got and all(r.positive_score == sum(x * y for x, y in zip(q[r.anchor_id][1], q[r.positive_id][1]))
                       and 30 * r.positive_score <= 100 * r.negative_score <= 90 * r.positive_score
                       and r.negative_score == sum(x * y for x, y in zip(q[r.anchor_id][1], q[r.negative_id][1])) for r in got)
    assert hard_negatives.mine(spark.createDataFrame([], schema)).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(1, [0.5], 1), (2, [0.5], 2)], schema)).count() == 0


def test_the_scan_drops_candidates_before_the_last_column():
    rng = np.random.default_rng(5)
    columns = np.floor(rng.normal(0, 60, (64, 3000)))
    block = hard_negatives.Block(columns, np.arange(3000), np.zeros(3000, np.int64))
    weights = np.floor(rng.normal(0, 60, 64) * np.linspace(3, 0.02, 64))
    left = []

    def shrink(lower, upper):
        stay = upper >= hard_negatives.kth(lower, 5)
        left.append(int(stay.sum()))
        return stay

    block.scan(weights, np.arange(3000), shrink)
    assert left == sorted(left, reverse=True) and left[-1] <= 10 and left[len(left) // 2] < 1500


# -- operator 12 -----------------------------------------------------------

def audited(rows, least_docs, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    of, in_docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = term.findall((text or "").translate(lower))
        of[lang, source].update(words)
        in_docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in in_docs[lang].items() if n >= least_docs]
        total = {s: sum(of[lang, s][t] for t in kept) for s in sources}
        share = lambda n, N: 1 + 10 ** 9 * (n + 5) // (N + 5 * len(kept))
        p = {s: {t: share(of[lang, s][t], total[s]) for t in kept} for s in sources}
        q = {t: share(sum(of[lang, s][t] for s in sources), sum(total.values())) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if of[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most]
                out += [(lang, s, part, item, v, r + 1) for r, (v, item) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("group_block,term_block", [(64, 4096), (2, 3)])
def test_source_audit_by_brute_force(spark, group_block, term_block):
    rng = random.Random(12)
    words = "the of And AND and ALPHA beta gamma été Été ÉTÉ über 日本 naïve x y".split()
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "de", "fr", None, ""])
        source = rng.choice(["s1", "s2", "S1", "é", "z" * 40, None])
        rows.append((lang, source, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) + rng.choice(["", "1", "_a", "\x00b\x7f"])))
    rows += [("en", "s1", None), ("en", "none", "12 34 ,."), ("lone", "only", "the the"), ("two", "a", ""), ("two", "b", None),
             ("en", "s1", "the " * 5000)] + [("en", "hot", "beta gamma")] * 100
    rows += [("fr", "s1", rows[0][2])] * 3
    df = clashing(spark.createDataFrame([(None, *r) for r in rows], "doc_id long, lang string, source string, text string"))
    got = source_audit.audit(df.repartition(7), least_docs=20, top=4, group_block=group_block, term_block=term_block)
    want = audited(rows, 20, 4)
    assert {r[2] for r in want} == {"pair", "term"} and any(r[:4] == ("two", "a", "pair", "b") and r[4] == 0 for r in want)
    assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got.collect()) == want


def test_source_audit_of_an_empty_table(spark):
    assert source_audit.audit(spark.createDataFrame([], "doc_id long, lang string, source string, text string")).count() == 0


def test_shares_are_exact_beyond_a_long(spark):
    n, total, terms = 4_000_000_000_123, 9_000_000_000_001, 77_777
    df = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    got = df.select(source_audit.share(F.col("n"), F.col("total"), F.col("terms"))).first()[0]
    assert got == 1 + 10 ** 9 * (n + 5) // (total + 5 * terms)


# -- operator 13 -----------------------------------------------------------

def archived(rows):
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 1000:
            first[html] = max(i, first.get(html, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(html) if html in first and first[html] != i else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


PAGES = "page_id long, url string, html string"


def page_rows():
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefgé日") for _ in range(5))
    page = lambda n: "<html>" + " ".join(word() for _ in range(n)) + "</html>"
    twin, short, edge = page(300), page(3), "é" * 500
    rows = [(i, f"http://x.org/{i}", page(rng.randint(1, 400))) for i in range(60)]
    rows += [(i, f"http://x.org/{i}", twin) for i in range(100, 220)] + [(i, None, short) for i in range(300, 330)]
    rows += [(400, "", edge), (401, "a\r\nWARC-Type: x", edge), (402, "ü b", edge[:-1]), (403, "u", edge[:-1])]
    rows += [(500, None, None), (501, None, ""), (502, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 90), (503, "u", "x" * 3_000_000)]
    rows += [(None, "n", twin), (None, "n", page(299)), (219, "again", twin), (5, "again", rows[5][2])]
    alone = page(350)
    return rows + [(None, "n", alone), (None, "n", alone)]


@pytest.mark.parametrize("share", [0.001, 0.9])
def test_warc_round_trip(spark, scratch, share):
    rows = page_rows()
    df = clashing(spark.createDataFrame(rows, PAGES)).repartition(4)
    warc.write_warc(df, f"{scratch}/w", hot_share=share)
    back = warc.read_warc(spark, f"{scratch}/w")
    got = sorted((tuple(r) for r in back.drop("url").collect()), key=repr)
    assert got == archived(rows)
    urls = {r.page_id: r.url for r in back.collect()}
    assert urls[7] == "http://x.org/7" and urls[500] == "urn:page:500" and urls[401] == "a%0D%0AWARC-Type: x"


def test_archives_open_with_any_zstandard_reader(spark, scratch):
    """Each archive begins with its dictionary; every record is a frame that needs it; texts of revisits are not stored."""
    rows = page_rows()
    warc.write_warc(spark.createDataFrame(rows, PAGES), f"{scratch}/w")
    texts = []
    for r in spark.read.format("binaryFile").load(f"{scratch}/w").collect():
        data = bytes(r.content)
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
        size = int.from_bytes(data[4:8], "little")
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
        with reader.stream_reader(data[8 + size:], read_across_frames=True) as stream:
            whole = stream.read()
        assert whole == b"".join(warc.records_of(data))
        texts.append(whole)
        frame = data[8 + size:]
        while int.from_bytes(frame[:4], "little") in warc.SKIPPABLE:
            frame = frame[8 + int.from_bytes(frame[4:8], "little"):]
        assert zstandard.get_frame_parameters(frame).dict_id == zstandard.ZstdCompressionDict(data[8:8 + size]).dict_id()
    whole = b"".join(texts)
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)
    twin = rows[60][2].encode()
    assert whole.count(twin) == 2  # the largest id of the copies occurs twice


def test_a_damaged_record_is_an_error():
    html = b"<p>hello</p>"
    good = warc.record(1, "u", html, len(html), hashlib.sha1(html).hexdigest(), None, None)
    assert warc.parsed(good)[:4] == (1, "u", len(html), hashlib.sha1(html).hexdigest())
    for bad in (good.replace(b"hello", b"hallo"), good[:-1], b"x" + good):
        with pytest.raises(ValueError):
            warc.parsed(bad)


def test_warc_of_few_and_no_pages(spark, scratch):
    one = [(1, "u", "x")]
    warc.write_warc(spark.createDataFrame(one, PAGES), f"{scratch}/one")
    assert [tuple(r) for r in warc.read_warc(spark, f"{scratch}/one").drop("url").collect()] == archived(one)
    warc.write_warc(spark.createDataFrame([], PAGES), f"{scratch}/none")
    assert warc.read_warc(spark, f"{scratch}/none").count() == 0
