"""One query per operator, over its whole table, and the oracle SQL where SQL can state it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paydw.llm import (hard_negatives, lang_id, line_dedup, mixing, ngram_join, piece_lattice, secret_scan, source_audit,
                       spot_sigs, token_counts, token_files, topk_search, warc)
from paydw.llm.common import table
from paydw.session import scratch_path


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source", "copies", "extra")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text") \
        .withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long"))
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", F.col("_dropped").cast("long").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"))


def op3_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.encode_and_decode(table(spark, sf_dir, "documents"),
                                           public_tokenizers.path("piece_bpe_32k.model"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings")) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_spot_sigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_sigs.fingerprints_beside_next(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "paydw-llm", f"tokens-{uuid.uuid4().hex}")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path,
                                  public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.document_index(token_files.read_token_files(spark, path))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang") \
        .withColumn("held_out", lang_id.held_out())
    net = lang_id.fit(docs.where("not held_out"))
    return lang_id.predict(docs, net, passing=("held_out",))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(table(spark, sf_dir, "documents"))


def op8_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op8_ngram_join`` with the number of links of every document, which its SQL has no column for."""
    return ngram_join.near_components(table(spark, sf_dir, "documents"), links=True)


def of_kind(kind: int):
    """A filter on spans; it takes one parameter only, as a second one would be handed the span's place."""
    return lambda span: span["kind"] == kind


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, *secret_scan.fit(docs))
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{name}")
              for k, name in enumerate(secret_scan.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "paydw-llm", f"warc-{uuid.uuid4().hex}")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).drop("url")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_source_mix, op2_line_dedup, op3_piece_lattice, op4_topk_search, op5_spot_sigs, op6_token_files, op7_language_id,
                              op8_ngram_join, op8_ngram_links, op9_secret_scan, op10_token_counts, op11_hard_negatives,
                              op12_source_audit, op13_warc)}

ORACLE: dict[str, str] = {
    # targets by trying how many sources stop; quotas by listing all quotients
    "op1_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS m
            FROM documents),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [3, 1, 2][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight
            FROM d GROUP BY source),
        o AS (
            SELECT *, row_number() OVER (ORDER BY source_size * (6 // weight), encode(source) NULLS LAST) AS nr FROM s),
        t AS (
            SELECT k.k, 150 * (SELECT sum(source_size) FROM o)
                        - 200 * coalesce((SELECT sum(source_size) FROM o WHERE nr <= k.k), 0) AS left_over,
                   (SELECT sum(weight) FROM o WHERE nr > k.k) AS sharing
            FROM (SELECT unnest(range((SELECT count(*) FROM o))) AS k) k),
        rate AS (
            SELECT * FROM t WHERE NOT EXISTS (
                SELECT 1 FROM o WHERE o.nr > t.k AND t.left_over * o.weight > 200 * o.source_size * t.sharing)
            ORDER BY k LIMIT 1),
        goal AS (
            SELECT o.source, o.source_size,
                   CASE WHEN o.nr <= rate.k THEN CAST(2 * o.source_size AS DOUBLE)
                        ELSE CAST(rate.left_over * o.weight AS DOUBLE) / CAST(100 * rate.sharing AS DOUBLE) END AS target,
                   greatest(1, CAST(ceil(o.source_size / 250000) AS BIGINT)) AS n_shards
            FROM o, rate),
        seats AS (SELECT CAST((150 * sum(source_size) + 800) // 1600 AS BIGINT) AS seats FROM o),
        q1 AS (
            SELECT source, target, row_number() OVER (
                       ORDER BY target / (2 * k + 1) DESC, encode(source) NULLS LAST, k) AS place
            FROM goal, (SELECT unnest(range((SELECT seats FROM seats))) AS k) ks
            WHERE target > 0 AND k <= target / 8),
        quota AS (SELECT source, count(*) AS quota FROM q1 WHERE place <= (SELECT seats FROM seats) GROUP BY source),
        p AS (
            SELECT d.*, goal.source_size, goal.target, CAST('0x' || substr(m, 1, 15) AS BIGINT) AS h,
                   CAST('0x' || substr(m, 16, 12) AS BIGINT) % goal.n_shards AS shard
            FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source),
        sh AS (
            SELECT source, shard, CAST(sum(size) AS BIGINT) AS words,
                   greatest(1, CAST(round(sum(size) / 16) AS BIGINT)) AS n
            FROM p GROUP BY source, shard),
        q2 AS (
            SELECT sh.source, sh.shard, quota.quota, row_number() OVER (
                       PARTITION BY sh.source ORDER BY CAST(words AS DOUBLE) / (2 * k + 1) DESC, sh.shard, k) AS place
            FROM sh JOIN quota ON sh.source IS NOT DISTINCT FROM quota.source,
                 LATERAL (SELECT unnest(range(quota.quota)) AS k) ks
            WHERE words > 0),
        sq AS (
            SELECT sh.*, least(coalesce(c.q, 0), 2 * n) AS q
            FROM sh LEFT JOIN (SELECT source, shard, count(*) AS q FROM q2 WHERE place <= quota GROUP BY source, shard) c
            ON c.source IS NOT DISTINCT FROM sh.source AND c.shard = sh.shard),
        blocks AS (
            SELECT source, shard, j * words // n AS lo, (j + 1) * words // n AS hi
            FROM (SELECT sq.*, unnest(range(n)) AS j FROM sq)
            WHERE (j * 999999937 + (shard + 1) * 7368798) % n < q % n),
        e AS (
            SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY h, doc_id, size
                                      ROWS UNBOUNDED PRECEDING) AS en FROM p),
        more AS (
            SELECT e.doc_id, sum(least(b.hi, e.en) - greatest(b.lo, e.en - e.size)) AS more
            FROM e JOIN blocks b ON b.source IS NOT DISTINCT FROM e.source AND b.shard = e.shard
                 AND b.lo < e.en AND b.hi > e.en - e.size
            GROUP BY e.doc_id)
        SELECT e.doc_id, CAST(e.size AS BIGINT) AS size, e.source_size, e.target,
               CAST(sq.q // sq.n * e.size + coalesce(more.more, 0) AS BIGINT) AS taken
        FROM e JOIN sq ON sq.source IS NOT DISTINCT FROM e.source AND sq.shard = e.shard
        LEFT JOIN more ON more.doc_id = e.doc_id""",
    "op2_line_dedup": """
        WITH l AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos
            FROM documents),
        first AS (
            SELECT line, min({'d': doc_id, 'p': pos}) AS at FROM l WHERE length(line) >= 20 GROUP BY line),
        near AS (
            SELECT DISTINCT b.line FROM first a JOIN first b
            ON length(a.line) BETWEEN length(b.line) - 2 AND length(b.line) + 2
               AND a.at < b.at AND a.line <> b.line AND levenshtein(a.line, b.line) <= 2),
        marked AS (
            SELECT l.doc_id, l.pos, l.line,
                   length(l.line) >= 20 AND (n.line IS NOT NULL OR f.at <> {'d': l.doc_id, 'p': l.pos}) AS gone
            FROM l LEFT JOIN first f ON f.line = l.line LEFT JOIN near n ON n.line = l.line),
        kept AS (
            SELECT doc_id, count(*) AS n_lines, count_if(gone) AS n_dropped,
                   coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
            FROM marked GROUP BY doc_id)
        SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, CAST(coalesce(k.n_dropped, 0) AS BIGINT) AS n_dropped,
               CASE WHEN d.text IS NOT NULL THEN sha256(k.text) END AS kept_sha256
        FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id""",

    "op4_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND NOT coalesce(list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))), FALSE)),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        r AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
            FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op8_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        g AS (
            SELECT DISTINCT doc_id, gram FROM (
                SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(
                           range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                       WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram FROM w)),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        links AS (
            SELECT c.a, c.b FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both
                FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL) c
            JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b
            WHERE 100 * c.both >= 90 * (na.n + nb.n - c.both)),
        reach AS (
            SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
               least(w.doc_id, coalesce((SELECT min(b) FROM reach WHERE a = w.doc_id), w.doc_id)) AS component_id
        FROM w LEFT JOIN n ON n.doc_id = w.doc_id""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND NOT coalesce(list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))), FALSE)),
        s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (
            SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
                 AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 10""",
    "op12_source_audit": r"""
        WITH d AS (
            SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        w AS (
            SELECT nr, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        c AS (SELECT nr, lang, source, term, count(*) AS n FROM w GROUP BY ALL),
        k AS (SELECT lang, term FROM c GROUP BY ALL HAVING count(*) >= 30),
        g AS (SELECT DISTINCT lang, source FROM d),
        n AS (SELECT lang, source, term, sum(n) AS n FROM c JOIN k USING (lang, term) GROUP BY ALL),
        f AS (
            SELECT g.lang, g.source, k.term, CAST(coalesce(n.n, 0) AS HUGEINT) AS n
            FROM g JOIN k USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
        of_lang AS (SELECT lang, CAST(count(DISTINCT term) AS HUGEINT) AS v, sum(n) AS total FROM f GROUP BY lang),
        of_group AS (SELECT lang, source, sum(n) AS total FROM f GROUP BY ALL),
        p AS (
            SELECT f.lang, f.source, f.term, f.n,
                   CAST(1 + 1000000000 * (f.n + 5) // (of_group.total + 5 * of_lang.v) AS BIGINT) AS p
            FROM f JOIN of_group USING (lang, source) JOIN of_lang USING (lang)),
        q AS (
            SELECT lang, term, CAST(1 + 1000000000 * (sum(n) + 5) // (any_value(total) + 5 * any_value(v)) AS BIGINT) AS q
            FROM f JOIN of_lang USING (lang) GROUP BY ALL),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce((
                       SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term
                       WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
            FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source),
        terms AS (
            SELECT lang, source, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        u AS (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM terms),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM u)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM r WHERE part = 'pair' OR rank <= 50""",
    "op13_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END
                   AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id <> coalesce(page_id, first_id - 1) THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> coalesce(page_id, first_id - 1) THEN first_id END AS refers_to
        FROM f""",
}
