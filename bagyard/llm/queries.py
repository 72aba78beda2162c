"""Registered queries of this package: thin digests of what the operators return."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bagyard.llm import chunking, covertree, lexical, minhash, mixing, negatives, packing, quality, risk_rules, suffixes, token_records, toxicity, warc
from bagyard.llm.frames import scratch_path, ship, table, tokenizer_file
from bagyard.llm.labelled import held_out


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).alias("repeated_words"), "spans", "cuts")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    token_records.write_records(table(spark, sf_dir, "documents"), f"{folder}/data", tokenizer_file("byte_bpe_50k.json"))
    token_records.write_index(spark, f"{folder}/data", f"{folder}/index")
    starts = token_records.file_starts(spark.read.parquet(f"{folder}/index"))
    rows = token_records.read_records(spark, f"{folder}/data", with_ids=False).join(starts, "file")
    return rows.select("doc_id", (F.col("file_start") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2048)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests, 2048)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = risk_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"))


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    return run


_ALL = {
    "op1_warc": op1_warc,
    "op2_cover_tree": op2_cover_tree,
    "op3_suffix_array": op3_suffix_array,
    "op4_toxicity": op4_toxicity,
    "op5_source_mix": op5_source_mix,
    "op6_minhash": op6_minhash,
    "op7_token_records": op7_token_records,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality": op9_quality,
    "op10_fingerprints": op10_fingerprints,
    "op11_risk_rules": op11_risk_rules,
    "op12_bag_search": op12_bag_search,
    "op13_hard_negatives": op13_hard_negatives,
}

QUERIES = {name: _shipped(fn) for name, fn in _ALL.items()}

ORACLES = {
    "op1_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, body, strlen(body) AS payload_bytes, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS first FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hex || '0', CAST((5 * i) // 4 + 1 AS INT), 2) AS INT) >> CAST(3 - (5 * i) % 4 AS INT)) & 31) + 1 AS INT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
""",
    "op6_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN ws IS NULL OR len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w
), x AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM x a JOIN x b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p WHERE 100 * k >= 75 * (na + nb - k)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON reach.r = e.a
), c AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
""",
    "op2_cover_tree": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), g AS (
  SELECT vec_id, label, x, sqrt(list_inner_product(x, x)) AS n FROM v
  WHERE label IS NOT NULL AND x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND list_inner_product(x, x) > 0
), e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_inner_product(a.x, b.x) / (a.n * b.n) >= 0.93
), reach AS (
  SELECT vec_id, vec_id AS r FROM v UNION SELECT reach.vec_id, e.b FROM reach JOIN e ON reach.r = e.a
), c AS (
  SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id
), d AS (
  SELECT a, count(*) AS n_links FROM e GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN d ON a = vec_id
""",
    "op11_risk_rules": r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS x FROM documents
), w AS (
  SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM t
), g AS (
  SELECT r, unnest(range(1, len(ws) - 6)) AS p, unnest(list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' '))) AS x FROM w WHERE len(ws) > 8
), s AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, x) AS k FROM g
), v AS (
  SELECT r, least(8, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p) - p, 8)) AS c FROM s WHERE k > 1
), y AS (
  SELECT r, CAST(sum(c) AS BIGINT) AS n FROM v GROUP BY r
), m AS (
  SELECT w.r, doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(y.n, 0) AS n_repeat_words
  FROM w LEFT JOIN y ON w.r = y.r
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    coalesce(least(1000, 1000 * n_symbols // nullif(word_chars, 0)), 0) AS v1, coalesce(least(1000, 1000 * n_dup_lines // nullif(n_lines, 0)), 0) AS v2,
    coalesce(least(1000, 1000 * n_repeat_words // nullif(n_words, 0)), 0) AS v3, coalesce(least(1000, 20 * word_chars // nullif(n_words, 0)), 0) AS v4 FROM m
), l AS (
  SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 7) AS BIGINT) % 3 = 0 AS tuning, max(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), e AS (
  SELECT b.lang, unnest(['v1', 'v2', 'v3', 'v4']) AS rule, unnest([v1, v2, v3, v4]) AS v, good, tuning FROM b JOIN l USING (doc_id) WHERE NOT base_failed AND good IN (0, 1)
), z AS (
  SELECT lang, rule, v, count(*) FILTER (good = 1 AND NOT tuning) AS held, count(*) FILTER (good = 1 AND tuning) AS ok, count(*) FILTER (good = 0 AND tuning) AS bad FROM e GROUP BY lang, rule, v
), n AS (
  SELECT lang, sum(held) AS n FROM z WHERE rule = 'v1' GROUP BY lang HAVING sum(held) > 0
), d AS (
  SELECT lang, n, 0.05 / (4 * (SELECT count(*) FROM n)) AS level, unnest(range(0, CAST(floor(n * 0.01) AS BIGINT) + 1)) AS k FROM n
), c AS (
  SELECT lang, n, level, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.01) + (n - k) * ln(0.99))) OVER (PARTITION BY lang ORDER BY k) AS p FROM d
), a AS (
  SELECT lang, max(k) AS allowed FROM c WHERE p <= level GROUP BY lang
), o AS (
  SELECT lang, rule, v, sum(held) OVER u AS hit, sum(bad) OVER u / nullif(sum(bad) OVER q, 0) AS x, sum(ok) OVER u / nullif(sum(ok) OVER q, 0) AS y FROM z
  WINDOW u AS (PARTITION BY lang, rule ORDER BY v DESC ROWS UNBOUNDED PRECEDING), q AS (PARTITION BY lang, rule)
), f AS (
  SELECT o.lang, rule, v, coalesce(x, 0) - 10.0 * coalesce(y, 0) AS gain FROM o JOIN a ON o.lang IS NOT DISTINCT FROM a.lang WHERE hit <= allowed AND v > 0
), t2 AS (
  SELECT lang, rule, v FROM f WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, v DESC) = 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT EXISTS (
  SELECT 1 FROM t2 WHERE t2.lang IS NOT DISTINCT FROM b.lang AND t2.v <= CASE rule WHEN 'v1' THEN v1 WHEN 'v2' THEN v2 WHEN 'v3' THEN v3 ELSE v4 END) AS kept
FROM b
""",
    "op12_bag_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL
), s AS (
  SELECT count(*) AS nd, CAST(sum(len(ts)) AS BIGINT) AS nt FROM d WHERE len(ts) > 0
), f AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, nd
), m AS (
  SELECT r, doc_id, 25 + (75 * len(ts) * nd) // nt AS m FROM d, s WHERE len(ts) > 0
), q AS (
  SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)
), x AS (
  SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY i, item_id, r, doc_id
), y AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM x WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM y WHERE rank <= 10
""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS LAST) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.id NULLS LAST) AS INTEGER) AS rank, n.id AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.a = n.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
""",
}
