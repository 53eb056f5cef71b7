"""One query per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from etlkit.llm import (
    collocations, decontamination, language_id, lm_scoring, mixing, near_duplicates, passages, quality_rules,
    spelling_variants, token_counts, token_files, top_products, web_archives,
)
from etlkit.llm.registry import ORACLES, QUERIES, query, table
from etlkit.workspace import new_path

__all__ = ["ORACLES", "QUERIES"]

MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER before, 0))::BIGINT::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM sources
  WINDOW before AS (ORDER BY (source_size * 3)::DOUBLE / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least((source_size * 3)::DOUBLE, max(level) OVER () * weight) AS target FROM levels),
drawn AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'text:' || md5(coalesce(d.text, '')))), 1, 13))::BIGINT::DOUBLE
      / 4503599627370496.0::DOUBLE AS draw
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""


@query("op10_mix_sources", MIX_SQL)
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(table(spark, sf_dir, "documents")).select(
        "doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op4_token_files")
def write_and_read_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "tokens")
    token_files.write_tokens(
        table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op3_token_counts")
def count_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op1_language_id")
def identify_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_near_duplicates")
def group_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates.NearDuplicates(docs).groups().select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op2_decontamination")
def find_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "item_words", "covered", "coverage", F.size("tiles").alias("n_tiles"))


TOP_SQL = """
WITH scaled AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM scaled q JOIN scaled c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


@query("op8_top_products", TOP_SQL)
def search_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.top_products(table(spark, sf_dir, "embeddings"))


WARC_SQL = """
WITH records AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
kept AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS response
  FROM records)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to
FROM kept
"""


@query("op7_web_archives", WARC_SQL)
def write_and_read_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "archives")
    web_archives.write_archives(table(spark, sf_dir, "pages"), folder)
    return web_archives.read_archives(spark, folder)


@query("op9_repeated_passages")
def find_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query("op5_lm_scores")
def score_by_language_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good are the target."""
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    return lm_scoring.difference_scores(table(spark, sf_dir, "documents"), good)


@query("op13_quality_rules")
def judge_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality_rules.COUNTS, "base_failed", "kept")


@query("op11_spelling_variants")
def group_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.word_counts(table(spark, sf_dir, "documents"), slip_every=199)
    return spelling_variants.spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
  FROM documents),
sizes AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
starts AS (
  SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
  FROM pieces, (VALUES (1), (2), (3), (4)) AS lengths(k)),
runs AS (
  SELECT lang, k, words[i:i + k - 1] AS p, count(*) AS a FROM starts GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.k, c.p, c.a, j, f.a AS l, g.a AS r, ((2000000::HUGEINT * c.a) // (f.a + g.a))::BIGINT AS score
  FROM runs c JOIN (VALUES (1), (2), (3)) AS places(j) ON j < c.k
  JOIN runs f ON f.lang = c.lang AND f.p = c.p[1:j]
  JOIN runs g ON g.lang = c.lang AND g.p = c.p[j + 1:c.k]),
scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
inner_parts AS (
  SELECT lang, p[i:i + m - 1] AS p, a
  FROM (SELECT lang, p, a, m, unnest(range(1, k - m + 2)) AS i
        FROM scored JOIN (VALUES (2), (3)) AS parts(m) ON m < k)),
longer AS (SELECT lang, p, max(a) AS a FROM inner_parts GROUP BY ALL),
ranked AS (
  SELECT s.*, array_to_string(s.p, ' ') AS phrase
  FROM scored s LEFT JOIN longer o ON o.lang = s.lang AND o.p = s.p
  WHERE o.a IS NULL OR 100 * o.a < 80 * s.a)
SELECT r.lang, row_number() OVER (PARTITION BY r.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked r JOIN sizes USING (lang) QUALIFY rank <= 2000
"""


@query("op12_collocations", COLLOCATIONS_SQL)
def mine_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
