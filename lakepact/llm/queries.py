"""Registered queries of the training-data operators, and the SQL of those that SQL can express.

Each query applies its operator, with production parameters, to its whole table. What SQL cannot
express (trained models, sketches, token ids) is held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakepact.llm import (
    embed_lsh, licence, lm_mixing, phrases, pii_semicrf, qgram_decon, quality_rules, records, simhash, source_mix, spelling,
    toxicity_cnn, url_rules,
)
from lakepact.llm.common import read


def op1_pii_semicrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_semicrf.digest(pii_semicrf.find_entities(read(spark, sf_dir, "documents")))


def op2_lm_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_mixing.score_documents(read(spark, sf_dir, "documents"))


def op3_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_cnn.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.encode_documents(read(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return url_rules.judge(pages, url_rules.seed_labels(pages), unnamed=url_rules.SEED_TOKENS)


def op6_qgram_decon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qgram_decon.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_embed_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_lsh.near_vectors(read(spark, sf_dir, "embeddings"))


def op9_licence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence.scan(read(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii_semicrf, op2_lm_mixing, op3_toxicity_cnn, op4_token_records, op5_url_rules, op6_qgram_decon,
        op7_source_mix, op8_embed_lsh, op9_licence, op10_simhash, op11_spelling, op12_phrases, op13_quality_rules,
    )
}

ORACLES: dict[str, str] = {
    "op7_source_mix": r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), chr(31), md5(coalesce(text, '')))), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1 AS rnk
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE rnk % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w,
         (source_size * 3)::DOUBLE AS cap
  FROM s
), o AS (
  SELECT *, coalesce(sum(cap) OVER f, 0.0) AS cap_before, coalesce(sum(w) OVER f, 0.0) AS w_before,
         sum(source_size) OVER () AS total, sum(w) OVER () AS w_all
  FROM w
  WINDOW f AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, (total::DOUBLE - cap_before) / (w_all - w_before) AS level_k FROM o
), t AS (
  SELECT source, source_size,
         least(cap, w * max(CASE WHEN w * level_k <= cap THEN level_k END) OVER ()) AS target
  FROM l
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM t
), c AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.copies,
         floor(r.target - r.copies * r.source_size)::BIGINT AS room,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN upto <= room THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
""",
    "op12_phrases": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
         )) AS piece
  FROM documents
), x AS (
  SELECT lang, ws FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p) WHERE len(ws) > 0
), words AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM x GROUP BY lang
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: list_slice(ws, i, i + k - 1))) AS phrase
  FROM x, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k
), f AS (
  SELECT lang, k, phrase, count(*)::BIGINT AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100
), inner_parts AS (
  SELECT lang, list_slice(phrase, i, i + j - 1) AS phrase, f
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS j FROM f WHERE k >= 3))
), longer AS (
  SELECT lang, phrase, max(f) AS most FROM inner_parts GROUP BY lang, phrase
), kept AS (
  SELECT f.lang, f.k, f.phrase, f.f AS a FROM f LEFT JOIN longer b ON b.lang = f.lang AND b.phrase = f.phrase
  WHERE f.k >= 2 AND (b.most IS NULL OR 100 * b.most < 100 * f.f)
), cuts AS (
  SELECT *, unnest(range(1, k)) AS c FROM kept
), scored AS (
  SELECT t.lang, t.phrase, t.a, l.f AS l, r.f AS r, w.n, t.c,
         ((1000::HUGEINT * t.a * w.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts t JOIN words w ON w.lang = t.lang
  JOIN f l ON l.lang = t.lang AND l.phrase = list_slice(t.phrase, 1, t.c)
  JOIN f r ON r.lang = t.lang AND r.phrase = list_slice(t.phrase, t.c + 1, t.k)
), least AS (
  SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM least QUALIFY rank <= 2000
""",
}
