"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.llm import decontaminate, embed_dedup, hard_negatives, html_text, ngram_join, packing, phrases, pii, quality, token_file, toxicity, url_filter, warc
from snaplake.llm.labels import fold

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.json"
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    SPARK[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contamination.*")


@register
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), parts=3, held=1)
    scored = toxicity.score_toxicity(docs, model, out="score")
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, rule string")
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), rules)


ORACLE["op7_url_filter"] = """
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@register
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


@register
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), parts=5, held=0)
    scored = quality.score_quality(docs, model, out="score")
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_warc(warc.archive(table(spark, sf_dir, "pages")))


@register
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@register
def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_file.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return token_file.read_tokens(files)


@register
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


@register
def op5_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@register
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


ORACLE["op12_hard_negatives"] = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 5
"""


@register
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


ORACLE["op13_phrases"] = r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL)),
placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces WHERE len(words) > 0),
grams AS (
  SELECT lang, words[i:i + size - 1] AS phrase, count(*) AS f
  FROM placed, (VALUES (1), (2), (3)) AS sizes(size)
  WHERE i + size - 1 <= len(words) GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE len(phrase) = 1 GROUP BY lang),
candidate AS (SELECT lang, phrase, f AS a FROM grams WHERE len(phrase) > 1 AND f >= 10),
inside AS (
  SELECT lang, part, max(a) AS longer
  FROM (SELECT lang, a, unnest([phrase[1:2], phrase[2:3]]) AS part FROM candidate WHERE len(phrase) = 3) GROUP BY lang, part),
kept AS (
  SELECT c.* FROM candidate c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.part
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * c.a),
cuts AS (SELECT *, unnest(range(1, len(phrase))) AS k FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, CAST(1000000 * c.a::HUGEINT * c.a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.phrase[1:c.k]
  JOIN grams y ON y.lang = c.lang AND y.phrase = c.phrase[c.k + 1:]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
         array_to_string(phrase, ' ') AS phrase, a, l, r, score FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
