"""A corpus pipeline from five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and reread as the next one's ``docs``; all but the last return the columns
of ``documents``. Extra columns of ``docs`` stay through those stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.llm import decontaminate, ngram_join, packing, pii, toxicity
from snaplake.llm.common import free_name, settle
from snaplake.session import ensure_checkpoint_dir, ship_code

REJECT = 0.7
VOCABULARY = "byte_bpe_50k.json"


def _prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_code(spark)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of ``REJECT`` or more go; null and empty texts stay."""
    _prepare(spark)
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs, "toxicity")
    return toxicity.score_toxicity(docs, model, out=name).where(F.col(name) < REJECT).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shingle sets, the one with the smallest id stays."""
    _prepare(spark)
    return ngram_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    _prepare(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become ``<kind>``; ``n_chars`` follows the text."""
    _prepare(spark)
    name = free_name(docs, "pii")
    clean = pii.redact(pii.with_spans(docs, out=name), spans_col=name).drop(name)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and place."""
    _prepare(spark)
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", reject_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("personal data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Fitted models, connected components and packing have no SQL form; the tests
#: hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    _prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
