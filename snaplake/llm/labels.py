"""Bounded, deterministic samples of labelled documents for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts, F.lit(0))


def sample_ids(labels: DataFrame, label: str, value: int, rows: int) -> DataFrame:
    """Ids labelled ``value``, the ``rows`` smallest by hash; each id once."""
    ids = labels.where(F.col(label) == value).select("doc_id").where("doc_id IS NOT NULL").distinct()
    return ids.orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id").limit(rows).withColumn("label", F.lit(value))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, rows: dict[int, int]) -> DataFrame:
    """(doc_id, text, label) of at most ``rows[value]`` documents of each label value.
    The ids are broadcast: their number is bounded by ``rows``."""
    picked = None
    for value, many in rows.items():
        ids = sample_ids(labels, label, value, many)
        picked = ids if picked is None else picked.unionByName(ids)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id", "label"])
