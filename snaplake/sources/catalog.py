"""Catalog: named views over bronze and ad-hoc SQL."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from snaplake.schemas import ALL_TABLES
from snaplake.sources import bronze

log = logging.getLogger(__name__)


def register_bronze(spark: SparkSession, bronze_root: str, prefix: str = "bronze_",
                    tables: list[str] | None = None) -> tuple[list[str], list[str]]:
    """A temp view per bronze table (declared columns only).

    Absent tables are skipped with a warning; rerunning replaces the views.
    Returns (created, skipped).
    """
    created, skipped = [], []
    for t in tables or ALL_TABLES:
        try:
            df = bronze.read_table(spark, bronze_root, t)
            df.schema  # resolves the path now
        except Exception as e:  # noqa: BLE001 - a missing folder is an AnalysisException
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
                log.warning("bronze table %s absent; view skipped", t)
                skipped.append(t)
                continue
            raise
        df.createOrReplaceTempView(prefix + t)
        created.append(t)
    log.info("bronze views: %d created, %d skipped", len(created), len(skipped))
    return created, skipped


def query(spark: SparkSession, sql: str, args: dict | None = None, **frames) -> DataFrame:
    """Run SQL (optionally with ``:name`` parameter markers and ``{df}``
    frame arguments); the result stays a DataFrame (``toPandas`` /
    ``toArrow`` is the caller's choice)."""
    if frames:
        return spark.sql(sql, args=args, **frames)
    return spark.sql(sql, args=args)
