"""Bucketed tables: rows that join on a key already lie together.

The large joins of the active mart all use the company key. Tables written with the same
number of buckets on it, sorted within each, join without an exchange on either side:
each task reads one bucket of both. The one shuffle is paid when a month is written,
once, instead of at every join.

A bucket cannot be split by adaptive execution, so keys with very many rows are taken out of
the bucketed join and salted (``bucketed_join``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.operators.enrich import SALTS, split_hot_join

BUCKET_BYTES = 128 << 20
MOST_BUCKETS = 1 << 16  # Spark takes up to 100,000


def buckets_for(input_bytes: int, floor: int = 8, bucket_bytes: int = BUCKET_BYTES) -> int:
    """A power of two of buckets of about ``bucket_bytes``, larger ones where Spark would not
    take so many; tables that join need the same."""
    wanted = max(floor, -(-input_bytes // bucket_bytes))
    return min(1 << (wanted - 1).bit_length(), MOST_BUCKETS)


def table_name(root: str) -> str:
    """A catalog name for the table at ``root``."""
    return "bucketed_" + re.sub(r"[^A-Za-z0-9_]+", "_", root.strip("/"))[-100:].lower()


def write_bucketed(df: DataFrame, root: str, by: str, buckets: int, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` at ``root`` in ``buckets`` buckets of ``by``, a sorted file for each (and
    each partition), registered in the session's catalog. With ``partition_by`` only the
    partitions that ``df`` holds are replaced, so months are loaded one by one."""
    spark = df.sparkSession
    name = table_name(root)
    laid = df.repartition(buckets, F.col(by)).sortWithinPartitions(*(partition_by or []), by)
    if not spark.catalog.tableExists(name):
        writer = laid.write.mode("overwrite").option("path", root).bucketBy(buckets, by).sortBy(by)
        (writer.partitionBy(*partition_by) if partition_by else writer).format("parquet").saveAsTable(name)
    else:
        columns = spark.table(name).columns  # partition columns come last
        old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            laid.select(*columns).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    return read_bucketed(spark, root).select(*df.columns)


def read_bucketed(spark: SparkSession, root: str, like: DataFrame | None = None, by: str | None = None, buckets: int | None = None,
                  partition_by: list[str] | None = None) -> DataFrame:
    """The table at ``root``. A session that did not write it registers it first, from its
    layout: columns as in ``like``, ``buckets`` of ``by``, ``partition_by``."""
    name = table_name(root)
    if not spark.catalog.tableExists(name):
        if like is None or by is None or buckets is None:
            raise ValueError(f"{root} is not registered in this session: name its columns, key and buckets")
        parts = partition_by or []
        cols = [f for f in like.schema.fields if f.name not in parts] + [f for p in parts for f in like.schema.fields if f.name == p]
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols)
        spark.sql(f"CREATE TABLE `{name}` ({listed}) USING parquet" + (f" PARTITIONED BY ({', '.join(parts)})" if parts else "")
                  + f" CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{root}'")
    return spark.table(name)


def bucketed_join(left: DataFrame, right: DataFrame, by: str, period: str | None = None, hot: DataFrame | None = None,
                  salts: int = SALTS) -> DataFrame:
    """Left join of two tables bucketed on ``by``, without an exchange. With ``period`` that
    column has to agree too: as a pair of bounds, which the planner leaves to the join within
    a bucket, where an equality would have both sides shuffled on it as well.

    ``hot`` holds the keys with too many rows for one task (``enrich.hot_keys`` of a bucketed
    table counts them without an exchange); at most rows / least rows of a hot key. They leave
    the bucketed join and are salted."""
    on = [by] if period is None else [by, period]

    def joined(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumnsRenamed({c: f"__right_{c}" for c in on})
        same = F.col(by) == F.col(f"__right_{by}")
        if period is not None:
            same = same & (F.col(period) >= F.col(f"__right_{period}")) & (F.col(period) <= F.col(f"__right_{period}"))
        return a.join(b, same, "left").drop(*[f"__right_{c}" for c in on])

    if hot is None:
        return joined(left, right)
    few = F.broadcast(hot)
    cold = joined(left.join(few, by, "left_anti"), right.join(few, by, "left_anti"))
    busy = left.join(few, by, "left_semi")
    warm = split_hot_join(busy, right.join(few, by, "left_semi"), on, "left", salts=salts, hot=hot if period is None else busy.select(*on).distinct())
    return cold.unionByName(warm.select(*cold.columns))
