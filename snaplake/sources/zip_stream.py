"""Arriving zips as a stream.

``spark.readStream.format("zipcsvstream")`` watches a landing folder
(``competencia=YYYY-MM/<Name>.zip``) for one table's zips. An offset is the set of
(period, file, size, time) seen so far, a few dozen names per month, so a zip that arrives
late for an old period, or is issued again under its name, is new like any other: no zip is
read twice and none is missed, whatever the order of arrival. Spark's checkpoint keeps the
offsets, and its Parquet sink commits whole batches, so bronze has every zip exactly once
across restarts.
"""

from __future__ import annotations

import posixpath
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from snaplake.schemas import FILE_PREFIXES, columns_of
from snaplake.session import ship_code
from snaplake.sources import bronze
from snaplake.sources.zip_csv import PATH_COLUMN, ZipCsvDataSource, ZipCsvReader, ZipPartition, _filesystem

_PERIOD = re.compile(r"competencia=([^/]+)/[^/]+$")


def table_of_name(name: str) -> str:
    """``landing.table_of`` for one file name."""
    stem = re.sub(r"\.zip$", "", name.lower())
    return next((t for prefix, t in FILE_PREFIXES if stem.startswith(prefix)), stem)


class ZipStreamReader(DataSourceStreamReader):
    """Offsets ``{"zips": {period: {file: "size@time"}}}``; one partition per new zip."""

    def __init__(self, options: dict, schema: StructType):
        self.options = options
        self.schema = schema
        self.root = options["path"].rstrip("/")
        self.table = options["table"]

    def initialOffset(self) -> dict:
        return {"zips": {}}

    def latestOffset(self) -> dict:
        import pyarrow.fs as pafs

        fs, path = _filesystem(self.root)
        seen: dict[str, dict[str, str]] = {}
        for info in fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True)):
            name, period = posixpath.basename(info.path), _PERIOD.search(info.path)
            if info.type == pafs.FileType.File and period and name.lower().endswith(".zip") and table_of_name(name) == self.table:
                seen.setdefault(period[1], {})[name] = f"{info.size}@{info.mtime_ns}"
        return {"zips": seen}

    def partitions(self, start: dict, end: dict) -> list[ZipPartition]:
        before = start["zips"]
        return [ZipPartition(f"{self.root}/competencia={period}/{name}") for period, names in sorted(end["zips"].items())
                for name, mark in sorted(names.items()) if before.get(period, {}).get(name) != mark]

    def read(self, partition: ZipPartition):
        return ZipCsvReader({**self.options, "with_path": "true"}, self.schema).read(partition)

    def commit(self, end: dict) -> None:
        """Landing zips stay where they are."""


class ZipStreamSource(ZipCsvDataSource):
    """Options as ``zipcsv``; ``path`` is the landing folder, ``table`` is required."""

    @classmethod
    def name(cls) -> str:
        return "zipcsvstream"

    def streamReader(self, schema: StructType) -> ZipStreamReader:
        return ZipStreamReader(self.options, schema)


def zip_stream(spark: SparkSession, landing_root: str, table: str, extraction_date: str, na_tokens: str | None = None) -> DataFrame:
    """Streaming bronze rows of ``table``: declared columns and the four metadata columns."""
    columns_of(table)
    ship_code(spark)
    spark.dataSource.register(ZipStreamSource)
    reader = spark.readStream.format("zipcsvstream").option("path", landing_root).option("table", table).option("with_path", "true")
    df = (reader.option("na_tokens", na_tokens) if na_tokens else reader).load()
    df = df.withColumn("_competencia", F.regexp_extract(F.col(PATH_COLUMN), _PERIOD.pattern, 1)).drop(PATH_COLUMN)
    return bronze.with_metadata(df, None, extraction_date)


def ingest_arrived(spark: SparkSession, landing_root: str, bronze_root: str, table: str, extraction_date: str,
                   checkpoint: str | None = None) -> StreamingQuery:
    """Start a stream that takes the zips that have arrived into ``tabela=<table>`` and ends.

    Run again after more have arrived, in this or another application: the checkpoint (by
    default beside bronze) knows which are in."""
    checkpoint = checkpoint or f"{bronze_root.rstrip('/')}/_checkpoints/{table}"
    rows = zip_stream(spark, landing_root, table, extraction_date).withColumn(bronze.PERIOD_DIR, F.col("_competencia"))
    return (rows.writeStream.format("parquet").partitionBy(bronze.PERIOD_DIR).option("compression", "snappy")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .start(f"{bronze_root.rstrip('/')}/tabela={table}"))
