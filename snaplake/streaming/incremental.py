"""Incremental loads as Structured Streaming jobs.

Bronze grows by whole files (new months, new shards). A file-source stream
over a bronze table with ``trigger(availableNow=True)`` processes exactly the
files not yet seen (its checkpoint plays the watermark's role, and a
re-issued month arrives as new files, so it is not missed), then stops.
Each micro-batch is staged with the same column expressions as the batch
path and merged into a versioned table by ``foreachBatch``.

The merge is idempotent (merging a batch twice equals merging it once), so
a micro-batch replayed after an executor or driver loss leaves the table as
if it ran once. Across batches all rows of a key's latest period stay, so the
result does not depend on the order files are picked up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from snaplake.operators.incremental import drop_matched, latest_per_key
from snaplake.schemas import raw_schema
from snaplake.session import ensure_checkpoint_dir
from snaplake.sinks import tables

BRONZE_META = ["_fonte", "_competencia", "_arquivo_origem", "_data_extracao"]


def bronze_stream(spark: SparkSession, bronze_root: str, table: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame over ``bronze_root/tabela=<table>`` (declared columns)."""
    schema = raw_schema(table)
    for c in BRONZE_META:
        schema = schema.add(c, "string")
    schema = schema.add("competencia", "string")
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    path = f"{bronze_root.rstrip('/')}/tabela={table}"
    return r.option("basePath", path).parquet(path).drop("competencia")


def merge_latest(spark: SparkSession, root: str, batch: DataFrame, keys: list[str],
                 order: list[str] | None = None, partition_by: list[str] | None = None,
                 sort_by: list[str] | None = None) -> None:
    """Latest-wins merge of ``batch`` into the versioned table at ``root``.

    A batch may be older than what the table has of its keys, so their rows join the batch
    first; then only the partitions that hold or receive them are rewritten."""
    current = tables.read_table(spark, root, schema=batch.schema)
    if current is None:
        tables.write_version(latest_per_key(batch, keys, order), root, partition_by, sort_by)
        return
    there = drop_matched(current.select(*batch.columns), batch, keys, order, how="left_semi")
    tables.merge_into(spark, root, batch.unionByName(there), keys, partition_by, sort_by, order)


def stream_merge(stream: DataFrame, root: str, keys: list[str],
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 checkpoint: str | None = None, partition_by: list[str] | None = None,
                 sort_by: list[str] | None = None, name: str | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream merging every new batch into ``root``.

    ``transform`` runs per micro-batch on a static frame, so it may join
    static code tables or use any batch operator.
    """
    spark = stream.sparkSession
    if checkpoint is None:
        checkpoint = f"{root.rstrip('/')}/_stream_checkpoint"
    ensure_checkpoint_dir(spark)

    def each(batch: DataFrame, epoch_id: int) -> None:
        staged = transform(batch) if transform else batch
        merge_latest(spark, root, staged, keys, partition_by=partition_by, sort_by=sort_by)

    w = (stream.writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    return w.start()


def run_until_done(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for the stream to end; with a limit, stop it and raise when it is missed,
    so that a partial table never passes for a whole one."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"the stream did not end within {timeout_s} s; its table is incomplete")
    if query.exception() is not None:
        raise query.exception()
