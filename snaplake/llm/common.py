"""Helpers shared by the operators: written tables, files in the shared
folder, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.session import work_dir


_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, drop: Callable[[], None]) -> None:
    """Say, in a task, that ``owner`` keeps something in this worker that ``drop`` lets go.

    Workers are used again by later stages; what other owners keep goes first, so tables
    of one operator do not stay beside those of the next."""
    for name in [n for n in _HELD if n != owner]:
        _HELD.pop(name)()
    _HELD[owner] = drop


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    The lineage ends at files that outlive any executor, and the plan above
    is computed once however often the result is read."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_shared(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a URI or plain path in the shared folder."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete the folder of a settled table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that the Python objects
    made for one batch stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of sorted batches, a table for each run of equal integer ``keys``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        spots = np.stack([batch.column(c).to_numpy() for c in keys], 1)
        if held and any(held[0].column(c)[0].as_py() != x for c, x in zip(keys, spots[0].tolist())):
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        last = 0
        for cut in (np.flatnonzero((spots[1:] != spots[:-1]).any(1)) + 1).tolist():
            yield pa.Table.from_batches([*held, batch.slice(last, cut - last)]).combine_chunks()
            held, last = [], cut
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (src, dst);
    the component is its smallest node.

    Alternates large-star and small-star contraction until no edge changes.
    Only minima per node are aggregated, so a hub of any degree is combined on
    the map side, and the joins back are plain equi-joins that adaptive
    execution can split. Each round is a written table.
    """
    spark = edges.sparkSession
    e = settle(edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
               .distinct(), "cc-edges")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    seen = mark(e)
    while seen[0]:
        both = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("m"))
        large = (both.join(low, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
                 .where("src <> dst"))
        down = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (large.join(down, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
                 .union(down.select("src", F.col("m").alias("dst"))).where("src <> dst").distinct())
        after = settle(small, "cc-round")
        now = mark(after)
        drop_table(spark, e)
        e = after
        if now == seen:
            break
        seen = now
    return (e.select(F.col("src").alias("node"), F.col("dst").alias("component"))
            .union(e.select(F.col("dst"), F.col("dst"))).distinct())
