"""Session construction and the shared work folder.

On a cluster the shared folder comes from ``spark.checkpoint.dir``, which the
cluster names. A folder of our own is made only when that setting is unset on
a local master (tests, laptops); on a cluster an unset value is an error.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app_name: str = "snaplake", extra: dict | None = None) -> SparkSession:
    """A session tuned for the pipeline: AQE on, UI off, UTC, Arrow on.

    ``master=None`` leaves the master to ``spark-submit``;
    ``shuffle_partitions=None`` keeps the cluster's setting (AQE coalesces).
    """
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings that keep shuffle and scan partitions near
    ``target_partition_bytes`` for a job reading ``input_bytes``.

    The initial shuffle width is sized for the input (at least 3 waves of
    the cluster's cores) and AQE coalesces it down at runtime, so
    partitions neither spill from being too large nor flood the scheduler
    from being tiny. Skewed partitions over 4x the target are split by AQE.
    """
    width = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        **runtime_filter_conf(),
    }


def runtime_filter_conf(creation_bytes: int = 1 << 30, scan_bytes: int = 10 << 30) -> dict[str, str]:
    """Settings under which a join's filtered side, up to ``creation_bytes`` by estimate, makes a
    Bloom filter for the scan of the other, from ``scan_bytes`` on. The filter has a fixed
    size (8 MB); a side too large for it filters less and changes no row."""
    return {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(creation_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(scan_bytes),
    }


def _conf(spark: SparkSession, key: str) -> str | None:
    value = spark.conf.get(key, None)
    if value:
        return value
    return spark.sparkContext.getConf().get(key, None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating one only for local masters."""
    current = _conf(spark, CHECKPOINT_KEY)
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_KEY} is unset; a cluster run needs a shared folder")
        current = tempfile.mkdtemp(prefix="snaplake-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, current)
    spark.sparkContext.setCheckpointDir(current)
    return current


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make ``snaplake`` importable in Python workers (data source, pandas
    functions, foreachBatch), wherever the driver was started from.

    The package is zipped into the shared checkpoint folder and added with
    ``addPyFile`` once per SparkContext (on clusters, ``--py-files`` does
    the same at submit time).
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import io
    import os
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.writestr(os.path.relpath(full, os.path.dirname(pkg)), open(full, "rb").read())
    target = work_dir(spark, "code") + ".zip"
    # Written through Hadoop's filesystem API, so the shared folder may be
    # HDFS, S3 or a mount; addPyFile then ships it to every executor.
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(target)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    out.write(bytearray(buf.getvalue()))
    out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def session_key(spark: SparkSession) -> tuple:
    """Identity of a session and its running context (for frame caches)."""
    return (id(spark), spark.sparkContext.applicationId)


WRITERS_KEY = "spark.sql.maxConcurrentOutputFileWriters"
SHUFFLES_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_HELD: dict[tuple, list] = {}
_HELD_LOCK = threading.Lock()


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    """``name`` is ``value`` inside. Blocks may overlap: the last to end restores the setting."""
    key = (*session_key(spark), name)
    with _HELD_LOCK:
        held = _HELD.setdefault(key, [0, spark.conf.get(name)])
        held[0] += 1
        spark.conf.set(name, value)
    try:
        yield
    finally:
        with _HELD_LOCK:
            held[0] -= 1
            if held[0] == 0:
                spark.conf.set(name, held[1])
                del _HELD[key]


def brief_shuffles(spark: SparkSession):
    """Shuffle files of queries made inside go as soon as the query has ended, not when the driver
    next collects its garbage: of a run of many steps, those of one step are kept at a time."""
    return _setting(spark, SHUFFLES_KEY, "true")


def unsorted_writes(spark: SparkSession, files: int = 64):
    """Partitioned writes inside keep up to ``files`` files of a task open, so the rows of a
    task that fills a few folders are not sorted (and spilled) by folder; a task that meets
    more folders sorts the rest."""
    return _setting(spark, WRITERS_KEY, str(files))


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/snaplake-work/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can open a local path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def is_local_fs(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


__all__ = ["build_session", "ensure_checkpoint_dir", "ship_code", "work_dir", "local_path",
           "is_local_fs"]
