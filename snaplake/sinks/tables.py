"""Table materialisation on plain Parquet: layouts, versions, publishing.

A table lives under ``root`` as version directories ``root/_v=000001/``,
``root/_v=000002/``, ... A version counts once its write job finished and
its ``_COMMITTED`` marker was created afterwards; readers take the newest
committed version. The marker is a small JSON document: the table's schema
(so partition columns read back with their written types), its partition
columns, and a manifest mapping every live partition directory (e.g.
``uf=SP/ano_abertura=2020``) to the version holding its current files.

A full write puts the whole table in the new version. A merge into a
partitioned table writes only the partitions it touches (those receiving
source rows and those losing matched or deleted keys) and carries the
others over by reference, so a monthly or per-state merge costs the
partitions it changes, not the table. A touched partition left empty drops
out of the manifest, so a key that moved partition leaves no stale row.
Writing a new version never modifies files being read, and a failed job
leaves the previous version current; rerunning it is safe.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snaplake.session import work_dir

VERSION_PREFIX = "_v="
MARKER = "_COMMITTED"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath, jvm


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, hpath, _ = _fs(spark, path)
    fs.delete(hpath, True)


@contextmanager
def kept_rows(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function that writes rows to a compressed table in the shared folder and reads them back,
    so that they are made once and their lineage ends. The tables go when the block ends."""
    paths: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        paths.append(work_dir(spark, name))
        df.write.option("compression", "zstd").parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            remove_folder(spark, path)


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions of the table at ``root`` whose write committed, ascending."""
    fs, hroot, jvm = _fs(spark, root)
    if not fs.exists(hroot):
        return []
    out = []
    for st in fs.listStatus(hroot):
        name = st.getPath().getName()
        if (st.isDirectory() and name.startswith(VERSION_PREFIX)
                and name[len(VERSION_PREFIX):].isdigit()):
            marker = jvm.org.apache.hadoop.fs.Path(st.getPath(), MARKER)
            if fs.exists(marker):
                out.append(int(name[len(VERSION_PREFIX):]))
    return sorted(out)


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{VERSION_PREFIX}{version:06d}"


def _next_version(spark: SparkSession, root: str) -> int:
    versions = committed_versions(spark, root)
    return (versions[-1] + 1) if versions else 1


def _write_marker(spark: SparkSession, path: str, meta: dict) -> None:
    fs, hpath, jvm = _fs(spark, path)
    # Created, never overwritten: of two writers of one version, the second fails.
    out = fs.create(jvm.org.apache.hadoop.fs.Path(hpath, MARKER), False)
    out.write(bytearray(json.dumps(meta).encode("utf-8")))
    out.close()


def read_meta(spark: SparkSession, root: str, version: int) -> dict:
    """Schema, partition columns and manifest of one committed version."""
    path = version_path(root, version)
    fs, hpath, jvm = _fs(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(hpath, MARKER))
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative partition directories ``depth`` levels below ``path``."""
    fs, hpath, jvm = _fs(spark, path)
    level = [("", hpath)]
    for _ in range(depth):
        nxt = []
        for rel, p in level:
            for st in fs.listStatus(p):
                name = st.getPath().getName()
                # partition folders may start with "_" (e.g. _competencia=...)
                if st.isDirectory() and "=" in name and not name.startswith("."):
                    nxt.append((f"{rel}/{name}" if rel else name, st.getPath()))
        level = nxt
    return sorted(rel for rel, _ in level)


def layout(df: DataFrame, partition_by: list[str] | None = None,
           sort_by: list[str] | None = None, clustered: bool = False) -> DataFrame:
    """Cluster rows for a partitioned write: one shuffle on the partition
    columns (AQE's rebalance splits hot partitions such as one large state),
    then a local sort so Parquet min/max statistics prune well. ``clustered``:
    the rows come from files of these very partitions, so they are not shuffled."""
    out = df
    if partition_by and not clustered:
        out = out.hint("rebalance", *partition_by)
    if partition_by or sort_by:
        out = out.sortWithinPartitions(*((partition_by or []) + (sort_by or [])))
    return out


def _write(df: DataFrame, root: str, version: int, partition_by, sort_by,
           max_records_per_file, clustered: bool = False) -> list[str]:
    # Static: what an attempt without a marker left in this folder goes first.
    w = (layout(df, partition_by, sort_by, clustered).write.mode("overwrite").format("parquet")
         .option("partitionOverwriteMode", "static"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    path = version_path(root, version)
    w.save(path)
    return partition_folders(df.sparkSession, path, len(partition_by)) if partition_by else [""]


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None,
                  sort_by: list[str] | None = None, max_records_per_file: int | None = None,
                  clustered: bool = False) -> int:
    """Write ``df`` as the next (full) version of the table at ``root``."""
    spark = df.sparkSession
    version = _next_version(spark, root)
    parts = _write(df, root, version, partition_by or [], sort_by, max_records_per_file, clustered)
    _write_marker(spark, version_path(root, version), {
        "schema": json.loads(df.schema.json()),
        "partition_by": list(partition_by or []),
        "manifest": {rel: version for rel in parts},
        "written": {str(version): len(parts)},
    })
    return version


def read_table(spark: SparkSession, root: str, version: int | None = None,
               schema=None, with_file: bool = False) -> DataFrame | None:
    """The newest committed version (or ``version``), None when none exists.

    ``with_file`` adds ``__file``, the data file each row came from.
    """
    if version is None:
        versions = committed_versions(spark, root)
        if not versions:
            return None
        version = versions[-1]
    meta = read_meta(spark, root, version)
    stored = StructType.fromJson(meta["schema"])
    schema = schema or stored
    names = stored.fieldNames() + (["__file"] if with_file else [])
    manifest: dict = meta["manifest"]
    if not manifest:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("__file", F.lit(None).cast("string")).select(*names) \
            if with_file else empty
    if meta["partition_by"]:
        # A version whose written partitions are all still live is read as
        # one folder; otherwise its live partition folders are listed.
        live: dict[int, list[str]] = {}
        for rel, v in manifest.items():
            live.setdefault(v, []).append(rel)
        written = meta.get("written", {})
        paths = []
        for v, rels in sorted(live.items()):
            if written.get(str(v)) == len(rels):
                paths.append(version_path(root, v))
            else:
                paths += [f"{version_path(root, v)}/{rel}" for rel in sorted(rels)]
        df = spark.read.option("basePath", root.rstrip("/")).schema(schema).parquet(*paths)
    else:
        (v,) = set(manifest.values())
        path = version_path(root, v)
        df = spark.read.option("basePath", path).schema(schema).parquet(path)
    if with_file:
        df = df.withColumn("__file", F.input_file_name())
    return df.select(*names)


def partition_values(spark: SparkSession, root: str, column: str) -> list[str | None]:
    """Distinct values of a partition column, from the newest manifest (no
    data is read). Null partitions come back as None."""
    versions = committed_versions(spark, root)
    if not versions:
        return []
    meta = read_meta(spark, root, versions[-1])
    if column not in meta["partition_by"]:
        raise ValueError(f"{column} is not a partition column of {root}")
    out = set()
    for rel in meta["manifest"]:
        for seg in rel.split("/"):
            name, _, value = seg.partition("=")
            if name == column:
                value = unquote(value)
                out.add(None if value == "__HIVE_DEFAULT_PARTITION__" else value)
    return sorted(out, key=lambda v: (v is None, v or ""))


def latest_value(spark: SparkSession, root: str, column: str) -> str | None:
    """Largest value of a partition column in the newest version: from the manifest, no scan."""
    return max((v for v in partition_values(spark, root, column) if v is not None), default=None)


def write_full(df: DataFrame, root: str, partition_by: list[str] | None = None,
               sort_by: list[str] | None = None) -> DataFrame:
    """Full-refresh materialisation: write a version, return the table."""
    write_version(df, root, partition_by, sort_by)
    return read_table(df.sparkSession, root, schema=df.schema).select(*df.columns)


def publish(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Point temp view ``name`` at the newest committed version of ``root``."""
    table = read_table(spark, root)
    if table is None:
        raise FileNotFoundError(f"no committed version under {root}")
    table.createOrReplaceTempView(name)
    return table


def _values(rel: str) -> tuple[str | None, ...]:
    """Partition values of a folder such as ``uf=SP/ano=2020``, as text."""
    raw = [unquote(seg.partition("=")[2]) for seg in rel.split("/")]
    return tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in raw)


def read_partitions(spark: SparkSession, root: str, meta: dict, rels: set[str], schema) -> DataFrame:
    """Only the live partition folders ``rels`` of a version."""
    names = schema.fieldNames()
    if not rels:
        return spark.createDataFrame([], schema)
    paths = [f"{version_path(root, meta['manifest'][rel])}/{rel}" for rel in sorted(rels)]
    return spark.read.option("basePath", root.rstrip("/")).schema(schema).parquet(*paths).select(*names)


def merge_into(spark: SparkSession, root: str, source: DataFrame, keys: list[str],
               partition_by: list[str] | None = None, sort_by: list[str] | None = None,
               order: list[str] | None = None, deletes: DataFrame | None = None,
               null_safe: bool = True, settled: bool = False) -> DataFrame:
    """Upsert ``source`` into the table at ``root`` as a new version.

    ``settled`` says that the source holds rows of each key's largest ``order`` only, and
    none of a key in ``deletes`` (a load of one month, say), where those are distinct and
    written: it is then made once, without the aggregate that finds them.

    Unpartitioned tables are rewritten whole. Partitioned tables rewrite the
    touched partitions only: partitions receiving source rows, plus the
    partitions currently holding matched or deleted keys (a key may move).
    The key join runs once, on key columns, to name the folders; the write then
    reads those folders and no others.
    """
    from snaplake.operators.incremental import latest_per_key, upsert

    current = read_table(spark, root, schema=source.schema, with_file=bool(partition_by))
    if current is None:
        write_version(upsert(None, source, keys, order, deletes), root, partition_by, sort_by)
        return read_table(spark, root, schema=source.schema).select(*source.columns)
    if not partition_by:
        merged = upsert(current.select(*source.columns), source, keys, order=order,
                        deletes=deletes, null_safe=null_safe)
        write_version(merged, root, partition_by, sort_by)
        return read_table(spark, root, schema=source.schema).select(*source.columns)

    # The source feeds three steps (touched partitions, the folders they
    # replace, the write): it is written once, compressed, in the shared folder,
    # and goes after the merge. So do the keys to delete, which may
    # come from as much work; rows they name leave the source at once.
    with kept_rows(spark) as keep:
        if deletes is not None and not settled:
            deletes = keep(deletes.select(*keys).distinct(), "merge-deletes")
        src = keep(source.distinct() if settled else latest_per_key(source, keys, order, without=deletes), "merge-source")
        _merge(spark, root, current, src, keys, partition_by, sort_by, order, deletes, null_safe)
    return read_table(spark, root, schema=source.schema).select(*source.columns)


def _merge(spark: SparkSession, root: str, current: DataFrame, src: DataFrame, keys: list[str], partition_by: list[str],
           sort_by: list[str] | None, order: list[str] | None, deletes: DataFrame | None, null_safe: bool) -> None:
    """The merge of a written source into a partitioned table, whose rows name their files."""
    from snaplake.operators.incremental import holders, unmatched

    meta = read_meta(spark, root, committed_versions(spark, root)[-1])
    rel = F.regexp_extract("__file", r"/_v=[0-9]+/(.+)/[^/]+$", 1).alias("rel")
    moved = holders(current, src, keys, ["__file"], order, null_safe, deletes).select(rel)
    # One row per partition folder reaches the driver, twice: bounded by the
    # table's partition count, which the manifest holds anyway.
    replaced = {unquote(r["rel"]) for r in moved.distinct().collect()}
    receiving = {tuple(r) for r in src.select(*[F.col(c).cast("string") for c in partition_by]).distinct().collect()}
    replaced |= {rel for rel in meta["manifest"] if _values(rel) in receiving}
    replaced = {rel for rel in meta["manifest"] if rel in replaced or unquote(rel) in replaced}
    old_rows = read_partitions(spark, root, meta, replaced, src.schema)
    kept = unmatched(old_rows, src, keys, order, null_safe, deletes)
    new_content = kept.unionByName(src.select(*kept.columns))
    version = _next_version(spark, root)
    written = _write(new_content, root, version, partition_by, sort_by, None)
    manifest = {rel: v for rel, v in meta["manifest"].items() if rel not in replaced}
    manifest.update({rel: version for rel in written})
    counts = dict(meta.get("written", {}), **{str(version): len(written)})
    _write_marker(spark, version_path(root, version), {
        "schema": json.loads(src.schema.json()),
        "partition_by": list(partition_by),
        "manifest": manifest,
        "written": counts,
    })


def readable(spark: SparkSession, root: str, version: int) -> bool:
    """Whether a version is committed and all its partition folders are still there."""
    if version not in committed_versions(spark, root):
        return False
    for rel, v in read_meta(spark, root, version)["manifest"].items():
        fs, path, _ = _fs(spark, f"{version_path(root, v)}/{rel}")
        if not fs.exists(path):
            return False
    return True


def replace_partitions(df: DataFrame, root: str, partition_by: list[str],
                       column: str, values: list[str], sort_by: list[str] | None = None,
                       clustered: bool = False) -> int:
    """Replace every partition whose ``column`` is in ``values`` with ``df``.

    ``df`` holds the new content of exactly those values (e.g. the months
    being loaded); all other partitions are carried over by reference, so
    loading one month writes one month. ``clustered`` as in ``layout``. Returns the
    new version.
    """
    spark = df.sparkSession
    versions = committed_versions(spark, root)
    if not versions:
        return write_version(df, root, partition_by, sort_by, clustered=clustered)
    if column not in partition_by:
        raise ValueError(f"{column} must be a partition column")
    prev = read_meta(spark, root, versions[-1])
    version = versions[-1] + 1
    written = _write(df, root, version, partition_by, sort_by, None, clustered)
    gone = {str(v) for v in values}

    def hit(rel: str) -> bool:
        for seg in rel.split("/"):
            name, _, value = seg.partition("=")
            if name == column and unquote(value) in gone:
                return True
        return False

    manifest = {rel: v for rel, v in prev["manifest"].items() if not hit(rel)}
    manifest.update({rel: version for rel in written})
    _write_marker(spark, version_path(root, version), {
        "schema": json.loads(df.schema.json()),
        "partition_by": list(partition_by),
        "manifest": manifest,
        "written": dict(prev.get("written", {}), **{str(version): len(written)}),
    })
    return version


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete files no reader of the last ``keep`` versions can reach.

    Keeps every partition folder referenced by the manifests of the newest
    ``keep`` committed versions, and those versions' markers; removes other
    partition folders, versions left with nothing referenced, and
    uncommitted folders older than the newest committed version (failed
    writes). Returns the removed paths.
    """
    versions = committed_versions(spark, root)
    if not versions:
        return []
    kept_versions = versions[-keep:]
    live: dict[int, set[str]] = {}
    for v in kept_versions:
        for rel, owner in read_meta(spark, root, v)["manifest"].items():
            live.setdefault(owner, set()).add(rel)
    fs, hroot, jvm = _fs(spark, root)
    removed = []
    for st in fs.listStatus(hroot):
        name = st.getPath().getName()
        digits = name[len(VERSION_PREFIX):]
        if not (st.isDirectory() and name.startswith(VERSION_PREFIX) and digits.isdigit()):
            continue
        v = int(digits)
        if v > versions[-1]:
            continue  # possibly a write in progress
        if v in kept_versions:
            refs = live.get(v, set())
            if "" in refs:
                continue
            meta = read_meta(spark, root, v)
            depth = len(meta["partition_by"])
            for rel in partition_folders(spark, version_path(root, v), depth):
                if rel not in refs:
                    p = f"{version_path(root, v)}/{rel}"
                    fs.delete(jvm.org.apache.hadoop.fs.Path(p), True)
                    removed.append(p)
            continue
        refs = live.get(v)
        if not refs:
            fs.delete(st.getPath(), True)
            removed.append(version_path(root, v))
            continue
        if "" in refs:
            continue
        depth = len(read_meta(spark, root, v)["partition_by"]) if fs.exists(
            jvm.org.apache.hadoop.fs.Path(st.getPath(), MARKER)) else 0
        for rel in partition_folders(spark, version_path(root, v), depth):
            if rel not in refs:
                p = f"{version_path(root, v)}/{rel}"
                fs.delete(jvm.org.apache.hadoop.fs.Path(p), True)
                removed.append(p)
    return removed
