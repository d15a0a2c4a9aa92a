"""Append a frame to a named table of plain Parquet files, all or nothing.

``df.write.format("snapappend").option("path", ...)`` lets each task write one file under
the append's own hidden folder and report it with its row count. The commit moves the
reported files into the table and then writes the append's receipt; readers take the files
that receipts name. A task that fails, runs twice or loses its executor is not in any
report, so its rows are never visible; an append that is repeated under the same ``batch``
finds its receipt and adds nothing.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from snaplake.session import ship_code
from snaplake.sources.zip_csv import _filesystem

RECEIPTS = "_receipts"


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class AppendWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: str):
        self.path = path.rstrip("/")
        self.batch = batch

    def write(self, iterator: Iterator) -> Written:
        import pyarrow.parquet as pq

        fs, root = _filesystem(self.path)
        name, rows, writer = f"part-{uuid.uuid4().hex}.parquet", 0, None
        folder = f"{root}/_open/{self.batch}"
        try:
            for batch in iterator:
                if writer is None:
                    fs.create_dir(folder, recursive=True)
                    writer = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=fs, compression="snappy")
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written(name if writer is not None else None, rows)

    def commit(self, messages: list) -> None:
        fs, root = _filesystem(self.path)
        files = [m for m in messages if m is not None and m.file]
        fs.create_dir(f"{root}/{RECEIPTS}", recursive=True)
        for m in files:
            fs.move(f"{root}/_open/{self.batch}/{m.file}", f"{root}/{m.file}")
        receipt = {"batch": self.batch, "rows": sum(m.rows for m in files), "files": sorted(m.file for m in files)}
        with fs.open_output_stream(f"{root}/{RECEIPTS}/{self.batch}.json.new") as out:
            out.write(json.dumps(receipt).encode())
        fs.move(f"{root}/{RECEIPTS}/{self.batch}.json.new", f"{root}/{RECEIPTS}/{self.batch}.json")
        self.abort(messages)

    def abort(self, messages: list) -> None:
        """Files of tasks that nobody asks for go."""
        import pyarrow.fs as pafs

        fs, root = _filesystem(self.path)
        if fs.get_file_info(f"{root}/_open/{self.batch}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/_open/{self.batch}")


class AppendSource(DataSource):
    """Options: ``path`` of the table, ``batch`` naming the append."""

    @classmethod
    def name(cls) -> str:
        return "snapappend"

    def writer(self, schema: StructType, overwrite: bool) -> AppendWriter:
        if overwrite:
            raise ValueError("snapappend only appends")
        return AppendWriter(self.options["path"], self.options["batch"])


def _receipts(path: str) -> dict[str, dict]:
    import pyarrow.fs as pafs

    fs, root = _filesystem(path.rstrip("/"))
    found = fs.get_file_info(pafs.FileSelector(f"{root}/{RECEIPTS}", allow_not_found=True))
    out = {}
    for info in found:
        if info.path.endswith(".json"):
            with fs.open_input_stream(info.path) as f:
                out[posixpath.basename(info.path)[:-len(".json")]] = json.loads(f.read())
    return out


def append_rows(df: DataFrame, path: str, batch: str | None = None) -> int:
    """Append ``df`` to the table at ``path``; returns how many rows that added (0 where
    ``batch`` was already in). Of appends of the same batch, one may run at a time."""
    spark = df.sparkSession
    batch = batch or uuid.uuid4().hex
    if batch in _receipts(path):
        return 0
    ship_code(spark)
    spark.dataSource.register(AppendSource)
    df.write.format("snapappend").mode("append").option("path", path).option("batch", batch).save()
    return _receipts(path)[batch]["rows"]


def read_appended(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all committed appends."""
    files = [f"{path.rstrip('/')}/{f}" for r in _receipts(path).values() for f in r["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
