"""The landing zone: monthly folders of zipped extracts.

Layout: ``<root>/competencia=YYYY-MM/<Name>.zip``. Listing is a Spark job
over file metadata (``binaryFile`` without reading ``content``), so it scales
to any number of months; the routing from file name to table is a Column
expression, not a Python loop.
"""

from __future__ import annotations

import posixpath
import re
import zipfile
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.schemas import FILE_PREFIXES, columns_of
from snaplake.session import brief_shuffles, ship_code, unsorted_writes
from snaplake.sinks.tables import partition_folders, remove_folder
from snaplake.sources.csv_dialect import write_csv


def table_of(name: Column | str) -> Column:
    """File name -> table: lower-case, strip ``.zip``, first matching prefix,
    else the stem itself."""
    c = F.col(name) if isinstance(name, str) else name
    stem = F.regexp_replace(F.lower(c), r"\.zip$", "")
    expr = None
    for prefix, table in FILE_PREFIXES:
        cond = stem.startswith(prefix)
        expr = F.when(cond, F.lit(table)) if expr is None else expr.when(cond, F.lit(table))
    return expr.otherwise(stem)


def list_files(spark: SparkSession, root: str, period: str | None = None) -> DataFrame:
    """``(nome, pasta, tabela, size_bytes, path)`` for every ``.zip`` under
    ``root`` (or one period's folder), ordered by name."""
    base = root.rstrip("/")
    if period is not None:
        base = f"{base}/competencia={period}"
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", "*.[zZ][iI][pP]")
             .option("recursiveFileLookup", "true")
             .load(base)
             .select("path", "length"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    pasta = F.regexp_extract("path", r"competencia=([^/]+)/[^/]+$", 1)
    return files.select(
        name.alias("nome"),
        F.nullif(pasta, F.lit("")).alias("pasta"),
        table_of(name).alias("tabela"),
        F.coalesce(F.col("length"), F.lit(0)).cast("long").alias("size_bytes"),
        F.col("path"),
    ).orderBy("nome")


def period_of(run_date) -> str:
    """``YYYY-MM`` of a run date (a ``date``/``datetime`` or ISO text)."""
    text = run_date if isinstance(run_date, str) else run_date.isoformat()
    return text[:7]


def periods(spark: SparkSession, root: str) -> DataFrame:
    """Distinct period folders (``YYYY-MM``: length 7, ``-`` at index 4), ascending."""
    p = list_files(spark, root).select("pasta").distinct()
    ok = (F.length("pasta") == 7) & (F.substring("pasta", 5, 1) == "-")
    return p.where(ok).orderBy("pasta")


def latest_period(spark: SparkSession, root: str) -> str:
    """The most recent period folder; raises when there is none."""
    row = periods(spark, root).agg(F.max("pasta").alias("p")).first()
    if row is None or row["p"] is None:
        raise RuntimeError(f"no period folder under {root}")
    return row["p"]


def listing_summary(listing: DataFrame) -> DataFrame:
    """Files and bytes per (period, table)."""
    return listing.groupBy("pasta", "tabela").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("total_bytes"))


# ----------------------------------------------------------------- writing

def _zip_tasks(batches):
    """mapInPandas body: one zip per (csv folder, zip path) row, streamed."""
    import pandas as pd

    from snaplake.sources.zip_csv import _filesystem

    for pdf in batches:
        out = []
        for src_dir, dest, member in zip(pdf["src_dir"], pdf["dest"], pdf["member"]):
            fs_src, p_src = _filesystem(src_dir)
            import pyarrow.fs as pafs

            parts = sorted(i.path for i in fs_src.get_file_info(pafs.FileSelector(p_src))
                           if i.type == pafs.FileType.File
                           and not posixpath.basename(i.path).startswith(("_", ".")))
            fs_dst, p_dst = _filesystem(dest)
            fs_dst.create_dir(posixpath.dirname(p_dst), recursive=True)
            size = 0
            with fs_dst.open_output_stream(p_dst) as raw:
                with zipfile.ZipFile(_Sink(raw), "w", compression=zipfile.ZIP_DEFLATED) as zf:
                    with zf.open(member, "w", force_zip64=True) as w:
                        for part in parts:
                            with fs_src.open_input_stream(part, compression="detect") as r:
                                while True:
                                    block = r.read(1 << 20)
                                    if not block:
                                        break
                                    w.write(block)
                                    size += len(block)
            out.append((posixpath.basename(p_dst), size))
        yield pd.DataFrame(out, columns=["nome", "csv_bytes"])


class _Sink:
    """Write-only, non-seekable file wrapper zipfile can stream into."""

    def __init__(self, raw):
        self.raw = raw
        self.pos = 0

    def write(self, b):
        self.raw.write(b)
        self.pos += len(b)
        return len(b)

    def tell(self):
        return self.pos

    def flush(self):
        pass

    def seekable(self):
        return False


def write_zips(df: DataFrame, root: str, staging: str, table: str) -> None:
    """``write_extracts`` now; the staged members go once they are zipped."""
    with brief_shuffles(df.sparkSession):
        write_extracts(df, root, staging, table).collect()  # a row per zip
    remove_folder(df.sparkSession, staging)


def write_extracts(df: DataFrame, root: str, staging: str, table: str,
                   file_col: str = "nome", period_col: str = "_competencia") -> DataFrame:
    """Write raw rows as landing zips: ``root/competencia=P/<nome>.zip``.

    Spark writes the CSV members in parallel (one folder per zip, gzipped); a second
    job zips each folder in its own task, streaming, so no file passes
    through the driver. Returns ``(nome, csv_bytes)`` per zip (lazy).
    """
    cols = columns_of(table)
    with unsorted_writes(df.sparkSession):
        write_csv(df.select(*cols, F.col(period_col).alias("__p"), F.col(file_col).alias("__f")),
                  staging, partition_by=["__p", "__f"], compression="gzip")
    return _zip_folders(df.sparkSession, root, staging)


def write_lines(df: DataFrame, root: str, staging: str, line_col: str,
                file_col: str = "nome", period_col: str = "_competencia") -> DataFrame:
    """The same from lines of text as they are, well formed or not."""
    out = df.select(F.col(line_col).alias("line"), F.col(period_col).alias("__p"), F.col(file_col).alias("__f"))
    with unsorted_writes(df.sparkSession):
        (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("__p", "__f").text(staging, compression="gzip"))
    return _zip_folders(df.sparkSession, root, staging)


def _zip_folders(spark: SparkSession, root: str, staging: str) -> DataFrame:
    """Zips the folders that lie in ``staging``: they are listed, not found by making the
    rows again."""
    ship_code(spark)
    rows = []
    for rel in partition_folders(spark, staging, 2):
        period, name = (unquote(seg.partition("=")[2]) for seg in rel.split("/"))
        if "__HIVE_DEFAULT_PARTITION__" in (period, name):
            raise ValueError(f"rows without a period or a file name in {staging}")
        member = re.sub(r"(?i)\.zip$", ".CSV", name)
        rows.append((f"{staging.rstrip('/')}/{rel}", f"{root.rstrip('/')}/competencia={period}/{name}", member))
    plan = spark.createDataFrame(rows, "src_dir string, dest string, member string")  # a row per zip
    return plan.repartition(max(1, len(rows))).mapInPandas(_zip_tasks, "nome string, csv_bytes long")
