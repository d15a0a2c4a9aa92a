"""Bronze: raw extracts as Parquet with four metadata columns.

Layout: ``<root>/tabela=<table>/competencia=<YYYY-MM>/part-*.parquet``
(Snappy; a file per zip, or at most ``max_records_per_file`` rows each if given). Writing one table
for any number of months is one Spark job over all their zips; dynamic
partition overwrite replaces exactly the months written, so a rerun is
idempotent and shards of one month never overwrite each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snaplake.schemas import ALL_TABLES, SOURCE_TAG, columns_of
from snaplake.session import unsorted_writes
from snaplake.sources.zip_csv import ORIGIN_COLUMN, read_zips

PERIOD_DIR = "competencia"


def with_metadata(df: DataFrame, period: str | None, extraction_date: str,
                  origin: str | None = None) -> DataFrame:
    """Add ``_fonte``, ``_competencia``, ``_arquivo_origem``, ``_data_extracao``.

    ``period`` None keeps an existing ``_competencia`` column; ``origin``
    None keeps the scan's ``_arquivo_origem``. The extraction date is passed
    in (not read from the clock) so reruns produce identical files.
    """
    cols = {"_fonte": F.lit(SOURCE_TAG), "_data_extracao": F.lit(extraction_date)}
    if period is not None:
        cols["_competencia"] = F.lit(period)
    if origin is not None or ORIGIN_COLUMN not in df.columns:
        cols[ORIGIN_COLUMN] = F.lit(origin)
    return df.withColumns(cols)


def write_table(df: DataFrame, root: str, table: str,
                max_records_per_file: int = 0) -> None:
    """Write bronze rows of ``table`` (any months) under ``root/tabela=table``.

    No shuffle and no sort: each scan task (one zip) writes its own files into its
    month's folder.
    """
    out = df.select(*columns_of(table), "_fonte", "_competencia", ORIGIN_COLUMN,
                    "_data_extracao", F.col("_competencia").alias(PERIOD_DIR))
    with unsorted_writes(df.sparkSession):
        (out.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", max_records_per_file)
         .option("compression", "snappy")
         .partitionBy(PERIOD_DIR)
         .parquet(f"{root.rstrip('/')}/tabela={table}"))


def months(spark: SparkSession, root: str, table: str) -> list[str]:
    """Months present in bronze for ``table`` (folder listing, no data read)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/tabela={table}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{PERIOD_DIR}="):
            out.append(name.split("=", 1)[1])
    return sorted(out)


def read_table(spark: SparkSession, root: str, table: str,
               periods: list[str] | None = None) -> DataFrame:
    """Declared columns + metadata of one bronze table over all its months.

    The folder-derived ``competencia`` column is used for partition pruning
    and then dropped (only declared columns are exposed).
    """
    df = spark.read.parquet(f"{root.rstrip('/')}/tabela={table}")
    if periods:
        df = df.where(F.col(PERIOD_DIR).isin(*periods))
    return df.select(*columns_of(table), "_fonte", "_competencia", ORIGIN_COLUMN,
                     "_data_extracao")


def run_concurrently(fn, items, max_jobs: int = 4) -> list:
    """``[fn(x) for x in items]`` with up to ``max_jobs`` Spark jobs in
    flight (Spark schedules jobs from several driver threads side by side);
    the first error is raised."""
    if max_jobs <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max_jobs) as pool:
        return list(pool.map(fn, items))


REPORT = ("tabela string, competencia string, arquivo string, n_rows bigint, n_padded bigint, n_rejected bigint")


def ingest_report(spark: SparkSession, landing_root: str, bronze_root: str, periods: list[str],
                  extraction_date: str, tables: list[str] | None = None, na_tokens=None,
                  max_jobs: int = 4) -> DataFrame:
    """Landing zips of ``periods`` -> bronze: one listing job, then one scan
    and one write job per table covering all the months (each zip's month
    comes from its folder). Returns a row per zip: rows read, rows padded, lines rejected.

    The counts are observed while bronze is written (the source ends each zip with a row
    that counts), so nothing is read again. Only zips that rejected lines are scanned a
    second time, for the lines: they go to ``tabela=rejeitos`` (see ``read_rejects``).
    """
    from snaplake.sources.landing import list_files
    from snaplake.sources.zip_csv import COUNTS_COLUMN, PATH_COLUMN

    wanted = tables or ALL_TABLES
    for t in wanted:
        columns_of(t)
    listing = (list_files(spark, landing_root)
               .where(F.col("pasta").isin(*periods) & F.col("tabela").isin(*wanted))
               .select("tabela", "path").collect())  # one row per zip
    by_table: dict[str, list[str]] = {}
    for r in listing:
        by_table.setdefault(r["tabela"], []).append(r["path"])
    period = F.regexp_extract(F.col(PATH_COLUMN), r"competencia=([^/]+)/[^/]+$", 1)

    def load(table: str) -> list[tuple]:
        paths = sorted(by_table.get(table, []))
        if not paths:
            return []
        seen = Observation()
        df = read_zips(spark, paths, table=table, na_tokens=na_tokens, with_path=True, counts=True)
        last = F.when(F.col(COUNTS_COLUMN).isNotNull(), F.struct(PATH_COLUMN, f"{COUNTS_COLUMN}.*"))
        df = df.observe(seen, F.collect_list(last).alias("zips"))  # a row per zip, as the listing has
        df = df.where(F.col(COUNTS_COLUMN).isNull()).withColumn("_competencia", period)
        write_table(with_metadata(df.drop(PATH_COLUMN, COUNTS_COLUMN), None, extraction_date), bronze_root, table)
        zips = sorted(tuple(z) for z in seen.get["zips"])
        write_rejects(spark, bronze_root, table, paths, [z[0] for z in zips if z[3]])
        return [(table, z[0].rsplit("competencia=", 1)[-1].split("/")[0], z[0].rsplit("/", 1)[-1], *z[1:]) for z in zips]

    # Tables are independent jobs; submitting them together keeps the
    # cluster busy while single-zip code tables run one task each.
    rows = [r for found in run_concurrently(load, wanted, max_jobs) for r in found]
    return spark.createDataFrame(rows, REPORT)


def ingest(spark: SparkSession, landing_root: str, bronze_root: str, periods: list[str],
           extraction_date: str, tables: list[str] | None = None, na_tokens=None,
           max_jobs: int = 4) -> DataFrame:
    """``ingest_report`` summed up: zips read and rows landed per table and month."""
    report = ingest_report(spark, landing_root, bronze_root, periods, extraction_date, tables, na_tokens, max_jobs)
    return report.groupBy("tabela", "competencia").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"))


REJECTS = "rejeitos"


def write_rejects(spark: SparkSession, bronze_root: str, table: str, paths: list[str], guilty: list[str]) -> None:
    """Replace the rejected lines of the ``paths``' months with those of ``guilty``."""
    jvm = spark.sparkContext._jvm
    months_read = sorted({p.rsplit("competencia=", 1)[-1].split("/")[0] for p in paths})
    base = f"{bronze_root.rstrip('/')}/tabela={REJECTS}"
    for month in months_read:  # a re-issued month leaves no old lines
        path = jvm.org.apache.hadoop.fs.Path(f"{base}/origem={table}/{PERIOD_DIR}={month}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    for month in months_read:
        zips = [p for p in guilty if f"competencia={month}/" in p]
        if zips:
            (read_zips(spark, zips, table=table, rejects=True).write.mode("overwrite")
             .parquet(f"{base}/origem={table}/{PERIOD_DIR}={month}"))


def read_rejects(spark: SparkSession, bronze_root: str) -> DataFrame:
    """(tabela, competencia, arquivo, linha, n_campos): the lines that no bronze table took."""
    from snaplake.sources.zip_csv import REJECT_SCHEMA

    base = f"{bronze_root.rstrip('/')}/tabela={REJECTS}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        df = spark.createDataFrame([], f"{REJECT_SCHEMA}, origem string, {PERIOD_DIR} string")
    else:
        df = spark.read.schema(f"{REJECT_SCHEMA}, origem string, {PERIOD_DIR} string").parquet(base)
    return df.select(F.col("origem").alias("tabela"), PERIOD_DIR, F.col("_arquivo_origem").alias("arquivo"), "linha", "n_campos")


def summary(spark: SparkSession, bronze_root: str, tables: list[str],
            periods: list[str] | None = None) -> DataFrame:
    """Files read and rows written per (table, period), from bronze itself."""
    out = None
    for t in tables:
        s = (read_table(spark, bronze_root, t, periods)
             .groupBy(F.col("_competencia").alias("competencia"))
             .agg(F.countDistinct(ORIGIN_COLUMN).alias("n_files"),
                  F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("tabela"), "*"))
        out = s if out is None else out.unionByName(s)
    return out
