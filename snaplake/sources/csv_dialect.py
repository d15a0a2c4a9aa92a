"""The extracts' CSV dialect with Spark's built-in CSV reader and writer.

For unzipped members: ``;`` separator, no header, ISO-8859-1, ``"`` quotes
with doubled quotes as the escape, quoted newlines allowed. Spark's reader
pads short rows and truncates over-long ones, and keeps the text of both (the
corrupt-record column, with column pruning off so that every field is counted). The
separators outside quotes in that text tell them apart: short rows stay padded, over-long
rows are dropped, or come back as rejects with their number of fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.schemas import raw_schema

DIALECT = {
    "sep": ";",
    "header": "false",
    "encoding": "ISO-8859-1",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
}


RAW = "__line"
ORIGIN = "_arquivo_origem"


def n_fields(line: Column) -> Column:
    """Number of fields of a line: separators outside quoted stretches, and one."""
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*+"', "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(DIALECT["sep"]), F.lit(""))) + 1).cast("int")


def _lines(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Declared columns, and the text of each row whose number of fields is not theirs."""
    schema = T.StructType([*raw_schema(table).fields, T.StructField(RAW, T.StringType(), True)])
    return (spark.read.options(**DIALECT).option("columnNameOfCorruptRecord", RAW).option("columnPruning", "false")
            .schema(schema).csv(path).withColumn(ORIGIN, F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)))


def _read(table: str) -> Column:
    """Always true, and names a declared column: the reader wants one beside the line."""
    return F.coalesce(F.length(raw_schema(table).fieldNames()[0]), F.lit(0)) >= 0


def read_csv(spark: SparkSession, path: str, table: str, drop_long_rows: bool = True) -> DataFrame:
    """Raw extract ``table`` from plain CSV files at ``path``."""
    df = _lines(spark, path, table)
    if drop_long_rows:
        df = df.where(_read(table) & (F.col(RAW).isNull() | (n_fields(F.col(RAW)) <= len(raw_schema(table)))))
    return df.drop(RAW)


def read_rejects(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(file, line, number of fields) of the over-long rows that ``read_csv`` drops."""
    df = _lines(spark, path, table).withColumn("n_campos", n_fields(F.col(RAW)))
    return df.where(_read(table) & (F.col("n_campos") > len(raw_schema(table)))).select(ORIGIN, F.col(RAW).alias("linha"), "n_campos")


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str = "none") -> None:
    """Write ``df`` in the extract dialect (all fields quoted, like the source), in place of
    all that ``path`` held."""
    w = df.write.mode("overwrite").options(**{k: v for k, v in DIALECT.items()
                                             if k != "multiLine"}).option("quoteAll", "true")
    w = w.option("compression", compression).option("partitionOverwriteMode", "static")
    if compression == "gzip":  # staged, to be read once
        w = w.option("zlib.compress.level", "BEST_SPEED")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
