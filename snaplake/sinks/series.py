"""Extraction series: small extracts kept per series and extraction date.

Layout ``<root>/serie=<name>/data_extracao=<YYYY-MM-DD>/part-*.<fmt>``. The
formats are Parquet (Snappy), JSON and CSV with a header. JSON is written as
JSON lines (one object per line, UTF-8), which Spark and most tools read
back; the reference wrote one JSON array per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = {"parquet", "json", "csv"}


def write_series(df: DataFrame, root: str, serie: str, extraction_date: str,
                 fmt: str = "parquet") -> str:
    """Write ``df`` as one extraction of ``serie``; reruns replace that date only."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {sorted(FORMATS)}")
    out = df.withColumns({"serie": F.lit(serie), "data_extracao": F.lit(extraction_date)})
    w = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("serie", "data_extracao"))
    if fmt == "csv":
        w = w.option("header", "true")
    elif fmt == "parquet":
        w = w.option("compression", "snappy")
    w.format(fmt).save(root)
    return f"{root.rstrip('/')}/serie={serie}/data_extracao={extraction_date}"


def read_series(spark: SparkSession, root: str, serie: str | None = None,
                fmt: str = "parquet", schema=None) -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", "true")
    if schema is not None:
        r = r.schema(schema)
    df = r.load(root)
    return df.where(F.col("serie") == serie) if serie else df
