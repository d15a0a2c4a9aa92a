"""Landing zips from staged rows: made once, not sorted by folder, gzipped on the way."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from snaplake.session import WRITERS_KEY, unsorted_writes
from snaplake.sources import bronze, landing, zip_csv


def companies(spark, seen, n=200):
    count = F.udf(lambda i: (seen.add(1) if seen is not None else None, f"{i:08d}")[1]).asNondeterministic()
    rows = spark.range(n).repartition(4).select(
        count("id").alias("cnpj_basico"), F.lit('A "b" é').alias("razao_social"), F.lit("2062").alias("natureza_juridica"), F.lit("49").alias("qualificacao_responsavel"),
        F.lit("1,0").alias("capital_social"), F.lit(None).cast("string").alias("porte_empresa"), F.lit("").alias("ente_federativo_responsavel"),
        F.when(F.col("id") % 2 == 0, "2026-01").otherwise("2026-02").alias("_competencia"),
        F.concat(F.lit("Empresas"), (F.col("id") % 3).cast("string"), F.lit(".zip")).alias("nome"))
    return rows


def test_rows_are_made_once_and_zips_hold_them_all(spark, scratch):
    seen = spark.sparkContext.accumulator(0)
    df = companies(spark, seen)
    before = spark.conf.get(WRITERS_KEY)
    sizes = landing.write_extracts(df, f"{scratch}/landing", f"{scratch}/staging", "empresas").collect()
    assert seen.value == 200  # it was made three times: for the rows, to count the zips, to name them
    assert spark.conf.get(WRITERS_KEY) == before
    assert sorted({r["nome"] for r in sizes}) == ["Empresas0.zip", "Empresas1.zip", "Empresas2.zip"] and len(sizes) == 6
    staged = [f for _, _, files in os.walk(f"{scratch}/staging") for f in files if f.startswith("part-")]
    assert staged and all(f.endswith(".gz") for f in staged)
    with zipfile.ZipFile(f"{scratch}/landing/competencia=2026-01/Empresas0.zip") as zf:
        assert zf.namelist() == ["Empresas0.CSV"] and zf.read("Empresas0.CSV").startswith(b'"')
    bronze.ingest(spark, f"{scratch}/landing", f"{scratch}/bronze", ["2026-01", "2026-02"], "2026-02-20", ["empresas"])
    back = bronze.read_table(spark, f"{scratch}/bronze", "empresas")
    assert sorted(r[0] for r in back.select("cnpj_basico").collect()) == [f"{i:08d}" for i in range(200)]


def test_a_second_write_zips_its_own_folders_only(spark, scratch):
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df = companies(spark, spark.sparkContext.accumulator(0))
        for month in ("2026-01", "2026-02"):
            got = landing.write_extracts(df.where(F.col("_competencia") == month), f"{scratch}/landing", f"{scratch}/staging", "empresas").collect()
            assert len(got) == 3
    finally:
        spark.conf.set(key, old)
    with pytest.raises(ValueError):
        lines = spark.range(3).select(F.lit("x").alias("l"), F.lit("2026-01").alias("_competencia"), F.lit(None).cast("string").alias("nome"))
        landing.write_lines(lines, f"{scratch}/l2", f"{scratch}/s2", "l")


def test_partitioned_writes_that_fill_few_folders_do_not_sort(spark, scratch):
    before = spark.conf.get(WRITERS_KEY)
    with unsorted_writes(spark, 3):
        with unsorted_writes(spark, 3):
            pass
        assert spark.conf.get(WRITERS_KEY) == "3"
        spark.range(1000).withColumn("p", F.col("id") % 10).write.partitionBy("p").parquet(f"{scratch}/many")  # more folders than files
    assert spark.conf.get(WRITERS_KEY) == before
    assert spark.read.parquet(f"{scratch}/many").groupBy("p").count().where("count = 100").count() == 10


def test_reader_does_not_read_ahead(monkeypatch):
    import pyarrow.csv as pc

    asked = []
    real = pc.ReadOptions
    monkeypatch.setattr(pc, "ReadOptions", lambda **kw: (asked.append(kw), real(**kw))[1])
    import io

    reader = zip_csv.ZipCsvReader({"path": "x", "table": "empresas"}, type("S", (), {"fields": []})())
    line = b'"1";"N";"2062";"49";"1,0";"01";""\n'
    batches = list(reader._read_arrow(io.BytesIO(line * 100_000), "E.zip", zip_csv.Tally(False)))
    assert asked[0]["use_threads"] is False and asked[0]["block_size"] <= 1 << 20
    assert sum(b.num_rows for b in batches) == 100_000 and len(batches) > 2
