from pyspark.sql import functions as F

from snaplake.sinks import series, tables
from snaplake.sources import catalog


def test_series_formats_roundtrip(spark, scratch):
    df = spark.createDataFrame([("AC", 22), ("RJ", 92), ("TO", 139)], "uf string, municipios int")
    for fmt in ["parquet", "json", "csv"]:
        root = f"{scratch}/{fmt}"
        series.write_series(df, root, "estados", "2026-03-26", fmt=fmt)
        series.write_series(df, root, "estados", "2026-03-26", fmt=fmt)  # rerun replaces
        back = series.read_series(spark, root, "estados", fmt=fmt)
        assert back.count() == 3
        assert {r["uf"] for r in back.collect()} == {"AC", "RJ", "TO"}


def test_full_refresh_and_publish(spark, scratch):
    root = f"{scratch}/t"
    df = spark.range(10).select(F.col("id"), (F.col("id") % 3).cast("string").alias("p"))
    tables.write_full(df, root, partition_by=["p"], sort_by=["id"])
    tables.write_full(df.where("id < 5"), root, partition_by=["p"])
    tables.publish(spark, "t_view", root)
    assert spark.sql("select count(*) c from t_view").first().c == 5
    assert tables.read_table(spark, root, version=1).count() == 10


def test_query_with_parameters(spark):
    df = spark.range(5)
    got = catalog.query(spark, "SELECT count(*) AS c FROM {t} WHERE id > :lo", args={"lo": 2}, t=df)
    assert got.first().c == 2


def test_register_bronze_skips_absent(spark, scratch):
    from snaplake.sources import bronze
    raw = spark.createDataFrame([("01", "X")], "codigo string, descricao string")
    bronze.write_table(bronze.with_metadata(raw, "2026-01", "2026-02-20", "Cnaes.zip"),
                       f"{scratch}/bronze", "cnaes")
    created, skipped = catalog.register_bronze(spark, f"{scratch}/bronze")
    assert created == ["cnaes"] and "empresas" in skipped
    assert spark.sql("select * from bronze_cnaes").columns == [
        "codigo", "descricao", "_fonte", "_competencia", "_arquivo_origem", "_data_extracao"]


def test_cluster_conf_sizes_partitions():
    from snaplake.session import cluster_conf
    c = cluster_conf(100 << 40, 8000)                     # 100 TB on 8000 cores
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert int(cluster_conf(1 << 30, 64)["spark.sql.shuffle.partitions"]) == 192
