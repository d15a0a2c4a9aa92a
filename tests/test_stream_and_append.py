"""Arriving zips as a stream, and appends that commit as a whole."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from snaplake.sinks import append
from snaplake.sources import bronze, zip_stream
from snaplake.sources.landing import table_of
from snaplake.streaming.incremental import run_until_done
from test_ingest_counts import make_zip


def line(i):
    return f'"{i:08d}";"N{i}";"2062";"49";"1,0";"01";""'


def test_zips_in_three_steps_with_restarts(spark, scratch):
    land, out = f"{scratch}/landing", f"{scratch}/bronze"

    def arrive(period, name, ids):
        make_zip(f"{land}/competencia={period}/{name}", [line(i) for i in ids])

    def take():
        run_until_done(zip_stream.ingest_arrived(spark, land, out, "empresas", "2026-02-20"))
        return sorted(r[0] for r in bronze.read_table(spark, out, "empresas").select("cnpj_basico").collect())

    arrive("2026-02", "Empresas0.zip", range(5))
    arrive("2026-02", "Socios0.zip", range(900, 905))  # another table's
    assert take() == [f"{i:08d}" for i in range(5)]
    arrive("2026-02", "Empresas1.zip", range(5, 9))
    arrive("2026-01", "Empresas0.zip", range(20, 23))  # late, for an older month
    want = [f"{i:08d}" for i in [*range(9), *range(20, 23)]]
    assert take() == want and take() == want  # nothing new: nothing twice
    arrive("2026-03", "EMPRESAS9.ZIP", [50])
    assert take() == want + ["00000050"]
    # the same as one batch over all of them
    bronze.ingest(spark, land, f"{scratch}/batch", ["2026-01", "2026-02", "2026-03"], "2026-02-20", ["empresas"])
    cols = ["cnpj_basico", "_competencia", "_arquivo_origem", "_fonte", "_data_extracao"]
    both = [sorted(tuple(r) for r in bronze.read_table(spark, b, "empresas").select(*cols).collect()) for b in (out, f"{scratch}/batch")]
    assert both[0] == both[1]


def test_offsets_name_new_and_reissued_zips(scratch):
    land = f"{scratch}/landing"
    reader = zip_stream.ZipStreamReader({"path": land, "table": "empresas"}, None)
    start = reader.initialOffset()
    assert reader.latestOffset() == {"zips": {}}
    make_zip(f"{land}/competencia=2026-01/Empresas0.zip", [line(1)])
    first = reader.latestOffset()
    assert [os.path.basename(p.path) for p in reader.partitions(start, first)] == ["Empresas0.zip"]
    assert reader.partitions(first, first) == []
    make_zip(f"{land}/competencia=2026-01/Empresas0.zip", [line(i) for i in range(100)])
    make_zip(f"{land}/competencia=2026-02/Empresas1.zip", [line(1)])
    assert len(reader.partitions(first, reader.latestOffset())) == 2


def test_routing_by_name_is_that_of_the_listing(spark):
    names = ["Empresas0.zip", "ESTABELECIMENTOS3.ZIP", "Socios1.zip", "weird.zip", "Cnaes.zip"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r[0]: r[1] for r in df.select("n", table_of("n")).collect()} == {n: zip_stream.table_of_name(n) for n in names}


def test_append_counts_and_repeats(spark, scratch):
    root = f"{scratch}/table"
    df = spark.range(1000).select("id", F.col("id").cast("string").alias("s")).repartition(4)
    assert append.read_appended(spark, root, df.schema).count() == 0
    assert append.append_rows(df, root, "one") == 1000
    assert append.append_rows(df, root, "one") == 0
    assert append.append_rows(df.where("id < 10"), root) == 10
    assert append.append_rows(df.where("id < 0"), root, "none") == 0
    back = append.read_appended(spark, root, df.schema)
    assert back.count() == 1010 and back.select(F.sum("id")).first()[0] == 999 * 500 + 45


def test_a_failed_append_leaves_nothing(spark, scratch):
    root = f"{scratch}/table"
    df = spark.range(100).repartition(4)
    bad = df.withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("planted")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="planted"):
        append.append_rows(bad, root, "b")
    assert append.read_appended(spark, root, df.schema).count() == 0
    assert append.append_rows(df, root, "b") == 100  # the retry does not double
    assert append.read_appended(spark, root, df.schema).count() == 100 and not os.path.exists(f"{root}/_open/b")


def test_files_of_a_task_that_ran_twice_are_not_read(spark, scratch):
    root = f"{scratch}/table"
    writer = append.AppendWriter(root, "b")
    import pyarrow as pa
    batch = pa.record_batch({"id": pa.array([1, 2, 3])})
    lost, kept = writer.write(iter([batch])), writer.write(iter([batch, batch]))
    writer.commit([kept, append.Written(None, 0)])
    assert append.read_appended(spark, root, "id long").count() == 6 == append._receipts(root)["b"]["rows"]
    assert not os.path.exists(f"{root}/{lost.file}")
    shutil.rmtree(root)
