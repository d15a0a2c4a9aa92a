"""What a step writes for itself goes when the step ends."""

import os
import time

from pyspark.sql import functions as F
from test_one_month_loads import MONTHS, ROWS, fill

from snaplake.plans.runner import Lakehouse
from snaplake.session import SHUFFLES_KEY, brief_shuffles, ensure_checkpoint_dir
from snaplake.sinks import tables
from snaplake.sources import landing


def parts(spark):
    """Bytes of the data files in the shared folder."""
    found = {}
    for folder, _, files in os.walk(ensure_checkpoint_dir(spark).removeprefix("file:")):
        found |= {f"{folder}/{f}": os.path.getsize(f"{folder}/{f}") for f in files if f.startswith("part-")}
    return found


def test_kept_rows_go_when_the_block_ends(spark):
    before = parts(spark)
    with tables.kept_rows(spark) as keep:
        rows = keep(spark.range(10).withColumn("d", F.lit(None).cast("date")), "some")
        assert rows.count() == 10 and rows.dtypes == [("id", "bigint"), ("d", "date")] and len(parts(spark)) > len(before)
    assert parts(spark).keys() == before.keys()


def test_loads_leave_no_copies_of_their_rows(spark, scratch):
    lh = Lakehouse(spark, f"{scratch}/lh")
    before = parts(spark)
    for step in ([0], [1, 2]):
        fill(lh, spark, [r for r in ROWS if r[-1] in {MONTHS[i] for i in step}])
        lh.build(["mrt_estabelecimentos_ativos"])
        del lh.table
    fill(lh, spark, [("a1", "a", "02", "AC", "2026-04")])
    assert lh.build_states(rules=[])[1] == []
    left = {p: size for p, size in parts(spark).items() if p not in before}
    assert sum(left.values()) < 2000, left  # hot keys, of which there are none


def test_shuffle_files_go_with_their_query(spark):
    def held():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size())}

    before, setting = held(), spark.conf.get(SHUFFLES_KEY)
    with brief_shuffles(spark):
        with brief_shuffles(spark):
            pass
        assert spark.conf.get(SHUFFLES_KEY) == "true"
        df = spark.range(1000).repartition(7, "id")
        assert df.where("id >= 0").count() == 1000
        for _ in range(50):
            if not held() - before:
                break
            time.sleep(0.1)
        assert not {f for f in held() - before if f.startswith("shuffle_")}
    assert spark.conf.get(SHUFFLES_KEY) == setting


def test_staged_members_go_once_they_are_zipped(spark, scratch):
    cols = landing.columns_of("empresas")
    df = spark.range(20).select(*[F.col("id").cast("string").alias(c) for c in cols], F.lit("2026-01").alias("_competencia"), F.lit("Empresas0.zip").alias("nome"))
    landing.write_zips(df, f"{scratch}/landing", f"{scratch}/staging", "empresas")
    assert os.path.getsize(f"{scratch}/landing/competencia=2026-01/Empresas0.zip") and not os.path.exists(f"{scratch}/staging")
