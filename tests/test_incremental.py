import datetime as dt

from pyspark.sql import functions as F

from snaplake.operators.incremental import latest_per_key, since, upsert, watermark
from snaplake.operators.snapshot import latest_snapshot
from snaplake.sinks import tables

SCHEMA = "k string, k2 string, v long, uf string, _competencia string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_upsert_basic_and_idempotent(spark):
    t = spark.createDataFrame([("a", "x", 1, "AC", "2026-01"), ("b", "x", 2, "AC", "2026-01")], SCHEMA)
    s = spark.createDataFrame([("b", "x", 20, "SP", "2026-02"), ("c", "x", 3, "SP", "2026-02")], SCHEMA)
    once = upsert(t, s, ["k"])
    twice = upsert(once, s, ["k"])
    assert rows(once) == rows(twice) == [("a", "x", 1, "AC", "2026-01"), ("b", "x", 20, "SP", "2026-02"),
                                         ("c", "x", 3, "SP", "2026-02")]


def test_upsert_order_insensitive_and_latest_wins(spark):
    s1 = spark.createDataFrame([("a", "x", 1, "AC", "2026-01"), ("a", "x", 2, "AC", "2026-02"),
                                ("a", "x", 0, "AC", "2026-02")], SCHEMA)
    s2 = spark.createDataFrame(list(reversed(s1.collect())), SCHEMA)
    # every row of the latest month stays, older ones go
    assert rows(upsert(None, s1, ["k"])) == rows(upsert(None, s2, ["k"])) == [
        ("a", "x", 0, "AC", "2026-02"), ("a", "x", 2, "AC", "2026-02")]


def test_upsert_composite_null_safe(spark):
    t = spark.createDataFrame([("a", None, 1, "AC", "2026-01"), ("a", "y", 1, "AC", "2026-01")], SCHEMA)
    s = spark.createDataFrame([("a", None, 9, "AC", "2026-02"), ("a", None, 1, "AC", "2026-02")], SCHEMA)
    got = rows(upsert(t, s, ["k", "k2"]))
    # without a whole key, only a row that says the same is replaced
    assert got == rows(spark.createDataFrame([("a", "y", 1, "AC", "2026-01"), ("a", None, 1, "AC", "2026-02"),
                                              ("a", None, 9, "AC", "2026-02")], SCHEMA))
    # plain equality would keep the old null-keyed row as well
    assert len(rows(upsert(t, s, ["k", "k2"], null_safe=False))) == 4


PARTNER = "cnpj_basico string, cnpj_cpf_socio string, nome string, _competencia string"


def test_partners_without_id_all_survive(spark):
    rows_ = [("1", None, "ANA", "2026-01"), ("1", None, "BIA", "2026-01"), ("1", "9", "CAIO", "2026-01")]
    jan = spark.createDataFrame(rows_, PARTNER)
    feb = spark.createDataFrame([(a, b, c, "2026-02") for a, b, c, _ in rows_[1:]], PARTNER)
    keys = ["cnpj_basico", "cnpj_cpf_socio"]
    got = rows(upsert(upsert(None, jan, keys), feb, keys))
    assert {(r[2], r[3]) for r in got} == {("ANA", "2026-01"), ("BIA", "2026-02"), ("CAIO", "2026-02")}
    assert got == rows(upsert(None, jan.unionByName(feb), keys))


def test_deletes_win_over_the_source(spark):
    s = spark.createDataFrame([("a", "x", 1, "AC", "2026-02"), ("b", "x", 1, "AC", "2026-02")], SCHEMA)
    gone = spark.createDataFrame([("a",)], "k string")
    assert [r[0] for r in rows(upsert(None, s, ["k"], deletes=gone))] == ["b"]


def test_leftovers_of_a_failed_write_are_never_published(spark, scratch):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # as build_session sets it
    try:
        root = f"{scratch}/ghost"
        t = spark.createDataFrame([("a", "x", 1, "AC", "2026-01"), ("b", "x", 2, "SP", "2026-01")], SCHEMA)
        s = spark.createDataFrame([("a", "x", 9, "AC", "2026-02")], SCHEMA)
        ghost = spark.createDataFrame([("ghost", "x", 0, "ZZ", "2026-01")], SCHEMA)
        tables.write_version(t, root, partition_by=["uf"])
        ghost.write.partitionBy("uf").parquet(tables.version_path(root, 2))
        out = tables.merge_into(spark, root, s, ["k"], partition_by=["uf"])
        assert {r.k for r in out.collect()} == {"a", "b"}
        ghost.write.partitionBy("uf").parquet(tables.version_path(root, 3))
        tables.write_version(t, root, partition_by=["uf"])
        assert {r.k for r in tables.read_table(spark, root).collect()} == {"a", "b"}
        ghost.write.partitionBy("uf").parquet(tables.version_path(root, 4))
        tables.replace_partitions(s, root, ["uf"], "uf", ["AC"])
        assert {r.k for r in tables.read_table(spark, root).collect()} == {"a", "b"}
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_second_writer_of_a_version_fails(spark, scratch):
    import pytest
    root = f"{scratch}/two"
    tables.write_version(spark.createDataFrame([("a", "x", 1, "AC", "2026-01")], SCHEMA), root)
    with pytest.raises(Exception, match="already exists|FileAlreadyExists"):
        tables._write_marker(spark, tables.version_path(root, 1), {})


def test_merge_reads_only_touched_partitions(spark, scratch):
    root = f"{scratch}/pruned"
    t = spark.createDataFrame([(str(i), "x", i, uf, "2026-01") for i, uf in enumerate(["AC", "SP", "RJ"])], SCHEMA)
    tables.write_version(t, root, partition_by=["uf"])
    meta = tables.read_meta(spark, root, 1)
    got = tables.read_partitions(spark, root, meta, {"uf=SP"}, t.schema)
    assert all("uf=SP" in f for f in got.inputFiles()) and got.count() == 1


def test_stream_that_misses_its_limit_raises(spark):
    import pytest

    from snaplake.streaming.incremental import run_until_done

    class Slow:
        stopped = False

        def awaitTermination(self, timeout=None):
            return False

        def stop(self):
            self.stopped = True

    with pytest.raises(TimeoutError):
        run_until_done(Slow(), 0.1)


def test_upsert_keys_unique_after(spark):
    t = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("k2"),
                                F.col("id").alias("v"), F.lit("AC").alias("uf"),
                                F.lit("2026-01").alias("_competencia"))
    s = spark.range(100, 300).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("k2"),
                                     (F.col("id") * 10).alias("v"), F.lit("SP").alias("uf"),
                                     F.lit("2026-02").alias("_competencia"))
    out = upsert(t, s, ["k"])
    assert out.count() == 300 and out.select("k").distinct().count() == 300


def test_upsert_deletes(spark):
    t = spark.createDataFrame([("a", "x", 1, "AC", "2026-01"), ("b", "x", 2, "AC", "2026-01")], SCHEMA)
    s = spark.createDataFrame([("c", "x", 3, "AC", "2026-02")], SCHEMA)
    gone = spark.createDataFrame([("a",)], "k string")
    assert [r[0] for r in upsert(t, s, ["k"], deletes=gone).orderBy("k").collect()] == ["b", "c"]


def test_merge_into_no_stale_partition(spark, scratch):
    t = spark.createDataFrame([("a", "x", 1, "AC", "2026-01"), ("b", "x", 2, "AC", "2026-01")], SCHEMA)
    root = f"{scratch}/mart"
    tables.write_version(t, root, partition_by=["uf"])
    s = spark.createDataFrame([("a", "x", 10, "SP", "2026-02")], SCHEMA)  # key a moves AC -> SP
    out = tables.merge_into(spark, root, s, ["k"], partition_by=["uf"])
    assert rows(out) == [("a", "x", 10, "SP", "2026-02"), ("b", "x", 2, "AC", "2026-01")]
    assert tables.committed_versions(spark, root) == [1, 2]
    # partition column keeps its type / leading zeros through the marker schema
    z = spark.createDataFrame([("a", "007")], "k string, code string")
    tables.write_version(z, f"{scratch}/z", partition_by=["code"])
    assert tables.read_table(spark, f"{scratch}/z").collect()[0]["code"] == "007"


def test_uncommitted_version_is_ignored(spark, scratch):
    root = f"{scratch}/t"
    df = spark.createDataFrame([("a", "x", 1, "AC", "2026-01")], SCHEMA)
    tables.write_version(df, root)
    # a crashed job leaves files without the commit marker
    df.write.parquet(tables.version_path(root, 2))
    assert tables.committed_versions(spark, root) == [1]
    assert tables.read_table(spark, root).count() == 1


def test_watermark_rules(spark):
    t = spark.createDataFrame([("a", "x", 1, "AC", "2026-01"), ("b", "x", 1, "SP", "2026-02")], SCHEMA)
    src = spark.createDataFrame([("c", "x", 1, "AC", m) for m in ["2026-01", "2026-02", "2026-03"]], SCHEMA)
    assert watermark(None) is None                                   # D14: no target -> full load
    assert watermark(t.where("false")) is None                       # empty target -> full load
    assert since(src, None).count() == 3
    assert watermark(t) == "2026-02"
    assert [r._competencia for r in since(src, "2026-02").collect()] == ["2026-03"]
    assert since(src, "2026-02", inclusive=True).count() == 2        # D13 re-issued month
    assert watermark(t, scope={"uf": "AC"}) == "2026-01"             # D2 per-scope watermark


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("a", "x", 1, "AC", "2026-01"), ("a", "x", 2, "AC", "2026-02"),
                                ("b", "x", 3, "SP", "2026-01")], SCHEMA)
    assert rows(latest_snapshot(df)) == [("a", "x", 2, "AC", "2026-02")]
    assert rows(latest_snapshot(df, by=["uf"])) == [("a", "x", 2, "AC", "2026-02"),
                                                    ("b", "x", 3, "SP", "2026-01")]
    assert rows(latest_per_key(df, ["k"])) == [("a", "x", 2, "AC", "2026-02"),
                                               ("b", "x", 3, "SP", "2026-01")]
    assert dt  # keep import


def test_merge_rewrites_only_touched_partitions(spark, scratch):
    root = f"{scratch}/parts"
    t = spark.createDataFrame([(str(i), "x", i, uf, "2026-01") for i, uf in
                               enumerate(["AC", "AC", "SP", "SP", "RJ"])], SCHEMA)
    tables.write_version(t, root, partition_by=["uf"])
    # key 0 moves AC -> RJ, key 2 is updated in SP, AC keeps key 1
    s = spark.createDataFrame([("0", "x", 100, "RJ", "2026-02"), ("2", "x", 200, "SP", "2026-02")], SCHEMA)
    out = tables.merge_into(spark, root, s, ["k"], partition_by=["uf"])
    assert rows(out) == [("0", "x", 100, "RJ", "2026-02"), ("1", "x", 1, "AC", "2026-01"),
                         ("2", "x", 200, "SP", "2026-02"), ("3", "x", 3, "SP", "2026-01"),
                         ("4", "x", 4, "RJ", "2026-01")]
    meta = tables.read_meta(spark, root, 2)
    assert meta["manifest"] == {"uf=AC": 2, "uf=RJ": 2, "uf=SP": 2}
    # a merge touching SP only leaves AC and RJ in version 2
    s2 = spark.createDataFrame([("3", "x", 300, "SP", "2026-03")], SCHEMA)
    tables.merge_into(spark, root, s2, ["k"], partition_by=["uf"])
    meta = tables.read_meta(spark, root, 3)
    assert meta["manifest"] == {"uf=AC": 2, "uf=RJ": 2, "uf=SP": 3}
    # the last key of a partition leaving it empties it out of the manifest
    gone = spark.createDataFrame([("1",)], "k string")
    empty_src = spark.createDataFrame([], SCHEMA)
    from snaplake.operators.incremental import upsert  # noqa: F401
    tables.merge_into(spark, root, empty_src, ["k"], partition_by=["uf"], deletes=gone)
    meta = tables.read_meta(spark, root, 4)
    assert "uf=AC" not in meta["manifest"]
    assert tables.read_table(spark, root).count() == 4
    # an untouched-partition read path still works after several versions
    assert {r.uf for r in tables.read_table(spark, root).collect()} == {"SP", "RJ"}


def test_vacuum_keeps_what_readers_need(spark, scratch):
    root = f"{scratch}/vac"
    t = spark.createDataFrame([(str(i), "x", i, uf, "2026-01") for i, uf in
                               enumerate(["AC", "SP", "RJ"])], SCHEMA)
    tables.write_version(t, root, partition_by=["uf"])                       # v1: AC SP RJ
    s = spark.createDataFrame([("1", "x", 10, "SP", "2026-02")], SCHEMA)
    tables.merge_into(spark, root, s, ["k"], partition_by=["uf"])            # v2: SP
    s = spark.createDataFrame([("2", "x", 20, "RJ", "2026-03")], SCHEMA)
    tables.merge_into(spark, root, s, ["k"], partition_by=["uf"])            # v3: RJ
    spark.createDataFrame([("9", "x", 9, "AC", "x")], SCHEMA).write.parquet(
        tables.version_path(root, 1) + "_broken")                            # not a version
    before = rows(tables.read_table(spark, root))
    removed = tables.vacuum(spark, root, keep=1)
    # v1's SP and RJ folders are superseded; its AC folder is still read
    assert sorted(r.rsplit("/", 1)[-1] for r in removed) == ["uf=RJ", "uf=SP"]
    assert all("/_v=000001/" in r for r in removed)
    assert rows(tables.read_table(spark, root)) == before
    assert tables.read_table(spark, root, version=3).count() == 3
