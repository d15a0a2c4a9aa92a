"""Bucketed silver tables, and the cleaning expressions as SQL functions."""

import pytest
from pyspark.sql import functions as F

from snaplake import functions as fn
from snaplake import queries as Q
from snaplake.functions import sql as sql_functions
from snaplake.operators.enrich import counted_bytes, estimated_bytes, hot_keys
from snaplake.schemas import PORTE_LABELS
from snaplake.sinks import buckets
from snaplake.session import work_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def exchanges_below_joins(df):
    """Exchanges by the company key in the physical plan before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(cnpj_basico" in line]


@pytest.mark.parametrize("name", ["active_establishments_bucketed", "active_bucketed_by_month"])
def test_no_exchange_under_the_large_joins(spark, no_broadcast, name):
    plain = Q.SPARK["active_establishments"](spark, SF)
    assert len(exchanges_below_joins(plain)) == 3
    df = Q.SPARK[name](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert exchanges_below_joins(df) == [] and text.count("SelectedBucketsCount") == 3 and text.count("SortMergeJoin") >= 2


def test_months_are_replaced_and_other_sessions_can_read(spark):
    root = work_dir(spark, "buckets")
    rows = spark.createDataFrame([(f"{i:08d}", i, m) for i in range(50) for m in ("2026-01", "2026-02")], "k string, v int, _competencia string")
    buckets.write_bucketed(rows, root, "k", 4, ["_competencia"])
    again = rows.where("_competencia = '2026-02' AND v < 10").withColumn("v", F.col("v") + 100)
    back = buckets.write_bucketed(again, root, "k", 4, ["_competencia"])
    want = sorted(tuple(r) for r in rows.where("_competencia = '2026-01'").union(again).collect())
    assert sorted(tuple(r) for r in back.collect()) == want
    spark.sql(f"DROP TABLE `{buckets.table_name(root)}`")
    with pytest.raises(ValueError):
        buckets.read_bucketed(spark, root)
    other = buckets.read_bucketed(spark, root, rows, "k", 4, ["_competencia"])
    spark.sql(f"MSCK REPAIR TABLE `{buckets.table_name(root)}`") if other.isEmpty() else None
    assert sorted(tuple(r) for r in buckets.read_bucketed(spark, root).select(*rows.columns).collect()) == want


def test_hot_keys_leave_the_bucketed_join(spark, no_broadcast):
    left = spark.createDataFrame([("a", i) for i in range(40)] + [("b", 1), ("c", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", "A"), ("b", "B"), ("d", "D")], "k string, w string")
    lt, rt = (buckets.write_bucketed(df, work_dir(spark, "hot"), "k", 4) for df in (left, right))
    want = sorted(map(str, left.join(right, "k", "left").collect()))
    hot = hot_keys(lt, ["k"], 10)
    assert [r.k for r in hot.collect()] == ["a"] and "Exchange" not in lt.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    for some in (None, hot, hot.limit(0)):
        assert sorted(map(str, buckets.bucketed_join(lt, rt, "k", hot=some).collect())) == want


def test_months_agree_in_the_bucketed_join(spark, no_broadcast):
    left = spark.createDataFrame([("a", m, i) for i, m in enumerate("xyxyz")] + [("b", "x", 9), ("b", None, 8)], "k string, m string, v int")
    right = spark.createDataFrame([("a", "x", "AX"), ("a", "y", "AY"), ("b", "y", "BY"), ("b", None, "B")], "k string, m string, w string")
    lt, rt = (buckets.write_bucketed(df, work_dir(spark, "months"), "k", 4) for df in (left, right))
    want = sorted(map(str, left.join(right, ["k", "m"], "left").select("k", "m", "v", "w").collect()))
    for some in (None, hot_keys(lt, ["k"], 3)):
        assert sorted(map(str, buckets.bucketed_join(lt, rt, "k", "m", some).select("k", "m", "v", "w").collect())) == want


def test_bucket_counts_are_powers_of_two():
    assert [buckets.buckets_for(n << 20) for n in (0, 1, 1024, 1025, 100_000)] == [8, 8, 8, 16, 1024]


def test_sql_functions_say_the_same(spark):
    assert len(sql_functions.register(spark)) == len(sql_functions.FUNCTIONS)
    texts = [None, "", "  ", " x ", "1234,56", "x,1", "20240131", " 20240131 ", "00000000", "20231345", "2024013", "S", "N", "s", "00", "01", "05", "99", "\t"]
    df = spark.createDataFrame([(t, texts[i - 1]) for i, t in enumerate(texts)], "a string, b string")
    df.createOrReplaceTempView("cells")
    got = spark.sql("SELECT blank_to_null(a), decimal_comma(a), compact_date(a), concat_key(a, b, a), is_yes(a), company_size(a), "
                    "month_start(compact_date(a)) FROM cells").collect()
    date = fn.parse_compact_date("a")
    want = df.select(fn.blank_to_null("a"), fn.decimal_comma("a"), date, fn.concat_key("a", "b", "a"), fn.flag("a"),
                     fn.decode("a", PORTE_LABELS), fn.month_start(date)).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_sql_staging_has_no_python_and_pushes_filters(spark):
    df = Q.SPARK["sql_stage_establishments"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "compact_date(" not in plan and "blank_to_null(" not in plan
    sql_functions.register(spark)
    spark.read.parquet(f"{SF}/orders.parquet").createOrReplaceTempView("plain_orders")
    plan = spark.sql("SELECT is_yes(o_orderstatus) FROM plain_orders WHERE blank_to_null(o_orderpriority) IS NOT NULL AND o_custkey = 7")
    assert "EqualTo(o_custkey,7)" in plan._jdf.queryExecution().executedPlan().toString()


def test_runtime_filter_reaches_both_large_tables(spark, no_broadcast, scratch):
    from snaplake.plans import gold
    from snaplake.session import runtime_filter_conf
    paths = {}
    for t in ("estabelecimentos", "empresas", "simples"):
        paths[t] = f"{scratch}/{t}"
        Q.stg(spark, SF, t).write.parquet(paths[t])
    t, d = {k: spark.read.parquet(p) for k, p in paths.items()}, Q.dims(spark, SF)
    conf = runtime_filter_conf(scan_bytes=1)
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = gold.active_establishments(t["estabelecimentos"], t["empresas"], t["simples"], *[d[k] for k in (
            "municipios", "cnaes", "naturezas", "motivos", "paises")], uf="RJ", runtime_filter=True)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("might_contain") >= 2 and "LeftSemi" not in plan
        got = sorted(map(str, df.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted(map(str, Q.SPARK["active_by_state"](spark, SF).collect()))


def test_maximum_from_footers(spark, scratch):
    from snaplake.operators import incremental as inc
    df = spark.range(1000).select("id", F.expr("date_add(DATE'2020-01-01', cast(id AS int))").alias("d"), F.lit("x").alias("s"))
    df.repartition(3).write.parquet(f"{scratch}/t")
    plans = []
    assert inc.watermark_from_footers(spark, [f"{scratch}/t"], "id", plans) == 999
    assert str(inc.watermark_from_footers(spark, [f"{scratch}/t"], "d", plans)) == "2022-09-26"
    assert all("PushedAggregation: [MAX(" in p for p in plans)
    assert inc.watermark_from_footers(spark, [f"{scratch}/t"], "s") == "x"
    df.limit(0).write.parquet(f"{scratch}/none")
    assert inc.watermark_from_footers(spark, [f"{scratch}/none"], "id") is None


def test_partner_watermark_comes_from_the_manifest(spark, monkeypatch):
    from snaplake.operators import incremental as inc
    from snaplake.plans.runner import BY_NAME
    lh = Q.built(spark, SF)
    monkeypatch.setattr(inc, "watermark", lambda *a, **k: pytest.fail("scanned for the watermark"))
    lh._incremental(BY_NAME["int_socios"], None, False)


def test_buckets_follow_the_rows_and_not_the_product_of_a_join(spark):
    """The optimizer puts a join at the product of its sides: 150,000 orders of 15,000 customers had
    16,384 buckets."""
    a = spark.range(50_000).select(F.col("id").alias("k"), F.lit("x" * 50).alias("v"))
    joined = a.join(spark.range(50_000).select(F.col("id").alias("k"), F.lit("y" * 50).alias("w")), "k").hint("merge")
    assert counted_bytes(joined) == 50_000 * (8 + 20 + 20)
    assert buckets.buckets_for(estimated_bytes(joined)) > 1000 and buckets.buckets_for(counted_bytes(joined)) == 8
    assert buckets.buckets_for(1 << 60) <= 100_000  # the most that Spark takes
