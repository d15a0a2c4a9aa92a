import pytest
from pyspark.sql import functions as F

from snaplake.operators.enrich import hot_keys, split_hot_join


def test_split_hot_join_equals_join_with_a_third_on_one_key(spark):
    n = 3000
    left = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.col("id").alias("v"))
    right = spark.createDataFrame([("HOT", "h"), ("k1", "a"), ("k2", "b"), ("zz", "z")],
                                  "k string, label string")
    assert [r.k for r in hot_keys(left, ["k"], n // 4).collect()] == ["HOT"]
    plain = sorted(map(tuple, left.join(right, "k", "left").collect()), key=str)
    split = split_hot_join(left, right, ["k"], "left", min_rows=n // 4)
    assert sorted(map(tuple, split.collect()), key=str) == plain
    assert split.count() == n  # nothing dropped, nothing duplicated


def test_split_hot_join_refuses_right_and_full(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            split_hot_join(df, df.withColumnRenamed("v", "w"), ["k"], how)


def test_company_side_reduced_and_three_exchanges(spark):
    """Without broadcasts: establishments, companies and tax regime are each shuffled
    once; with a state filter both sides are first reduced to its companies."""
    from snaplake import queries as Q
    from snaplake.plans import gold
    sf = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = Q.dims(spark, sf)
        args = (Q.stg(spark, sf, "estabelecimentos"), Q.stg(spark, sf, "empresas"), Q.stg(spark, sf, "simples"),
                d["municipios"], d["cnaes"], d["naturezas"], d["motivos"], d["paises"])
        plan = gold.active_establishments(*args)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") <= 3 and "FullOuter" not in plan  # one of them makes the fixture
        plan = gold.active_establishments(*args, uf="RJ")._jdf.queryExecution().executedPlan().toString()
        assert "LeftSemi" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
