"""The model runner on the smallest tables: batches by state, checks."""

from pyspark.sql import functions as F

from snaplake import queries as Q
from snaplake.plans.runner import Lakehouse
from snaplake.session import work_dir
from snaplake.sources.landing import period_of

SF = "/root/testdata/sf0.001"


def test_period_of():
    import datetime as dt
    assert period_of(dt.date(2026, 3, 20)) == "2026-03" and period_of("2025-01-20") == "2025-01"


def test_batch_by_state_loads_every_state(spark):
    land, _ = Q.lake(spark, SF)
    lh = Lakehouse(spark, work_dir(spark, "runner-test"), snapshot="as_loaded")
    lh.backfill(land, ["2026-01", "2026-02"], "2026-02-20",
                targets=[m for m in ["stg_estabelecimentos", "stg_empresas", "stg_simples"]])
    for t in ["stg_cnaes", "stg_municipios", "stg_naturezas", "stg_motivos", "stg_paises"]:
        lh.build([t])
    states = ["AC", "AL", "AM"]
    ok, failed = lh.run_by(states + ["XX"])
    assert ok == states + ["XX"] and failed == []
    mart = lh.table("mrt_estabelecimentos_ativos")
    got = {r.uf: r.n for r in mart.groupBy("uf").agg(F.count(F.lit(1)).alias("n")).collect()}
    # each state of the batch is present (a table-wide watermark would have
    # kept only the first), with exactly the active rows of that state
    full = Q.SPARK["active_establishments"](spark, SF)
    want = {r.uf: r.n for r in full.where(F.col("uf").isin(*states))
            .groupBy("uf").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want and set(got) == set(states)
    # rerunning a state changes nothing (idempotent)
    lh.run_by(["AL"])
    assert lh.table("mrt_estabelecimentos_ativos").count() == sum(want.values())


def test_run_by_continues_after_failure(spark):
    lh = Lakehouse(spark, work_dir(spark, "runner-fail"))

    def build(targets=None, uf=None):
        if uf == "AL":
            raise RuntimeError("boom")

    ok, failed = lh.run_by(["AC", "AL", "AM"], build=build)
    assert ok == ["AC", "AM"] and failed == [("AL", "boom")]


def test_checks_on_built_models(spark):
    lh = Q.built(spark, SF)
    rows = lh.check().collect()
    rep = {(r.model, r.column_name, r.test_name): r.failures for r in rows}
    assert len(rep) == 40 and {r.status for r in rows} <= {"PASS", "FAIL"}
    assert rep[("mrt_estabelecimentos_ativos", "cod_situacao_cadastral", "accepted_values")] == 0
    assert rep[("mrt_estabelecimentos_ativos", "cnpj", "unique")] == 0


def test_gold_filters_reach_the_silver_scan(spark):
    from snaplake.plans import gold
    lh = Q.built(spark, SF)
    t = lh.table
    mart = gold.active_establishments(t("stg_estabelecimentos"), t("stg_empresas"), t("stg_simples"),
                                      t("stg_municipios"), t("stg_cnaes"), t("stg_naturezas"),
                                      t("stg_motivos"), t("stg_paises"), uf="AC")
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(cod_situacao_cadastral,02)" in plan      # row-group filter at the scan
    assert "PartitionFilters: [isnotnull(uf" in plan and "(uf" in plan and "= AC)" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_latest_snapshot_from_manifest(spark):
    from snaplake.sinks import tables
    lh = Q.built(spark, SF)
    assert tables.partition_values(spark, lh.path("stg_estabelecimentos"), "_competencia") == \
        ["2026-01", "2026-02", "2026-03"]
    latest = Lakehouse(spark, lh.root, snapshot="latest")
    df = latest._latest("stg_estabelecimentos", lh.table("stg_estabelecimentos"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "2026-03" in plan
    assert {r._competencia for r in df.select("_competencia").distinct().collect()} == {"2026-03"}


def test_month_tables_load_only_new_months(spark):
    from snaplake.sinks import tables
    lh = Q.built(spark, SF)   # built month after month
    root = lh.path("stg_estabelecimentos")
    versions = tables.committed_versions(spark, root)
    meta = tables.read_meta(spark, root, versions[-1])
    owners = {rel.split("/")[-1]: v for rel, v in meta["manifest"].items()}
    # each month's partitions were written once and then carried over
    for month, version in zip(["2026-01", "2026-02", "2026-03"], versions):
        assert {v for k, v in owners.items() if k == f"_competencia={month}"} == {version}
    # a rebuild with nothing new writes no version
    lh.build(["stg_estabelecimentos"])
    assert tables.committed_versions(spark, root) == versions


def test_batch_over_all_states_is_the_whole_mart(spark):
    def rows(name):
        return {(r.uf, r._competencia): r.n for r in Q.SPARK[name](spark, SF)
                .groupBy("uf", "_competencia").agg(F.count(F.lit(1)).alias("n")).collect()}

    want = rows("active_establishments")
    assert len({uf for uf, _ in want}) > 20 and rows("run_by_all_states") == want
