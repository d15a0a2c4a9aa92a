"""Dynamics kept up by signed changes, and tests kept up by partition summaries."""

import pytest
from pyspark.sql import functions as F

from snaplake import queries as Q
from snaplake.operators import quality as dq
from snaplake.plans import gold
from snaplake.plans.checks import RULES
from snaplake.plans.runner import BY_NAME, Lakehouse
from snaplake.session import work_dir
from snaplake.sinks import tables
from snaplake.sources.derived import SNAPSHOT_MONTHS

SF = "/root/testdata/sf0.001"
DQ_MODELS = ["stg_estabelecimentos", "stg_empresas", "stg_simples"]


def rows_of(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_changed_rows_move_their_events(spark):
    schema = "uf string, cod_cnae_principal string, cod_situacao_cadastral string, data_inicio_atividade date, data_situacao_cadastral date"
    rows = [("SP", "1", "02", "2020-01-05", "2020-01-05"), ("SP", None, "08", "2020-01-09", "2021-03-01"), ("RJ", "1", "03", None, "2021-03-02"),
            (None, "1", "02", "2020-01-05", None), ("RJ", "2", "04", "2020-02-01", None)]
    later = [("SP", "1", "08", "2020-01-05", "2022-05-05"), rows[1], ("SP", "1", "03", None, "2021-03-02"), rows[3], ("RJ", "2", "04", "2020-02-01", "2022-05-09")]

    def frame(data):
        return spark.createDataFrame(data, schema.replace("date", "string")).withColumns(
            {c: F.col(c).cast("date") for c in ("data_inicio_atividade", "data_situacao_cadastral")})

    cnaes = spark.createDataFrame([("1", "one")], "codigo string, descricao string")
    a, b = frame(rows), frame(later)
    state = gold.apply_delta(None, gold.dynamics_delta(None, a))
    assert rows_of(gold.labelled_dynamics(state, cnaes)) == rows_of(gold.monthly_dynamics(a, cnaes))
    delta = gold.dynamics_delta(a, b)
    assert gold.dynamics_delta(a, a).isEmpty() and delta.where("uf IS NULL").isEmpty()
    assert rows_of(gold.labelled_dynamics(gold.apply_delta(state, delta), cnaes)) == rows_of(gold.monthly_dynamics(b, cnaes))
    gone = gold.apply_delta(state, gold.dynamics_delta(a, a.limit(0)))
    assert gone.isEmpty()  # groups at zero go


def test_every_month_equals_a_recount(spark):
    land, _ = Q.snapshot_lake(spark, SF)
    lh = Lakehouse(spark, work_dir(spark, "deltas"))
    state_root = lh.path("mrt_dinamica_contagens")
    for month in SNAPSHOT_MONTHS[:2]:
        lh.backfill(land, [month], Q.EXTRACTION_DATE, Q.DYNAMICS_MODELS)
        got = rows_of(lh.update_dynamics())
        recount = gold.monthly_dynamics(lh._latest("int_estabelecimentos", lh.table("int_estabelecimentos")),
                                        lh._latest("stg_cnaes", lh.table("stg_cnaes")))
        assert got == rows_of(recount)
    versions = tables.committed_versions(spark, state_root)
    lh.update_dynamics()  # nothing new: nothing written
    assert tables.committed_versions(spark, state_root) == versions
    # a version with the same folders: what both share is not read
    known = lh.spark.createDataFrame([(SNAPSHOT_MONTHS[1], tables.committed_versions(spark, lh.path("int_estabelecimentos"))[-1])],
                                     "contado_mes string, contado_versao int").first()
    before, after = lh.changed_snapshots(known, *known)
    assert before.inputFiles() == [] and after.inputFiles() == []


@pytest.mark.parametrize("rules", [
    [*dq.not_null("k", "v"), dq.unique("k"), dq.unique(("k", "v")), dq.accepted_values("v", ["a", "b"]), dq.unique("v", per=["m"])]])
def test_summaries_of_parts_add_up(spark, rules):
    df = spark.createDataFrame([("1", "a", "x"), ("1", "b", "y"), (None, "z", "x"), ("2", None, "y"), ("2", None, "x"), ("3", "z", None), ('["', "a,", None)],
                               "k string, v string, m string")
    parts = None
    for m in ("x", "y", None):
        one = dq.summarise(df.where(F.col("m").eqNullSafe(F.lit(m))), rules, ["m"])
        parts = one if parts is None else parts.unionByName(one)
    assert rows_of(dq.merged(parts, "t", rules)) == rows_of(dq.check(df, "t", rules))
    assert rows_of(dq.merged(dq.summarise(df.limit(0), rules, ["m"]), "t", rules)) == rows_of(dq.check(df.limit(0), "t", rules))


def test_only_new_partitions_are_summarised(spark):
    land, _ = Q.snapshot_lake(spark, SF)
    lh = Lakehouse(spark, work_dir(spark, "summaries"))
    for month in SNAPSHOT_MONTHS:
        lh.backfill(land, [month], Q.EXTRACTION_DATE, DQ_MODELS)
        for name in DQ_MODELS:
            meta, todo, _ = lh.unsummarised(BY_NAME[name])
            assert todo and all(f"_competencia={month}" in rel for rel in todo)
        got = rows_of(lh.check_incremental(DQ_MODELS))
        assert got == rows_of(dq.with_status(dq.check_all({n: (lh.table(n), RULES[n]) for n in DQ_MODELS})))
        assert all(lh.unsummarised(BY_NAME[n])[1] == set() for n in DQ_MODELS)


def test_report_of_all_models(spark):
    lh = Q.built(spark, SF)
    assert rows_of(lh.check_incremental()) == rows_of(lh.check())
