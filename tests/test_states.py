"""The state batch as one job: per-state watermarks, held-back and failing states."""

import pytest
from pyspark.sql import functions as F

from snaplake import queries as Q
from snaplake.operators import incremental as inc
from snaplake.operators import quality as dq
from snaplake.plans import gold
from snaplake.plans.runner import Lakehouse
from snaplake.schemas import STATES
from snaplake.session import work_dir
from snaplake.sources.derived import SNAPSHOT_MONTHS

SF = "/root/testdata/sf0.001"
MART = "mrt_estabelecimentos_ativos"


def rows_of(df):
    return sorted((tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect()))


def test_watermark_of_each_scope(spark):
    target = spark.createDataFrame([("SP", "2026-01"), ("SP", "2026-02"), ("RJ", "2026-01"), (None, "2026-03")], "uf string, _competencia string")
    assert inc.watermarks(target, "uf") == {"SP": "2026-02", "RJ": "2026-01", None: "2026-03"}
    assert inc.watermarks(None, "uf") == {} and inc.watermarks(target.limit(0), "uf") == {}
    source = spark.createDataFrame([(u, f"2026-0{m}") for u in ("SP", "RJ", "AC", None) for m in (1, 2, 3, 4)], "uf string, _competencia string")

    def fresh(**kw):
        return sorted((r.uf or "", r._competencia[-1]) for r in inc.since_each(source, inc.watermarks(target, "uf"), "uf", **kw).collect())

    want = [("", "4"), *[("AC", m) for m in "1234"], *[("RJ", m) for m in "234"], *[("SP", m) for m in "34"]]
    assert fresh() == want and fresh(scopes=["SP", "RJ", "AC", None]) == want
    assert fresh(again=["2026-01"]) == sorted([*want, ("", "1"), ("RJ", "1"), ("SP", "1")])
    known = source.where("uf IS NULL OR uf <> 'AC'")
    got = inc.since_each(known, inc.watermarks(target, "uf"), "uf", scopes=["SP", "RJ", None])
    assert sorted((r.uf or "", r._competencia[-1]) for r in got.collect()) == [w for w in want if w[0] != "AC"]


def test_scopes_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(inc, "MOST_SCOPES", 2)
    with pytest.raises(ValueError):
        inc.watermarks(spark.range(5).select(F.col("id").cast("string").alias("uf"), F.lit("2026-01").alias("_competencia")), "uf")


def test_rules_by_state_equal_rules_on_each_state(spark):
    df = spark.createDataFrame([("SP", "1", "a"), ("SP", "1", None), ("RJ", "1", "b"), ("RJ", None, "z"), (None, "2", None), (None, "2", "a")], "uf string, k string, v string")
    rules = [dq.unique("k"), *dq.not_null("k", "v"), dq.accepted_values("v", ["a", "b"]), dq.unique(("k", "v"))]
    for some in (rules, rules[1:3]):
        got = {(r[0], *r[2:4], r[4]) for r in dq.check(df, "m", some, by="uf").collect()}
        want = {(s, r.column_name, r.test_name, r.failures) for s in ("SP", "RJ", None)
                for r in dq.check(df.where(F.col("uf").eqNullSafe(F.lit(s))), "m", some).collect()}
        assert got == want


def test_held_state_catches_up(spark):
    lh = Q.held_lakehouse(spark, SF)
    before = lh.table(MART).where("uf = 'AC'")
    assert {r[0] for r in before.select("_competencia").distinct().collect()} == {SNAPSHOT_MONTHS[0]}
    kept = {r[0] for r in before.select("cnpj").collect()}
    ok, failed = lh.build_states()
    for key in [k for k in Q._LH if "held" in k]:
        del Q._LH[key]  # the query's state is used up
    assert not failed and set(ok) >= {"AC"}
    assert rows_of(lh.table(MART)) == rows_of(Q.q_lakehouse_active_establishments(spark, SF))
    assert kept - {r[0] for r in lh.table(MART).where("uf = 'AC'").select("cnpj").collect()}  # some had moved or closed


def small_lake(spark):
    land, _ = Q.lake(spark, SF)
    lh = Lakehouse(spark, work_dir(spark, "lakehouse"), snapshot="as_loaded")
    lh.backfill(land, ["2026-01", "2026-02"], Q.EXTRACTION_DATE, Q.ACTIVE_MODELS[:-1])
    return lh


def test_a_state_that_breaks_the_job_is_isolated(spark, monkeypatch):
    lh, real = small_lake(spark), gold.active_establishments

    def broken(*args, **kw):
        bad = F.when(F.col("uf") == "BA", F.raise_error(F.lit("planted"))).otherwise(F.col("email"))
        return real(*args, **kw).withColumn("email", bad)

    monkeypatch.setattr(gold, "active_establishments", broken)
    ok, failed = lh.build_states()
    assert [s for s, _ in failed] == ["BA"] and "planted" in failed[0][1]
    assert "BA" not in ok and {r.uf for r in lh.table(MART).select("uf").distinct().collect()} == set(ok)
    monkeypatch.setattr(gold, "active_establishments", real)
    assert lh.build_states(["BA"]) == (["BA"], [])
    assert rows_of(lh.table(MART).select(*gold.ACTIVE_COLUMNS)) == rows_of(Q.q_active_establishments(spark, SF))


def test_one_scan_of_companies(spark):
    lh = small_lake(spark)
    rows, _ = lh.states_batch(STATES)
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    scans = [leaves.apply(i).toString() for i in range(leaves.size())]
    assert sum("capital_social" in s for s in scans) == 1 and sum("opcao_pelo_mei" in s for s in scans) == 1
