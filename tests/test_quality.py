from snaplake.operators import quality as dq
from snaplake.plans.checks import RULES, scoped


def test_rules_report(spark):
    df = spark.createDataFrame([("1", "02", "a"), ("1", "03", None), (None, "02", "b"), ("2", None, "c")],
                               "k string, st string, d string")
    rep = dq.check(df, "m", [*dq.not_null("k", "d"), dq.unique("k"),
                             dq.accepted_values("st", ["02"])])
    got = {(r.column_name, r.test_name): r.failures for r in rep.collect()}
    assert got == {("k", "not_null"): 1, ("d", "not_null"): 1, ("k", "unique"): 1,
                   ("st", "accepted_values"): 1}
    assert dq.failed(rep).count() == 4


def test_unique_scoped_per_month(spark):
    df = spark.createDataFrame([("1", "2026-01"), ("1", "2026-02")], "k string, _competencia string")
    assert dq.check(df, "m", [dq.unique("k")]).first().failures == 1
    assert dq.check(df, "m", scoped([dq.unique("k")], ["_competencia"])).first().failures == 0


def test_forty_declared_tests():
    assert sum(len(r) for r in RULES.values()) == 40
    kinds = [r.test for rs in RULES.values() for r in rs]
    assert kinds.count("not_null") == 29 and kinds.count("unique") == 10
    assert kinds.count("accepted_values") == 1


def test_status_column(spark):
    df = spark.createDataFrame([("1",), (None,)], "k string")
    rep = dq.with_status(dq.check(df, "m", dq.not_null("k")))
    assert [(r.failures, r.status) for r in rep.collect()] == [(1, "FAIL")]


def test_lookup_by_month_never_multiplies(spark):
    from snaplake.operators.enrich import lookup
    est = spark.createDataFrame([("1", "2026-01"), ("1", "2026-02"), ("9", "2026-02")], "cod string, _competencia string")
    dim = spark.createDataFrame([("1", "old", "2026-01"), ("1", "new", "2026-02")], "codigo string, descricao string, _competencia string")
    got = sorted(tuple(r) for r in lookup(est, dim, "cod", "nome", period="_competencia").fillna("-").collect())
    assert got == [("1", "2026-01", "old"), ("1", "2026-02", "new"), ("9", "2026-02", "-")]
