"""A load of one month: its rows are made once, and give what the merge of any months gives."""

import pytest
from pyspark.sql import functions as F

from snaplake.plans import gold
from snaplake.plans.runner import BY_NAME, Lakehouse
from snaplake.sinks import tables

MONTHS = ["2026-01", "2026-02", "2026-03"]


def establishments(spark, rows):
    """Staged rows from (cnpj, company, status, state, month)."""
    named = dict.fromkeys(c for c in gold.ACTIVE_COLUMNS if c not in gold.COMPANY_COLUMNS[1:] + gold.TAX_COLUMNS[1:]
                          and not c.startswith(("descricao_", "nome_municipio", "nome_pais", "is_", "ano_", "mes_")))
    df = spark.createDataFrame(rows, "cnpj string, cnpj_basico string, cod_situacao_cadastral string, uf string, _competencia string")
    date = {"data_situacao_cadastral", "data_inicio_atividade", "data_situacao_especial"}
    return df.select(*[c if c in df.columns else F.lit(None).cast("date" if c in date else "string").alias(c) for c in named])


ROWS = [("a1", "a", "02", "SP", MONTHS[0]), ("b1", "b", "02", "SP", MONTHS[0]), ("c1", "c", "02", "RJ", MONTHS[0]), (None, "a", "02", "SP", MONTHS[0]),
        ("a1", "a", "02", "RJ", MONTHS[1]), ("a1", "a", "02", "RJ", MONTHS[1]), ("b1", "b", "08", "SP", MONTHS[1]), (None, "a", "02", "SP", MONTHS[1]),
        ("d1", "c", "02", "MG", MONTHS[1]), ("d1", "c", "08", "MG", MONTHS[1]), ("e1", "a", "02", None, MONTHS[1]),
        ("e1", "a", "02", "SP", MONTHS[2]), ("c1", "c", "04", "RJ", MONTHS[2]), ("b1", "b", "02", "SP", MONTHS[2]), (None, None, "02", "SP", MONTHS[2])]
WANT = [(None, None, "SP", "2026-03"), (None, "a", "SP", "2026-02"), ("a1", "a", "RJ", "2026-02"), ("b1", "b", "SP", "2026-03"), ("e1", "a", "SP", "2026-03")]


def fill(lh, spark, rows, seen=None):
    """Staging of the months of ``rows``; ``seen`` counts the names that are read."""
    months = sorted({r[-1] for r in rows})
    est = establishments(spark, rows)
    counted = F.udf(lambda k: (seen.add(1) if seen is not None else None, k)[1]).asNondeterministic()
    emp = [f"{c} {'double' if c == 'capital_social' else 'string'}" for c in gold.COMPANY_COLUMNS]
    tax = [f"{c} {'date' if c.startswith('data_') else 'string'}" for c in gold.TAX_COLUMNS]
    named = [("stg_empresas", emp, [(k, f"{k} SA", *[None] * 5, p) for k in "abc" for p in months]),
             ("stg_simples", tax, [("a", "S", *[None] * 5, p) for p in months])]
    for name, cols, values in named:
        df = spark.createDataFrame(values, ", ".join([*cols, "_competencia string"]))
        tables.replace_partitions(df, lh.path(name), ["_competencia"], "_competencia", months)
    m = BY_NAME["stg_estabelecimentos"]
    tables.replace_partitions(est, lh.path(m.name), m.partition_by, "_competencia", months)
    empty = spark.createDataFrame([], "codigo string, descricao string, _competencia string")
    read = lh.table

    def table(name):
        if name.startswith("stg_") and BY_NAME[name].kind == "view":
            return empty
        return read(name).withColumn("nome_fantasia", counted("nome_fantasia")) if name == m.name and seen is not None else read(name)

    lh.table = table


def mart(lh):
    found = lh.table("mrt_estabelecimentos_ativos").select("cnpj", "cnpj_basico", "uf", "_competencia").collect()
    return sorted((tuple(r) for r in found), key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("steps", [[[0], [1], [2]], [[0], [1, 2]]])
def test_one_by_one_or_in_one_merge(spark, scratch, steps):
    lh = Lakehouse(spark, f"{scratch}/lh")
    for step in steps:
        fill(lh, spark, [r for r in ROWS if r[-1] in {MONTHS[i] for i in step}])
        lh.build(["mrt_estabelecimentos_ativos"])
        del lh.table
    assert mart(lh) == WANT
    fill(lh, spark, [("a1", "a", "08", "RJ", MONTHS[2])])  # the last month again, as a re-issue
    lh.refresh_months = MONTHS[2:]
    lh.build(["mrt_estabelecimentos_ativos"])
    del lh.table
    assert mart(lh) == [r for r in WANT if r[0] != "a1"]


def test_a_month_is_made_once(spark, scratch):
    lh = Lakehouse(spark, f"{scratch}/lh")
    fill(lh, spark, [r for r in ROWS if r[-1] == MONTHS[0]])
    lh.build(["mrt_estabelecimentos_ativos"])
    del lh.table
    seen = spark.sparkContext.accumulator(0)
    fill(lh, spark, [r for r in ROWS if r[-1] == MONTHS[1]], seen)
    lh.build(["mrt_estabelecimentos_ativos"])
    assert seen.value <= 11  # rows of two months, in one pass (66 when the merge made them again)


def test_core_is_written_without_a_shuffle(spark, scratch, monkeypatch):
    lh = Lakehouse(spark, f"{scratch}/lh")
    fill(lh, spark, [r for r in ROWS if r[-1] != MONTHS[2]])
    laid, layout = [], tables.layout
    monkeypatch.setattr(tables, "layout", lambda *a: (laid.append(layout(*a)), laid[-1])[1])
    lh.build(["int_estabelecimentos"])
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in laid]
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Sort [uf" in plans[0]
    del lh.table
    read = [lh.table(t).select("cnpj", "uf", "cod_situacao_cadastral", "_competencia") for t in ("int_estabelecimentos", "stg_estabelecimentos")]
    assert sorted(map(str, read[0].collect())) == sorted(map(str, read[1].collect())) and read[0].count() == 11
