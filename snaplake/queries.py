"""Registered queries: one per operator of the reference, each with a SQL twin.

Every query reads the driver's test tables (through the derived raw
extracts), so its work grows with the scale factor. ``SPARK[name](spark,
sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is DuckDB SQL over the same
base tables with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake import oracle as O
from snaplake.functions import sql as sql_functions
from snaplake.functions import (
    blank_to_null,
    concat_key,
    decimal_comma,
    decode,
    flag,
    month_start,
    nonblank,
    parse_compact_date,
    trim_spaces,
)
from snaplake.operators import incremental as inc
from snaplake.operators.enrich import counted_bytes
from snaplake.operators import quality as dq
from snaplake.operators.snapshot import latest_snapshot
from snaplake.plans import gold, silver
from snaplake.plans.checks import RULES
from snaplake.plans.runner import Lakehouse
from snaplake.schemas import ALL_TABLES, DOMAIN_TABLES, FILE_PREFIXES, PORTE_LABELS, STATES, STATUS_ACTIVE, columns_of
from snaplake.session import session_key, work_dir
from snaplake.sinks import append, buckets, series, tables
from snaplake.sources import bronze, catalog, csv_dialect, landing, zip_stream
from snaplake.sources.derived import SNAPSHOT_MONTHS, file_name_sql, raw_table
from snaplake.streaming import incremental as sinc

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        SPARK[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_STG: dict[tuple, DataFrame] = {}


def stg(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Staged derived extract; the lazy frame is reused within a session."""
    key = (*session_key(spark), sf_dir, table)
    if key not in _STG:
        _STG[key] = silver.stage(table, raw_table(spark, sf_dir, table))
    return _STG[key]


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: stg(spark, sf_dir, t) for t in DOMAIN_TABLES}


# ------------------------------------------------------------ expressions

@register("clean_text", O.ctes("raw_estabelecimentos") + """SELECT
 TRIM(cnpj_basico) AS basico_trim, NULLIF(TRIM(cnpj_basico), '') AS basico_clean,
 NULLIF(TRIM(nome_fantasia), '') AS nome_fantasia, NULLIF(TRIM(logradouro), '') AS logradouro,
 NULLIF(TRIM(cnae_fiscal_principal), '') AS cnae, NULLIF(TRIM(email), '') AS email
FROM raw_estabelecimentos""")
def q_clean_text(spark, sf_dir):
    r = raw_table(spark, sf_dir, "estabelecimentos")
    return r.select(trim_spaces("cnpj_basico").alias("basico_trim"),
                    blank_to_null("cnpj_basico").alias("basico_clean"),
                    blank_to_null("nome_fantasia").alias("nome_fantasia"),
                    blank_to_null("logradouro").alias("logradouro"),
                    blank_to_null("cnae_fiscal_principal").alias("cnae"),
                    blank_to_null("email").alias("email"))


@register("decimal_comma", O.ctes("raw_empresas") + """SELECT cnpj_basico, capital_social AS capital_raw,
 TRY_CAST(REPLACE(NULLIF(TRIM(capital_social), ''), ',', '.') AS DOUBLE) AS capital_social
FROM raw_empresas""")
def q_decimal_comma(spark, sf_dir):
    r = raw_table(spark, sf_dir, "empresas")
    return r.select("cnpj_basico", F.col("capital_social").alias("capital_raw"),
                    decimal_comma("capital_social").alias("capital_social"))


@register("concat_key", O.ctes("raw_estabelecimentos") + """SELECT
 TRIM(cnpj_basico) || TRIM(cnpj_ordem) || TRIM(cnpj_dv) AS cnpj, _competencia
FROM raw_estabelecimentos""")
def q_concat_key(spark, sf_dir):
    r = raw_table(spark, sf_dir, "estabelecimentos")
    return r.select(concat_key("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj"),
                    "_competencia")


@register("parse_compact_date", O.ctes("raw_estabelecimentos") + f"""SELECT
 data_inicio_atividade AS raw_inicio, {O.pdate_expr('data_inicio_atividade')} AS data_inicio_atividade,
 data_situacao_cadastral AS raw_situacao,
 {O.pdate_expr('data_situacao_cadastral')} AS data_situacao_cadastral,
 {O.pdate_expr('data_situacao_especial')} AS data_situacao_especial
FROM raw_estabelecimentos""")
def q_parse_compact_date(spark, sf_dir):
    r = raw_table(spark, sf_dir, "estabelecimentos")
    return r.select(F.col("data_inicio_atividade").alias("raw_inicio"),
                    parse_compact_date("data_inicio_atividade").alias("data_inicio_atividade"),
                    F.col("data_situacao_cadastral").alias("raw_situacao"),
                    parse_compact_date("data_situacao_cadastral").alias("data_situacao_cadastral"),
                    parse_compact_date("data_situacao_especial").alias("data_situacao_especial"))


@register("decode_size", O.ctes("stg_empresas", extra=[("sizes", " UNION ALL ".join(
    f"SELECT '{code}' AS code, '{label}' AS label" for code, label in PORTE_LABELS))])
          + "SELECT cnpj_basico, cod_porte_empresa, "
          "(SELECT label FROM sizes WHERE code = cod_porte_empresa) AS descricao_porte_empresa FROM stg_empresas")
def q_decode_size(spark, sf_dir):
    e = stg(spark, sf_dir, "empresas")
    return e.select("cnpj_basico", "cod_porte_empresa",
                    decode("cod_porte_empresa", PORTE_LABELS).alias("descricao_porte_empresa"))


@register("flag_option", O.ctes("stg_simples") + """SELECT cnpj_basico, opcao_pelo_simples,
 CASE WHEN opcao_pelo_simples = 'S' THEN TRUE ELSE FALSE END AS is_simples, opcao_pelo_mei,
 CASE WHEN opcao_pelo_mei = 'S' THEN TRUE ELSE FALSE END AS is_mei
FROM stg_simples""")
def q_flag_option(spark, sf_dir):
    s = stg(spark, sf_dir, "simples")
    return s.select("cnpj_basico", "opcao_pelo_simples", flag("opcao_pelo_simples").alias("is_simples"),
                    "opcao_pelo_mei", flag("opcao_pelo_mei").alias("is_mei"))


@register("year_month", O.ctes("stg_estabelecimentos") + """SELECT cnpj, data_inicio_atividade,
 CAST(YEAR(data_inicio_atividade) AS INTEGER) AS ano_abertura,
 CAST(MONTH(data_inicio_atividade) AS INTEGER) AS mes_abertura
FROM stg_estabelecimentos""")
def q_year_month(spark, sf_dir):
    s = stg(spark, sf_dir, "estabelecimentos")
    return s.select("cnpj", "data_inicio_atividade",
                    F.year("data_inicio_atividade").alias("ano_abertura"),
                    F.month("data_inicio_atividade").alias("mes_abertura"))


@register("month_start", O.ctes("stg_estabelecimentos") + """SELECT cnpj,
 CAST(DATE_TRUNC('month', data_inicio_atividade) AS DATE) AS mes_inicio,
 CAST(DATE_TRUNC('month', data_situacao_cadastral) AS DATE) AS mes_situacao
FROM stg_estabelecimentos""")
def q_month_start(spark, sf_dir):
    s = stg(spark, sf_dir, "estabelecimentos")
    return s.select("cnpj", month_start("data_inicio_atividade").alias("mes_inicio"),
                    month_start("data_situacao_cadastral").alias("mes_situacao"))


@register("nonblank_key_filter", O.ctes("raw_estabelecimentos") + """SELECT cnpj_basico, cnpj_ordem, cnpj_dv
FROM raw_estabelecimentos WHERE NULLIF(TRIM(cnpj_basico), '') IS NOT NULL""")
def q_nonblank_key_filter(spark, sf_dir):
    r = raw_table(spark, sf_dir, "estabelecimentos")
    return r.where(nonblank("cnpj_basico")).select("cnpj_basico", "cnpj_ordem", "cnpj_dv")


# ---------------------------------------------------------------- staging

for _name, _table in [("stage_companies", "empresas"), ("stage_establishments", "estabelecimentos"),
                      ("stage_partners", "socios"), ("stage_tax_regime", "simples")]:
    def _make(table):
        def q(spark, sf_dir):
            return stg(spark, sf_dir, table)
        return q
    register(_name, O.ctes(f"stg_{_table}") + f"SELECT * FROM stg_{_table}")(_make(_table))


@register("stage_domain", O.domain_union_sql())
def q_stage_domain(spark, sf_dir):
    out = None
    for t in DOMAIN_TABLES:
        d = stg(spark, sf_dir, t).select(F.lit(t).alias("tabela"), "*")
        out = d if out is None else out.unionByName(d)
    return out


@register("establishments_core", O.ctes("int_estabelecimentos") + "SELECT * FROM int_estabelecimentos")
def q_establishments_core(spark, sf_dir):
    return silver.establishments_core(stg(spark, sf_dir, "estabelecimentos"))


@register("partners_enriched", O.ctes("stg_socios", "codes") + O.partners_sql())
def q_partners_enriched(spark, sf_dir):
    return silver.partners_enriched(stg(spark, sf_dir, "socios"), stg(spark, sf_dir, "paises"),
                                    stg(spark, sf_dir, "qualificacoes"))


# ------------------------------------------------------------------- gold

def _active(spark, sf_dir, **kw):
    d = dims(spark, sf_dir)
    return gold.active_establishments(
        stg(spark, sf_dir, "estabelecimentos"), stg(spark, sf_dir, "empresas"),
        stg(spark, sf_dir, "simples"), d["municipios"], d["cnaes"], d["naturezas"],
        d["motivos"], d["paises"], **kw)


@register("active_establishments", O.ctes(*O.ACTIVE_DEPS) + O.active_sql())
def q_active_establishments(spark, sf_dir):
    return _active(spark, sf_dir)


@register("active_establishments_by_month", O.ctes(*O.ACTIVE_DEPS) + O.active_sql(month_aware=True))
def q_active_establishments_by_month(spark, sf_dir):
    """Companies and tax regime of each establishment's own month (D3)."""
    return _active(spark, sf_dir, month_aware=True)


@register("active_by_state", O.ctes(*O.ACTIVE_DEPS) + O.active_sql("AND uf = 'RJ'"))
def q_active_by_state(spark, sf_dir):
    return _active(spark, sf_dir, uf="RJ")


def _core(spark, sf_dir):
    return silver.establishments_core(stg(spark, sf_dir, "estabelecimentos"))


@register("openings", O.ctes("int_estabelecimentos") + O.OPENINGS_SQL)
def q_openings(spark, sf_dir):
    return gold.openings(_core(spark, sf_dir))


@register("closings", O.ctes("int_estabelecimentos") + O.CLOSINGS_SQL)
def q_closings(spark, sf_dir):
    return gold.closings(_core(spark, sf_dir))


@register("monthly_dynamics", O.dynamics_sql(null_safe=False))
def q_monthly_dynamics(spark, sf_dir):
    return gold.monthly_dynamics(_core(spark, sf_dir), stg(spark, sf_dir, "cnaes"))


@register("monthly_dynamics_null_safe", O.dynamics_sql(null_safe=True))
def q_monthly_dynamics_null_safe(spark, sf_dir):
    return gold.monthly_dynamics(_core(spark, sf_dir), stg(spark, sf_dir, "cnaes"), null_safe=True)


@register("monthly_dynamics_by_join", O.dynamics_sql(null_safe=False))
def q_monthly_dynamics_by_join(spark, sf_dir):
    return gold.monthly_dynamics_by_join(_core(spark, sf_dir), stg(spark, sf_dir, "cnaes"))


# ------------------------------------------------ snapshots and increments



def _est_three_months(spark, sf_dir):
    """Establishments as loaded (2026-01/02) plus the full 2026-03 snapshot."""
    return stg(spark, sf_dir, "estabelecimentos").unionByName(
        silver.stage_establishments(raw_table(spark, sf_dir, "estabelecimentos_next")))


_THREE = O.ctes("stg_estabelecimentos", "stg_estabelecimentos_next", extra=[(
    "est3", "SELECT * FROM stg_estabelecimentos UNION ALL SELECT * FROM stg_estabelecimentos_next")])


@register("latest_snapshot", _THREE + """SELECT * FROM est3
WHERE _competencia = (SELECT max(_competencia) FROM est3)""")
def q_latest_snapshot(spark, sf_dir):
    return latest_snapshot(_est_three_months(spark, sf_dir))


@register("latest_snapshot_by_state", O.ctes("stg_estabelecimentos") + """SELECT s.* FROM stg_estabelecimentos s
JOIN (SELECT uf, max(_competencia) AS m FROM stg_estabelecimentos GROUP BY uf) x
  ON s.uf IS NOT DISTINCT FROM x.uf AND s._competencia = x.m""")
def q_latest_snapshot_by_state(spark, sf_dir):
    return latest_snapshot(stg(spark, sf_dir, "estabelecimentos"), by=["uf"])


_ACTIVE_LATEST = O.ctes(*O.ACTIVE_DEPS, "stg_estabelecimentos_next", extra=[
    ("est3", "SELECT * FROM stg_estabelecimentos UNION ALL SELECT * FROM stg_estabelecimentos_next"),
    ("est_latest", "SELECT * FROM est3 WHERE _competencia = (SELECT max(_competencia) FROM est3)"),
]) + O.active_sql(src="est_latest")


@register("active_latest_snapshot", _ACTIVE_LATEST)
def q_active_latest_snapshot(spark, sf_dir):
    """The active mart over a multi-month table, one snapshot per input (D3)."""
    d = dims(spark, sf_dir)
    return gold.active_establishments(
        latest_snapshot(_est_three_months(spark, sf_dir)),
        latest_snapshot(stg(spark, sf_dir, "empresas")),
        latest_snapshot(stg(spark, sf_dir, "simples")),
        *(latest_snapshot(d[t]) for t in ["municipios", "cnaes", "naturezas", "motivos", "paises"]))


PARTNER_KEYS = ["cnpj_basico", "cnpj_cpf_socio"]
_PARTNERS = O.ctes("stg_socios", "codes", extra=[
    ("p", O.partners_sql()),
    ("t", "SELECT * FROM p WHERE _competencia = '2026-01'"),
    ("s0", "SELECT * FROM p WHERE _competencia > (SELECT max(_competencia) FROM t)"),
])


@register("incremental_since", _PARTNERS + "SELECT * FROM s0")
def q_incremental_since(spark, sf_dir):
    p = silver.partners_enriched(stg(spark, sf_dir, "socios"), stg(spark, sf_dir, "paises"),
                                 stg(spark, sf_dir, "qualificacoes"))
    target = p.where(F.col("_competencia") == "2026-01")
    return inc.since(p, inc.watermark(target))


_LATEST_PARTNERS = _PARTNERS + O.latest_sql("p", PARTNER_KEYS, silver.PARTNER_COLUMNS)


def _upsert_sql(keys: list[str], cols: list[str], deletes: str | None = None) -> str:
    """Target and source together, each key's latest rows; deleted keys gone."""
    gone = f" WHERE ({', '.join(keys)}) NOT IN ({deletes})" if deletes else ""
    names = ", ".join(cols)
    return (f", both_sides AS (SELECT {names} FROM t UNION ALL SELECT {names} FROM s0),\n"
            f"final AS ({O.latest_sql('both_sides', keys, cols)})\nSELECT * FROM final{gone}")


@register("upsert_composite_key", _LATEST_PARTNERS)
def q_upsert_composite_key(spark, sf_dir):
    """A first load of 2026-01 and a merge of what is newer: all rows of each key's
    latest month, partners without an id told apart by all they say."""
    p = silver.partners_enriched(stg(spark, sf_dir, "socios"), stg(spark, sf_dir, "paises"),
                                 stg(spark, sf_dir, "qualificacoes"))
    target = inc.upsert(None, p.where(F.col("_competencia") == "2026-01"), PARTNER_KEYS)
    source = inc.since(p, inc.watermark(target))
    return inc.upsert(target, source, PARTNER_KEYS)


_ACTIVE_NEXT = O.ctes(*O.ACTIVE_DEPS, "stg_estabelecimentos_next", extra=[
    ("t", O.active_sql()), ("s0", O.active_sql(src="stg_estabelecimentos_next"))])


def _active_next(spark, sf_dir):
    d = dims(spark, sf_dir)
    args = (stg(spark, sf_dir, "empresas"), stg(spark, sf_dir, "simples"), d["municipios"],
            d["cnaes"], d["naturezas"], d["motivos"], d["paises"])
    nxt = silver.stage_establishments(raw_table(spark, sf_dir, "estabelecimentos_next"))
    return (gold.active_establishments(stg(spark, sf_dir, "estabelecimentos"), *args),
            gold.active_establishments(nxt, *args), nxt)


@register("upsert_single_key", _ACTIVE_NEXT.rstrip() + _upsert_sql(["cnpj"], gold.ACTIVE_COLUMNS))
def q_upsert_single_key(spark, sf_dir):
    """Merge next month's active establishments into the mart table on disk.

    The mart is written as version 1 partitioned by (uf, ano_abertura); the
    merge writes version 2. A quarter of the establishments change state, so
    their rows move partition; the read-back must hold no stale copy.
    """
    target, source, _ = _active_next(spark, sf_dir)
    root = work_dir(spark, "active_mart")
    parts = ["uf", "ano_abertura"]
    tables.write_version(target, root, partition_by=parts, sort_by=["data_inicio_atividade"])
    return tables.merge_into(spark, root, source, ["cnpj"], partition_by=parts,
                             sort_by=["data_inicio_atividade"])


@register("upsert_with_deletes", _ACTIVE_NEXT.rstrip() + _upsert_sql(
    ["cnpj"], gold.ACTIVE_COLUMNS,
    deletes="SELECT cnpj FROM stg_estabelecimentos_next "
            "WHERE cod_situacao_cadastral IS DISTINCT FROM '02'"))
def q_upsert_with_deletes(spark, sf_dir):
    """The same merge on disk, and establishments no longer active leave the mart."""
    target, source, nxt = _active_next(spark, sf_dir)
    gone = nxt.where(~F.col("cod_situacao_cadastral").eqNullSafe("02")).select("cnpj")
    root = work_dir(spark, "active_mart_deletes")
    parts = ["uf", "ano_abertura"]
    tables.write_version(target, root, partition_by=parts)
    return tables.merge_into(spark, root, source, ["cnpj"], partition_by=parts, deletes=gone)


# ------------------------------------------------------------ data checks


_EST_ALL_NOT_NULL = dq.not_null(*silver.CORE_COLUMNS)


@register("dq_not_null", O.ctes("stg_estabelecimentos") + "\nUNION ALL\n".join(
    O.dq_sql("stg_estabelecimentos", "stg_estabelecimentos", _EST_ALL_NOT_NULL)))
def q_dq_not_null(spark, sf_dir):
    """Null counts of every establishment column, all from one scan."""
    return dq.check(stg(spark, sf_dir, "estabelecimentos"), "stg_estabelecimentos",
                    _EST_ALL_NOT_NULL)


_UNIQUE_CASES = [
    ("stg_estabelecimentos", [dq.unique("cnpj"), dq.unique("cnpj_basico"),
                              dq.unique("cnpj", per=["_competencia"])]),
    ("stg_socios", [dq.unique(("cnpj_basico", "cnpj_cpf_socio")),
                    dq.unique(("cnpj_basico", "cnpj_cpf_socio"), per=["_competencia"])]),
    ("stg_empresas", [dq.unique("cnpj_basico")]),
]


@register("dq_unique", O.ctes("stg_estabelecimentos", "stg_socios", "stg_empresas")
          + "\nUNION ALL\n".join(s for m, rules in _UNIQUE_CASES for s in O.dq_sql(m, m, rules)))
def q_dq_unique(spark, sf_dir):
    """Duplicate keys, including partner-key collisions within a month."""
    frames = {"stg_estabelecimentos": "estabelecimentos", "stg_socios": "socios",
              "stg_empresas": "empresas"}
    return dq.check_all({m: (stg(spark, sf_dir, frames[m]), rules) for m, rules in _UNIQUE_CASES})


_ACCEPT = [dq.accepted_values("cod_situacao_cadastral", [STATUS_ACTIVE]),
           dq.accepted_values("cod_porte_empresa", ["00", "01", "03", "05"])]


@register("dq_accepted_values", O.ctes("stg_estabelecimentos", "stg_empresas") + "\nUNION ALL\n".join(
    O.dq_sql("stg_estabelecimentos", "stg_estabelecimentos", _ACCEPT[:1])
    + O.dq_sql("stg_empresas", "stg_empresas", _ACCEPT[1:])))
def q_dq_accepted_values(spark, sf_dir):
    return dq.check_all({
        "stg_estabelecimentos": (stg(spark, sf_dir, "estabelecimentos"), _ACCEPT[:1]),
        "stg_empresas": (stg(spark, sf_dir, "empresas"), _ACCEPT[1:]),
    })


def _models(spark, sf_dir) -> dict[str, DataFrame]:
    s = {f"stg_{t}": stg(spark, sf_dir, t) for t in
         ["empresas", "estabelecimentos", "socios", "simples", *DOMAIN_TABLES]}
    return {
        **s,
        "int_estabelecimentos": silver.establishments_core(s["stg_estabelecimentos"]),
        "int_socios": silver.partners_enriched(s["stg_socios"], s["stg_paises"],
                                               s["stg_qualificacoes"]),
        "mrt_dinamica_mensal": gold.monthly_dynamics(
            silver.establishments_core(s["stg_estabelecimentos"]), s["stg_cnaes"], ordered=False),
        "mrt_estabelecimentos_ativos": gold.active_establishments(
            s["stg_estabelecimentos"], s["stg_empresas"], s["stg_simples"], s["stg_municipios"],
            s["stg_cnaes"], s["stg_naturezas"], s["stg_motivos"], s["stg_paises"]),
    }


_DQ_ALL_CTES = O.ctes(*O.ACTIVE_DEPS, "stg_socios", "int_estabelecimentos",
                      extra=[("int_socios", O.partners_sql()),
                             ("mrt_dinamica_mensal", O.dynamics_body()),
                             ("mrt_estabelecimentos_ativos", O.active_sql())])


@register("dq_all", _DQ_ALL_CTES + "\nUNION ALL\n".join(
    s for m, rules in RULES.items() for s in O.dq_sql(m, m, rules)))
def q_dq_all(spark, sf_dir):
    """All 40 declared tests over the pipeline's models, as one report."""
    models = _models(spark, sf_dir)
    return dq.check_all({m: (models[m], rules) for m, rules in RULES.items()})


# -------------------------------------------------- landing and bronze files


_LAKE: dict[tuple, tuple[str, str]] = {}
EXTRACTION_DATE = "2026-02-20"


def lake(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Landing zips and bronze tables written from the derived extracts.

    Built once per session and scale factor under the shared checkpoint
    folder: Spark writes the CSV members, zips them in parallel tasks, then
    ingests every table (both months in one job per table).
    """
    key = (*session_key(spark), sf_dir)
    if key in _LAKE:
        return _LAKE[key]
    base = work_dir(spark, "lake")
    land, stage_dir, bz = f"{base}/landing", f"{base}/staging", f"{base}/bronze"
    def write(t):
        raw = raw_table(spark, sf_dir, t)
        raw = raw.withColumn("nome", F.expr(file_name_sql(t, "spark")))
        landing.write_zips(raw, land, f"{stage_dir}/{t}", t)

    bronze.run_concurrently(write, ALL_TABLES, 4)
    periods = [r["pasta"] for r in landing.periods(spark, land).collect()]
    bronze.ingest(spark, land, bz, periods, EXTRACTION_DATE)
    _LAKE[key] = (land, bz)
    return _LAKE[key]


def _files_sql() -> str:
    parts = [f"SELECT DISTINCT {file_name_sql(t, 'duckdb')} AS nome, _competencia AS pasta, "
             f"'{t}' AS tabela_src FROM raw_{t}" for t in ALL_TABLES]
    return ",\nfiles AS (" + "\nUNION ALL\n".join(parts) + ")\n"


_ROUTE = "CASE " + " ".join(
    f"WHEN regexp_replace(lower(nome), '\\.zip$', '') LIKE '{p}%' THEN '{t}'"
    for p, t in FILE_PREFIXES) + " ELSE regexp_replace(lower(nome), '\\.zip$', '') END"

_RAW_ALL = O.ctes(*[f"raw_{t}" for t in ALL_TABLES]).rstrip()


@register("file_table_routing", _RAW_ALL + _files_sql()
          + f"SELECT nome, pasta, {_ROUTE} AS tabela FROM files")
def q_file_table_routing(spark, sf_dir):
    land, _ = lake(spark, sf_dir)
    return landing.list_files(spark, land).select("nome", "pasta", "tabela")


@register("file_listing_summary", _RAW_ALL + _files_sql() + f"""SELECT pasta, {_ROUTE} AS tabela,
 CAST(count(*) AS BIGINT) AS n_files, TRUE AS has_bytes FROM files GROUP BY 1, 2""")
def q_file_listing_summary(spark, sf_dir):
    land, _ = lake(spark, sf_dir)
    s = landing.listing_summary(landing.list_files(spark, land))
    return s.select("pasta", "tabela", "n_files", (F.col("total_bytes") > 0).alias("has_bytes"))


@register("latest_period", _RAW_ALL + _files_sql()
          + "SELECT max(pasta) AS latest_period FROM files")
def q_latest_period(spark, sf_dir):
    land, _ = lake(spark, sf_dir)
    return landing.periods(spark, land).agg(F.max("pasta").alias("latest_period"))


def _rows_sql() -> str:
    parts = [f"SELECT '{t}' AS tabela, _competencia AS competencia, "
             f"CAST(count(DISTINCT {file_name_sql(t, 'duckdb')}) AS BIGINT) AS n_files, "
             f"CAST(count(*) AS BIGINT) AS n_rows FROM raw_{t} GROUP BY _competencia"
             for t in ALL_TABLES]
    return "\nUNION ALL\n".join(parts)


@register("bronze_ingest_summary", _RAW_ALL + "\n" + _rows_sql())
def q_bronze_ingest_summary(spark, sf_dir):
    """Zips read and rows landed per table and month: every shard kept."""
    _, bz = lake(spark, sf_dir)
    return bronze.summary(spark, bz, ALL_TABLES)


@register("bronze_stage_establishments", O.ctes("stg_estabelecimentos")
          + "SELECT * FROM stg_estabelecimentos")
def q_bronze_stage_establishments(spark, sf_dir):
    """Staging fed from bronze (zips -> Parquet) equals staging fed directly."""
    _, bz = lake(spark, sf_dir)
    return silver.stage_establishments(bronze.read_table(spark, bz, "estabelecimentos"))


@register("bronze_monthly_dynamics", O.dynamics_sql(null_safe=False))
def q_bronze_monthly_dynamics(spark, sf_dir):
    _, bz = lake(spark, sf_dir)
    core = silver.establishments_core(
        silver.stage_establishments(bronze.read_table(spark, bz, "estabelecimentos")))
    cn = silver.stage_domain(bronze.read_table(spark, bz, "cnaes"))
    return gold.monthly_dynamics(core, cn)


def _damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots of companies as quoted lines; every 20th line has fields too many
    (the last one empty), every 30th has two too few."""
    raw = raw_table(spark, sf_dir, "empresas_full")
    cells = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in columns_of("empresas")]
    kind = F.col("cnpj_basico").cast("int")
    line = (F.when(kind % 20 == 3, F.concat_ws(";", *cells, F.lit('"x;y"'), F.lit("")))
            .when(kind % 30 == 7, F.concat_ws(";", *cells[:-2])).otherwise(F.concat_ws(";", *cells)))
    return raw.select(line.alias("linha"), F.expr(file_name_sql("empresas", "spark")).alias("nome"), "_competencia")


_DAMAGED = O.ctes("raw_empresas_full").rstrip() + f""", lines AS (
 SELECT *, {file_name_sql("empresas", "duckdb")} AS arquivo, CAST(cnpj_basico AS INTEGER) % 20 = 3 AS too_long,
  CAST(cnpj_basico AS INTEGER) % 30 = 7 AS too_short FROM raw_empresas_full)
"""


def damaged_bronze(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """(report, bronze folder) of an ingestion whose zips hold lines of wrong lengths."""
    key = (*session_key(spark), sf_dir, "damaged")
    if key not in _LAKE:
        base = work_dir(spark, "damaged")
        landing.write_lines(_damaged_lines(spark, sf_dir), f"{base}/landing", f"{base}/staging", "linha").collect()
        report = bronze.ingest_report(spark, f"{base}/landing", f"{base}/bronze", SNAPSHOT_MONTHS, EXTRACTION_DATE, ["empresas"])
        _LAKE[key] = (report, f"{base}/bronze")
    return _LAKE[key]


@register("ingest_zip_counts", _DAMAGED + """SELECT 'empresas' AS tabela, _competencia AS competencia, arquivo,
 CAST(count(*) FILTER (WHERE NOT too_long) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE too_short AND NOT too_long) AS BIGINT) AS n_padded,
 CAST(count(*) FILTER (WHERE too_long) AS BIGINT) AS n_rejected FROM lines GROUP BY ALL""")
def q_ingest_zip_counts(spark, sf_dir):
    """What each zip gave, counted while bronze is written."""
    return damaged_bronze(spark, sf_dir)[0]


@register("ingest_rejected_lines", _DAMAGED + """SELECT 'empresas' AS tabela, _competencia AS competencia, arquivo,
 concat_ws(';', """ + ", ".join(f"""'"' || coalesce({c}, '') || '"'""" for c in columns_of("empresas"))
          + """, '"x;y"', '') AS linha, """ + f"{len(columns_of('empresas')) + 2} AS n_campos FROM lines WHERE too_long")
def q_ingest_rejected_lines(spark, sf_dir):
    """The lines that bronze did not take, as they are in the zips."""
    return bronze.read_rejects(spark, damaged_bronze(spark, sf_dir)[1])


@register("csv_dialect_scan", _DAMAGED + "SELECT " + ", ".join(
    f"CASE WHEN too_short AND {i} >= {len(columns_of('empresas')) - 2} THEN NULL ELSE NULLIF({c}, '') END AS {c}"
    for i, c in enumerate(columns_of("empresas"))) + " FROM lines WHERE NOT too_long")
def q_csv_dialect_scan(spark, sf_dir):
    """The same lines as plain files, by Spark's CSV reader: short rows padded, long rows
    dropped though their last field is empty."""
    path = work_dir(spark, "csv-lines")
    _damaged_lines(spark, sf_dir).select("linha").write.text(path)
    return csv_dialect.read_csv(spark, path, "empresas").select(*columns_of("empresas"))


# ------------------------------------------------- the whole flow, on disk



def snapshot_lake(spark: SparkSession, sf_dir: str, reissued: bool = False) -> tuple[str, str]:
    """Landing zips of three full monthly snapshots of every table, and a second landing
    folder, which takes a re-issue of the last month's establishments when it is asked for."""
    key = (*session_key(spark), sf_dir, "snapshots")
    if key not in _LAKE or reissued and (*key, "again") not in _LAKE:
        land, again = _LAKE.get(key) or [f"{work_dir(spark, 'snapshots')}/{part}" for part in ("landing", "reissued")]

        def write(job):
            source, t, to = job
            raw = raw_table(spark, sf_dir, source).withColumn("nome", F.expr(file_name_sql(t, "spark")))
            landing.write_zips(raw, to, f"{to}-staging/{source}", t)

        jobs = [] if key in _LAKE else [(f"{t}_full", t, land) for t in ALL_TABLES]
        if reissued:
            jobs.append(("estabelecimentos_reissued", "estabelecimentos", again))
        bronze.run_concurrently(write, jobs, 4)
        _LAKE[key] = (land, again)
        if reissued:
            _LAKE[(*key, "again")] = (land, again)
    return _LAKE[key]


_LH: dict[tuple, Lakehouse] = {}
ACTIVE_MODELS = ["stg_estabelecimentos", "stg_empresas", "stg_simples", *[f"stg_{t}" for t in DOMAIN_TABLES],
                 "mrt_estabelecimentos_ativos"]


def lakehouse(spark: SparkSession, sf_dir: str, steps: tuple[tuple[str, ...], ...], targets: list[str] | None = None) -> Lakehouse:
    """Landing zips -> bronze -> silver -> gold on disk, ``steps`` of months each
    ingested and built before the next; kept for the session."""
    key = (*session_key(spark), sf_dir, steps, tuple(targets or ()))
    if key not in _LH:
        land, _ = snapshot_lake(spark, sf_dir)
        lh = Lakehouse(spark, work_dir(spark, "lakehouse"))
        for months in steps:
            lh.backfill(land, list(months), EXTRACTION_DATE, targets)
        _LH[key] = lh
    return _LH[key]


MONTHLY = tuple((m,) for m in SNAPSHOT_MONTHS)


def built(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """All models, month after month: a first load and two merges."""
    return lakehouse(spark, sf_dir, MONTHLY)


_EST_NOW = [("est_now", O.latest_sql("stg_estabelecimentos_full", ["cnpj"], silver.CORE_COLUMNS))]
_ACTIVE_FULL = O.ctes("stg_estabelecimentos_full", "stg_empresas_full", "stg_simples_full", "codes_full", extra=_EST_NOW) \
    + O.active_sql(src="est_now", month_aware=True, suffix="_full")


@register("lakehouse_active_establishments", _ACTIVE_FULL)
def q_lakehouse_active_establishments(spark, sf_dir):
    """The active mart after three snapshots loaded one by one: names, options, states
    and labels of each establishment's latest month; closed ones are gone."""
    return built(spark, sf_dir).table("mrt_estabelecimentos_ativos").select(*gold.ACTIVE_COLUMNS)


@register("lakehouse_backfill_active", _ACTIVE_FULL)
def q_lakehouse_backfill_active(spark, sf_dir):
    """The same mart from one run over all three months."""
    lh = lakehouse(spark, sf_dir, (tuple(SNAPSHOT_MONTHS),), ACTIVE_MODELS)
    return lh.table("mrt_estabelecimentos_ativos").select(*gold.ACTIVE_COLUMNS)


@register("lakehouse_active_after_closure", _ACTIVE_FULL)
def q_lakehouse_active_after_closure(spark, sf_dir):
    """One month, then two in one merge: an establishment active in the second and
    closed in the third does not come back."""
    lh = lakehouse(spark, sf_dir, (MONTHLY[0], tuple(SNAPSHOT_MONTHS[1:])), ACTIVE_MODELS)
    return lh.table("mrt_estabelecimentos_ativos").select(*gold.ACTIVE_COLUMNS)


@register("incremental_reissued_month", O.ctes(
    "stg_estabelecimentos_full", "stg_estabelecimentos_reissued", "stg_empresas_full", "stg_simples_full", "codes_full", extra=[
        ("est_all", "SELECT * FROM stg_estabelecimentos_full WHERE _competencia < '2026-03' "
                    "UNION ALL SELECT * FROM stg_estabelecimentos_reissued"),
        ("est_now", O.latest_sql("est_all", ["cnpj"], silver.CORE_COLUMNS))])
    + O.active_sql(src="est_now", month_aware=True, suffix="_full"))
def q_incremental_reissued_month(spark, sf_dir):
    """The last month comes again with other names; ``refresh_months`` re-stages it
    and the incremental mart takes its rows again."""
    key = (*session_key(spark), sf_dir, "reissued")
    if key not in _LH:
        land, again = snapshot_lake(spark, sf_dir, reissued=True)
        lh = Lakehouse(spark, work_dir(spark, "lakehouse"))
        lh.backfill(land, SNAPSHOT_MONTHS, EXTRACTION_DATE, ACTIVE_MODELS)
        lh.refresh_months = SNAPSHOT_MONTHS[-1:]
        lh.ingest(again, lh.refresh_months, EXTRACTION_DATE, ["estabelecimentos"])
        lh.build(ACTIVE_MODELS)
        _LH[key] = lh
    return _LH[key].table("mrt_estabelecimentos_ativos").select(*gold.ACTIVE_COLUMNS)


@register("lakehouse_monthly_dynamics", O.ctes("stg_estabelecimentos_full", "stg_cnaes_full", extra=[
    ("newest", "SELECT * FROM stg_estabelecimentos_full WHERE _competencia = '2026-03'"),
    ("codes", "SELECT 'cnaes' AS kind, codigo, descricao FROM stg_cnaes_full WHERE _competencia = '2026-03'")])
    + O.dynamics_body(src="newest"))
def q_lakehouse_monthly_dynamics(spark, sf_dir):
    """Dynamics of the latest of three snapshots."""
    return built(spark, sf_dir).table("mrt_dinamica_mensal").select(*gold.DYNAMICS_COLUMNS)


@register("lakehouse_incremental_partners", O.ctes("stg_socios_full", "codes_full", extra=[
    ("p", O.partners_sql("stg_socios_full", month_aware=True))]) + O.latest_sql("p", PARTNER_KEYS, silver.PARTNER_COLUMNS))
def q_lakehouse_incremental_partners(spark, sf_dir):
    """int_socios after a first load and two merges."""
    return built(spark, sf_dir).table("int_socios").select(*silver.PARTNER_COLUMNS)


@register("dq_incremental", O.ctes("stg_estabelecimentos_full", "stg_empresas_full", "stg_simples_full") + "\nUNION ALL\n".join(
    part for t in ("stg_estabelecimentos", "stg_empresas", "stg_simples") for part in O.dq_sql(t, f"{t}_full", RULES[t])))
def q_dq_incremental(spark, sf_dir):
    """The tests of three partitioned tables after three loads, each of which summarised
    its own month only."""
    key = (*session_key(spark), sf_dir, "summaries")
    models = ["stg_estabelecimentos", "stg_empresas", "stg_simples"]
    if key not in _LH:
        land, _ = snapshot_lake(spark, sf_dir)
        lh = Lakehouse(spark, work_dir(spark, "lakehouse"))
        for month in SNAPSHOT_MONTHS:
            lh.backfill(land, [month], EXTRACTION_DATE, models)
            lh.check_incremental(models)
        _LH[key] = lh
    return _LH[key].check_incremental(models).drop("status")


@register("lakehouse_published_view", O.ctes("stg_estabelecimentos_full") + """SELECT _competencia, uf,
 CAST(count(*) AS BIGINT) AS n_rows FROM stg_estabelecimentos_full GROUP BY _competencia, uf""")
def q_lakehouse_published_view(spark, sf_dir):
    """The view that a build publishes, by SQL."""
    tables.publish(spark, "stg_estabelecimentos", built(spark, sf_dir).path("stg_estabelecimentos"))
    return spark.sql("SELECT _competencia, uf, count(*) AS n_rows FROM stg_estabelecimentos GROUP BY _competencia, uf")


@register("dynamics_by_deltas", ORACLE["lakehouse_monthly_dynamics"])
def q_dynamics_by_deltas(spark, sf_dir):
    """Dynamics kept up over three snapshots by signed changes: equal to a recount."""
    key = (*session_key(spark), sf_dir, "deltas")
    if key not in _LH:
        land, _ = snapshot_lake(spark, sf_dir)
        lh = Lakehouse(spark, work_dir(spark, "lakehouse"))
        for month in SNAPSHOT_MONTHS:
            lh.backfill(land, [month], EXTRACTION_DATE, DYNAMICS_MODELS)
            lh.update_dynamics()
        _LH[key] = lh
    return _LH[key].update_dynamics()


DYNAMICS_MODELS = ["stg_estabelecimentos", "int_estabelecimentos", "stg_cnaes"]


@register("dynamics_by_deltas_reissued", O.ctes("stg_estabelecimentos_reissued", "stg_cnaes_full", extra=[
    ("again", "SELECT * FROM stg_estabelecimentos_reissued WHERE uf <> 'AC' AND cod_situacao_cadastral <> '03'"),
    ("codes", "SELECT 'cnaes' AS kind, codigo, descricao FROM stg_cnaes_full WHERE _competencia = '2026-03'")])
    + O.dynamics_body(src="again"))
def q_dynamics_by_deltas_reissued(spark, sf_dir):
    """The last month comes again without one state and without suspended establishments:
    their events are taken back."""
    key = (*session_key(spark), sf_dir, "deltas-reissued")
    if key not in _LH:
        land, _ = snapshot_lake(spark, sf_dir)
        base = work_dir(spark, "again")
        raw = raw_table(spark, sf_dir, "estabelecimentos_reissued").withColumn("nome", F.expr(file_name_sql("estabelecimentos", "spark")))
        raw = raw.where("trim(uf) <> 'AC' AND trim(situacao_cadastral) <> '03'")
        landing.write_zips(raw, f"{base}/landing", f"{base}/staging", "estabelecimentos")
        lh = Lakehouse(spark, work_dir(spark, "lakehouse"))
        lh.backfill(land, SNAPSHOT_MONTHS, EXTRACTION_DATE, DYNAMICS_MODELS)
        lh.update_dynamics()
        lh.refresh_months = SNAPSHOT_MONTHS[-1:]
        lh.ingest(f"{base}/landing", lh.refresh_months, EXTRACTION_DATE, ["estabelecimentos"])
        lh.build(DYNAMICS_MODELS)
        _LH[key] = lh
    return _LH[key].update_dynamics()


def _run_by(spark, sf_dir, states):
    """The active mart as loaded, built by one run for each of ``states``."""
    key = (*session_key(spark), sf_dir, "run_by", tuple(states))
    if key not in _LH:
        land, _ = lake(spark, sf_dir)
        lh = Lakehouse(spark, work_dir(spark, "lakehouse"), snapshot="as_loaded")
        lh.backfill(land, ["2026-01", "2026-02"], EXTRACTION_DATE, ACTIVE_MODELS[:-1])
        ok, failed = lh.run_by(list(states))
        if failed:
            raise RuntimeError(failed)
        _LH[key] = lh
    return _LH[key].table("mrt_estabelecimentos_ativos").select(*gold.ACTIVE_COLUMNS)


@register("run_by_state", O.ctes(*O.ACTIVE_DEPS) + O.active_sql("AND uf IN ('AC', 'AL')"))
def q_run_by_state(spark, sf_dir):
    """A batch of two states only, AC and AL (as loaded): each loads whole, and no
    other state comes in. ``run_by_all_states`` is the whole batch."""
    return _run_by(spark, sf_dir, ["AC", "AL"])


@register("run_by_all_states", ORACLE["active_establishments"])
def q_run_by_all_states(spark, sf_dir):
    """The active mart built state by state over all 27 (as loaded), like the
    reference's batch: the same rows as in one run."""
    return _run_by(spark, sf_dir, STATES)


@register("states_in_one_job", ORACLE["active_establishments"])
def q_states_in_one_job(spark, sf_dir):
    """The batch over all states (as loaded) as one job and one merge, each state past its
    own watermark: the same rows as state by state."""
    key = (*session_key(spark), sf_dir, "states")
    if key not in _LH:
        land, _ = lake(spark, sf_dir)
        lh = Lakehouse(spark, work_dir(spark, "lakehouse"), snapshot="as_loaded")
        lh.backfill(land, ["2026-01", "2026-02"], EXTRACTION_DATE, ACTIVE_MODELS[:-1])
        _, failed = lh.build_states(rules=[])
        if failed:
            raise RuntimeError(failed)
        _LH[key] = lh
    return _LH[key].table("mrt_estabelecimentos_ativos").select(*gold.ACTIVE_COLUMNS)


HELD_STATE = "AC"
_HELD = O.ctes("stg_estabelecimentos_full", "stg_empresas_full", "stg_simples_full", "codes_full", extra=[
    ("est_first", f"SELECT * FROM stg_estabelecimentos_full WHERE _competencia = '{SNAPSHOT_MONTHS[0]}'"),
    *_EST_NOW,
    ("kept_back", f"SELECT cnpj FROM est_first WHERE uf = '{HELD_STATE}' AND cod_situacao_cadastral = '02' "
                  f"UNION SELECT cnpj FROM est_now WHERE uf = '{HELD_STATE}'"),
    ("est_mixed", "SELECT * FROM est_now WHERE cnpj NOT IN (SELECT cnpj FROM kept_back WHERE cnpj IS NOT NULL) "
                  "UNION ALL SELECT * FROM est_first WHERE cnpj IN (SELECT cnpj FROM kept_back)")]) \
    + O.active_sql(src="est_mixed", month_aware=True, suffix="_full")


def held_lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """One month, then two more in which one state's rows break a rule."""
    key = (*session_key(spark), sf_dir, "held")
    if key not in _LH:
        land, _ = snapshot_lake(spark, sf_dir)
        lh = Lakehouse(spark, work_dir(spark, "lakehouse"))
        lh.backfill(land, SNAPSHOT_MONTHS[:1], EXTRACTION_DATE, ACTIVE_MODELS[:-1])
        lh.build_states(rules=[])
        lh.backfill(land, SNAPSHOT_MONTHS[1:], EXTRACTION_DATE, ACTIVE_MODELS[:-1])
        _, failed = lh.build_states(rules=[dq.accepted_values("uf", [s for s in STATES if s != HELD_STATE])])
        if [s for s, _ in failed] != [HELD_STATE]:
            raise RuntimeError(failed)
        _LH[key] = lh
    return _LH[key]


@register("states_one_held_back", _HELD)
def q_states_one_held_back(spark, sf_dir):
    """A batch in which one state breaks a rule: it and all moves into and out of it stay
    as they were after the first month, every other state is up to date."""
    return held_lakehouse(spark, sf_dir).table("mrt_estabelecimentos_ativos").select(*gold.ACTIVE_COLUMNS)


@register("active_by_state_filtered", ORACLE["active_by_state"])
def q_active_by_state_filtered(spark, sf_dir):
    """One state's active establishments; companies and tax regime are left to Spark's
    runtime filter instead of a join with the state's distinct companies."""
    return _active(spark, sf_dir, uf="RJ", runtime_filter=True)


@register("watermark_from_footers", O.ctes("stg_estabelecimentos") + """SELECT max(data_situacao_cadastral) AS newest_change,
 max(_competencia) AS newest_month FROM stg_estabelecimentos""")
def q_watermark_from_footers(spark, sf_dir):
    """The newest change of status from Parquet footers, and the newest month from a
    table's manifest: neither reads a row."""
    root = work_dir(spark, "footers")
    tables.write_version(stg(spark, sf_dir, "estabelecimentos"), root, ["_competencia"])
    newest = inc.watermark_from_footers(spark, [tables.version_path(root, 1)], "data_situacao_cadastral")
    return spark.createDataFrame([(newest, tables.latest_value(spark, root, "_competencia"))], "newest_change date, newest_month string")


def bucketed_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Establishments, companies and tax regime staged into tables bucketed on the company."""
    key = (*session_key(spark), sf_dir, "bucketed")
    if key not in _LAKE:
        staged = {t: stg(spark, sf_dir, t) for t in ("estabelecimentos", "empresas", "simples")}
        n = buckets.buckets_for(max(counted_bytes(raw_table(spark, sf_dir, t)) for t in staged))
        base = work_dir(spark, "bucketed")
        _LAKE[key] = {t: buckets.write_bucketed(df, f"{base}/{t}", "cnpj_basico", n, ["_competencia"]) for t, df in staged.items()}
    return _LAKE[key]


def _active_bucketed(spark, sf_dir, **kw):
    t, d = bucketed_tables(spark, sf_dir), dims(spark, sf_dir)
    return gold.active_establishments(t["estabelecimentos"], t["empresas"], t["simples"], *[d[k] for k in (
        "municipios", "cnaes", "naturezas", "motivos", "paises")], hot_key_rows=1_000_000, bucketed=True, **kw)


@register("active_establishments_bucketed", ORACLE["active_establishments"])
def q_active_establishments_bucketed(spark, sf_dir):
    """The active mart from bucketed silver tables: neither large join shuffles."""
    return _active_bucketed(spark, sf_dir)


@register("active_bucketed_by_month", ORACLE["active_establishments_by_month"])
def q_active_bucketed_by_month(spark, sf_dir):
    """The same with companies and tax regime of the establishment's own month."""
    return _active_bucketed(spark, sf_dir, month_aware=True)


_SQL_STAGE = """SELECT trim(cnpj_basico) AS cnpj_basico, trim(cnpj_ordem) AS cnpj_ordem, trim(cnpj_dv) AS cnpj_dv,
 concat_key(cnpj_basico, cnpj_ordem, cnpj_dv) AS cnpj,
 blank_to_null(situacao_cadastral) AS cod_situacao_cadastral, blank_to_null(motivo_situacao_cadastral) AS cod_motivo_situacao_cadastral,
 blank_to_null(pais) AS cod_pais, blank_to_null(cnae_fiscal_principal) AS cod_cnae_principal, blank_to_null(municipio) AS cod_municipio,
 compact_date(data_situacao_cadastral) AS data_situacao_cadastral, compact_date(data_inicio_atividade) AS data_inicio_atividade,
 compact_date(data_situacao_especial) AS data_situacao_especial,
 {same}, _competencia, _data_extracao
FROM raw_establishments WHERE blank_to_null(cnpj_basico) IS NOT NULL"""
_SAME_NAME = ["identificador_matriz_filial", "nome_fantasia", "nome_cidade_exterior", "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero",
              "complemento", "bairro", "cep", "uf", "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax", "email", "situacao_especial"]


@register("sql_stage_establishments", ORACLE["stage_establishments"])
def q_sql_stage_establishments(spark, sf_dir):
    """Staging written in SQL alone, with the registered functions."""
    sql_functions.register(spark)
    raw_table(spark, sf_dir, "estabelecimentos").createOrReplaceTempView("raw_establishments")
    return spark.sql(_SQL_STAGE.format(same=", ".join(f"blank_to_null({c}) AS {c}" for c in _SAME_NAME)))


@register("sql_companies_decoded", O.ctes("stg_empresas", "stg_simples", extra=[("sizes", " UNION ALL ".join(
    f"SELECT '{k}' AS code, '{v}' AS label" for k, v in PORTE_LABELS))]) + """SELECT e.cnpj_basico, e.capital_social, s.label AS tamanho,
 coalesce(t.opcao_pelo_simples = 'S', FALSE) AS is_simples FROM stg_empresas e LEFT JOIN sizes s ON s.code = e.cod_porte_empresa
 LEFT JOIN stg_simples t ON t.cnpj_basico = e.cnpj_basico""")
def q_sql_companies_decoded(spark, sf_dir):
    """Decimal comma, decode and flag from SQL."""
    sql_functions.register(spark)
    raw_table(spark, sf_dir, "empresas").createOrReplaceTempView("raw_companies")
    stg(spark, sf_dir, "simples").createOrReplaceTempView("stg_tax_regime")
    return spark.sql("""SELECT trim(e.cnpj_basico) AS cnpj_basico, decimal_comma(e.capital_social) AS capital_social,
 company_size(blank_to_null(e.porte_empresa)) AS tamanho, is_yes(t.opcao_pelo_simples) AS is_simples
FROM raw_companies e LEFT JOIN stg_tax_regime t ON t.cnpj_basico = trim(e.cnpj_basico) WHERE blank_to_null(e.cnpj_basico) IS NOT NULL""")


# ------------------------------------------- views, parameters, small sinks

@register("bronze_views_sql", O.ctes("raw_socios") + """SELECT _competencia, identificador_socio,
 CAST(count(*) AS BIGINT) AS n_rows FROM raw_socios WHERE _competencia = '2026-02' GROUP BY ALL""")
def q_bronze_views_sql(spark, sf_dir):
    """Bronze registered as views, then an ad-hoc query with a parameter."""
    _, bz = lake(spark, sf_dir)
    catalog.register_bronze(spark, bz)
    return catalog.query(spark, "SELECT _competencia, identificador_socio, count(*) AS n_rows FROM bronze_socios "
                         "WHERE _competencia = :month GROUP BY _competencia, identificador_socio",
                         args={"month": landing.period_of("2026-02-20")})


for _fmt in ("parquet", "json", "csv"):
    def _make_series(fmt):
        def q(spark, sf_dir):
            """Company records written as a dated series and read back."""
            root = work_dir(spark, f"series-{fmt}")
            rows = stg(spark, sf_dir, "empresas").select("cnpj_basico", "razao_social", "cod_porte_empresa")
            series.write_series(rows, root, "empresas", "2026-02-20", fmt=fmt)
            back = series.read_series(spark, root, "empresas", fmt=fmt)
            return back.select(F.lpad(F.col("cnpj_basico").cast("string"), 8, "0").alias("cnpj_basico"), "razao_social",
                               F.lpad(F.col("cod_porte_empresa").cast("string"), 2, "0").alias("cod_porte_empresa"))
        return q
    register(f"series_{_fmt}", O.ctes("stg_empresas") + "SELECT cnpj_basico, razao_social, cod_porte_empresa FROM stg_empresas")(
        _make_series(_fmt))


def _loss_sql() -> str:
    parts = []
    for t, cols in silver.PARSED.items():
        for c, kind in cols:
            tc = f"TRIM({c})"
            if kind == "date":
                meant = f"LENGTH({tc}) = 8 AND {tc} <> '00000000'"
                lost = f"{meant} AND try_strptime({tc}, '%Y%m%d') IS NULL"
            else:
                meant = f"NULLIF({tc}, '') IS NOT NULL"
                lost = f"{meant} AND TRY_CAST(REPLACE({tc}, ',', '.') AS DOUBLE) IS NULL"
            parts.append(f"SELECT '{t}' AS tabela, '{c}' AS column_name, "
                         f"CAST(count(*) FILTER (WHERE {meant}) AS BIGINT) AS n_values, "
                         f"CAST(count(*) FILTER (WHERE {lost}) AS BIGINT) AS n_lost "
                         f"FROM raw_{t} WHERE NULLIF(TRIM(cnpj_basico), '') IS NOT NULL")
    return O.ctes(*[f"raw_{t}" for t in silver.PARSED]) + "\nUNION ALL\n".join(parts)


@register("dq_parse_losses", _loss_sql())
def q_dq_parse_losses(spark, sf_dir):
    """Malformed dates / numbers counted instead of failing the run (D11)."""
    out = None
    for t in silver.PARSED:
        r = silver.parse_losses(raw_table(spark, sf_dir, t), t)
        out = r if out is None else out.unionByName(r)
    return out


# ------------------------------------------------------------- streaming



@register("streamed_partners", _LATEST_PARTNERS)
def q_streamed_partners(spark, sf_dir):
    """Bronze partner files streamed (availableNow, several micro-batches),
    staged, enriched and merged latest-wins into a versioned table."""
    _, bz = lake(spark, sf_dir)
    paises, quals = stg(spark, sf_dir, "paises"), stg(spark, sf_dir, "qualificacoes")
    root = work_dir(spark, "streamed_partners")
    stream = silver.stage_partners(sinc.bronze_stream(spark, bz, "socios", max_files_per_trigger=8))
    q = sinc.stream_merge(stream, root, ["cnpj_basico", "cnpj_cpf_socio"],
                          transform=lambda b: silver.partners_enriched(b, paises, quals), partition_by=["_competencia"])
    sinc.run_until_done(q)
    return tables.read_table(spark, root).select(*silver.PARTNER_COLUMNS)


@register("streamed_bronze", O.ctes("stg_empresas_full") + "SELECT * FROM stg_empresas_full")
def q_streamed_bronze(spark, sf_dir):
    """Company zips that land month by month, each month taken in by a stream started anew:
    staged, they are what one batch over all months gives."""
    key = (*session_key(spark), sf_dir, "arrived")
    if key not in _LAKE:
        base = work_dir(spark, "arrived")
        raw = raw_table(spark, sf_dir, "empresas_full").withColumn("nome", F.expr(file_name_sql("empresas", "spark")))
        for month in reversed(SNAPSHOT_MONTHS):  # the oldest month comes last
            landing.write_extracts(raw.where(F.col("_competencia") == month), f"{base}/landing", f"{base}/staging", "empresas").collect()
            sinc.run_until_done(zip_stream.ingest_arrived(spark, f"{base}/landing", f"{base}/bronze", "empresas", EXTRACTION_DATE))
        _LAKE[key] = (base, f"{base}/bronze")
    bz = _LAKE[key][1]
    return silver.stage_companies(bronze.read_table(spark, bz, "empresas"))


@register("appended_series", O.ctes("stg_empresas_full") + "SELECT cnpj_basico, razao_social, capital_social, _competencia FROM stg_empresas_full")
def q_appended_series(spark, sf_dir):
    """Companies appended month by month to a table by name; a repeated month adds nothing."""
    root = work_dir(spark, "appended")
    rows = silver.stage_companies(raw_table(spark, sf_dir, "empresas_full")).select("cnpj_basico", "razao_social", "capital_social", "_competencia")
    for month in (*SNAPSHOT_MONTHS, SNAPSHOT_MONTHS[0]):
        append.append_rows(rows.where(F.col("_competencia") == month), root, f"empresas-{month}")
    return append.read_appended(spark, root, rows.schema)


@register("active_establishments_hot_split", ORACLE["active_establishments"])
def q_active_establishments_hot_split(spark, sf_dir):
    """The active mart with companies of 4+ active establishments salted in the
    joins (same rows as the plain join)."""
    return _active(spark, sf_dir, hot_key_rows=4)
