"""Gold marts: active establishments and monthly opening/closing dynamics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.functions import decode, flag, month_start
from snaplake.operators.enrich import hot_keys, lookup, split_hot_join
from snaplake.sinks.buckets import bucketed_join
from snaplake.schemas import (
    PORTE_LABELS,
    STATUS_ACTIVE,
    STATUS_CLOSED,
    STATUS_SUSPENDED,
    STATUS_UNFIT,
)

CLOSING_STATUSES = [STATUS_SUSPENDED, STATUS_UNFIT, STATUS_CLOSED]
DYNAMICS_KEYS = ["mes_referencia", "uf", "cod_cnae_principal"]
DYNAMICS_COLUMNS = DYNAMICS_KEYS + ["qtd_aberturas", "qtd_baixadas", "qtd_inaptadas",
                                    "qtd_suspensas", "saldo_liquido", "descricao_cnae_principal"]


# ---------------------------------------------------------------- dynamics

def openings(core: DataFrame) -> DataFrame:
    """Establishments by month of start of activity, state and activity code."""
    return (
        core.where(F.col("data_inicio_atividade").isNotNull() & F.col("uf").isNotNull())
        .groupBy(month_start("data_inicio_atividade").alias("mes_referencia"),
                 "uf", "cod_cnae_principal")
        .agg(F.count(F.lit(1)).alias("qtd_aberturas"))
    )


def closings(core: DataFrame) -> DataFrame:
    """Closed / unfit / suspended establishments by month of status change."""
    status = F.col("cod_situacao_cadastral")
    return (
        core.where(status.isin(*CLOSING_STATUSES)
                   & F.col("data_situacao_cadastral").isNotNull()
                   & F.col("uf").isNotNull())
        .groupBy(month_start("data_situacao_cadastral").alias("mes_referencia"),
                 "uf", "cod_cnae_principal")
        .agg(F.count_if(status == STATUS_CLOSED).alias("qtd_baixadas"),
             F.count_if(status == STATUS_UNFIT).alias("qtd_inaptadas"),
             F.count_if(status == STATUS_SUSPENDED).alias("qtd_suspensas"))
    )


DYNAMICS_COUNTS = ["qtd_aberturas", "qtd_baixadas", "qtd_inaptadas", "qtd_suspensas"]
SIDE = "__side"


def dynamics_events(core: DataFrame, *carried: str) -> DataFrame:
    """Up to two events per establishment: an opening (``o``) in the month its activity
    started, a closing in the month its status ``st`` changed to closed/unfit/suspended."""
    status = F.col("cod_situacao_cadastral")
    opens = F.col("data_inicio_atividade").isNotNull()
    closes = status.isin(*CLOSING_STATUSES) & F.col("data_situacao_cadastral").isNotNull()
    events = F.array(
        F.when(opens, F.struct(F.lit(True).alias("o"),
                               month_start("data_inicio_atividade").alias("m"))),
        F.when(closes, F.struct(F.lit(False).alias("o"),
                                month_start("data_situacao_cadastral").alias("m"))),
    )
    return (
        core.where(F.col("uf").isNotNull() & (opens | closes))
        .select("uf", "cod_cnae_principal", status.alias("st"), *carried,
                F.explode(events).alias("e"))
        .where(F.col("e").isNotNull())
    )


def dynamics_keys() -> list:
    """Month, state and activity; an opening and a closing of a null activity stay apart,
    as they never match in a join on the activity."""
    side = F.when(F.col("cod_cnae_principal").isNull(), F.col("e.o")).alias(SIDE)
    return [F.col("e.m").alias("mes_referencia"), F.col("uf"), F.col("cod_cnae_principal"), side]


def _event_kinds() -> dict:
    closing = ~F.col("e.o")
    return {"qtd_aberturas": F.col("e.o"), "qtd_baixadas": closing & (F.col("st") == STATUS_CLOSED),
            "qtd_inaptadas": closing & (F.col("st") == STATUS_UNFIT), "qtd_suspensas": closing & (F.col("st") == STATUS_SUSPENDED)}


def monthly_dynamics(core: DataFrame, cnaes: DataFrame, null_safe: bool = False,
                     ordered: bool = True) -> DataFrame:
    """Openings and closings per (month, state, activity) in one scan, one shuffle.

    Each establishment emits up to two events (``dynamics_events``). One partial (map-side)
    aggregate counts both, which equals the full outer join of the two separate aggregates
    without performing it. With plain ``=`` in that join a null activity code never
    matches, so the opening and closing counts of a null code stay on two
    rows; ``null_safe=True`` merges them (one row per grain).
    """
    keys = dynamics_keys()[:3 if null_safe else 4]
    agg = dynamics_events(core).groupBy(*keys).agg(*[F.count_if(k).alias(c) for c, k in _event_kinds().items()])
    out = labelled_dynamics(agg, cnaes)
    return out.orderBy(*DYNAMICS_KEYS) if ordered else out


def labelled_dynamics(counts: DataFrame, cnaes: DataFrame) -> DataFrame:
    """The mart from its counts: net balance and activity label."""
    out = counts.select(
        *DYNAMICS_KEYS, *DYNAMICS_COUNTS,
        (F.col("qtd_aberturas") - F.col("qtd_baixadas")).alias("saldo_liquido"),
    )
    out = lookup(out, cnaes, "cod_cnae_principal", "descricao_cnae_principal")
    return out.where(F.col("mes_referencia").isNotNull())


def dynamics_delta(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """What the counts of ``after`` add to those of ``before``: groups whose counts change.

    Establishments lose the events they had and get those they have; what did not change
    cancels out in the map-side step, so only the groups of changed rows are left."""
    columns = ["uf", "cod_cnae_principal", "cod_situacao_cadastral", "data_inicio_atividade", "data_situacao_cadastral"]
    rows = after.select(*columns, F.lit(1).alias("sign"))
    if before is not None:
        rows = rows.unionByName(before.select(*columns, F.lit(-1).alias("sign")))
    signed = [F.sum(F.when(k, F.col("sign")).otherwise(0)).alias(c) for c, k in _event_kinds().items()]
    delta = dynamics_events(rows, "sign").groupBy(*dynamics_keys()).agg(*signed)
    return delta.where(" OR ".join(f"{c} <> 0" for c in DYNAMICS_COUNTS))


def apply_delta(state: DataFrame | None, delta: DataFrame) -> DataFrame:
    """Counts after ``delta``; groups at zero go."""
    both = delta if state is None else state.select(*delta.columns).unionByName(delta)
    keys = [*DYNAMICS_KEYS, SIDE]
    total = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in DYNAMICS_COUNTS])
    return total.where(" OR ".join(f"{c} <> 0" for c in DYNAMICS_COUNTS))


def monthly_dynamics_by_join(core: DataFrame, cnaes: DataFrame,
                             null_safe: bool = False) -> DataFrame:
    """The same from the two aggregates and a full outer join (kept for comparison)."""
    closed = closings(core).select(*[F.col(k).alias(f"closing_{k}") for k in DYNAMICS_KEYS],
                                   "qtd_baixadas", "qtd_inaptadas", "qtd_suspensas")
    same = F.lit(True)
    for k in DYNAMICS_KEYS:
        left, right = F.col(k), F.col(f"closing_{k}")
        same = same & (left.eqNullSafe(right) if null_safe else left == right)
    both = openings(core).join(closed, same, "full").na.fill(0)
    both = both.withColumns({k: F.coalesce(k, f"closing_{k}") for k in DYNAMICS_KEYS})
    both = both.withColumn("saldo_liquido", F.col("qtd_aberturas") - F.col("qtd_baixadas"))
    out = lookup(both, cnaes, "cod_cnae_principal", "descricao_cnae_principal")
    return out.where(F.col("mes_referencia").isNotNull()).select(*DYNAMICS_COLUMNS)


# ------------------------------------------------------ active establishments

# Output columns: fixed values.
ACTIVE_COLUMNS = [
    "cnpj", "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial",
    "razao_social", "nome_fantasia", "capital_social", "cod_porte_empresa",
    "descricao_porte_empresa", "ente_federativo_responsavel", "cod_natureza_juridica",
    "descricao_natureza_juridica", "cod_qualificacao_responsavel",
    "cod_situacao_cadastral", "data_situacao_cadastral", "cod_motivo_situacao_cadastral",
    "descricao_motivo_situacao_cadastral", "situacao_especial", "data_situacao_especial",
    "cod_cnae_principal", "descricao_cnae_principal", "cnae_fiscal_secundaria",
    "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep", "uf",
    "cod_municipio", "nome_municipio", "nome_cidade_exterior", "cod_pais", "nome_pais",
    "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax", "email",
    "data_inicio_atividade", "ano_abertura", "mes_abertura",
    "opcao_pelo_simples", "is_simples", "data_opcao_simples", "data_exclusao_simples",
    "opcao_pelo_mei", "is_mei", "data_opcao_mei", "data_exclusao_mei",
    "_competencia", "_data_extracao",
]

COMPANY_COLUMNS = ["cnpj_basico", "razao_social", "capital_social", "cod_porte_empresa",
                   "ente_federativo_responsavel", "cod_natureza_juridica",
                   "cod_qualificacao_responsavel"]
TAX_COLUMNS = ["cnpj_basico", "opcao_pelo_simples", "data_opcao_simples",
               "data_exclusao_simples", "opcao_pelo_mei", "data_opcao_mei",
               "data_exclusao_mei"]


def active_establishments(stg_est: DataFrame, companies: DataFrame, tax: DataFrame,
                          municipios: DataFrame, cnaes: DataFrame, naturezas: DataFrame,
                          motivos: DataFrame, paises: DataFrame,
                          uf: str | None = None,
                          since: str | None = None,
                          hot_key_rows: int | None = None,
                          month_aware: bool = False,
                          bucketed: bool = False,
                          runtime_filter: bool = False) -> DataFrame:
    """Active establishments with company, tax regime and code labels.

    The status filter (and the optional state / watermark filters) runs first
    and reaches the Parquet scan. Companies and tax regime are joined one after
    the other on ``cnpj_basico``, so the establishments are shuffled once: three
    exchanges. When a filter leaves few establishments, both sides are first
    reduced to their companies. ``hot_key_rows`` salts companies with that many
    active establishments. ``month_aware=True`` matches companies, tax regime
    and labels of the establishment's own month, so loading several months never
    multiplies rows. ``bucketed=True`` says that the three large tables are bucketed on
    ``cnpj_basico`` (``sinks.buckets``): neither large join then has an exchange.
    ``runtime_filter=True`` leaves the reduction of companies and tax regime to Spark's
    Bloom filter (``session.runtime_filter_conf``), which tests their rows at the scan,
    before their one exchange, instead of joining them with the distinct companies first.
    """
    a = stg_est.where(F.col("cod_situacao_cadastral") == STATUS_ACTIVE)
    if uf is not None:
        a = a.where(F.col("uf") == uf)
    if since is not None:
        a = a.where(F.col("_competencia") > since)
    keys = ["cnpj_basico"]
    emp, smp = companies.select(*COMPANY_COLUMNS, "_competencia"), tax.select(*TAX_COLUMNS, "_competencia")
    if month_aware:
        keys.append("_competencia")
    else:
        emp, smp = emp.drop("_competencia"), smp.drop("_competencia")
    if (uf is not None or since is not None) and not (bucketed or runtime_filter):
        wanted = a.select("cnpj_basico").distinct()
        emp, smp = emp.join(wanted, "cnpj_basico", "left_semi"), smp.join(wanted, "cnpj_basico", "left_semi")
    hot = None
    if hot_key_rows:  # counted once, on the establishments alone; of a bucketed table without an exchange
        hot = hot_keys(a, keys[:1] if bucketed else keys, hot_key_rows).checkpoint()
        hot = None if hot.isEmpty() else hot
    out = a
    for side in (emp, smp):
        if bucketed:
            out = bucketed_join(out, side, "cnpj_basico", "_competencia" if month_aware else None, hot)
        elif hot is not None:
            out = split_hot_join(out, side, keys, "left", hot=hot)
        else:
            out = out.join(side, keys, "left")
    period = "_competencia" if month_aware else None
    out = lookup(out, municipios, "cod_municipio", "nome_municipio", period=period)
    out = lookup(out, cnaes, "cod_cnae_principal", "descricao_cnae_principal", period=period)
    out = lookup(out, naturezas, "cod_natureza_juridica", "descricao_natureza_juridica", period=period)
    out = lookup(out, motivos, "cod_motivo_situacao_cadastral",
                 "descricao_motivo_situacao_cadastral", period=period)
    out = lookup(out, paises, "cod_pais", "nome_pais", period=period)
    out = out.withColumns({
        "descricao_porte_empresa": decode("cod_porte_empresa", PORTE_LABELS),
        "ano_abertura": F.year("data_inicio_atividade"),
        "mes_abertura": F.month("data_inicio_atividade"),
        "is_simples": flag("opcao_pelo_simples"),
        "is_mei": flag("opcao_pelo_mei"),
    })
    return out.select(*ACTIVE_COLUMNS)
