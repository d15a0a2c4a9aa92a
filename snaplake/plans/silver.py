"""Silver: typed, cleaned staging tables and the intermediate models.

Staging keeps one row per raw row whose key is not blank. Text columns are
trimmed and blank becomes null; dates are parsed from ``YYYYMMDD``; the
decimal-comma capital becomes a double. Metadata ``_competencia`` and
``_data_extracao`` pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.functions import (
    blank_to_null,
    concat_key,
    decimal_comma,
    nonblank,
    parse_compact_date,
    trim_spaces,
)
from snaplake.operators.enrich import lookup

META = ["_competencia", "_data_extracao"]


def _meta() -> list:
    return [F.col(c) for c in META]


def stage_domain(raw: DataFrame) -> DataFrame:
    """Code table: ``codigo``, ``descricao`` trimmed (blank code dropped)."""
    return raw.where(nonblank("codigo")).select(
        trim_spaces("codigo").alias("codigo"),
        trim_spaces("descricao").alias("descricao"),
        *_meta(),
    )


def stage_companies(raw: DataFrame) -> DataFrame:
    return raw.where(nonblank("cnpj_basico")).select(
        trim_spaces("cnpj_basico").alias("cnpj_basico"),
        blank_to_null("razao_social").alias("razao_social"),
        blank_to_null("natureza_juridica").alias("cod_natureza_juridica"),
        blank_to_null("qualificacao_responsavel").alias("cod_qualificacao_responsavel"),
        decimal_comma("capital_social").alias("capital_social"),
        blank_to_null("porte_empresa").alias("cod_porte_empresa"),
        blank_to_null("ente_federativo_responsavel").alias("ente_federativo_responsavel"),
        *_meta(),
    )


def stage_establishments(raw: DataFrame) -> DataFrame:
    nn = blank_to_null
    return raw.where(nonblank("cnpj_basico")).select(
        trim_spaces("cnpj_basico").alias("cnpj_basico"),
        trim_spaces("cnpj_ordem").alias("cnpj_ordem"),
        trim_spaces("cnpj_dv").alias("cnpj_dv"),
        concat_key("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj"),
        nn("identificador_matriz_filial").alias("identificador_matriz_filial"),
        nn("nome_fantasia").alias("nome_fantasia"),
        nn("situacao_cadastral").alias("cod_situacao_cadastral"),
        parse_compact_date("data_situacao_cadastral").alias("data_situacao_cadastral"),
        nn("motivo_situacao_cadastral").alias("cod_motivo_situacao_cadastral"),
        nn("nome_cidade_exterior").alias("nome_cidade_exterior"),
        nn("pais").alias("cod_pais"),
        parse_compact_date("data_inicio_atividade").alias("data_inicio_atividade"),
        nn("cnae_fiscal_principal").alias("cod_cnae_principal"),
        nn("cnae_fiscal_secundaria").alias("cnae_fiscal_secundaria"),
        nn("tipo_logradouro").alias("tipo_logradouro"),
        nn("logradouro").alias("logradouro"),
        nn("numero").alias("numero"),
        nn("complemento").alias("complemento"),
        nn("bairro").alias("bairro"),
        nn("cep").alias("cep"),
        nn("uf").alias("uf"),
        nn("municipio").alias("cod_municipio"),
        nn("ddd_1").alias("ddd_1"),
        nn("telefone_1").alias("telefone_1"),
        nn("ddd_2").alias("ddd_2"),
        nn("telefone_2").alias("telefone_2"),
        nn("ddd_fax").alias("ddd_fax"),
        nn("fax").alias("fax"),
        nn("email").alias("email"),
        nn("situacao_especial").alias("situacao_especial"),
        parse_compact_date("data_situacao_especial").alias("data_situacao_especial"),
        *_meta(),
    )


def stage_partners(raw: DataFrame) -> DataFrame:
    nn = blank_to_null
    return raw.where(nonblank("cnpj_basico")).select(
        trim_spaces("cnpj_basico").alias("cnpj_basico"),
        nn("identificador_socio").alias("identificador_socio"),
        nn("nome_socio_razao_social").alias("nome_socio_razao_social"),
        nn("cnpj_cpf_socio").alias("cnpj_cpf_socio"),
        nn("qualificacao_socio").alias("cod_qualificacao_socio"),
        parse_compact_date("data_entrada_sociedade").alias("data_entrada_sociedade"),
        nn("pais").alias("cod_pais"),
        nn("representante_legal").alias("cpf_representante_legal"),
        nn("nome_representante").alias("nome_representante"),
        nn("qualificacao_representante_legal").alias("cod_qualificacao_representante"),
        nn("faixa_etaria").alias("cod_faixa_etaria"),
        *_meta(),
    )


def stage_tax_regime(raw: DataFrame) -> DataFrame:
    nn = blank_to_null
    return raw.where(nonblank("cnpj_basico")).select(
        trim_spaces("cnpj_basico").alias("cnpj_basico"),
        nn("opcao_pelo_simples").alias("opcao_pelo_simples"),
        parse_compact_date("data_opcao_simples").alias("data_opcao_simples"),
        parse_compact_date("data_exclusao_simples").alias("data_exclusao_simples"),
        nn("opcao_pelo_mei").alias("opcao_pelo_mei"),
        parse_compact_date("data_opcao_mei").alias("data_opcao_mei"),
        parse_compact_date("data_exclusao_mei").alias("data_exclusao_mei"),
        *_meta(),
    )


STAGERS = {
    "empresas": stage_companies,
    "estabelecimentos": stage_establishments,
    "socios": stage_partners,
    "simples": stage_tax_regime,
    "cnaes": stage_domain,
    "motivos": stage_domain,
    "municipios": stage_domain,
    "naturezas": stage_domain,
    "paises": stage_domain,
    "qualificacoes": stage_domain,
}


def stage(table: str, raw: DataFrame) -> DataFrame:
    return STAGERS[table](raw)


# The intermediate establishments model: a column subset, no joins (domain
# joins happen in gold after the business filter).
# Column names: fixed values.
CORE_COLUMNS = [
    "cnpj", "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial",
    "cod_situacao_cadastral", "data_situacao_cadastral", "cod_motivo_situacao_cadastral",
    "situacao_especial", "data_situacao_especial",
    "cod_cnae_principal", "cnae_fiscal_secundaria",
    "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep", "uf",
    "cod_municipio", "nome_cidade_exterior", "cod_pais",
    "nome_fantasia", "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax", "email",
    "data_inicio_atividade",
    "_competencia", "_data_extracao",
]


def establishments_core(stg_est: DataFrame) -> DataFrame:
    return stg_est.select(*CORE_COLUMNS)


# Column names: fixed values.
PARTNER_COLUMNS = [
    "cnpj_basico", "identificador_socio", "nome_socio_razao_social", "cnpj_cpf_socio",
    "cod_qualificacao_socio", "descricao_qualificacao_socio", "data_entrada_sociedade",
    "cod_pais", "nome_pais", "cpf_representante_legal", "nome_representante",
    "cod_qualificacao_representante", "descricao_qualificacao_representante",
    "cod_faixa_etaria", "_competencia", "_data_extracao",
]


def partners_enriched(stg_partners: DataFrame, paises: DataFrame,
                      qualificacoes: DataFrame, month_aware: bool = False) -> DataFrame:
    """Partners with country and both qualification roles resolved
    (``month_aware``: with the labels of the partner's own month).

    ``qualificacoes`` plays two roles (partner, legal representative): two
    lookups of the same broadcast code table under different names.
    """
    period = "_competencia" if month_aware else None
    out = lookup(stg_partners, paises, "cod_pais", "nome_pais", period=period)
    out = lookup(out, qualificacoes, "cod_qualificacao_socio", "descricao_qualificacao_socio", period=period)
    out = lookup(out, qualificacoes, "cod_qualificacao_representante",
                 "descricao_qualificacao_representante", period=period)
    return out.select(*PARTNER_COLUMNS)


# Raw columns each staging model parses, and how (for the loss report).
PARSED = {
    "estabelecimentos": [("data_situacao_cadastral", "date"), ("data_inicio_atividade", "date"),
                         ("data_situacao_especial", "date")],
    "simples": [("data_opcao_simples", "date"), ("data_exclusao_simples", "date"),
                ("data_opcao_mei", "date"), ("data_exclusao_mei", "date")],
    "socios": [("data_entrada_sociedade", "date")],
    "empresas": [("capital_social", "double")],
}


def parse_losses(raw: DataFrame, table: str) -> DataFrame:
    """Values staging turned to null although they were meant to parse.

    A date is lost when its trimmed text has 8 characters, is not
    ``00000000``, and still is no valid ``YYYYMMDD`` date; a number is lost
    when non-blank text does not read as a decimal. The reference would stop
    the whole run on the first one; here they become null and are counted.
    One scan per table: ``(tabela, column_name, n_values, n_lost)``.
    """
    from snaplake.functions import decimal_comma as dc

    kept = raw.where(nonblank("cnpj_basico"))
    aggs = []
    for col, kind in PARSED[table]:
        t = F.trim(F.col(col))
        if kind == "date":
            meant = (F.length(t) == 8) & (t != "00000000")
            lost = meant & parse_compact_date(col).isNull()
        else:
            meant = nonblank(col)
            lost = meant & dc(col).isNull()
        aggs += [F.count_if(meant).alias(f"n_{col}"), F.count_if(lost).alias(f"l_{col}")]
    counts = kept.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(table).alias("tabela"), F.lit(c).alias("column_name"),
                              F.col(f"n_{c}").alias("n_values"), F.col(f"l_{c}").alias("n_lost"))
                     for c, _ in PARSED[table]])
    return counts.select(F.inline(rows))
