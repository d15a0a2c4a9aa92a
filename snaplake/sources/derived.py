"""Raw registry extracts derived from the driver's test tables.

The reference ships no data, so the raw (bronze-shaped) tables are derived
from ``orders``, ``customer``, ``nation`` and ``region`` by one SQL text per
table. The same text runs in Spark and in DuckDB (the oracle), with a few
dialect placeholders, so both engines see identical raw rows. The derivation
plants the awkward cases the cleaning rules exist for: padded and blank
keys, ``00000000`` and impossible dates, decimal commas, unknown codes, two
months and colliding partner keys. Every row count grows with the scale
factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snaplake.session import session_key

from snaplake.schemas import STATES, columns_of

BASE_TABLES = ["orders", "customer", "nation", "region"]

_DIALECT = {
    "spark": {
        "S": "string",
        "FMT1": "date_format(o_orderdate,'yyyyMMdd')",
        "FMT2": "date_format(date_add(cast(o_orderdate as date),40),'yyyyMMdd')",
    },
    "duckdb": {
        "S": "varchar",
        "FMT1": "strftime(o_orderdate,'%Y%m%d')",
        "FMT2": "strftime(cast(o_orderdate as date)+40,'%Y%m%d')",
    },
}


def _uf_case(shift: int = 0) -> str:
    arms = " ".join(f"when {i} then '{STATES[(i + shift) % 25]}'" for i in range(25))
    return f"case c_nationkey {arms} end"


def _next_snapshot(template: str) -> str:
    """The following month's full snapshot: same establishments, a third of
    them change status (active <-> closed) and a quarter move state."""
    t = template.replace(
        "case when o_orderstatus='O' then '02'",
        "case when o_orderkey%3=0 and o_orderstatus='O' then '08'"
        " when o_orderkey%3=0 then '02' when o_orderstatus='O' then '02'")
    t = t.replace("{UF} uf", "case when o_orderkey%4=0 then {UF2} else {UF} end uf")
    t = t.replace("case when o_orderkey%2=0 then '2026-01' else '2026-02' end _competencia",
                  "'2026-03' _competencia")
    t = t.replace("'2026-02-20' _data_extracao", "'2026-03-20' _data_extracao")
    return t


_TEMPLATES = {
    "estabelecimentos": """
select case when o_orderkey%5=0 then ' '||lpad(cast(o_custkey as {S}),8,'0')||' '
            when o_orderkey%101=0 then '  '
            else lpad(cast(o_custkey as {S}),8,'0') end cnpj_basico,
 lpad(cast(cast(floor(o_orderkey/100) as int) as {S}),4,'0') cnpj_ordem,
 lpad(cast(o_orderkey%100 as {S}),2,'0') cnpj_dv,
 case when o_orderkey%3=0 then '1' else '2' end identificador_matriz_filial,
 case when o_orderkey%7=0 then '' else 'LOJA '||cast(o_orderkey as {S}) end nome_fantasia,
 case when o_orderstatus='O' then '02' when o_orderstatus='F' then '08'
      when o_orderkey%2=0 then '03' else '04' end situacao_cadastral,
 {FMT2} data_situacao_cadastral,
 lpad(cast(o_orderkey%4 as {S}),2,'0') motivo_situacao_cadastral,
 '' nome_cidade_exterior,
 case when o_orderkey%50=0 then lpad(cast(c_nationkey as {S}),3,'0') else '' end pais,
 case when o_orderkey%17=0 then '00000000' when o_orderkey%19=0 then ''
      when o_orderkey%23=0 then '2024011' when o_orderkey%29=0 then '20231345'
      else {FMT1} end data_inicio_atividade,
 case when o_orderkey%13=0 then ' ' else lpad(cast(o_orderkey%6 as {S}),7,'0') end cnae_fiscal_principal,
 case when o_orderkey%4=0 then '0000001,0000002' else '' end cnae_fiscal_secundaria,
 'RUA' tipo_logradouro, ' '||o_orderpriority||' ' logradouro,
 cast(o_orderkey%1000 as {S}) numero, '' complemento, '' bairro,
 lpad(cast(o_custkey as {S}),8,'0') cep,
 {UF} uf, lpad(cast(c_nationkey as {S}),4,'0') municipio,
 '' ddd_1, '' telefone_1, '' ddd_2, '' telefone_2, '' ddd_fax, '' fax,
 case when o_orderkey%11=0 then 'loja'||cast(o_orderkey as {S})||'@example.com' else '' end email,
 case when o_orderkey%43=0 then 'ESPECIAL' else '' end situacao_especial,
 case when o_orderkey%43=0 then {FMT1} else '' end data_situacao_especial,
 case when o_orderkey%2=0 then '2026-01' else '2026-02' end _competencia,
 '2026-02-20' _data_extracao
from {orders} join {customer} on o_custkey=c_custkey""",
    "empresas": """
select lpad(cast(c_custkey as {S}),8,'0') cnpj_basico, c_name razao_social,
 lpad(cast(c_nationkey as {S}),4,'0') natureza_juridica,
 lpad(cast(c_custkey%9 as {S}),2,'0') qualificacao_responsavel,
 case when c_custkey%31=0 then '' else replace(cast(cast(c_acctbal as decimal(18,2)) as {S}),'.',',') end capital_social,
 case c_custkey%5 when 0 then '00' when 1 then '01' when 2 then '03' when 3 then '05' else '' end porte_empresa,
 '' ente_federativo_responsavel, '2026-01' _competencia, '2026-02-20' _data_extracao
from {customer}""",
    # Companies with c_custkey%3=0 get a blank key: staging drops them, so the
    # tax-regime join meets companies without a row here.
    "simples": """
select case when c_custkey%3=0 then '' else lpad(cast(c_custkey as {S}),8,'0') end cnpj_basico,
 case when c_custkey%2=0 then 'S' else 'N' end opcao_pelo_simples,
 '20200101' data_opcao_simples, '00000000' data_exclusao_simples,
 case when c_custkey%7=0 then 'S' when c_custkey%7=1 then '' else 'N' end opcao_pelo_mei,
 '' data_opcao_mei, '' data_exclusao_mei, '2026-01' _competencia, '2026-02-20' _data_extracao
from {customer}""",
    "socios": """
select lpad(cast(o_custkey as {S}),8,'0') cnpj_basico,
 cast(1+o_orderkey%3 as {S}) identificador_socio,
 'SOCIO '||cast(o_orderkey as {S}) nome_socio_razao_social,
 case when o_orderkey%37=0 then '' else lpad(cast(o_orderkey%50 as {S}),11,'0') end cnpj_cpf_socio,
 lpad(cast(o_orderkey%9 as {S}),2,'0') qualificacao_socio,
 {FMT1} data_entrada_sociedade,
 case when o_orderkey%3=2 then lpad(cast(o_orderkey%25 as {S}),3,'0') else '' end pais,
 '' representante_legal, '' nome_representante,
 lpad(cast(o_orderkey%11 as {S}),2,'0') qualificacao_representante_legal,
 cast(o_orderkey%10 as {S}) faixa_etaria,
 case when o_orderkey%2=0 then '2026-01' else '2026-02' end _competencia,
 '2026-02-20' _data_extracao
from {orders}""",
    "municipios": """
select lpad(cast(n_nationkey as {S}),4,'0') codigo, ' '||n_name descricao,
 '2026-01' _competencia, '2026-02-20' _data_extracao from {nation}""",
    "paises": """
select lpad(cast(n_nationkey as {S}),3,'0') codigo, n_name descricao,
 '2026-01' _competencia, '2026-02-20' _data_extracao from {nation}""",
    "naturezas": """
select lpad(cast(n_nationkey as {S}),4,'0') codigo, 'NATUREZA '||n_name descricao,
 '2026-01' _competencia, '2026-02-20' _data_extracao from {nation}""",
    "cnaes": """
select lpad(cast(r_regionkey as {S}),7,'0') codigo, 'ATIVIDADE '||r_name descricao,
 '2026-01' _competencia, '2026-02-20' _data_extracao from {region}""",
    "motivos": """
select lpad(cast(r_regionkey as {S}),2,'0') codigo, 'MOTIVO '||r_name descricao,
 '2026-01' _competencia, '2026-02-20' _data_extracao from {region}""",
    # Codes 09 and up get a blank code, so staging drops them and partners
    # with those qualification codes find no description.
    "qualificacoes": """
select case when n_nationkey<9 then lpad(cast(n_nationkey as {S}),2,'0') else '' end codigo,
 'QUALIFICACAO '||n_name descricao,
 '2026-01' _competencia, '2026-02-20' _data_extracao from {nation}""",
}


_TEMPLATES["estabelecimentos_next"] = _next_snapshot(_TEMPLATES["estabelecimentos"])

# Derived tables that are not raw extracts of their own, and their layout.
VARIANTS = {"estabelecimentos_next": "estabelecimentos"}

SNAPSHOT_MONTHS = ["2026-01", "2026-02", "2026-03"]
_PERIODS = ["case when o_orderkey%2=0 then '2026-01' else '2026-02' end _competencia", "'2026-01' _competencia"]

# What changes from one full snapshot to the next, per table: (text, new text).
_CHANGES = {
    "empresas": [("c_name razao_social", "c_name||' {N}' razao_social")],
    "simples": [("c_custkey%2=0 then 'S'", "(c_custkey+{I})%2=0 then 'S'")],
    "socios": [("'SOCIO '||cast", "case when o_orderkey%7=0 then 'SOCI{I} ' else 'SOCIO ' end||cast"),
               ("cast(o_orderkey%9 as {S}),2,'0') qualificacao_socio", "cast((o_orderkey+{I})%9 as {S}),2,'0') qualificacao_socio"),
               ("from {orders}", "from {orders} where (o_orderkey+{I})%11<>0")],
    "estabelecimentos": [
        ("case when o_orderstatus='O' then '02'",
         "case when (o_orderkey+{I})%3=0 and o_orderstatus='O' then '08' when (o_orderkey+{I})%3=0 then '02' when o_orderstatus='O' then '02'"),
        ("{UF} uf", "case when (o_orderkey+{I})%4=0 then {UF2} else {UF} end uf"),
        ("on o_custkey=c_custkey", "on o_custkey=c_custkey where (o_orderkey+{I})%13<>0")],
}
_LABELS = [("' '||n_name descricao", "' '||n_name||' {N}' descricao"), ("n_name descricao", "n_name||' {N}' descricao"),
           ("r_name descricao", "r_name||' {N}' descricao")]


def _snapshot(table: str, month: str, reissued: bool = False) -> str:
    """One month's full snapshot of ``table``: companies are renamed, options, states
    and statuses change, labels too, and some rows are absent in some months."""
    i = SNAPSHOT_MONTHS.index(month)
    text = _TEMPLATES[table]
    for old, new in _CHANGES.get(table, _LABELS[:1] if _LABELS[0][0] in _TEMPLATES[table] else _LABELS[1:]):
        text = text.replace(old, new.replace("{I}", str(i)).replace("{N}", f"M{i + 1}"))
    for period in _PERIODS:
        text = text.replace(period, f"'{month}' _competencia")
    return text.replace("'LOJA '||", "'LOJA NOVA '||") if reissued else text


for _table in list(_TEMPLATES):
    if _table in VARIANTS:
        continue
    _TEMPLATES[f"{_table}_full"] = "\nUNION ALL\n".join(_snapshot(_table, m) for m in SNAPSHOT_MONTHS)
    VARIANTS[f"{_table}_full"] = _table
_TEMPLATES["estabelecimentos_reissued"] = _snapshot("estabelecimentos", SNAPSHOT_MONTHS[-1], reissued=True)
VARIANTS["estabelecimentos_reissued"] = "estabelecimentos"


def raw_sql(table: str, dialect: str) -> str:
    """SQL text deriving raw ``table`` from the base tables.

    For ``duckdb`` the base tables are referenced by name; for ``spark`` they
    stay ``{orders}``-style placeholders for ``spark.sql(..., orders=df)``.
    """
    columns_of(VARIANTS.get(table, table))  # unknown table -> ValueError
    text = _TEMPLATES[table]
    subs = dict(_DIALECT[dialect], UF2=_uf_case(1), UF=_uf_case())
    for key, value in subs.items():
        text = text.replace("{" + key + "}", value)
    if dialect == "duckdb":
        for base in BASE_TABLES:
            text = text.replace("{" + base + "}", base)
    return text.strip()


_BASE_CACHE: dict[tuple, DataFrame] = {}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base test table; the lazy frame is reused within a session. Its files hold a row
    group each, so rows are spread over the cores before the extracts are made of them."""
    key = (*session_key(spark), sf_dir.rstrip("/"), name)
    if key not in _BASE_CACHE:
        _BASE_CACHE[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").repartition(
            spark.sparkContext.defaultParallelism)
    return _BASE_CACHE[key]


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Raw extract ``table`` (all strings + ``_competencia``, ``_data_extracao``)."""
    text = raw_sql(table, "spark")
    used = {t: base_table(spark, sf_dir, t) for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


# Landing file name of each raw row: the three large tables are sharded into
# ten zips by a number carried in the row, the others are single files.
_FILE_NAME = {
    "estabelecimentos": "'Estabelecimentos' || cast(cast(cnpj_dv as int) % 10 as {S}) || '.zip'",
    "empresas": "'Empresas' || cast(cast(cnpj_basico as int) % 10 as {S}) || '.zip'",
    "socios": "'Socios' || cast(cast(substr(nome_socio_razao_social, 7) as int) % 10 as {S}) || '.zip'",
}


def file_name_sql(table: str, dialect: str) -> str:
    """SQL expression naming the landing zip a raw row of ``table`` goes to."""
    text = _FILE_NAME.get(table, f"'{table.capitalize()}.zip'")
    return text.replace("{S}", _DIALECT[dialect]["S"])
