"""DuckDB SQL for the correctness check.

Each query registered in :mod:`snaplake.queries` has a SQL twin here, in a
formulation of its own: labels are scalar subqueries over one long table of
codes, dynamics are one union of events grouped once, and the latest rows of a
key are those whose month equals the key's largest.
"""

from __future__ import annotations

from snaplake.schemas import DOMAIN_TABLES, PORTE_LABELS
from snaplake.sources.derived import VARIANTS, raw_sql


def nn(c: str, alias: str | None = None) -> str:
    return f"NULLIF(TRIM({c}), '') AS {alias or c}"


def pdate_expr(c: str) -> str:
    t = f"TRIM({c})"
    return (f"CASE WHEN NULLIF({t}, '') IS NULL THEN NULL WHEN LENGTH({t}) <> 8 THEN NULL "
            f"WHEN {t} = '00000000' THEN NULL "
            f"ELSE CAST(try_strptime({t}, '%Y%m%d') AS DATE) END")


def pdate(c: str, alias: str | None = None) -> str:
    return f"{pdate_expr(c)} AS {alias or c}"


META = "_competencia, _data_extracao"


def _stg_body(table: str, src: str | None = None) -> str:
    src = src or f"raw_{table}"
    table = VARIANTS.get(table, table)
    if table in DOMAIN_TABLES:
        return (f"SELECT TRIM(codigo) AS codigo, TRIM(descricao) AS descricao, {META} "
                f"FROM {src} WHERE NULLIF(TRIM(codigo), '') IS NOT NULL")
    k = "WHERE NULLIF(TRIM(cnpj_basico), '') IS NOT NULL"
    if table == "empresas":
        cols = ["TRIM(cnpj_basico) AS cnpj_basico", nn("razao_social"),
                nn("natureza_juridica", "cod_natureza_juridica"),
                nn("qualificacao_responsavel", "cod_qualificacao_responsavel"),
                "TRY_CAST(REPLACE(NULLIF(TRIM(capital_social), ''), ',', '.') AS DOUBLE) AS capital_social",
                nn("porte_empresa", "cod_porte_empresa"), nn("ente_federativo_responsavel")]
    elif table == "estabelecimentos":
        cols = ["TRIM(cnpj_basico) AS cnpj_basico", "TRIM(cnpj_ordem) AS cnpj_ordem",
                "TRIM(cnpj_dv) AS cnpj_dv",
                "TRIM(cnpj_basico) || TRIM(cnpj_ordem) || TRIM(cnpj_dv) AS cnpj",
                nn("identificador_matriz_filial"), nn("nome_fantasia"),
                nn("situacao_cadastral", "cod_situacao_cadastral"),
                pdate("data_situacao_cadastral"),
                nn("motivo_situacao_cadastral", "cod_motivo_situacao_cadastral"),
                nn("nome_cidade_exterior"), nn("pais", "cod_pais"),
                pdate("data_inicio_atividade"),
                nn("cnae_fiscal_principal", "cod_cnae_principal"),
                nn("cnae_fiscal_secundaria"), nn("tipo_logradouro"), nn("logradouro"),
                nn("numero"), nn("complemento"), nn("bairro"), nn("cep"), nn("uf"),
                nn("municipio", "cod_municipio"), nn("ddd_1"), nn("telefone_1"), nn("ddd_2"),
                nn("telefone_2"), nn("ddd_fax"), nn("fax"), nn("email"),
                nn("situacao_especial"), pdate("data_situacao_especial")]
    elif table == "socios":
        cols = ["TRIM(cnpj_basico) AS cnpj_basico", nn("identificador_socio"),
                nn("nome_socio_razao_social"), nn("cnpj_cpf_socio"),
                nn("qualificacao_socio", "cod_qualificacao_socio"),
                pdate("data_entrada_sociedade"), nn("pais", "cod_pais"),
                nn("representante_legal", "cpf_representante_legal"),
                nn("nome_representante"),
                nn("qualificacao_representante_legal", "cod_qualificacao_representante"),
                nn("faixa_etaria", "cod_faixa_etaria")]
    elif table == "simples":
        cols = ["TRIM(cnpj_basico) AS cnpj_basico", nn("opcao_pelo_simples"),
                pdate("data_opcao_simples"), pdate("data_exclusao_simples"),
                nn("opcao_pelo_mei"), pdate("data_opcao_mei"), pdate("data_exclusao_mei")]
    else:
        raise ValueError(table)
    return f"SELECT {', '.join(cols)}, {META} FROM {src} {k}"


CORE_SQL = """SELECT cnpj, cnpj_basico, cnpj_ordem, cnpj_dv, identificador_matriz_filial,
 cod_situacao_cadastral, data_situacao_cadastral, cod_motivo_situacao_cadastral,
 situacao_especial, data_situacao_especial, cod_cnae_principal, cnae_fiscal_secundaria,
 tipo_logradouro, logradouro, numero, complemento, bairro, cep, uf, cod_municipio,
 nome_cidade_exterior, cod_pais, nome_fantasia, ddd_1, telefone_1, ddd_2, telefone_2,
 ddd_fax, fax, email, data_inicio_atividade, _competencia, _data_extracao
FROM stg_estabelecimentos"""


def ctes(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """A WITH clause defining raw_*, stg_* and int_* names plus their deps."""
    need: list[tuple[str, str]] = []
    seen: set[str] = set()

    def add(name: str, body: str):
        if name not in seen:
            seen.add(name)
            need.append((name, body))

    def want(name: str):
        if name.startswith("raw_"):
            add(name, raw_sql(name[4:], "duckdb"))
        elif name.startswith("stg_"):
            want("raw_" + name[4:])
            add(name, _stg_body(name[4:]))
        elif name == "int_estabelecimentos":
            want("stg_estabelecimentos")
            add(name, CORE_SQL)
        elif name in ("codes", "codes_full"):
            for t in CODE_TABLES:
                want(f"stg_{t}{name[5:]}")
            add("codes", codes_sql(name[5:]))
        else:
            raise ValueError(name)

    for n in names:
        want(n)
    for name, body in extra or []:
        add(name, body)
    return "WITH " + ",\n".join(f"{n} AS (\n{b}\n)" for n, b in need) + "\n"


CODE_TABLES = ["municipios", "cnaes", "naturezas", "motivos", "paises", "qualificacoes"]


def codes_sql(suffix: str = "", tables: list[str] = CODE_TABLES) -> str:
    """One long table of labels: (kind, codigo, descricao, _competencia)."""
    return " UNION ALL ".join(f"SELECT '{t}' AS kind, codigo, descricao, _competencia FROM stg_{t}{suffix}" for t in tables)


def _label(kind: str, code: str, month: str | None = None) -> str:
    when = f" AND w._competencia = {month}" if month else ""
    return f"(SELECT w.descricao FROM codes w WHERE w.kind = '{kind}' AND w.codigo = {code}{when})"


_COMPANY = ["razao_social", "capital_social", "cod_porte_empresa", "ente_federativo_responsavel",
            "cod_natureza_juridica", "cod_qualificacao_responsavel"]
_REGIME = ["opcao_pelo_simples", "data_opcao_simples", "data_exclusao_simples", "opcao_pelo_mei",
           "data_opcao_mei", "data_exclusao_mei"]


def active_sql(where_extra: str = "", src: str = "stg_estabelecimentos",
               month_aware: bool = False, suffix: str = "") -> str:
    """Active establishments; needs the CTE ``codes`` (``codes_sql``)."""
    month = "f._competencia" if month_aware else None
    own = {c: f"f.{c}" for c in ACTIVE_OWN}
    own |= {c: f"f.company.{c}" for c in _COMPANY} | {c: f"f.regime.{c}" for c in _REGIME}
    sizes = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in PORTE_LABELS)
    own["descricao_porte_empresa"] = f"CASE f.company.cod_porte_empresa {sizes} END"
    own["descricao_natureza_juridica"] = _label("naturezas", "f.company.cod_natureza_juridica", month)
    own["descricao_motivo_situacao_cadastral"] = _label("motivos", "f.cod_motivo_situacao_cadastral", month)
    own["descricao_cnae_principal"] = _label("cnaes", "f.cod_cnae_principal", month)
    own["nome_municipio"] = _label("municipios", "f.cod_municipio", month)
    own["nome_pais"] = _label("paises", "f.cod_pais", month)
    own["ano_abertura"] = "CAST(EXTRACT(year FROM f.data_inicio_atividade) AS INTEGER)"
    own["mes_abertura"] = "CAST(EXTRACT(month FROM f.data_inicio_atividade) AS INTEGER)"
    own["is_simples"] = "f.regime.opcao_pelo_simples IS NOT DISTINCT FROM 'S'"
    own["is_mei"] = "f.regime.opcao_pelo_mei IS NOT DISTINCT FROM 'S'"
    same = " AND x._competencia = z._competencia" if month_aware else ""

    def one(table: str, cols: list[str]) -> str:
        pack = ", ".join(f"{c} := x.{c}" for c in cols)
        return f"(SELECT struct_pack({pack}) FROM stg_{table}{suffix} x WHERE x.cnpj_basico = z.cnpj_basico{same})"

    return ("SELECT " + ", ".join(f"{text} AS {name}" for name, text in own.items())
            + f" FROM (SELECT z.*, {one('empresas', _COMPANY)} AS company, {one('simples', _REGIME)} AS regime"
            + f" FROM {src} z WHERE z.cod_situacao_cadastral = '02' {where_extra}) f")


ACTIVE_OWN = ["cnpj", "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia",
              "cod_situacao_cadastral", "data_situacao_cadastral", "cod_motivo_situacao_cadastral", "situacao_especial",
              "data_situacao_especial", "cod_cnae_principal", "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro",
              "numero", "complemento", "bairro", "cep", "uf", "cod_municipio", "nome_cidade_exterior", "cod_pais", "ddd_1",
              "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax", "email", "data_inicio_atividade", "_competencia",
              "_data_extracao"]

ACTIVE_DEPS = ["stg_estabelecimentos", "stg_empresas", "stg_simples", "codes"]

def _month_of(column: str) -> str:
    return f"make_date(year({column}), month({column}), 1)"


def _per_group(event_date: str, counts: dict[str, str], condition: str = "") -> str:
    """One row per group, each count a running total over the whole group."""
    group = f"PARTITION BY {_month_of(event_date)}, uf, cod_cnae_principal"
    totals = ", ".join(f"sum(({test})::INT) OVER ({group})::BIGINT AS {name}" for name, test in counts.items())
    return (f"SELECT DISTINCT {_month_of(event_date)} AS mes_referencia, uf, cod_cnae_principal, {totals} "
            f"FROM int_estabelecimentos WHERE NOT (uf IS NULL OR {event_date} IS NULL){condition}")


OPENINGS_SQL = _per_group("data_inicio_atividade", {"qtd_aberturas": "TRUE"})
CLOSINGS_SQL = _per_group("data_situacao_cadastral", {
    "qtd_suspensas": "cod_situacao_cadastral = '03'", "qtd_inaptadas": "cod_situacao_cadastral = '04'",
    "qtd_baixadas": "cod_situacao_cadastral = '08'"}, " AND list_contains(['03', '04', '08'], cod_situacao_cadastral)")


def dynamics_body(null_safe: bool = False, src: str = "int_estabelecimentos") -> str:
    """One row per event, grouped once. Events without an activity code stay apart
    by side unless ``null_safe``. Needs the CTE ``codes``."""
    side = "" if null_safe else ", CASE WHEN code IS NULL THEN what = 'opening' END"
    return f"""SELECT g.*, qtd_aberturas - qtd_baixadas AS saldo_liquido,
 {_label('cnaes', 'g.cod_cnae_principal')} AS descricao_cnae_principal
FROM (
 SELECT happened AS mes_referencia, uf, code AS cod_cnae_principal,
  COUNT(*) FILTER (WHERE what = 'opening') AS qtd_aberturas, COUNT(*) FILTER (WHERE what = '08') AS qtd_baixadas,
  COUNT(*) FILTER (WHERE what = '04') AS qtd_inaptadas, COUNT(*) FILTER (WHERE what = '03') AS qtd_suspensas
 FROM (
  SELECT CAST(DATE_TRUNC('month', data_inicio_atividade) AS DATE) AS happened, uf, cod_cnae_principal AS code,
   'opening' AS what FROM {src}
  UNION ALL
  SELECT CAST(DATE_TRUNC('month', data_situacao_cadastral) AS DATE), uf, cod_cnae_principal, cod_situacao_cadastral
  FROM {src} WHERE cod_situacao_cadastral IN ('03', '04', '08'))
 WHERE happened IS NOT NULL AND uf IS NOT NULL
 GROUP BY happened, uf, code{side}) g"""


def dynamics_sql(null_safe: bool) -> str:
    return ctes("int_estabelecimentos", "codes") + dynamics_body(null_safe)


PARTNER_OWN = ["cnpj_basico", "identificador_socio", "nome_socio_razao_social", "cnpj_cpf_socio", "cod_qualificacao_socio",
               "data_entrada_sociedade", "cod_pais", "cpf_representante_legal", "nome_representante",
               "cod_qualificacao_representante", "cod_faixa_etaria", "_competencia", "_data_extracao"]


def partners_sql(src: str = "stg_socios", month_aware: bool = False) -> str:
    """Partners with labels; needs the CTE ``codes``."""
    month = "v._competencia" if month_aware else None
    return (f"SELECT {', '.join(f'v.{c}' for c in PARTNER_OWN)}, {_label('paises', 'v.cod_pais', month)} AS nome_pais, "
            f"{_label('qualificacoes', 'v.cod_qualificacao_socio', month)} AS descricao_qualificacao_socio, "
            f"{_label('qualificacoes', 'v.cod_qualificacao_representante', month)} AS descricao_qualificacao_representante "
            f"FROM {src} v")


def identity_expr(keys: list[str], cols: list[str]) -> str:
    """Null for a whole key, else all that the row says."""
    rest = [c for c in cols if c not in (*keys, "_competencia", "_data_extracao")]
    said = " || '|' || ".join(f"COALESCE('=' || CAST({c} AS VARCHAR), '')" for c in rest)
    return f"CASE WHEN {' OR '.join(f'{k} IS NULL' for k in keys)} THEN {said} END"


def latest_sql(src: str, keys: list[str], cols: list[str]) -> str:
    """Distinct rows of each key's latest month."""
    by = ", ".join([*keys, identity_expr(keys, cols)])
    return (f"SELECT DISTINCT * EXCLUDE (newest) FROM (SELECT *, MAX(_competencia) OVER (PARTITION BY {by}) AS newest "
            f"FROM {src}) WHERE _competencia = newest")


def domain_union_sql() -> str:
    parts = [f"SELECT '{t}' AS tabela, codigo, descricao, {META} FROM stg_{t}" for t in DOMAIN_TABLES]
    return ctes(*[f"stg_{t}" for t in DOMAIN_TABLES]) + "\nUNION ALL\n".join(parts)


def dq_sql(model: str, src: str, rules) -> list[str]:
    """One SELECT per rule, same report columns as ``quality.check``."""
    out = []
    for r in rules:
        head = f"SELECT '{model}' AS model, '{r.label}' AS column_name, '{r.test}' AS test_name, "
        if r.test == "not_null":
            out.append(head + f"CAST(count(*) FILTER (WHERE {r.column} IS NULL) AS BIGINT) "
                       f"AS failures FROM {src}")
        elif r.test == "unique":
            cols = list(r.per) + r.columns
            present = " AND ".join(f"{c} IS NOT NULL" for c in r.columns)
            out.append(head + f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {', '.join(cols)} "
                       f"FROM {src} WHERE {present} GROUP BY {', '.join(cols)} HAVING count(*) > 1)")
        elif r.test == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in r.values)
            out.append(head + f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {r.column} AS v "
                       f"FROM {src} GROUP BY {r.column}) WHERE v NOT IN ({vals})")
    return out
