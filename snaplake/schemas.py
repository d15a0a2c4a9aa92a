"""Raw table layouts and code lists of the registry extracts.

The extracts are headerless, so the column order below *is* the schema.
Every raw column is a nullable string; types are assigned in silver.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the published layout of the extracts) --------
RAW_COLUMNS: dict[str, list[str]] = {
    "empresas": [
        "cnpj_basico", "razao_social", "natureza_juridica",
        "qualificacao_responsavel", "capital_social", "porte_empresa",
        "ente_federativo_responsavel",
    ],
    "estabelecimentos": [
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial",
        "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral",
        "motivo_situacao_cadastral", "nome_cidade_exterior", "pais",
        "data_inicio_atividade", "cnae_fiscal_principal", "cnae_fiscal_secundaria",
        "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep",
        "uf", "municipio", "ddd_1", "telefone_1", "ddd_2", "telefone_2",
        "ddd_fax", "fax", "email", "situacao_especial", "data_situacao_especial",
    ],
    "socios": [
        "cnpj_basico", "identificador_socio", "nome_socio_razao_social",
        "cnpj_cpf_socio", "qualificacao_socio", "data_entrada_sociedade", "pais",
        "representante_legal", "nome_representante",
        "qualificacao_representante_legal", "faixa_etaria",
    ],
    "simples": [
        "cnpj_basico", "opcao_pelo_simples", "data_opcao_simples",
        "data_exclusao_simples", "opcao_pelo_mei", "data_opcao_mei",
        "data_exclusao_mei",
    ],
    "cnaes": ["codigo", "descricao"],
    "motivos": ["codigo", "descricao"],
    "municipios": ["codigo", "descricao"],
    "naturezas": ["codigo", "descricao"],
    "paises": ["codigo", "descricao"],
    "qualificacoes": ["codigo", "descricao"],
}

# A landing file's name begins with its table's name.
FILE_PREFIXES: list[tuple[str, str]] = [(t, t) for t in RAW_COLUMNS]

# Company size code -> label (no entry -> null).
PORTE_LABELS: list[tuple[str, str]] = [
    ("00", "Não Informado"),
    ("01", "Micro Empresa"),
    ("03", "Empresa de Pequeno Porte"),
    ("05", "Demais"),
]

# Registration status codes.
STATUS_ACTIVE = "02"
STATUS_SUSPENDED = "03"
STATUS_UNFIT = "04"
STATUS_CLOSED = "08"

# The 27 federative units, in the order the batch-by-state run uses.
STATES: list[str] = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS",
    "MT", "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC",
    "SE", "SP", "TO",
]

# Bronze metadata.
SOURCE_TAG = "receita_federal_cnpj"
META_COLUMNS = ["_fonte", "_competencia", "_arquivo_origem", "_data_extracao"]
# ---------------------------------------------------------------------------

DOMAIN_TABLES = ["cnaes", "motivos", "municipios", "naturezas", "paises", "qualificacoes"]
FACT_TABLES = ["empresas", "estabelecimentos", "socios", "simples"]
ALL_TABLES = FACT_TABLES + DOMAIN_TABLES


def columns_of(table: str) -> list[str]:
    """Ordered raw columns of ``table``; unknown tables raise ``ValueError``."""
    try:
        return RAW_COLUMNS[table]
    except KeyError:
        raise ValueError(f"no schema defined for table {table!r}") from None


def raw_schema(table: str) -> T.StructType:
    """All-string, all-nullable schema of a raw extract."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns_of(table)])
