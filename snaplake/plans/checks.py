"""The data tests declared for the registry models (40 rules)."""

from __future__ import annotations

from snaplake.operators.quality import Rule, accepted_values, not_null, unique
from snaplake.schemas import DOMAIN_TABLES, STATUS_ACTIVE


def domain_rules() -> list[Rule]:
    return [*not_null("codigo"), unique("codigo"), *not_null("descricao")]


RULES: dict[str, list[Rule]] = {
    **{f"stg_{t}": domain_rules() for t in DOMAIN_TABLES},
    "stg_empresas": not_null("cnpj_basico"),
    "stg_estabelecimentos": [*not_null("cnpj_basico", "cnpj"), unique("cnpj")],
    "stg_socios": not_null("cnpj_basico"),
    "stg_simples": [*not_null("cnpj_basico"), unique("cnpj_basico")],
    "int_estabelecimentos": [*not_null("cnpj", "cnpj_basico", "cod_situacao_cadastral",
                                       "_competencia"), unique("cnpj")],
    "int_socios": not_null("cnpj_basico", "_competencia"),
    "mrt_dinamica_mensal": not_null("mes_referencia", "uf"),
    "mrt_estabelecimentos_ativos": [
        unique("cnpj"), *not_null("cnpj", "cnpj_basico", "cod_situacao_cadastral"),
        accepted_values("cod_situacao_cadastral", [STATUS_ACTIVE]), *not_null("_competencia"),
    ],
}


def scoped(rules: list[Rule], per: list[str]) -> list[Rule]:
    """The same rules with every ``unique`` taken within ``per`` (e.g. per
    month), so a table holding several snapshots does not fail by design."""
    return [Rule(r.column, r.test, r.values, tuple(per)) if r.test == "unique" else r
            for r in rules]
