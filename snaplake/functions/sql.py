"""The cleaning expressions as SQL functions, for users who write SQL.

Each is a temporary SQL function (``CREATE TEMPORARY FUNCTION ... RETURN``): Catalyst
replaces a call by its body, so a query that uses them plans like one written with the
built-in functions: no Python, and filters on their arguments still reach the scan. The
bodies say the same as ``functions.clean``; ``decode`` takes its labels from there.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from snaplake.schemas import PORTE_LABELS


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def decode_body(labels: Iterable[tuple[str, str]], value: str = "code") -> str:
    """A simple CASE without ELSE: an unknown code has no label."""
    arms = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in labels)
    return f"CASE {value} {arms} END"


FUNCTIONS = {
    "blank_to_null(value STRING) RETURNS STRING": "nullif(trim(value), '')",
    "decimal_comma(value STRING) RETURNS DOUBLE": "try_cast(replace(nullif(trim(value), ''), ',', '.') AS DOUBLE)",
    "compact_date(value STRING) RETURNS DATE":
        "CASE WHEN length(trim(value)) = 8 AND trim(value) <> '00000000' THEN try_to_date(trim(value), 'yyyyMMdd') END",
    "concat_key(a STRING, b STRING, c STRING) RETURNS STRING": "trim(a) || trim(b) || trim(c)",
    "is_yes(value STRING) RETURNS BOOLEAN": "coalesce(value = 'S', false)",
    "month_start(value DATE) RETURNS DATE": "CAST(date_trunc('month', value) AS DATE)",
    "company_size(code STRING) RETURNS STRING": decode_body(PORTE_LABELS),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session; returns their names."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in FUNCTIONS]
