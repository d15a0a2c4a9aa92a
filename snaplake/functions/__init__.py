"""Reusable column expressions (all JVM-side, codegen-friendly)."""

from snaplake.functions.clean import (  # noqa: F401
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
