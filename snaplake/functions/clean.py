"""Cleaning expressions for raw string columns.

Each function takes a column (name or ``Column``) and returns a ``Column``;
none of them is a UDF, so whole-stage codegen covers them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: ColumnLike) -> Column:
    """Strip leading/trailing spaces (only spaces, like SQL ``TRIM``)."""
    return F.trim(_col(c))


def blank_to_null(c: ColumnLike) -> Column:
    """``NULLIF(TRIM(c), '')``: blank or all-space text becomes null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def nonblank(c: ColumnLike) -> Column:
    """Predicate: the column holds something besides spaces."""
    return blank_to_null(c).isNotNull()


def decimal_comma(c: ColumnLike) -> Column:
    """Decimal-comma text (``'1234,56'``) to double; malformed text -> null."""
    text = F.replace(blank_to_null(c), F.lit(","), F.lit("."))
    return text.try_cast("double")


def concat_key(*parts: ColumnLike) -> Column:
    """Trimmed parts concatenated; null when any part is null."""
    return F.concat(*[F.trim(_col(p)) for p in parts])


def parse_compact_date(c: ColumnLike) -> Column:
    """``YYYYMMDD`` text to date.

    Blank -> null, trimmed length other than 8 -> null, ``00000000`` -> null,
    impossible dates -> null (the reference would fail the whole run).
    """
    t = F.trim(_col(c))
    ok = (F.length(t) == 8) & (t != F.lit("00000000"))
    return F.when(ok, F.try_to_date(t, "yyyyMMdd"))


def decode(c: ColumnLike, mapping: Iterable[tuple[str, str]]) -> Column:
    """Simple CASE: code -> label, codes not listed (and null) -> null."""
    expr = None
    src = _col(c)
    for code, label in mapping:
        expr = F.when(src == code, F.lit(label)) if expr is None else expr.when(src == code, F.lit(label))
    return expr if expr is not None else F.lit(None).cast("string")


def flag(c: ColumnLike, yes: str = "S") -> Column:
    """``CASE WHEN c = yes THEN TRUE ELSE FALSE END`` (null -> false)."""
    return F.coalesce(_col(c) == F.lit(yes), F.lit(False))


def month_start(c: ColumnLike) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(c), "MM")
