"""Monthly full snapshots: keep the latest one.

Extracts are full snapshots tagged by a period column (``YYYY-MM``). Joining
tables that hold several months on their key alone multiplies rows by the
number of months; filtering each table to its latest period first restores
one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_period(df: DataFrame, period: str = "_competencia") -> str | None:
    """Largest period present (one tiny aggregate job; None when empty)."""
    row = df.agg(F.max(period).alias("p")).first()
    return row["p"] if row else None


def latest_snapshot(df: DataFrame, period: str = "_competencia",
                    by: list[str] | None = None, latest: str | None = None) -> DataFrame:
    """Rows of the latest period, over the whole table or per ``by`` scope.

    Without ``by`` the maximum is a scalar subquery, so the plan stays lazy
    and, on a table partitioned by ``period``, the filter prunes partitions.
    When the caller knows the latest period from table metadata (a manifest,
    a folder listing), ``latest=`` skips that subquery's scan entirely.
    With ``by`` (e.g. ``["uf"]``) the maximum is taken per scope with a
    partial aggregate and semi-joined back, broadcast when the estimated size is
    small (no window over a possibly hot scope).
    """
    if latest is not None:
        # Known from table metadata: a literal, so partition pruning is static.
        return df.where(F.col(period) == F.lit(latest))
    if not by:
        return df.where(F.col(period) == df.select(F.max(period)).scalar())
    from snaplake.operators.enrich import maybe_broadcast

    tag = "__latest_period"
    scopes = maybe_broadcast(df.groupBy(*by).agg(F.max(period).alias(tag)))
    cond = [df[c].eqNullSafe(scopes[c]) for c in by] + [df[period] == scopes[tag]]
    return df.join(scopes, cond, "left_semi")
