"""Dimension lookups and skew-aware joins.

A lookup is a left join against a code table. A code table is broadcast only when
the optimizer's size estimate, in bytes, is below a bound; otherwise the join is left
to adaptive execution, which may still broadcast it from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20
SALTS = 32


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's upper estimate of the size of ``df``; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def counted_bytes(df: DataFrame) -> int:
    """Rows of ``df``, counted, times the width that its schema allows for. For choosing a
    number of partitions: of a join the optimizer's estimate is the product of its sides."""
    return df.count() * int(df._jdf.schema().defaultSize())


def maybe_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its estimated size is small, else ``df``."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def lookup(df: DataFrame, dim: DataFrame, on: str | Column, as_: str,
           key: str = "codigo", value: str = "descricao", period: str | None = None,
           max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left-join ``dim[value]`` as column ``as_`` where ``df[on] = dim[key]``.

    Plain equality: a null code finds nothing. The same ``dim`` may be used
    several times under different ``as_`` names (role-playing dimension). With
    ``period``, the label is that of the row's own snapshot.
    """
    tag = f"__lk_{as_}"
    cols = [F.col(key).alias(tag), F.col(value).alias(as_)]
    if period:
        cols.append(F.col(period).alias(f"{tag}_period"))
    right = maybe_broadcast(dim.select(*cols), max_bytes)
    cond = (F.col(on) if isinstance(on, str) else on) == F.col(tag)
    if period:
        cond = cond & (F.col(period) == F.col(f"{tag}_period"))
    return df.join(right, cond, "left").drop(tag, f"{tag}_period")


def hot_keys(df: DataFrame, keys: list[str], min_rows: int) -> DataFrame:
    """Keys holding at least ``min_rows`` rows of ``df`` (partial aggregate)."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return (df.where(present).groupBy(*keys).count()
            .where(F.col("count") >= min_rows).select(*keys))


def split_hot_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
                   min_rows: int = 1_000_000, salts: int = SALTS, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join in which the hot keys of ``left`` are salted.

    Rows of keys with at least ``min_rows`` rows on the left get one of ``salts``
    salts, and the right side's rows of those keys are repeated for each, so that
    no task receives a whole hot key however many there are. ``how`` is ``left``
    or ``inner``: repeated right rows would come out of other joins. ``hot`` gives the hot
    keys where the caller has counted them (``hot_keys``).
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how={how!r}: only left and inner joins can be split")
    hot = (hot_keys(left, keys, min_rows) if hot is None else hot).withColumn("__hot", F.lit(True))
    a = left.join(hot, keys, "left").withColumn(
        "__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")).otherwise(0)).drop("__hot")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    b = right.join(hot, keys, "left").withColumn(
        "__salt", F.explode(F.when(F.col("__hot"), every).otherwise(F.array(F.lit(0))))).drop("__hot")
    return a.join(b, [*keys, "__salt"], how).drop("__salt")
