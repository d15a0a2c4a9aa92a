"""Declarative data checks, run as Spark aggregates.

A rule names a column (or columns) and a test. Like generic SQL data tests, the
``failures`` of a rule are the rows its failing-rows query would return:

* ``not_null``: rows where the column is null;
* ``unique``: distinct non-null values (or value combinations) seen more
  than once, optionally within a scope such as ``_competencia``;
* ``accepted_values``: distinct non-null values outside the list.

All rules of a model are answered by one scan and one shuffle (a
``GROUPING SETS`` aggregate, see ``check``). Nothing is collected: ``check``
returns a lazy report frame ``(model, column_name, test_name, failures)``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    column: str | tuple[str, ...]
    test: str
    values: tuple[str, ...] = ()
    per: tuple[str, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [self.column] if isinstance(self.column, str) else list(self.column)

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(*cols: str) -> list[Rule]:
    return [Rule(c, "not_null") for c in cols]


def unique(col: str | tuple[str, ...], per: Iterable[str] = ()) -> Rule:
    return Rule(col, "unique", per=tuple(per))


def accepted_values(col: str, values: Iterable[str]) -> Rule:
    return Rule(col, "accepted_values", values=tuple(values))


REPORT_COLUMNS = ["model", "column_name", "test_name", "failures"]


def _row(model: str, rule: Rule, failures) -> list:
    return [F.lit(model).alias("model"), F.lit(rule.label).alias("column_name"),
            F.lit(rule.test).alias("test_name"), failures.cast("long").alias("failures")]


def null_counts(df: DataFrame, model: str, rules: list[Rule]) -> DataFrame | None:
    """All not_null rules in one scan, unpivoted to one report row per rule."""
    if not rules:
        return None
    counts = df.agg(*[F.count_if(F.col(r.column).isNull()).alias(f"c{i}")
                      for i, r in enumerate(rules)])
    packed = F.array(*[F.struct(*_row(model, r, F.col(f"c{i}"))) for i, r in enumerate(rules)])
    return counts.select(F.inline(packed))



def check(df: DataFrame, model: str, rules: Iterable[Rule], by: str | None = None) -> DataFrame:
    """Report frame with one row per rule (lazy; ``failures == 0`` passes); with ``by``, one
    row per rule and value of that column (a state, say), which comes first.

    All rules of a model come from one scan: a ``GROUPING SETS`` aggregate
    with one set per ``unique`` / ``accepted_values`` rule plus the empty set
    (whose row carries the ``not_null`` counts). Its partial step runs
    map-side, so a hot value collapses before the shuffle; each rule's
    failures are then counted on the small grouped result.
    """
    rules = list(rules)
    for r in rules:
        if r.test not in ("not_null", "unique", "accepted_values"):
            raise ValueError(f"unknown test {r.test!r}")
    nulls = [r for r in rules if r.test == "not_null"]
    grouped = [r for r in rules if r.test != "not_null"]
    if not grouped and by is None:
        return null_counts(df, model, nulls)
    scope = () if by is None else (by,)
    sets, cols = [], list(scope)

    def key_of(r: Rule) -> tuple[str, ...]:
        return scope + tuple(c for c in (*r.per, *r.columns) if c not in scope)

    for r in grouped:
        key = key_of(r)
        if key not in sets:
            sets.append(key)
        cols += [c for c in key if c not in cols]
    if scope not in sets:
        sets.append(scope)
    aggs = [F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__gid")]
    aggs += [F.count_if(F.col(r.column).isNull()).alias(f"__null{i}") for i, r in enumerate(nulls)]
    g = df.groupingSets([[F.col(c) for c in k] for k in sets], *cols).agg(*aggs)

    def gid(key) -> int:
        # grouping_id: one bit per grouping column, set when it is absent.
        bits = 0
        for c in cols:
            bits = (bits << 1) | (0 if c in key else 1)
        return bits

    # One global aggregate over the (small) grouped result answers every
    # rule, so the scan and the grouping shuffle happen once.
    gid_col = F.col("__gid")
    counts, rows = [], []
    for i, r in enumerate(nulls):
        counts.append(F.coalesce(F.max(F.when(gid_col == gid(scope), F.col(f"__null{i}"))),
                                 F.lit(0)).alias(f"__f{len(rows)}"))
        rows.append(r)
    for r in grouped:
        key = key_of(r)
        cond = gid_col == gid(key)
        for c in r.columns:
            cond = cond & F.col(c).isNotNull()
        if r.test == "unique":
            cond = cond & (F.col("__n") > 1)
        else:
            cond = cond & ~F.col(r.column).isin(*r.values)
        counts.append(F.count_if(cond).alias(f"__f{len(rows)}"))
        rows.append(r)
    packed = F.array(*[F.struct(*_row(model, r, F.col(f"__f{i}"))) for i, r in enumerate(rows)])
    return g.groupBy(*scope).agg(*counts).select(*scope, F.inline(packed))


def check_all(models: dict[str, tuple[DataFrame, list[Rule]]]) -> DataFrame:
    """Reports of several models in one frame."""
    out = None
    for name, (df, rules) in models.items():
        rep = check(df, name, rules)
        out = rep if out is None else out.unionByName(rep)
    return out


# ------------------------------------------------- tests from kept summaries

MARK = -1  # rule of the row that says a partition has been summarised
SUMMARY_COLUMNS = ["rule", "key", "n"]


def _key(rule: Rule):
    """The values a rule groups by, as one text that no other values have."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in (*rule.per, *rule.columns)]), {"ignoreNullFields": "false"})


def summarise(df: DataFrame, rules: Iterable[Rule], by: list[str]) -> DataFrame:
    """(__part_<c> per partition column, rule, key, n): what each partition adds to each
    rule, in one scan: its nulls (``not_null``), its rows per key (``unique``), or the
    values outside the list (``accepted_values``). Summaries of partitions add up."""
    items = []
    for i, r in enumerate(rules):
        key = F.lit(None).cast("string")
        hit = F.lit(True)
        for c in r.columns:
            hit = hit & F.col(c).isNotNull()
        if r.test == "not_null":
            hit = F.col(r.column).isNull()
        else:
            key = _key(r)
            if r.test == "accepted_values":
                hit = hit & ~F.col(r.column).isin(*r.values)
        items.append(F.when(hit, F.struct(F.lit(i).alias("rule"), key.alias("key"))))
    parts = [F.col(c).cast("string").alias(f"__part_{c}") for c in by]
    rows = df.select(*parts, F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("x")).select("*", "x.*").drop("x")
    return rows.groupBy(*[f"__part_{c}" for c in by], "rule", "key").agg(F.count(F.lit(1)).alias("n"))


def merged(summaries: DataFrame, model: str, rules: Iterable[Rule]) -> DataFrame:
    """The report of ``check`` from the summaries of all partitions."""
    rules = list(rules)
    unique_rules = [i for i, r in enumerate(rules) if r.test == "unique"]
    per_key = summaries.where(F.col("rule") >= 0).groupBy("rule", "key").agg(F.sum("n").alias("n"))
    counts = []
    for i, r in enumerate(rules):
        own = F.col("rule") == i
        if r.test == "not_null":
            counts.append(F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias(f"c{i}"))
        else:
            counts.append(F.count_if(own & (F.col("n") > 1) if i in unique_rules else own).alias(f"c{i}"))
    packed = F.array(*[F.struct(*_row(model, r, F.col(f"c{i}"))) for i, r in enumerate(rules)])
    return per_key.agg(*counts).select(F.inline(packed))


def failed(report: DataFrame) -> DataFrame:
    return report.where(F.col("failures") > 0)


def with_status(report: DataFrame) -> DataFrame:
    """Add ``status``: ``PASS`` when a rule has no failing rows, else ``FAIL``."""
    return report.withColumn("status", F.when(F.col("failures") == 0, F.lit("PASS"))
                             .otherwise(F.lit("FAIL")))
