"""URL filter by a sort-merge range join (DataFrame operations only).

A rule is a host and a path prefix; it fits its host and all subdomains when
the url's path starts with the rule's. Keys are ``reversed host, NUL, path`` as
bytes: a rule covers the interval from its key to its key followed by 0xFF
(a byte that UTF-8 never holds), and the intervals of one host are nested or
apart. Every url contributes one point per host suffix that could carry a rule.

1. Rules: a sweep over each host's interval ends keeps the stack of open rules
   as a running depth; the top of the stack after an event is the last rule
   opened at that depth. The result is a step function: from this key on, this
   rule is the innermost one.
2. Steps and points are sorted together by range partitioning (keys, then row
   ids, so one hot host spreads over many partitions) and each partition is
   swept once. What is open where a partition begins comes from the last step
   of the partitions before it: one row per partition.
3. Of the rules that a url's points met, the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaplake.llm.common import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """A-Z lower-cased text between the first ``://`` and the next ``/``, ``?``
    or ``#``; empty where there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("\0"), path).cast("binary")


def rule_steps(rules: DataFrame) -> DataFrame:
    """Step function (key, top) of the innermost rule over the key space.

    ``rules`` has ``action`` (allow or block) and ``rule`` (host and path, such
    as ``example.net/en/``). Rules without a host or a path never fit and are
    left out; of equal rules with different actions, block holds."""
    cut = F.instr("rule", "/")
    rules = (rules.where("rule IS NOT NULL AND action IN ('allow', 'block')").withColumn("cut", cut).where("cut > 1")
             .select(F.translate(F.expr("substring(rule, 1, cut - 1)"), UPPER, LOWER).alias("host"),
                     F.expr("substring(rule, cut)").alias("path"), "action")
             .groupBy("host", "path").agg(F.max("action").alias("action")))
    rules = rules.withColumn("key", _key(F.split("host", r"\."), F.col("path"))).withColumn(
        "rule", F.struct((F.length("host") + F.length("path")).alias("size"), F.concat("host", "path").alias("name"), "action"))
    ends = F.explode(F.array(F.struct("key", F.lit(1).alias("turn"), "rule"),
                             F.struct(F.concat("key", F.lit(bytearray(b"\xff"))).alias("key"), F.lit(-1).alias("turn"),
                                      F.lit(None).cast(rules.schema["rule"].dataType).alias("rule"))))
    depth = Window.partitionBy("host").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    stack = Window.partitionBy("host", "depth").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    return (rules.select("host", ends.alias("e")).select("host", "e.*")
            .withColumn("depth", F.sum("turn").over(depth))
            .withColumn("top", F.when(F.col("depth") > 0, F.last("rule", ignorenulls=True).over(stack)))
            .select("key", F.struct("top").alias("step")))


def url_verdicts(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow") -> DataFrame:
    """One row (id, host, path, rule, verdict) per row of ``urls``.

    Null urls and urls without ``://`` have an empty host and path and meet no
    rule; without a rule the verdict is ``default``. The longest rule wins.
    Repeated rows stay repeated, and null ids stay. Empty tables give empty
    results; other columns, whatever their names, are not read."""
    spark: SparkSession = urls.sparkSession
    steps = rule_steps(rules)
    most = rules.agg(F.max(F.size(F.split(F.substring_index("rule", "/", 1), r"\.")))).first()[0] or 0
    points = (urls.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
              .withColumn("labels", F.split("host", r"\."))
              .withColumn("tails", F.greatest(F.lit(1), F.least(F.size("labels"), F.lit(most))))
              .withColumn("tail", F.explode(F.expr("sequence(1, tails)")))
              .withColumn("key", _key(F.expr("slice(labels, -tail, tail)"), F.col("path")))
              .select("key", F.lit(None).cast(steps.schema["step"].dataType).alias("step"), F.lit(1).alias("kind"), "id", "host",
                      "path", "tails"))
    rows = points.unionByName(steps.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    rows = settle(rows.repartitionByRange("key", "kind", "id").withColumn("bucket", F.spark_partition_id()), "url-sorted")

    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = (rows.groupBy("bucket").agg(F.max(F.when(F.col("kind") == 0, F.struct("key", "step"))).alias("last"))
             .select("bucket", F.last("last", ignorenulls=True).over(ahead)["step"].alias("carry")))
    sweep = Window.partitionBy("bucket").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = (rows.withColumn("open", F.last("step", ignorenulls=True).over(sweep)).where("kind = 1")
           .join(F.broadcast(carry), "bucket")  # a row per partition
           .select("id", "host", "path", "tails", F.coalesce("open", "carry")["top"].alias("top")))
    best = met.groupBy("id", "host", "path", "tails").agg(F.max("top").alias("top"), F.count("*").alias("n"))
    return (best.withColumn("copy", F.explode(F.expr("sequence(1, int(n / tails))")))
            .select(F.col("id").alias(id_col), "host", "path", F.col("top.name").alias("rule"),
                    F.coalesce(F.col("top.action"), F.lit(default)).alias("verdict")))
