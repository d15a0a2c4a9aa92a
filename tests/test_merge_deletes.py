"""Merges with deletes on disk: the keys to delete are made once, deleted rows leave the source."""

from pyspark.sql import functions as F

from snaplake.operators import incremental as inc
from snaplake.sinks import tables

SCHEMA = "k string, uf string, v int, _competencia string"


def rows_of(df):
    return sorted((tuple(r) for r in df.select("k", "uf", "v", "_competencia").collect()), key=str)


def test_keys_to_delete_are_made_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda k: (seen.add(1), k)[1]).asNondeterministic()
    target = spark.createDataFrame([("a", "SP", 1, "2026-01"), ("b", "SP", 2, "2026-01"), ("c", "RJ", 3, "2026-01")], SCHEMA)
    source = spark.createDataFrame([("a", "RJ", 4, "2026-02"), ("d", "SP", 5, "2026-02")], SCHEMA)
    gone = spark.createDataFrame([("b",), ("d",), ("x",), ("b",)], "k string").select(count("k").alias("k"))
    root = f"{scratch}/t"
    tables.write_version(target, root, ["uf"])
    out = tables.merge_into(spark, root, source, ["k"], ["uf"], deletes=gone)
    assert rows_of(out) == [("a", "RJ", 4, "2026-02"), ("c", "RJ", 3, "2026-01")]
    assert seen.value == 4  # they were made for the folders, for the source and for the rows kept


def test_merge_on_disk_equals_upsert(spark, scratch):
    """Repeats, older rows, missing and moved keys: what ``upsert`` says of the whole table."""
    target = spark.createDataFrame(
        [("a", "SP", 1, "2026-01"), ("a", "SP", 1, "2026-01"), ("b", "RJ", 2, "2026-01"), (None, "SP", 3, "2026-01"), (None, "RJ", 4, "2026-01"),
         ("e", None, 5, "2026-01"), ("f", "MG", 6, "2026-01"), ("", "SP", 9, "2026-01")], SCHEMA)
    source = spark.createDataFrame(
        [("a", "RJ", 1, "2026-02"), ("a", "RJ", 1, "2026-02"), ("a", "MG", 7, "2026-01"), (None, "SP", 3, "2026-02"), (None, "SP", 8, "2026-02"),
         ("g", "SP", 1, "2026-02"), ("g", "SP", 2, "2026-02"), ("b", "RJ", 9, "2026-02"), ("0", "SP", 1, "2026-02")], SCHEMA)
    gone = spark.createDataFrame([("b",), ("f",), (None,), ("f",), ("",)], "k string")
    for i, null_safe in enumerate((True, False)):
        for j, deletes in enumerate((gone, None)):
            root = f"{scratch}/t{i}{j}"
            tables.write_version(target, root, ["uf"])
            out = tables.merge_into(spark, root, source, ["k"], ["uf"], deletes=deletes, null_safe=null_safe)
            assert rows_of(out) == rows_of(inc.upsert(target, source, ["k"], deletes=deletes, null_safe=null_safe))


def test_rows_to_keep_have_no_digest(spark, scratch):
    """Whole keys are compared as they are; only rows without one say all they say."""
    root = f"{scratch}/t"
    tables.write_version(spark.createDataFrame([("a", "SP", 1, "2026-01"), (None, "SP", 2, "2026-01")], SCHEMA), root, ["uf"])
    source = spark.createDataFrame([("a", "SP", 2, "2026-02")], SCHEMA)
    plan = inc.unmatched(tables.read_table(spark, root), source, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    whole, _, odd = plan.partition("Join LeftAnti")[2].partition("Join LeftAnti")
    assert plan.count("Join LeftAnti") == 2 and "sha2(" not in whole and "sha2(" in odd
