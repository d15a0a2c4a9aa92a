import datetime as dt

from pyspark.sql import functions as F

from snaplake.functions import (
    blank_to_null, concat_key, decimal_comma, decode, flag, month_start, nonblank,
    parse_compact_date, trim_spaces,
)
from snaplake.schemas import PORTE_LABELS


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_trim_and_blank(spark):
    rows = [(" a ",), ("   ",), ("",), (None,), ("\tx\t",)]
    assert one(spark, rows, "v string", trim_spaces("v")) == ["a", "", "", None, "\tx\t"]
    assert one(spark, rows, "v string", blank_to_null("v")) == ["a", None, None, None, "\tx\t"]
    assert one(spark, rows, "v string", nonblank("v")) == [True, False, False, False, True]


def test_decimal_comma(spark):
    rows = [("1234,56",), (" 10,5 ",), ("",), (None,), ("12a,3",), ("-3,25",)]
    assert one(spark, rows, "v string", decimal_comma("v")) == [1234.56, 10.5, None, None, None, -3.25]


def test_concat_key_null_propagates(spark):
    df = spark.createDataFrame([(" 1", "2 ", "3"), ("1", None, "3")], "a string, b string, c string")
    assert [r[0] for r in df.select(concat_key("a", "b", "c")).collect()] == ["123", None]


def test_parse_compact_date(spark):
    rows = [("20240105",), (" 20240105 ",), ("00000000",), ("2024011",), ("20231345",),
            ("20230229",), ("",), (None,), ("2023022a",)]
    got = one(spark, rows, "v string", parse_compact_date("v"))
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 5)] + [None] * 7


def test_decode_without_else(spark):
    rows = [("00",), ("01",), ("03",), ("05",), ("02",), (None,)]
    got = one(spark, rows, "v string", decode("v", PORTE_LABELS))
    assert got[:4] == [label for _, label in PORTE_LABELS]
    assert got[4:] == [None, None]


def test_flag_null_is_false(spark):
    rows = [("S",), ("N",), (None,), ("s",)]
    assert one(spark, rows, "v string", flag("v")) == [True, False, False, False]


def test_month_start(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (None,)], "d date")
    assert [r[0] for r in df.select(month_start("d")).collect()] == [dt.date(2024, 2, 1), None]
    assert dict(df.select(month_start("d").alias("m")).dtypes)["m"] == "date"


def test_no_python_udfs_in_staging_plan(spark):
    from snaplake.plans import silver
    from snaplake.sources.derived import raw_table
    plan = silver.stage_establishments(raw_table(spark, "/root/testdata/sf0.001", "estabelecimentos"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert F  # keep import
