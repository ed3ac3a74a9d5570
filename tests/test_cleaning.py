import pytest
from pyspark.sql import types as T

from tidemark.operators import cleaning
from tests.conftest import day, rows


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "s string")


def test_strip_non_ascii(spark):
    out = cleaning.strip_non_ascii(texts(spark, "Intel® Pentium®", "Цена", None, "plain"))
    assert rows(out) == rows(texts(spark, "Intel Pentium", "", None, "plain"))


def test_trim_and_empty(spark):
    out = cleaning.trim_spaces(texts(spark, "   ", "\n a\t", None, " b "))
    assert rows(out) == rows(texts(spark, "", "\n a\t", None, "b"))
    assert rows(cleaning.empty_to_null(out)) == rows(texts(spark, None, "\n a\t", None, "b"))


def test_only_named_columns_change(spark):
    df = spark.createDataFrame([(" a ", " b ", 1)], "x string, y string, n int")
    assert cleaning.trim_spaces(df, ["x"]).first() == ("a", " b ", 1)
    assert cleaning.trim_spaces(df).first() == ("a", "b", 1)


@pytest.mark.parametrize(
    "before, after",
    [
        ("AMD EPYC 7742 64-Core Processor", "AMD EPYC 7742"), ("X 8-Cores Processor", "X"),
        ("A 8-Core Processor B", "A 8-Core Processor B"), (None, None),
    ],
)
def test_core_suffix(spark, before, after):
    assert cleaning.strip_core_suffix(texts(spark, before), "s").first().s == after


def test_decimal_comma(spark):
    df = cleaning.decimal_comma_to_point(texts(spark, "5,25", "1,234,5", "7"), "s")
    assert sorted(r.s for r in df.collect()) == ["1.234.5", "5.25", "7"]
    cast = cleaning.cast_to_schema(df, T.StructType([T.StructField("s", T.FloatType())]))
    assert rows(cast) == sorted([(5.25,), (None,), (7.0,)], key=repr)


def test_parse_date(spark):
    df = spark.createDataFrame([("01.02.2026",), ("2026/01/01",), (None,)], "valid_from string")
    assert rows(cleaning.parse_valid_from(df)) == sorted([(day("2026-02-01"),), (None,), (None,)], key=repr)
    with pytest.raises(Exception):
        cleaning.parse_date(df, "valid_from", "dd.MM.yyyy", strict=True).collect()


def test_drop_null(spark):
    assert cleaning.drop_null(texts(spark, "a", None), "s").count() == 1


def test_deduplicate_by_order(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, "c", 1), (2, "z", None), (None, "n", 1), (None, "m", 2)],
                               "k int, s string, v int")
    assert rows(cleaning.deduplicate(df, ["k"], ["s"])) == rows(
        spark.createDataFrame([(1, "a", 9), (2, "z", None), (None, "m", 2)], df.schema)
    )
    assert cleaning.deduplicate(df, ["k"]).count() == 3
    assert cleaning.deduplicate(df, ["k"], ["-v"]).filter("k = 1").first().s == "a"


def test_deduplicate_moves_one_row_per_key_and_task(spark):
    plan = cleaning.deduplicate(spark.range(10).selectExpr("id % 2 as k", "id as v"), ["k"], ["v"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_cast_to_schema(spark):
    df = spark.createDataFrame([("1", "x", "extra")], "a string, b string, e string")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType()), T.StructField("m", T.DateType())])
    assert cleaning.cast_to_schema(df, schema).columns == ["a", "b"]
    assert cleaning.cast_to_schema(df, schema).first() == (1, None)
    assert cleaning.cast_to_schema(df, schema, fill_missing=True).first() == (1, None, None)
    with pytest.raises(Exception):
        cleaning.cast_to_schema(df, schema, permissive=False).collect()


def test_steps_and_stamp(spark):
    steps = [cleaning.trim_spaces, cleaning.empty_to_null]
    out = cleaning.stamp_processed(cleaning.apply_steps(texts(spark, "  "), steps), "timestamp'2024-01-01 00:00:00'")
    assert out.columns == ["s", "processed_at"] and out.first().s is None
    assert cleaning.stamp_processed(texts(spark, "a")).first().processed_at is not None
