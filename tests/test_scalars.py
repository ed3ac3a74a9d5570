import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark import fixed
from tidemark.functions import scalars as fn
from tidemark.functions.text import literal
from tests.conftest import rows


def value(spark, expression):
    return spark.range(1).selectExpr(f"{expression} as v").first().v


@pytest.mark.parametrize(
    "text, code",
    [("'Texas, US'", "US"), ("'US'", None), ("'Austin, Texas, US'", "Texas"), ("'X, '", None), ("cast(null as string)", None)],
)
def test_country_code(spark, text, code):
    assert value(spark, fn.country_code(text)) == code


@pytest.mark.parametrize(
    "word, kind", [("ВТ1", "high"), ("ВТ2", "high"), ("ВТ3", "high"), ("ВТ4", "high"), ("ВТ", "high"), ("НТ", "low"), ("x", None)]
)
def test_tariff_type(spark, word, kind):
    assert value(spark, fn.tariff_type(literal(f"мерење {word}"))) == kind


def test_tariff_code(spark):
    for text, code in fixed.TARIFF_CODES.items():
        assert value(spark, fn.tariff_code(literal(text))) == code
    assert value(spark, fn.tariff_code("'other'")) == "unknown_tariff"
    assert value(spark, fn.tariff_code("cast(null as string)")) == "unknown_tariff"


@pytest.mark.parametrize(
    "mb, size", [(2048, 2048), (2560, 2048), (2561, 3072), (0, 2048), (10 ** 6, 184320), (11776, 11264), (None, None)]
)
def test_nearest_size(spark, mb, size):
    assert value(spark, fn.nearest_size(f"cast({literal(mb)} as double)")) == size


def test_nearest_size_equals_a_search(spark):
    found = rows(spark.range(0, 200000, 37).selectExpr("id", f"{fn.nearest_size('id')} as size"))
    assert all(size == min(fixed.GPU_MEMORY_SIZES_MB, key=lambda t: (abs(t - mb), t)) for mb, size in found)


def test_division(spark):
    assert value(spark, fn.safe_ratio("1.0D", "0.0D")) is None
    assert value(spark, fn.inverse("0.0D")) is None
    assert value(spark, fn.inverse("4.0D")) == 0.25
    assert value(spark, fn.safe_ratio("1.0D + 2.0D", "2.0D")) == 1.5
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        value(spark, "1.0D / 0.0D")


def test_whole_numbers_round_half_away_from_zero(spark):
    assert [value(spark, fn.to_whole(f"{v}D")) for v in (2.5, -2.5, 3.5, 2.4)] == [3, -3, 4, 2]


def test_memory_units_are_doubles(spark):
    df = spark.sql("select 1536L as mb").selectExpr(f"{fn.mb_to_gb('mb')} as gb")
    assert df.schema["gb"].dataType.simpleString() == "double" and df.first().gb == 1.5


def test_surrogate_key_marks_nulls(spark):
    null, empty = (value(spark, fn.surrogate_key("1", text)) for text in ("cast(null as string)", "''"))
    assert null != empty
    import hashlib

    assert value(spark, fn.surrogate_key("1", "'a'")) == hashlib.md5(b"1-a").hexdigest()
    assert null == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()


def test_weekday_and_hours(spark):
    assert value(spark, fn.iso_weekday("date'2024-01-07'")) == 7
    assert value(spark, fn.iso_weekday("date'2024-01-08'")) == 1
    assert value(spark, fn.hour_of_day("timestamp'2024-01-08 05:59:00'")) == 5
    assert str(value(spark, fn.hour_bucket("timestamp'2024-01-08 05:59:00'"))) == "2024-01-08 05:00:00"


def test_flags(spark):
    assert value(spark, fn.is_open("timestamp'9999-12-31 00:00:00'"))
    assert not value(spark, fn.is_open("timestamp'2024-01-01 00:00:00'"))
    assert [value(spark, fn.positive(v)) for v in ("1", "0", "-1", "cast(null as int)")] == [True, False, False, False]


def test_percent_true_of_nulls_is_zero(spark):
    df = spark.sql("select cast(null as double) as p union all select null")
    assert df.selectExpr(f"{fn.percent_true('p > 0')} as v").first().v == 0.0


def test_blank_and_timestamp(spark):
    assert value(spark, fn.blank_to_null("'  '")) is None
    assert str(value(spark, fn.utc_timestamp("'2026-01-02T03:04:05.123456Z'"))) == "2026-01-02 03:04:05.123456"


@settings(max_examples=25, deadline=None)
@given(st.text(max_size=20))
def test_literals_survive_quoting(spark, text):
    assert value(spark, literal(text)) == text
