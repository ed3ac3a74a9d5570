import pytest

from tidemark.operators import quality
from tidemark.operators.quality import Checks
from tidemark.plans import checks
from tests.conftest import rows


def frame(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0), (1, "a", -1.0), (None, "b", None), (None, "b", 2.0), (3, None, 7.0), (4, "zz", 9.0)],
        "k int, s string, v double",
    )


RULES = Checks(
    not_null=("k", "v"), not_null_warn=("s",), accepted={"s": ("a", "b")}, holds={"{c} > 0": ("v",)},
    holds_warn={"{c} < 9": ("v",)}, row_holds=("k < v",), unique=("k",), unique_keys=(("k", "s"), ("v",)),
)


def test_each_check(spark):
    got = {(r.check_name, r.target, r.severity): r.failures for r in quality.run_checks(frame(spark), "t", RULES).collect()}
    assert got == {
        ("not_null", "k", "error"): 2, ("not_null", "v", "error"): 1, ("not_null", "s", "warn"): 1,
        ("accepted_values", "s", "error"): 1,  # the null passes
        ("expression", "v > 0", "error"): 1, ("expression", "v < 9", "warn"): 1, ("expression", "k < v", "error"): 1,
        ("unique", "k", "error"): 1,  # nulls are left out
        ("unique_keys", "k, s", "error"): 2,  # nulls group together
        ("unique_keys", "v", "error"): 0,
    }
    assert len(RULES) == 10


def test_one_pass_equals_check_by_check(spark):
    df = frame(spark)
    for check, target, severity, condition in RULES.row_rules():
        alone = df.filter(condition).count()
        report = quality.run_checks(df, "t", RULES).filter(f"check_name = '{check}' and target = '{target}'")
        assert [r.failures for r in report.collect()] == [alone], (target, severity)


def test_gate(spark):
    good = frame(spark).filter("s = 'a' and v > 0")
    assert quality.gate(quality.run_checks(good, "t", RULES)) == []
    with pytest.raises(quality.QualityError, match="not_null k: 2"):
        quality.gate(quality.run_checks(frame(spark), "t", RULES))
    warned = quality.run_checks(frame(spark), "t", Checks(not_null_warn=("s",)))
    assert quality.gate(warned) == ["t: not_null s: 1"]


def test_singular_check(spark):
    schedule = spark.createDataFrame([(0, 7), (7, 7), (9, 8)], "start_hour int, end_hour int")
    report = quality.singular_check(schedule.filter("start_hour >= end_hour"), "schedule", "hour range")
    assert rows(report) == [("schedule", "singular", "hour range", "error", 2)]


def test_duplicate_keys(spark):
    assert rows(quality.duplicate_keys(frame(spark), ["s"])) == [("a", 2), ("b", 2)]


def test_declared_checks_are_complete():
    sizes = {table: len(declared) for table, declared in checks.ALL.items()}
    assert sizes == {
        "stg_compute_offers": 61, "stg_electricity_tariff_tiers": 8, "stg_electricity_tariff_schedule": 13,
        "stg_exchange_rates": 10, "int_compute_offers": 66, "int_electricity_tariff_tiers": 11,
        "int_electricity_tariff_schedule": 10, "int_exchange_rates": 13, "dim_electricity_tariff_tiers": 13,
        "dim_electricity_tariff_schedule": 12, "dim_exchange_rates": 15, "fct_compute_offers": 77,
        "mart_arbitrage_opportunities": 12, "mart_best_offers_by_gpu": 6, "mart_profitability_trends": 12,
        "mart_gpu_model_summary": 16,
    }
    severities = [rule[2] for c in checks.ALL.values() for rule in c.row_rules()]
    keys = sum(len(c.key_rules()) for c in checks.ALL.values())
    assert (severities.count("error") + keys, severities.count("warn")) == (267, 88)
