import statistics

import pytest
from pyspark.sql import functions as F

from tidewright.functions import distributions, rates, text, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def ts(value):
    return F.lit(value).cast("timestamp")


@pytest.mark.parametrize(
    "later, earlier, days",
    [
        ("2024-03-01 23:00:00", "2024-02-01 00:00:00", 29),
        ("2024-03-02 00:00:00", "2024-02-01 00:00:00", 30),
        ("2024-03-01 00:01:00", "2024-02-29 23:59:00", 0),
        ("2024-02-29 23:59:00", "2024-03-01 00:01:00", 0),
        ("2024-02-01 00:00:00", "2024-02-03 12:00:00", -2),
        ("2024-02-01 00:00:00", None, None),
    ],
)
def test_whole_days_truncates_toward_zero(spark, later, earlier, days):
    assert one(spark, times.whole_days(ts(later), ts(earlier))) == days


@pytest.mark.parametrize(
    "days, label",
    [
        (29, "New Release (<30 Days)"),
        (30, "Recent (1-6 Months)"),
        (179, "Recent (1-6 Months)"),
        (180, "Catalog (6-24 Months)"),
        (719, "Catalog (6-24 Months)"),
        (720, "Legacy (2+ Years)"),
        (-5, "New Release (<30 Days)"),
        (None, "Legacy (2+ Years)"),
    ],
)
def test_age_cohort(spark, days, label):
    assert one(spark, times.age_cohort(F.lit(days).cast("int"))) == label


def test_fractional_days(spark):
    assert one(spark, times.fractional_days(ts("2024-01-02 12:00:00"), ts("2024-01-01 00:00:00"))) == 1.5


@pytest.mark.parametrize(
    "stamp, kwargs, kept",
    [
        ("2024-01-10T00:00:00", {"after": "2024-01-10T00:00:00Z"}, False),
        ("2024-01-10T00:00:01", {"after": "2024-01-10T00:00:00Z"}, True),
        ("2024-01-10T02:00:00+02:00", {"after": "2024-01-10T00:00:00Z"}, False),
        ("2024-01-07T00:00:00Z", {"max_days": 3, "as_of": "2024-01-10T00:00:00Z"}, True),
        ("2024-01-06T23:59:59Z", {"max_days": 3, "as_of": "2024-01-10T00:00:00Z"}, False),
        ("2024-01-01T00:00:00Z", {"after": "2023-12-31T00:00:00Z", "max_days": 1, "as_of": "2024-01-10T00:00:00Z"}, True),
        ("2024-01-10T00:00:00Z", {}, False),
        (None, {"max_days": 3, "as_of": "2024-01-10T00:00:00Z"}, False),
    ],
)
def test_keep_record(spark, stamp, kwargs, kept):
    kwargs = {k: F.lit(v) if k in ("after", "as_of") else v for k, v in kwargs.items()}
    assert one(spark, times.keep_record(F.lit(stamp), **kwargs)) is kept


def test_rates_guard_zero_and_keep_negatives(spark):
    lit = F.lit
    assert one(spark, rates.lifetime_rate(lit(3), lit(1), lit(0))) is None
    assert one(spark, rates.lifetime_rate(lit(3), lit(1), lit(8))) == 0.5
    assert one(spark, rates.lifetime_rate(lit(3), lit(None).cast("int"), lit(8))) is None
    assert one(spark, rates.marginal_rate(lit(5), lit(3), lit(1), lit(1), lit(10), lit(20))) == -0.2
    assert one(spark, rates.marginal_rate(lit(5), lit(6), lit(1), lit(1), lit(10), lit(10))) is None
    assert one(spark, rates.view_velocity(lit(10), lit(40), lit(0.0))) is None
    assert one(spark, rates.view_velocity(lit(10), lit(40), lit(1.5))) == 20.0


def test_float_ratio_modes(spark):
    assert one(spark, rates.float_ratio(F.lit(1), F.lit(0))) is None
    with pytest.raises(Exception, match="division by zero"):
        one(spark, rates.float_ratio(F.lit(1), F.lit(0), on_zero="error"))
    single = one(spark, rates.float_ratio(F.lit(1), F.lit(3)))
    assert single != 1 / 3 and abs(single - 1 / 3) < 1e-7


def test_half_even(spark):
    assert [one(spark, rates.half_even(F.lit(v))) for v in (0.5, 1.5, 2.5, -0.5)] == [0, 2, 2, 0]


def test_argmax_takes_first_maximum(spark):
    assert one(spark, rates.argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0)))) == 1


def test_text_helpers(spark):
    assert one(spark, text.flatten_lines(F.lit("a\nb\n"))) == "a b "
    assert one(spark, text.flatten_lines(F.lit(None).cast("string"))) == ""
    assert one(spark, text.join_tags(F.lit(None).cast("array<string>"))) == ""
    assert one(spark, text.join_tags(F.array(F.lit("x"), F.lit("y")))) == "x,y"
    assert one(spark, text.strip_label_prefix(F.lit("__label__kor_Hang"))) == "kor_Hang"
    assert one(spark, text.upload_list_id(F.lit("UC123"), "Short")) == "UUSH123"
    assert one(spark, text.words(F.lit("Été, 락-2! "))) == ["été", "락", "2"]
    assert one(spark, text.words(F.lit(None).cast("string"))) == []
    assert one(spark, text.label_name(F.lit(3))) is None
    assert one(spark, text.label_code(F.lit("negative"))) == 0
    assert one(spark, text.label_code(F.lit("other"))) is None


def test_normal_distribution(spark):
    normal = statistics.NormalDist()
    for z in (-8.0, -2.5, -0.3, 0.0, 1.0, 4.0, 7.5):
        assert one(spark, distributions.normal_cdf(F.lit(z))) == pytest.approx(normal.cdf(z), abs=3e-12)
    for p in (1e-9, 0.02, 0.3, 0.5, 0.9, 1 - 1e-6):
        assert one(spark, distributions.normal_quantile(F.lit(p))) == pytest.approx(normal.inv_cdf(p), abs=1e-12)


def test_tails_match_closed_forms():
    from math import erfc, exp, sqrt

    for x in (0.1, 2.0, 9.0, 40.0):
        assert distributions.chi2_tail(x, 2) == pytest.approx(exp(-x / 2), rel=1e-12)
        assert distributions.chi2_tail(x, 1) == pytest.approx(erfc(sqrt(x / 2)), rel=1e-12)
        assert distributions.f_tail(x, 2, 10) == pytest.approx((1 + x / 5) ** -5, rel=1e-12)
