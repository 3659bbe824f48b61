"""Hand-computed checks of rounding, clipping, division, labels and business rules."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from venue_analytics.functions import numeric as n
from venue_analytics.functions import rules


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("x,digits,want", [(2.345, 2, 2.35), (0.125, 2, 0.13), (-2.5, 0, -3.0), (2.4, 0, 2.0), (0.0, 1, 0.0)])
def test_half_up(spark, x, digits, want):
    assert one(spark, n.half_up(F.lit(x), digits)) == want


@pytest.mark.parametrize("x,digits,want", [(0.125, 2, 0.12), (2.5, 0, 2.0), (3.5, 0, 4.0), (-0.375, 2, -0.38)])
def test_half_even(spark, x, digits, want):
    assert one(spark, n.half_even(F.lit(x), digits)) == want


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1,), (2,)], "x int")
    assert [r[0] for r in df.select(n.clip("x", 0, 1)).collect()] == [None, 0, 1]


def test_zero_denominator_is_null(spark):
    assert one(spark, n.safe_div(F.lit(1), F.lit(0))) is None


def test_exact_avg_of_nothing_is_null(spark):
    assert spark.range(0).agg(n.exact_avg("id")).first()[0] is None


def test_exact_avg_skips_nulls(spark):
    df = spark.createDataFrame([(Decimal("0.10"),), (None,), (Decimal("0.20"),)], "x decimal(6,2)")
    assert df.agg(n.exact_avg("x")).first()[0] == pytest.approx(0.15, abs=0)


def test_unit_amount_rounds_half_up(spark):
    big = lambda v: F.lit(v).cast("bigint")
    assert one(spark, n.unit_amount(big(1005), big(2))) == Decimal("5.03")
    assert one(spark, n.unit_amount(big(1), big(0))) is None


def test_month_name_is_padded(spark):
    assert one(spark, rules.month_name(F.lit(5))) == "May      "
    assert one(spark, rules.month_name(F.lit(9))) == "September"


@pytest.mark.parametrize("share,want", [(0.95, "Sellout"), (0.9499, "High"), (0.88, "High"), (0.8799, "Medium"), (0.75, "Medium"), (0.7499, "Low")])
def test_attendance_tier_edges(spark, share, want):
    assert one(spark, rules.attendance_tier(F.lit(share))) == want


@pytest.mark.parametrize("pct,want", [(97, 1.20), (96.99, 1.15), (88, 1.15), (75, 1.10), (74.9, 1.05)])
def test_scenario_buffer_edges(spark, pct, want):
    assert one(spark, rules.scenario_buffer(F.lit(pct))) == want


@pytest.mark.parametrize("pct,want", [(95, "Maximum Staffing"), (85, "High Staffing"), (70, "Medium Staffing"), (69.9, "Standard Staffing")])
def test_staffing_edges(spark, pct, want):
    assert one(spark, rules.staffing_level(F.lit(pct))) == want


@pytest.mark.parametrize("ratio,want", [(-0.11, "Underperforming"), (-0.10, "On Target"), (0.10, "On Target"), (0.11, "Overperforming"), (None, "On Target")])
def test_performance_flag(spark, ratio, want):
    assert one(spark, rules.performance_flag(F.lit(ratio).cast("double"))) == want


@pytest.mark.parametrize("value,want", [(1234567890, "$1.23B"), (345000000, "$345.0M"), (12300, "$12.3K"), (-2500, "$-2.5K"), (890, "$890")])
def test_compact_currency(spark, value, want):
    assert one(spark, rules.compact_currency(F.lit(value))) == want


def test_labels(spark):
    assert one(spark, rules.shorten(F.lit("Season Ticket Holder"), 16)) == "Season Ticket H…"
    assert one(spark, rules.shorten(F.lit("Short"), 16)) == "Short"
    assert one(spark, rules.pct_label(F.lit(12.34))) == "12.3%"
    assert one(spark, rules.dow_ordinal(F.lit("Sunday"))) == 6
    assert one(spark, rules.dow_ordinal(F.lit("Someday"))) == 3
    assert one(spark, rules.month_abbr(F.lit(7))) == "7"


def test_weather_precedence(spark):
    say = lambda t, p, s, v: one(spark, rules.weather_condition(F.lit(t), F.lit(p), F.lit(s), F.lit(v)))
    assert say(30, True, True, True) == "Severe Storm"
    assert say(30, True, True, False) == "Snow"
    assert say(49, True, False, False) == "Rain/Cold"
    assert say(50, True, False, False) == "Rain"
    assert say(86, False, False, False) == "Hot/Sunny"
    assert say(85, False, False, False) == "Clear"


def test_demand_share_bounds(spark):
    base = {k: F.lit(v) for k, v in dict(home_pop=1.0, away_pop=1.0, home_win_pct=1.0, away_win_pct=1.0, weekend=True, rivalry=True, tv=True,
                                         holiday=True, promo_lift=0.1, severe=False, snow=False, precip=False).items()}
    assert one(spark, rules.demand_share(base)) == 1.02
    storm = {**{k: F.lit(0.0) for k in ("home_pop", "away_pop", "home_win_pct", "away_win_pct", "promo_lift")},
             **{k: F.lit(False) for k in ("weekend", "rivalry", "tv", "holiday")}, "severe": F.lit(True), "snow": F.lit(True), "precip": F.lit(True)}
    assert one(spark, rules.demand_share(storm)) == pytest.approx(0.64)
