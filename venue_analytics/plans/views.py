"""The seven KPI views, and their registration under the names dashboards query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import avg_r, exact_avg, half_up, safe_div
from ..functions.rules import performance_flag
from ..operators.marts import full_revenue, hub, revenue_parts, variance_ratio
from ..operators.ranking import dense_rank_desc
from .attendance import MATCHUP
from .executive import _r, fanned
from .fans import total_spend


def game_day_revenue(t) -> DataFrame:
    """Full profit and loss per game."""
    return full_revenue(t, "attendance", "promotions").select(
        "game_id", "game_date", "season", "home_team_name", "away_team_name", "day_of_week", "month", "is_weekend",
        "rivalry_flag", "nationally_televised_flag", "actual_attendance", "arena_capacity", "capacity_pct",
        "attendance_tier", "promotion_type", "promotion_flag",
        _r("ticket_rev", 2).alias("net_ticket_revenue"), _r("con_rev", 2).alias("concession_revenue"),
        _r("merch_rev", 2).alias("merchandise_revenue"), _r("total_rev", 2).alias("total_game_day_revenue"),
        half_up(safe_div("total_rev", "actual_attendance"), 2).alias("revenue_per_attendee"),
    )


def attendance_performance(t) -> DataFrame:
    """Attendance against its baseline, with a performance flag."""
    ratio = variance_ratio()
    return hub(t, "attendance", "promotions", "weather").select(
        "game_id", "game_date", "season", "home_team_name", "away_team_name", "day_of_week", "month", "is_weekend",
        "rivalry_flag", "nationally_televised_flag", "home_team_win_pct_entering_game", "actual_attendance",
        "arena_capacity", "capacity_pct", "expected_attendance_baseline", "attendance_variance", "attendance_tier",
        half_up(ratio * 100, 2).alias("variance_pct"), performance_flag(ratio).alias("performance_flag"),
        "promotion_type", "weather_condition", "temperature_f", "snow_flag", "severe_weather_flag",
    )


def ticket_segment_performance(t) -> DataFrame:
    """Every ticket record with its game, price tier and revenue rank within the game."""
    details = hub(t, "attendance").select(*MATCHUP, "attendance_tier")
    ranked = dense_rank_desc(t.records("ticket_sales"), "game_id", "net_ticket_revenue", "segment_revenue_rank", details)
    out = ranked.join(t["ticket_segments"].select("segment_id", "price_tier"), "segment_id")
    return out.select(
        *MATCHUP, "attendance_tier", "segment_id", "segment_name", "price_tier", "tickets_available", "tickets_sold",
        "avg_ticket_price", "discount_pct", "gross_ticket_revenue", "net_ticket_revenue", "sell_through_rate",
        "segment_revenue_rank",
    )


def _promotion_effect(t, revenue: DataFrame) -> DataFrame:
    played = t["promotions"].join(t["attendance"].select("game_id", "capacity_pct"), "game_id")
    baseline = played.where(~F.col("promotion_flag")).agg(exact_avg("capacity_pct")).scalar()
    return played.join(revenue, "game_id").groupBy("promotion_type").agg(
        F.count("*").alias("games"),
        exact_avg("capacity_pct").alias("_cap"),
        avg_r("promotion_cost", 0).alias("avg_promo_cost"),
        avg_r("sponsor_value_estimate", 0).alias("avg_sponsor_value"),
        avg_r("game_rev", 0).alias("avg_game_revenue"),
    ).withColumn("_base", baseline).select(
        "promotion_type", "games", half_up("_cap", 2).alias("avg_capacity_pct"),
        half_up("_base", 2).alias("baseline_capacity_pct"),
        half_up(F.col("_cap") - F.col("_base"), 2).alias("estimated_att_lift_pct_pts"),
        "avg_promo_cost", "avg_sponsor_value", "avg_game_revenue",
    ).orderBy(F.desc("avg_capacity_pct"))


def promotion_effectiveness(t) -> DataFrame:
    """Fill and lift over unpromoted games; game revenue as the three-fact join repeats it."""
    rev = fanned(revenue_parts(t))
    return _promotion_effect(t, rev.select("game_id", (F.col("fan_ticket") + F.col("fan_con") + F.col("fan_merch")).alias("game_rev")))


def promotion_effectiveness_fixed(t) -> DataFrame:
    """The same with every revenue record counted once."""
    rev = revenue_parts(t)
    return _promotion_effect(t, rev.select("game_id", (F.col("ticket_rev") + F.col("con_rev") + F.col("merch_rev")).alias("game_rev")))


def concession_merchandise_demand(t) -> DataFrame:
    """Revenue per head and stock of both ancillary lines, per game."""
    out = hub(t, "attendance").join(t.mart("concessions_by_game"), "game_id").join(t.mart("merchandise_by_game"), "game_id")
    return out.select(
        *MATCHUP, "actual_attendance", "attendance_tier",
        _r("con_rev", 2).alias("total_concession_revenue"),
        half_up(safe_div("con_rev", "actual_attendance"), 2).alias("concession_per_cap"),
        F.col("con_inventory").alias("total_con_inventory_rec"),
        _r("merch_rev", 2).alias("total_merchandise_revenue"),
        half_up(safe_div("merch_rev", "actual_attendance"), 2).alias("merchandise_per_cap"),
        F.col("merch_inventory").alias("total_merch_inventory_rec"),
        _r(F.col("con_rev") + F.col("merch_rev"), 2).alias("total_ancillary_revenue"),
    )


def fan_segment_value(t) -> DataFrame:
    """Mean behaviour per loyalty status, ranked by value."""
    out = t["fan_profiles"].groupBy("loyalty_status").agg(
        F.count("*").alias("fan_count"),
        avg_r("games_attended_last_12_months", 1).alias("avg_games_attended"),
        avg_r("avg_ticket_spend", 2).alias("avg_ticket_spend"),
        avg_r("avg_concession_spend", 2).alias("avg_concession_spend"),
        avg_r("avg_merchandise_spend", 2).alias("avg_merchandise_spend"),
        avg_r(total_spend(), 2).alias("avg_total_spend"),
        half_up(exact_avg("promotion_usage_rate") * 100, 1).alias("avg_promo_usage_pct"),
        half_up(exact_avg("email_engagement_score") * 100, 1).alias("avg_email_engagement_pct"),
        avg_r("fan_value_score", 3).alias("avg_fan_value_score"),
        exact_avg("fan_value_score").alias("_raw"),
    )
    return out.withColumn("value_rank", F.rank().over(W.orderBy(F.desc_nulls_first("_raw")))).drop("_raw")


def _best(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Key with the highest mean of a measure; ties go to the first key in order."""
    means = df.groupBy(key).agg(exact_avg(measure).alias("_m"))
    return means.orderBy(F.desc_nulls_first("_m"), key).limit(1).select(key)


def _dashboard(t, totals: DataFrame) -> DataFrame:
    opponent = _best(hub(t, "attendance"), "away_team_name", "capacity_pct").scalar()
    segment = _best(t["fan_profiles"], "loyalty_status", "fan_value_score").scalar()
    total = F.round(F.col("t") + F.col("c") + F.col("m"), 0)
    return totals.select(
        "total_games", F.col("att").cast("double").alias("total_attendance"),
        half_up(safe_div("cap", "cap_n"), 1).alias("avg_capacity_pct"),
        _r("t").alias("total_ticket_revenue"), _r("c").alias("total_concession_revenue"),
        _r("m").alias("total_merchandise_revenue"), total.cast("double").alias("total_game_day_revenue"),
        half_up(safe_div(total, "att"), 2).alias("avg_revenue_per_attendee"),
        opponent.alias("top_opponent"), segment.alias("top_fan_segment"),
    )


def executive_dashboard(t) -> DataFrame:
    """One row of totals over the three-fact join, as written: each game weighs by its joined rows."""
    games = fanned(full_revenue(t, "attendance"))
    rows = F.col("fan_rows")
    return _dashboard(t, games.agg(
        F.count_distinct("game_id").alias("total_games"),
        F.sum(F.col("actual_attendance").cast("decimal(10,0)") * rows).alias("att"),
        F.sum(F.col("capacity_pct") * rows).alias("cap"), F.sum(F.when(F.col("capacity_pct").isNotNull(), rows)).alias("cap_n"),
        F.sum("fan_ticket").alias("t"), F.sum("fan_con").alias("c"), F.sum("fan_merch").alias("m"),
    ))


def executive_dashboard_fixed(t) -> DataFrame:
    """One row of totals with every game and record counted once."""
    games = full_revenue(t, "attendance")
    return _dashboard(t, games.agg(
        F.count("*").alias("total_games"), F.sum("actual_attendance").alias("att"),
        F.sum("capacity_pct").alias("cap"), F.count("capacity_pct").alias("cap_n"),
        F.sum("ticket_rev").alias("t"), F.sum("con_rev").alias("c"), F.sum("merch_rev").alias("m"),
    ))


VIEWS = {
    "vw_game_day_revenue": game_day_revenue,
    "vw_attendance_performance": attendance_performance,
    "vw_ticket_segment_performance": ticket_segment_performance,
    "vw_promotion_effectiveness": promotion_effectiveness,
    "vw_concession_merchandise_demand": concession_merchandise_demand,
    "vw_fan_segment_value": fan_segment_value,
    "vw_executive_dashboard": executive_dashboard,
}


def register_views(t) -> list[str]:
    """Create or replace the KPI views as session views; nothing is computed until they are read."""
    for name, build in VIEWS.items():
        build(t).createOrReplaceTempView(name)
    return list(VIEWS)


QUERIES = {f"v{i}_{name[3:]}": build for i, (name, build) in enumerate(VIEWS.items(), start=1)}
QUERIES["v4_promotion_effectiveness_fixed"] = promotion_effectiveness_fixed
QUERIES["v7_executive_dashboard_fixed"] = executive_dashboard_fixed
