"""Promotion questions: lift, revenue, sponsor gain and the best type for weak games."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import avg_r, exact_avg, half_up, sum_r


def _promoted(t, condition: Column | None = None) -> DataFrame:
    out = t["promotions"].join(t["attendance"], "game_id")
    return out if condition is None else out.where(condition)


def lift_by_type(t) -> DataFrame:
    return _promoted(t).groupBy("promotion_type").agg(
        F.count("*").alias("games"),
        avg_r("capacity_pct", 2).alias("avg_capacity_pct"),
        avg_r("expected_promotion_lift_pct", 2).alias("avg_expected_lift_pct"),
        avg_r("actual_attendance", 0).alias("avg_actual_attendance"),
    ).orderBy(F.desc("avg_capacity_pct"))


def revenue_by_type(t) -> DataFrame:
    """Game revenue by promotion type for games with ticket sales; other revenue counts as zero if absent."""
    zero = F.lit(0)
    per_game = (
        t["games"].select("game_id").join(t["promotions"].select("game_id", "promotion_type"), "game_id")
        .join(t.mart("tickets_by_game"), "game_id")
        .join(t.mart("concessions_by_game"), "game_id", "left")
        .join(t.mart("merchandise_by_game"), "game_id", "left")
    )
    total = F.col("ticket_rev") + F.coalesce("con_rev", zero) + F.coalesce("merch_rev", zero)
    return per_game.groupBy("promotion_type").agg(
        F.count("*").alias("games"),
        avg_r(total, 0).alias("avg_total_revenue"),
        sum_r(total, 0).alias("total_revenue"),
    ).orderBy(F.desc("avg_total_revenue"))


def roi_by_type(t) -> DataFrame:
    gain = exact_avg("sponsor_value_estimate") - exact_avg("promotion_cost")
    return _promoted(t, F.col("promotion_flag")).groupBy("promotion_type").agg(
        F.count("*").alias("games"),
        avg_r("promotion_cost", 0).alias("avg_promo_cost"),
        avg_r("sponsor_value_estimate", 0).alias("avg_sponsor_value"),
        avg_r("capacity_pct", 1).alias("avg_capacity_pct"),
        half_up(gain, 0).alias("avg_net_sponsor_gain"),
    ).orderBy(F.desc("avg_net_sponsor_gain"))


def _fill_by_type(df: DataFrame, count_name: str) -> DataFrame:
    return df.groupBy("promotion_type").agg(
        F.count("*").alias(count_name),
        avg_r("capacity_pct", 2).alias("avg_capacity_pct"),
        avg_r("actual_attendance", 0).alias("avg_attendance"),
    ).orderBy(F.desc("avg_capacity_pct"))


def best_for_weekdays(t) -> DataFrame:
    weekday = t["games"].where(~F.col("is_weekend")).select("game_id")
    return _fill_by_type(_promoted(t, F.col("promotion_flag")).join(weekday, "game_id"), "weekday_games")


def best_for_low_demand(t) -> DataFrame:
    low = _promoted(t, F.col("promotion_flag") & (F.col("attendance_tier") == "Low"))
    return _fill_by_type(low, "low_demand_games")


QUERIES = {
    "q16_lift_by_promotion": lift_by_type,
    "q17_revenue_by_promotion": revenue_by_type,
    "q18_promotion_roi": roi_by_type,
    "q19_best_weekday_promotion": best_for_weekdays,
    "q20_best_low_demand_promotion": best_for_low_demand,
}
