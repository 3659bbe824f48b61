"""Attendance questions: who draws, when, and which games missed or beat expectation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import avg_r, half_up
from ..operators.marts import hub, variance_ratio

MATCHUP = ["game_id", "game_date", "home_team_name", "away_team_name"]


def _attendance_means(digits: int = 1) -> list:
    return [
        F.count("*").alias("games"),
        avg_r("actual_attendance", 0).alias("avg_attendance"),
        avg_r("capacity_pct", digits).alias("avg_capacity_pct"),
    ]


def top_opponents(t) -> DataFrame:
    """Ten visiting teams with the highest mean attendance."""
    out = hub(t, "attendance").groupBy(F.col("away_team_name").alias("opponent")).agg(
        F.count("*").alias("games_played"),
        avg_r("actual_attendance", 0).alias("avg_attendance"),
        avg_r("capacity_pct", 1).alias("avg_capacity_pct"),
        F.max("actual_attendance").alias("max_attendance"),
    )
    return out.orderBy(F.desc("avg_attendance"), "opponent").limit(10)


def by_weekday(t) -> DataFrame:
    return hub(t, "attendance").groupBy("day_of_week").agg(*_attendance_means()).orderBy(F.desc("avg_attendance"))


def by_month(t) -> DataFrame:
    out = hub(t, "attendance").groupBy("month").agg(*_attendance_means())
    return out.select("month", rules.month_name("month").alias("month_name"), "games", "avg_attendance", "avg_capacity_pct").orderBy("month")


def weekend_vs_weekday(t) -> DataFrame:
    label = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("game_type")
    return hub(t, "attendance").groupBy(label).agg(
        *_attendance_means(),
        F.min("actual_attendance").alias("min_attendance"),
        F.max("actual_attendance").alias("max_attendance"),
    ).orderBy(F.desc("avg_attendance"))


def by_opponent_tier(t) -> DataFrame:
    """Mean fill by the opponent's market size and popularity."""
    # Means per team first: the dimension then joins one row per team instead of one per game.
    per_team = hub(t, "attendance").groupBy("away_team_id").agg(
        F.count("*").alias("n"), F.sum("capacity_pct").alias("cap"), F.count("capacity_pct").alias("cap_n")
    )
    teams = t["teams"].select("team_id", "market_size_tier", "historical_popularity_score")
    out = per_team.join(teams, per_team.away_team_id == teams.team_id).groupBy(
        F.col("market_size_tier").alias("opponent_market_tier"),
        F.col("historical_popularity_score").alias("avg_opp_popularity"),
    ).agg(
        F.sum("n").alias("games"),
        half_up(F.sum("cap").cast("double") / F.nullif(F.sum("cap_n").cast("double"), F.lit(0.0)), 2).alias("avg_capacity_pct"),
    )
    return out.orderBy(F.desc("avg_capacity_pct"), "avg_opp_popularity")


def sellouts(t) -> DataFrame:
    """Twenty-five fullest games at or above 97 percent of capacity."""
    out = hub(t, "attendance", "promotions").where(F.col("capacity_pct") >= 97)
    return out.orderBy(F.desc("capacity_pct"), "game_id").limit(25).select(
        *MATCHUP, "actual_attendance", "arena_capacity", F.round("capacity_pct", 1).alias("capacity_pct"),
        "attendance_tier", "promotion_type",
    )


def _with_variance(df: DataFrame) -> DataFrame:
    return df.withColumn("ratio", variance_ratio()).withColumn("variance_pct", half_up(F.col("ratio") * 100, 1))


def underperforming(t) -> DataFrame:
    """Twenty games furthest below their baseline, all missing it by more than a tenth."""
    out = _with_variance(hub(t, "attendance", "promotions", "weather")).where(F.col("ratio") < -0.10)
    return out.select(
        *MATCHUP, "actual_attendance", "expected_attendance_baseline", "attendance_variance", "variance_pct",
        "attendance_tier", "promotion_type", "weather_condition",
    ).orderBy("variance_pct", "game_id").limit(20)


def overperforming(t) -> DataFrame:
    """Twenty games furthest above their baseline, all beating it by more than a tenth."""
    out = _with_variance(hub(t, "attendance", "promotions")).where(F.col("ratio") > 0.10)
    return out.select(
        *MATCHUP, "actual_attendance", "expected_attendance_baseline", "variance_pct", "rivalry_flag",
        "nationally_televised_flag", "promotion_type",
    ).orderBy(F.desc("variance_pct"), "game_id").limit(20)


def missed_potential(t) -> DataFrame:
    """Games with at least two demand signals that still fell more than five percent short."""
    signals = sum(
        (F.when(F.col(c), 1).otherwise(0) for c in ("rivalry_flag", "nationally_televised_flag", "is_weekend")),
        F.lit(0),
    )
    out = hub(t, "attendance").select(
        *MATCHUP, "capacity_pct", "attendance_tier", signals.alias("demand_signal_score"),
        (variance_ratio() * 100).alias("variance_pct"),
    )
    out = out.where((F.col("demand_signal_score") >= 2) & (F.col("variance_pct") < -5))
    return out.orderBy("variance_pct", "game_id").limit(20)


QUERIES = {
    "q01_top_opponents": top_opponents,
    "q02_attendance_by_weekday": by_weekday,
    "q03_attendance_by_month": by_month,
    "q04_weekend_vs_weekday": weekend_vs_weekday,
    "q05_capacity_by_opponent_tier": by_opponent_tier,
    "q06_sellouts": sellouts,
    "q07_underperforming": underperforming,
    "q08_overperforming": overperforming,
    "q37_missed_potential": missed_potential,
}
