"""Concession and merchandise questions: per-head spend, demand, stock and margins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import avg_r, half_up, safe_div, sum_r
from ..operators.marts import hub
from .attendance import MATCHUP


def _hub_with(t, mart: str) -> DataFrame:
    return hub(t, "attendance").join(t.mart(mart), "game_id")


def _per_head(t, mart: str, revenue: str, extra: str, total_name: str, rate_name: str) -> DataFrame:
    out = _hub_with(t, mart).select(
        *MATCHUP, "actual_attendance", extra,
        F.round(revenue, 0).cast("double").alias(total_name),
        half_up(safe_div(revenue, "actual_attendance"), 2).alias(rate_name),
    )
    # A null rate (nobody attended) sorts first, as in the source dialect.
    return out.orderBy(F.desc_nulls_first(rate_name), "game_id").limit(20)


def concession_per_head(t) -> DataFrame:
    return _per_head(t, "concessions_by_game", "con_rev", "attendance_tier", "total_concession_revenue", "concession_per_cap")


def merchandise_per_head(t) -> DataFrame:
    return _per_head(t, "merchandise_by_game", "merch_rev", "rivalry_flag", "total_merch_revenue", "merch_per_cap")


def top_food_demand(t) -> DataFrame:
    return _hub_with(t, "concessions_by_game").select(
        *MATCHUP, "actual_attendance", F.col("food_units").alias("food_bev_units"),
        F.round("food_rev", 0).cast("double").alias("food_bev_revenue"),
        F.col("food_inventory").alias("food_bev_inventory_rec"),
    ).orderBy(F.desc("food_bev_units"), "game_id").limit(20)


def top_merchandise_demand(t) -> DataFrame:
    return _hub_with(t, "merchandise_by_game").select(
        *MATCHUP, "rivalry_flag", "actual_attendance", F.col("merch_units").alias("total_merch_units"),
        F.round("merch_rev", 0).cast("double").alias("total_merch_revenue"),
        F.col("merch_inventory").alias("total_inventory_rec"),
    ).orderBy(F.desc("total_merch_units"), "game_id").limit(20)


def stock_by_tier(t) -> DataFrame:
    out = hub(t, "attendance").join(t.mart("concessions_by_game"), "game_id").join(t.mart("merchandise_by_game"), "game_id")
    return out.groupBy("attendance_tier").agg(
        F.count_distinct("game_id").alias("games"),
        avg_r("actual_attendance", 0).alias("avg_attendance"),
        avg_r("con_inventory", 0).alias("avg_concession_inventory_rec"),
        avg_r("merch_inventory", 0).alias("avg_merch_inventory_rec"),
    ).orderBy(F.desc("avg_attendance"))


def _margin_by_category(fact: DataFrame) -> DataFrame:
    """Totals per category and the mean of the per-record margin shares."""
    share = safe_div("gross_margin", "gross_revenue")
    return fact.groupBy("category").agg(
        sum_r("gross_revenue", 0).alias("total_revenue"),
        sum_r("estimated_cost", 0).alias("total_cost"),
        sum_r("gross_margin", 0).alias("total_margin"),
        half_up(F.avg(share) * 100, 1).alias("avg_margin_pct"),
        avg_r("per_cap_spend", 2).alias("avg_per_cap_spend"),
    ).orderBy(F.desc("total_margin"))


def concession_margins(t) -> DataFrame:
    return _margin_by_category(t.records("concessions"))


def merchandise_margins(t) -> DataFrame:
    return _margin_by_category(t.records("merchandise"))


QUERIES = {
    "q21_concession_per_head": concession_per_head,
    "q22_merchandise_per_head": merchandise_per_head,
    "q23_top_food_demand": top_food_demand,
    "q24_top_merchandise_demand": top_merchandise_demand,
    "q25_stock_by_tier": stock_by_tier,
    "q26_concession_margins": concession_margins,
    "q27_merchandise_margins": merchandise_margins,
}
