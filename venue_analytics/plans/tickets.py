"""Ticket questions: segments, prices, discounts and the best and worst games."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import avg_r, exact_avg, half_up, safe_div, sum_r
from ..operators.marts import hub
from .attendance import MATCHUP


def revenue_by_segment(t) -> DataFrame:
    segments = t["ticket_segments"].select("segment_id", F.col("segment_name").alias("name"), "price_tier")
    return t.records("ticket_sales").join(segments, "segment_id").groupBy(F.col("name").alias("segment_name"), "price_tier").agg(
        F.count("*").alias("game_records"),
        F.sum("tickets_sold").alias("total_tickets_sold"),
        avg_r("avg_ticket_price", 2).alias("avg_ticket_price"),
        sum_r("gross_ticket_revenue", 0).alias("total_gross_revenue"),
        sum_r("net_ticket_revenue", 0).alias("total_net_revenue"),
        avg_r("sell_through_rate", 1).alias("avg_sell_through_pct"),
    ).orderBy(F.desc("total_net_revenue"))


def price_by_segment_and_tier(t) -> DataFrame:
    """Mean price and sell-through per segment and demand tier.

    Tickets are summed per game and segment before they meet attendance, so a game with very many
    records crosses the network as at most one row per segment.
    """
    parts = t.records("ticket_sales").groupBy("game_id", "segment_name").agg(
        F.count("*").alias("n"),
        F.sum("avg_ticket_price").alias("price"), F.count("avg_ticket_price").alias("price_n"),
        F.sum("sell_through_rate").alias("rate"), F.count("sell_through_rate").alias("rate_n"),
    )
    tier = t["attendance"].select("game_id", "attendance_tier")
    return parts.join(tier, "game_id").groupBy("segment_name", "attendance_tier").agg(
        half_up(safe_div(F.sum("price"), F.sum("price_n")), 2).alias("avg_ticket_price"),
        half_up(safe_div(F.sum("rate"), F.sum("rate_n")), 1).alias("avg_sell_through_pct"),
        F.sum("n").alias("records"),
    ).orderBy("segment_name", "attendance_tier")


def sell_through_ranking(t) -> DataFrame:
    out = t.records("ticket_sales").groupBy("segment_name").agg(
        half_up(exact_avg("sell_through_rate"), 2).alias("avg_sell_through"),
        F.round(F.min("sell_through_rate"), 2).cast("double").alias("min_sell_through"),
        F.round(F.max("sell_through_rate"), 2).cast("double").alias("max_sell_through"),
    )
    # One row per segment: the single-partition window ranks a handful of rows.
    rank = F.rank().over(W.orderBy(F.desc_nulls_first("avg_sell_through")))
    return out.withColumn("sell_through_rank", rank).orderBy("sell_through_rank", "segment_name")


def _game_ticket_totals(t) -> DataFrame:
    tickets = t.mart("tickets_by_game").select(
        "game_id", F.round("ticket_rev", 0).cast("double").alias("total_net_ticket_revenue"),
        F.col("tickets_sold").alias("total_tickets_sold"),
    )
    return hub(t, "attendance", "promotions").join(tickets, "game_id")


def top_games(t) -> DataFrame:
    return _game_ticket_totals(t).select(
        *MATCHUP, "rivalry_flag", "nationally_televised_flag", "total_net_ticket_revenue", "total_tickets_sold",
        "capacity_pct", "promotion_type",
    ).orderBy(F.desc("total_net_ticket_revenue"), "game_id").limit(15)


def bottom_games(t) -> DataFrame:
    return _game_ticket_totals(t).select(
        *MATCHUP, "day_of_week", "total_net_ticket_revenue", "capacity_pct", "promotion_type",
    ).orderBy("total_net_ticket_revenue", "game_id").limit(15)


def discount_impact(t) -> DataFrame:
    return t.records("ticket_sales").groupBy("segment_name", rules.discount_bucket("discount_pct").alias("discount_bucket")).agg(
        F.count("*").alias("records"),
        avg_r("tickets_sold", 0).alias("avg_tickets_sold"),
        avg_r("gross_ticket_revenue", 0).alias("avg_gross_revenue"),
        avg_r("net_ticket_revenue", 0).alias("avg_net_revenue"),
        avg_r("sell_through_rate", 1).alias("avg_sell_through"),
    ).orderBy("segment_name", "discount_bucket")


def corporate_value(t) -> DataFrame:
    """Twenty games with the highest corporate ticket revenue plus sponsor value."""
    corporate = t.records("ticket_sales").where(F.col("segment_name") == rules.CORPORATE_SEGMENT)
    per_game = corporate.groupBy("game_id").agg(F.sum("net_ticket_revenue").alias("rev"))
    sponsor = t["promotions"].groupBy("game_id").agg(exact_avg("sponsor_value_estimate").alias("sponsor"))
    out = t["games"].join(per_game, "game_id").join(sponsor, "game_id").select(
        *MATCHUP,
        F.round("rev", 0).cast("double").alias("corporate_ticket_revenue"),
        half_up("sponsor", 0).alias("sponsor_value_estimate"),
        half_up(F.col("rev").cast("double") + F.col("sponsor"), 0).alias("total_partner_value"),
    )
    return out.orderBy(F.desc_nulls_first("total_partner_value"), "game_id").limit(20)


QUERIES = {
    "q09_revenue_by_segment": revenue_by_segment,
    "q10_price_by_segment_and_tier": price_by_segment_and_tier,
    "q11_sell_through_ranking": sell_through_ranking,
    "q12_top_ticket_games": top_games,
    "q13_bottom_ticket_games": bottom_games,
    "q14_discount_impact": discount_impact,
    "q15_corporate_value": corporate_value,
}
