"""Executive questions: per-game profit and loss, revenue split, trends and staffing.

Three of them (revenue split, monthly trend, staffing) are defined over joins that repeat each fact once
per row of the others. The as-written results are computed from per-game sums times the other facts'
row counts, which is the same number without ever building the repeated rows; the ``_fixed`` variants
count every record once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import half_up, safe_div
from ..operators.marts import full_revenue, revenue_parts
from .attendance import MATCHUP


def _r(c: str | Column, digits: int = 0) -> Column:
    return F.round(c, digits).cast("double")


def fanned(df: DataFrame) -> DataFrame:
    """Per-game sums as a join of the three facts would repeat them, plus the joined row count.

    Row counts multiply as decimals: for a game with billions of records their product exceeds a long.
    """
    tickets, con, merch = (F.col(c).cast("decimal(20,0)") for c in ("ticket_rows", "con_rows", "merch_rows"))
    return (
        df.withColumn("fan_rows", tickets * con * merch)
        .withColumn("fan_ticket", F.col("ticket_rev") * (con * merch))
        .withColumn("fan_con", F.col("con_rev") * (tickets * merch))
        .withColumn("fan_merch", F.col("merch_rev") * (tickets * con))
    )


def game_breakdown(t) -> DataFrame:
    """Ticket, concession and merchandise revenue of every game, best first."""
    return full_revenue(t, "attendance").select(
        "game_id", "game_date", "season", "home_team_name", "away_team_name", "actual_attendance",
        F.round("capacity_pct", 1).alias("capacity_pct"),
        _r("ticket_rev").alias("ticket_revenue"), _r("con_rev").alias("concession_revenue"),
        _r("merch_rev").alias("merchandise_revenue"), _r("total_rev").alias("total_game_day_revenue"),
    ).orderBy(F.desc("total_game_day_revenue"), "game_id")


def _split(df: DataFrame, ticket: str, con: str, merch: str) -> DataFrame:
    sums = df.agg(F.sum(ticket).alias("t"), F.sum(con).alias("c"), F.sum(merch).alias("m"))
    total = F.col("t") + F.col("c") + F.col("m")
    share = lambda c: half_up(safe_div(c, total) * 100, 1)
    return sums.select(
        _r("t").alias("total_ticket_revenue"), _r("c").alias("total_concession_revenue"),
        _r("m").alias("total_merchandise_revenue"), _r(total).alias("total_game_day_revenue"),
        share("t").alias("ticket_share_pct"), share("c").alias("concession_share_pct"),
        share("m").alias("merch_share_pct"),
    )


def revenue_split(t) -> DataFrame:
    """Revenue totals and shares over the three-fact join, as written."""
    return _split(fanned(revenue_parts(t)), "fan_ticket", "fan_con", "fan_merch")


def revenue_split_fixed(t) -> DataFrame:
    """Revenue totals and shares of games with all three facts, every record once."""
    return _split(revenue_parts(t), "ticket_rev", "con_rev", "merch_rev")


def top_games(t) -> DataFrame:
    """Ten games with the highest total of rounded revenues, densely ranked."""
    out = full_revenue(t, "attendance", "promotions").select(
        *MATCHUP, "rivalry_flag", "nationally_televised_flag", "actual_attendance",
        F.round("capacity_pct", 1).alias("capacity_pct"), "promotion_type",
        _r("ticket_rev").alias("ticket_rev"), _r("con_rev").alias("con_rev"), _r("merch_rev").alias("merch_rev"),
    ).withColumn("total_revenue", F.col("ticket_rev") + F.col("con_rev") + F.col("merch_rev"))
    # Every larger total is already among the top ten, so ranking after the cut gives the same ranks
    # and the single-partition window sees ten rows.
    top = out.orderBy(F.desc("total_revenue"), "game_id").limit(10)
    return top.withColumn("revenue_rank", F.dense_rank().over(W.orderBy(F.desc("total_revenue"))))


def monthly_trend(t) -> DataFrame:
    """Monthly trend as written: games group further by their own concession and merchandise revenue."""
    return full_revenue(t).groupBy("season", "month", "con_rev", "merch_rev").agg(
        F.count_distinct("game_id").alias("games"), F.sum("ticket_rev").alias("tickets"),
    ).select(
        "season", "month", rules.month_name("month").alias("month_name"), "games",
        _r("tickets").alias("ticket_revenue"), _r("con_rev").alias("concession_revenue"),
        _r("merch_rev").alias("merchandise_revenue"),
        _r(F.col("tickets") + F.col("con_rev") + F.col("merch_rev")).alias("total_revenue"),
    ).orderBy("season", "month")


def monthly_trend_fixed(t) -> DataFrame:
    """One row per season and month."""
    return full_revenue(t).groupBy("season", "month").agg(
        F.count("*").alias("games"), F.sum("ticket_rev").alias("tickets"), F.sum("con_rev").alias("con"),
        F.sum("merch_rev").alias("merch"),
    ).select(
        "season", "month", rules.month_name("month").alias("month_name"), "games",
        _r("tickets").alias("ticket_revenue"), _r("con").alias("concession_revenue"),
        _r("merch").alias("merchandise_revenue"),
        _r(F.col("tickets") + F.col("con") + F.col("merch")).alias("total_revenue"),
    ).orderBy("season", "month")


def _readiness(df: DataFrame, ticket: Column, con: Column, merch: Column) -> DataFrame:
    return df.where(F.col("attendance_tier").isin("High", "Sellout")).select(
        *MATCHUP, "actual_attendance", "arena_capacity", F.round("capacity_pct", 1).alias("capacity_pct"),
        "attendance_tier", "promotion_type", _r(ticket).alias("ticket_rev"),
        con.alias("total_con_inventory_rec"), merch.alias("total_merch_inventory_rec"),
        rules.staffing_level("capacity_pct").alias("staffing_level"),
    ).orderBy(F.desc("capacity_pct"), "game_id").limit(20)


def staffing(t) -> DataFrame:
    """Twenty fullest high-demand games with stock and staffing, as written."""
    df = fanned(full_revenue(t, "attendance", "promotions"))
    return _readiness(
        df, F.col("fan_ticket"),
        F.col("con_inventory").cast("decimal(20,0)") * F.col("ticket_rows") * F.col("merch_rows"),
        F.col("merch_inventory").cast("decimal(20,0)") * F.col("ticket_rows") * F.col("con_rows"),
    )


def staffing_fixed(t) -> DataFrame:
    """Twenty fullest high-demand games with every record counted once."""
    df = full_revenue(t, "attendance", "promotions")
    return _readiness(df, F.col("ticket_rev"), F.col("con_inventory"), F.col("merch_inventory"))


QUERIES = {
    "q34_game_breakdown": game_breakdown,
    "q35_revenue_split": revenue_split,
    "q35_revenue_split_fixed": revenue_split_fixed,
    "q36_top_games": top_games,
    "q38_monthly_trend": monthly_trend,
    "q38_monthly_trend_fixed": monthly_trend_fixed,
    "q40_staffing": staffing,
    "q40_staffing_fixed": staffing_fixed,
}
