"""Per-game roll-ups of the three revenue facts and the revenue marts built from them.

Aggregating before joining keeps every later join one row per game on both sides. Partial aggregation
runs before the shuffle, so a game that holds a large share of a fact is combined map-side and arrives
at its reducer as a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import safe_div


def tickets_by_game(t) -> DataFrame:
    return t.records("ticket_sales").groupBy("game_id").agg(
        F.count("*").alias("ticket_rows"),
        F.sum("tickets_sold").alias("tickets_sold"),
        F.sum("net_ticket_revenue").alias("ticket_rev"),
    )


def _by_game(fact: DataFrame, short: str, extra: list[Column]) -> DataFrame:
    return fact.groupBy("game_id").agg(
        F.count("*").alias(f"{short}_rows"),
        F.sum("gross_revenue").alias(f"{short}_rev"),
        F.sum("gross_margin").alias(f"{short}_margin"),
        F.sum("units_sold").alias(f"{short}_units"),
        F.sum("recommended_inventory_units").alias(f"{short}_inventory"),
        *extra,
    )


def concessions_by_game(t) -> DataFrame:
    food = F.col("category").isin(*rules.FOOD_AND_DRINK)
    zero = F.lit(0)
    extra = [
        F.sum(F.when(food, F.col("units_sold")).otherwise(zero)).alias("food_units"),
        F.sum(F.when(food, F.col("gross_revenue")).otherwise(zero)).alias("food_rev"),
        F.sum(F.when(food, F.col("recommended_inventory_units")).otherwise(zero)).alias("food_inventory"),
    ]
    return _by_game(t.records("concessions", once=True), "con", extra)


def merchandise_by_game(t) -> DataFrame:
    return _by_game(t.records("merchandise", once=True), "merch", [])


ROLLUPS = {
    "tickets_by_game": tickets_by_game,
    "concessions_by_game": concessions_by_game,
    "merchandise_by_game": merchandise_by_game,
}


def revenue_parts(t, how: str = "inner") -> DataFrame:
    """game_id with ticket, concession and merchandise revenue.

    ``inner`` keeps games that have all three facts; ``left`` keeps every game of the ticket roll-up's
    side when joined onto the hub, so callers fill the nulls with zero.
    """
    tickets = t.mart("tickets_by_game")
    return (
        tickets.join(t.mart("concessions_by_game"), "game_id", how)
        .join(t.mart("merchandise_by_game"), "game_id", how)
    )


def hub(t, *others: str) -> DataFrame:
    """games joined with the named one-row-per-game tables (inner, on game_id)."""
    out = t["games"]
    for name in others:
        out = out.join(t[name], "game_id")
    return out


def hub_with_revenue(t, *others: str) -> DataFrame:
    """Hub left-joined with the three roll-ups; missing revenue counts as zero."""
    out = hub(t, *others)
    for name in ROLLUPS:
        out = out.join(t.mart(name), "game_id", "left")
    zero = F.lit(0)
    for c in ("ticket_rev", "con_rev", "merch_rev"):
        out = out.withColumn(c, F.coalesce(F.col(c), zero))
    return out.withColumn("total_revenue", F.col("ticket_rev") + F.col("con_rev") + F.col("merch_rev"))


def full_revenue(t, *others: str) -> DataFrame:
    """Hub with games that have all three facts, and their exact total."""
    out = hub(t, *others).join(revenue_parts(t), "game_id")
    return out.withColumn("total_rev", F.col("ticket_rev") + F.col("con_rev") + F.col("merch_rev"))


def variance_ratio() -> Column:
    """(actual - expected) / expected, null on a zero baseline."""
    return safe_div(
        F.col("actual_attendance") - F.col("expected_attendance_baseline"), "expected_attendance_baseline"
    )
