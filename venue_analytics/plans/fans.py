"""Fan questions: spend, loyalty, frequency, distance and household."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import avg_r, exact_avg, half_up, safe_div


def total_spend() -> Column:
    return F.col("avg_ticket_spend") + F.col("avg_concession_spend") + F.col("avg_merchandise_spend")


def _spend_means(merch: str = "avg_merch_spend") -> list:
    return [
        avg_r("avg_ticket_spend", 2).alias("avg_ticket_spend"),
        avg_r("avg_concession_spend", 2).alias("avg_concession_spend"),
        avg_r("avg_merchandise_spend", 2).alias(merch),
    ]


def _ranked(df: DataFrame, by: str, name: str) -> DataFrame:
    """Rank the (few) aggregated groups by an unrounded mean and drop it."""
    return df.withColumn(name, F.rank().over(W.orderBy(F.desc_nulls_first(by)))).drop(by)


def spend_ranking(t) -> DataFrame:
    out = t["fan_profiles"].groupBy("loyalty_status").agg(
        F.count("*").alias("fan_count"), *_spend_means(),
        avg_r(total_spend(), 2).alias("avg_total_spend"), exact_avg(total_spend()).alias("_raw"),
    )
    return _ranked(out, "_raw", "spend_rank").orderBy(F.desc("avg_total_spend"), "loyalty_status")


def loyalty_contribution(t) -> DataFrame:
    """Revenue, its share and revenue per fan by loyalty status.

    Transactions are summed per fan first: a fan with very many transactions is combined before the
    join, and counting those rows counts distinct fans without a second shuffle.
    """
    per_fan = t["fan_transactions"].groupBy("fan_id").agg(F.sum("total_spend").alias("spend"))
    status = t["fan_profiles"].select("fan_id", "loyalty_status")
    spend = per_fan.join(status, "fan_id").groupBy("loyalty_status").agg(
        F.sum("spend").alias("revenue"), F.count("*").alias("unique_fans")
    )
    grand = spend.agg(F.sum("revenue")).scalar()
    return spend.select(
        "loyalty_status", "unique_fans", F.round("revenue", 0).cast("double").alias("total_revenue"),
        half_up(safe_div("revenue", grand) * 100, 1).alias("revenue_share_pct"),
        half_up(safe_div("revenue", "unique_fans"), 2).alias("revenue_per_fan"),
    ).orderBy(F.desc_nulls_first("revenue_per_fan"))


def promotion_usage(t) -> DataFrame:
    return t["fan_profiles"].groupBy("loyalty_status").agg(
        F.count("*").alias("fans"),
        half_up(exact_avg("promotion_usage_rate") * 100, 1).alias("avg_promo_usage_pct"),
        avg_r("avg_ticket_spend", 2).alias("avg_ticket_spend"),
        avg_r("games_attended_last_12_months", 1).alias("avg_games_attended"),
    ).orderBy(F.desc("avg_promo_usage_pct"))


def by_frequency(t) -> DataFrame:
    tier = rules.frequency_tier("games_attended_last_12_months").alias("frequency_tier")
    return t["fan_profiles"].groupBy(tier).agg(
        F.count("*").alias("fans"), *_spend_means(), avg_r("fan_value_score", 3).alias("avg_fan_value_score"),
    ).orderBy(F.desc("avg_fan_value_score"))


def by_distance(t) -> DataFrame:
    return t["fan_profiles"].groupBy("distance_from_arena_bucket").agg(
        F.count("*").alias("fans"), *_spend_means(),
        avg_r("games_attended_last_12_months", 1).alias("avg_games_attended"),
    ).orderBy(F.desc("avg_ticket_spend"))


def by_household(t) -> DataFrame:
    out = t["fan_profiles"].groupBy("household_type").agg(
        F.count("*").alias("fans"), avg_r("fan_value_score", 3).alias("avg_fan_value_score"), *_spend_means(),
        exact_avg("fan_value_score").alias("_raw"),
    )
    return _ranked(out, "_raw", "value_rank").orderBy(F.desc("avg_fan_value_score"), "household_type")


def rivalry_spend(t) -> DataFrame:
    """Transactions, fans and mean spend for rivalry and regular games.

    Each distinct count is a roll-up of its own keyed by (label, id), partial aggregation first, then
    counted per label; the three one-row-a-label results join on the label. No row is expanded per
    distinct column, and a null id counts as no distinct value.
    """
    games = t["games"].select("game_id", "rivalry_flag")
    label = F.when(F.col("rivalry_flag"), "Rivalry Game").otherwise("Regular Game").alias("game_type")
    labelled = t["fan_transactions"].join(games, "game_id").select(label, "*")
    distinct = lambda c, name: labelled.select("game_type", c).distinct().groupBy("game_type").agg(F.count(c).alias(name))
    means = labelled.groupBy("game_type").agg(
        avg_r("total_spend", 2).alias("avg_total_spend_per_txn"),
        avg_r("ticket_spend", 2).alias("avg_ticket_spend"),
        avg_r("concession_spend", 2).alias("avg_concession_spend"),
        avg_r("merchandise_spend", 2).alias("avg_merch_spend"),
    )
    return (
        distinct("transaction_id", "transactions").join(distinct("fan_id", "unique_fans"), "game_type").join(means, "game_type")
        .select("game_type", "transactions", "unique_fans", "avg_total_spend_per_txn", "avg_ticket_spend", "avg_concession_spend", "avg_merch_spend")
        .orderBy(F.desc("avg_total_spend_per_txn"))
    )


QUERIES = {
    "q28_spend_ranking": spend_ranking,
    "q29_loyalty_contribution": loyalty_contribution,
    "q30_promotion_usage": promotion_usage,
    "q31_spend_by_frequency": by_frequency,
    "q32_spend_by_distance": by_distance,
    "q33_value_by_household": by_household,
    "q39_rivalry_spend": rivalry_spend,
}
