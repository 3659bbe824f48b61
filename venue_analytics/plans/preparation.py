"""Registered jobs of the preparation stage: audit, validation, cleaning, features, derived columns."""

from __future__ import annotations

import uuid
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import half_up, int_div
from ..operators import quality
from ..operators.features import attendance_features, build_features, revenue_features, team_form
from ..sources.catalog import CORRUPT, Catalog, read_csv
from ..sources.schemas import SCHEMAS
from ..sources.tables import shared_root


def row_counts(t) -> DataFrame:
    """Rows per table, by table name."""
    parts = [t[name].agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name in SCHEMAS]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def _cleaned(name: str, t) -> DataFrame:
    return quality.clean(name, t[name])


def features_full(t) -> DataFrame:
    return build_features(t)


def features_attendance(t) -> DataFrame:
    return attendance_features(build_features(t))


def features_revenue(t) -> DataFrame:
    return revenue_features(build_features(t))


def features_train_fill(t) -> DataFrame:
    """Lagged features with first games filled from the training seasons only."""
    return build_features(t, fill="train_mean").select("game_id", "rolling_att_3", "rolling_att_5", "rolling_rev_3", "rolling_rev_5")


def tier_from_share(t) -> DataFrame:
    share = F.col("capacity_pct").cast("double") / 100.0
    return t["attendance"].select("game_id", rules.attendance_tier(share).alias("attendance_tier"))


def demand_baseline(t) -> DataFrame:
    """Expected attendance from pre-game signals, and the actual's distance from it."""
    team = t["teams"].select("team_id", "historical_popularity_score", "arena_capacity")
    home = team.toDF("home_team_id", "home_pop", "cap")
    away = team.select("team_id", "historical_popularity_score").toDF("away_team_id", "away_pop")
    df = (
        t["games"].join(t["attendance"].select("game_id", "actual_attendance"), "game_id")
        .join(t["promotions"].select("game_id", "promotion_flag", "expected_promotion_lift_pct"), "game_id")
        .join(t["weather"], "game_id").join(home, "home_team_id").join(away, "away_team_id")
    )
    lift = F.when(F.col("promotion_flag"), F.col("expected_promotion_lift_pct").cast("double") / 100.0).otherwise(0.0)
    share = rules.demand_share({
        "home_pop": F.col("home_pop"), "away_pop": F.col("away_pop"),
        "home_win_pct": F.col("home_team_win_pct_entering_game"), "away_win_pct": F.col("away_team_win_pct_entering_game"),
        "weekend": F.col("is_weekend"), "rivalry": F.col("rivalry_flag"), "tv": F.col("nationally_televised_flag"),
        "holiday": F.col("is_holiday_period"), "promo_lift": lift, "severe": F.col("severe_weather_flag"),
        "snow": F.col("snow_flag"), "precip": F.col("precipitation_flag"),
    })
    df = df.withColumn("share", share)
    expected = F.floor(F.col("cap") * F.least("share", F.lit(1.0)))
    return df.select(
        "game_id", half_up("share", 6).alias("demand_share"), expected.alias("expected_attendance"),
        (F.col("actual_attendance") - expected).alias("variance"),
    )


def weather_labels(t) -> DataFrame:
    label = rules.weather_condition(*[F.col(c) for c in ("temperature_f", "precipitation_flag", "snow_flag", "severe_weather_flag")])
    return t["weather"].select("game_id", label.alias("weather_condition"))


def inventory_recommendation(t) -> DataFrame:
    """Recommended stock per record from units sold and the game's tier."""
    both = t.records("concessions").select("game_id", "category", "units_sold").unionByName(t.records("merchandise").select("game_id", "category", "units_sold"))
    # Equal records give equal recommendations: count them before the join, so a hot game is combined map-side.
    grouped = both.groupBy("game_id", "category", "units_sold").agg(F.count("*").alias("records"))
    return grouped.join(t["attendance"].select("game_id", "attendance_tier"), "game_id").select(
        "game_id", "category", "units_sold", "records",
        rules.inventory_units("units_sold", "attendance_tier").alias("recommended_inventory_units"),
    )


def margins_and_units(table: str, t) -> DataFrame:
    """Cost, margin and implied units (at least one) per concession or merchandise record, summed by category."""
    cost_share = F.lit(None)
    for name, _, share in rules.CONCESSION_CATEGORIES if table == "concessions" else rules.MERCHANDISE_CATEGORIES:
        cost_share = F.when(F.col("category") == name, F.lit(share).cast("decimal(3,2)")).otherwise(cost_share)
    cost = F.round(F.col("gross_revenue") * cost_share, 2)
    units = F.greatest(F.lit(1).cast("bigint"), int_div(F.col("gross_revenue") * 100, F.col("avg_unit_price") * 100))
    return t.records(table).groupBy("category").agg(
        F.sum(cost).alias("cost"), F.sum(F.col("gross_revenue") - cost).alias("margin"), F.sum(units).alias("implied_units"),
    )


def fan_value_scores(t) -> DataFrame:
    score = rules.fan_value(*[F.col(c) for c in (
        "avg_ticket_spend", "games_attended_last_12_months", "avg_merchandise_spend", "avg_concession_spend",
        "email_engagement_score", "promotion_usage_rate")])
    return t["fan_profiles"].select("fan_id", half_up(score, 4).alias("fan_value_score"))


def calendar_flags(
    t, pairs: list[tuple[str, str]] = rules.RIVAL_PAIRS, televised: list[str] = rules.TELEVISED_TEAMS
) -> DataFrame:
    """Weekend (Friday to Sunday), holiday season, rivalry (either order of a pair) and televised flags."""
    home, away = F.col("home_team_abbr"), F.col("away_team_abbr")
    matchup = F.concat_ws("|", F.least(home, away), F.greatest(home, away))
    known = sorted({"|".join(sorted(p)) for p in pairs})
    return t["games"].select(
        "game_id", (F.weekday("game_date") >= 4).alias("is_weekend"), F.month("game_date").isin(12, 1).alias("is_holiday_period"),
        matchup.isin(*known).alias("rivalry_flag"), (home.isin(*televised) | away.isin(*televised)).alias("nationally_televised_flag"),
    )


# Pairs and televised teams in the adapter's own abbreviations, for the registered job.
ADAPTER_PAIRS = [("T01", "T02"), ("T01", "T03"), ("T04", "T05"), ("T06", "T04"), ("T07", "T08"), ("T24", "T01")]
ADAPTER_TELEVISED = ["T04", "T06", "T01", "T07", "T09", "T02", "T03"]


def discounted_spend(t) -> DataFrame:
    """Transaction totals after the promotion's ticket discount and concession uplift."""
    used = F.col("used_promotion")
    adjusted = lambda c, factor: F.when(used, F.round(F.col(c) * F.lit(factor).cast("decimal(3,2)"), 2)).otherwise(F.col(c))
    ticket, concession = adjusted("ticket_spend", "0.88"), adjusted("concession_spend", "1.15")
    zero = F.lit(0)
    return t["fan_transactions"].select(
        "transaction_id", F.greatest(ticket, zero).alias("ticket_spend"), F.greatest(concession, zero).alias("concession_spend"),
        F.greatest(ticket + concession + F.col("merchandise_spend"), zero).alias("total_spend"),
    )


def csv_round_trip(t, name: str = "ticket_sales") -> DataFrame:
    """S1, S2, S7: a domain table written as header CSV to the shared folder and read back typed.

    One row: rows, lines whose cells don't parse (kept, not nulled), empty cells read as null (segment
    names), and the exact sums of tickets sold and net revenue, to be equal to the source's.
    """
    spark = t["games"].sparkSession
    path = f"{shared_root(spark)}/csv/{name}-{uuid.uuid4().hex}"
    t[name].write.option("header", True).csv(path)
    back = read_csv(spark, path, name, keep_corrupt=True)
    return back.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(CORRUPT).alias("bad_rows"),
        F.count(F.when(F.col("segment_name").isNull(), 1)).alias("null_segment_names"),
        F.sum("tickets_sold").cast("bigint").alias("tickets_sold"),
        F.sum("net_ticket_revenue").cast("double").alias("net_ticket_revenue"),
    )


def catalog_layers(t) -> DataFrame:
    """S4-S6, S9: which layer of a two-folder catalogue answers for a table, and with how many rows.

    promotions is written to both folders (raw CSV, cleaned Parquet), ticket_segments to the raw one
    only, weather to none. A catalogue preferring cleaned tables and one preferring raw ones load each;
    a missing table gives an empty typed frame. Rows are counted by SQL text over the catalogue's views.
    """
    spark = t["games"].sparkSession
    root = f"{shared_root(spark)}/catalog-{uuid.uuid4().hex}"
    raw, cleaned = f"{root}/raw", f"{root}/cleaned"
    for name in ("promotions", "ticket_segments"):
        t[name].write.option("header", True).option("emptyValue", '""').csv(f"{raw}/{name}.csv")
    quality.clean("promotions", t["promotions"]).write.parquet(f"{cleaned}/promotions.parquet")
    rows = []
    for label, prefer in (("cleaned_first", "cleaned"), ("raw_first", "raw")):
        catalog = Catalog(spark, raw, cleaned, prefer=prefer, on_missing="empty")
        for name in ("promotions", "ticket_segments", "weather"):
            df = catalog.load(name)
            view = f"catalog_{label}_{name}"
            df.createOrReplaceTempView(view)
            count = catalog.query(f"SELECT COUNT(*) FROM {view}").head()[0]
            where = df.select(F.col("_metadata.file_path")).head() if count else None
            layer = "empty" if where is None else "cleaned" if "/cleaned/" in where[0] else "raw"
            rows.append((label, name, layer, int(count)))
    return spark.createDataFrame(rows, "catalog string, table_name string, layer string, rows long")


PASSED_THROUGH = ("weather", "promotions", "ticket_segments")


def passed_through(name: str, t) -> DataFrame:
    """C16: a table that cleaning passes through unchanged."""
    return quality.clean(name, t[name])


QUERIES = {
    **{f"c16_{name}": partial(passed_through, name) for name in PASSED_THROUGH},
    "s04_catalog_layers": catalog_layers,
    "s01_csv_round_trip": csv_round_trip,
    "s03_row_counts": row_counts,
    "c18_validate_all": quality.validate_all,
    "c17_issue_summary": lambda t: quality.issue_summary(quality.validate_all(t)),
    **{f"c_clean_{name}": partial(_cleaned, name) for name in quality.CLEANERS},
    "f13_features_full": features_full,
    "f13_features_attendance": features_attendance,
    "f13_features_revenue": features_revenue,
    "f10_features_train_fill": features_train_fill,
    "g1_attendance_tier": tier_from_share,
    "g2_demand_baseline": demand_baseline,
    "g3_weather_condition": weather_labels,
    "g4_inventory_recommendation": inventory_recommendation,
    "g5_margin_and_units": partial(margins_and_units, "concessions"),
    "g5_merchandise_margin_and_units": partial(margins_and_units, "merchandise"),
    "g6_team_form": team_form,
    "g7_fan_value_score": fan_value_scores,
    "g8_calendar_flags": lambda t: calendar_flags(t, ADAPTER_PAIRS, ADAPTER_TELEVISED),
    "g9_discounted_spend": discounted_spend,
}
