"""Report and dashboard aggregates, one job each, over the shared per-game marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import exact_avg, half_even, half_up, safe_div, sum_d
from ..operators.distribution import correlations, describe, histogram, seeded_sample
from ..operators.distribution import histograms as several_histograms
from ..operators.features import attendance_features, build_features
from ..operators.marts import full_revenue, hub, hub_with_revenue
from .preparation import demand_baseline
from ..operators.segments import BEHAVIOURAL_FEATURES
from .views import _best

FAN_FEATURES = BEHAVIOURAL_FEATURES
CORRELATED = [
    "is_weekend", "rivalry_flag", "nationally_televised_flag", "promotion_flag", "home_team_win_pct_entering_game",
    "away_team_win_pct_entering_game", "home_team_popularity", "away_team_popularity", "temperature_f", "snow_flag",
    "rolling_att_3", "month", "actual_attendance",
]


def _mean_by(df: DataFrame, key: str, value: str, name: str, top: int | None = None) -> DataFrame:
    out = df.groupBy(key).agg(exact_avg(value).alias(name)).orderBy(F.desc_nulls_last(name), key)
    return out if top is None else out.limit(top)


def _weighted_avg(total: str, rows: str) -> Column:
    """Mean over records from per-game sums and counts."""
    return safe_div(F.sum(total), F.sum(rows))


# ---- written reports -----------------------------------------------------------------------------
def game_mart(t) -> DataFrame:
    """Every game with attendance, promotion and revenue; missing revenue counts as zero."""
    return hub_with_revenue(t, "attendance", "promotions").select(
        "game_id", "game_date", "season", "month", "day_of_week", "home_team_name", "away_team_name", "is_weekend", "rivalry_flag",
        "nationally_televised_flag", "promotion_flag", "promotion_type", "actual_attendance", "capacity_pct",
        F.col("ticket_rev").alias("net_ticket_revenue"), "con_rev", "merch_rev", "total_revenue",
    )


def attendance_drivers(t) -> DataFrame:
    """Mean fill with and without each driver, and the lift."""
    drivers = ["is_weekend", "rivalry_flag", "promotion_flag", "nationally_televised_flag"]
    cap = F.col("capacity_pct")
    one = hub(t, "attendance", "promotions").agg(*[
        m for d in drivers for m in (
            exact_avg(F.when(F.col(d), cap)).alias(f"{d}_on"), exact_avg(F.when(~F.col(d), cap)).alias(f"{d}_off"))
    ])
    rows = [F.struct(
        F.lit(d).alias("driver"), F.col(f"{d}_on").alias("avg_capacity_with"), F.col(f"{d}_off").alias("avg_capacity_without"),
        (F.col(f"{d}_on") - F.col(f"{d}_off")).alias("lift")) for d in drivers]
    return one.select(F.inline(F.array(*rows)))


def top_opponents_by_fill(t, n: int = 5) -> DataFrame:
    return _mean_by(hub(t, "attendance"), "away_team_name", "capacity_pct", "avg_capacity_pct", n)


def top_months_by_fill(t) -> DataFrame:
    return _mean_by(hub(t, "attendance"), "month", "capacity_pct", "avg_capacity_pct", 3)


def emptiest_games(t) -> DataFrame:
    return hub(t, "attendance", "promotions").orderBy("capacity_pct", "game_id").limit(5).select(
        "game_id", "game_date", "home_team_name", "away_team_name", "capacity_pct", "promotion_type", "day_of_week")


def segment_totals(t) -> DataFrame:
    return t.records("ticket_sales").groupBy("segment_name").agg(
        sum_d("net_ticket_revenue").alias("total_net_rev"), exact_avg("avg_ticket_price").alias("avg_price"),
        exact_avg("sell_through_rate").alias("avg_st"),
    ).orderBy(F.desc("total_net_rev"))


def promotion_summary(t) -> DataFrame:
    return hub_with_revenue(t, "attendance", "promotions").groupBy("promotion_type").agg(
        F.count("*").alias("games"), exact_avg("capacity_pct").alias("avg_cap"), exact_avg("total_revenue").alias("avg_rev"),
    ).orderBy(F.desc("avg_cap"))


def weekday_promotions(t) -> DataFrame:
    weekday = hub(t, "attendance", "promotions").where(~F.col("is_weekend"))
    return _mean_by(weekday, "promotion_type", "capacity_pct", "avg_cap")


def category_margins(t) -> DataFrame:
    """Margin share of summed revenue, and mean spend per head, per category of both lines."""
    def part(table: str) -> DataFrame:
        return t.records(table).groupBy(F.lit(table).alias("line"), "category").agg(
            sum_d("gross_revenue").alias("revenue"), sum_d("gross_margin").alias("margin"),
            exact_avg("per_cap_spend").alias("avg_per_cap"))

    both = part("concessions").unionByName(part("merchandise"))
    return both.withColumn("margin_pct", half_even(safe_div("margin", "revenue") * 100, 1))


def rivalry_merchandise_lift(t) -> DataFrame:
    """Mean merchandise spend per head of rivalry games minus that of the others; zero if one is missing."""
    per_game = t.records("merchandise").groupBy("game_id").agg(F.sum("per_cap_spend").alias("s"), F.count("per_cap_spend").alias("n"))
    df = per_game.join(t["games"].select("game_id", "rivalry_flag"), "game_id")
    mean = lambda on: safe_div(F.sum(F.when(on, F.col("s"))), F.sum(F.when(on, F.col("n"))))
    means = df.agg(mean(F.col("rivalry_flag")).alias("rivalry"), mean(~F.col("rivalry_flag")).alias("regular"))
    return means.select("rivalry", "regular", F.coalesce(F.col("rivalry") - F.col("regular"), F.lit(0.0)).alias("lift"))


def loyalty_profile(t) -> DataFrame:
    return t["fan_profiles"].groupBy("loyalty_status").agg(
        F.count("*").alias("fans"), exact_avg("avg_ticket_spend").alias("avg_ticket"), exact_avg("avg_concession_spend").alias("avg_con"),
        exact_avg("avg_merchandise_spend").alias("avg_merch"), exact_avg("games_attended_last_12_months").alias("avg_games"),
        exact_avg("promotion_usage_rate").alias("avg_promo"),
    ).orderBy(F.desc("avg_ticket"))


def top_loyalty_tier(t) -> DataFrame:
    return _best(t["fan_profiles"], "loyalty_status", "avg_ticket_spend").withColumnRenamed("loyalty_status", "top_loyalty")


def canned_scenarios(t) -> DataFrame:
    """The report's three worked examples."""
    revenue = hub_with_revenue(t, "attendance", "promotions").agg(exact_avg("total_revenue")).scalar()
    base = t["attendance"].agg(exact_avg("actual_attendance").alias("att"), exact_avg("arena_capacity").alias("cap")).withColumn("rev", revenue)
    att, cap, rev = F.col("att"), F.col("cap"), F.col("rev")
    none = F.lit(None).cast("double")
    row = lambda name, a, b, c, d: F.struct(
        F.lit(name).alias("scenario"), a.alias("baseline_attendance"), b.alias("projected_attendance"),
        c.alias("baseline_revenue"), d.alias("projected_revenue"))
    return base.select(F.inline(F.array(
        row("Merchandise giveaway on a weak weekday", att * 0.72, att * 0.72 * 1.09, rev * 0.85, rev * 0.85 * 1.09),
        row("Rivalry game with higher prices", att, F.least(att * 1.07, cap), none, none),
        row("Ten percent attendance drop", att, att * 0.90, none, none))))


def executive_summary(t) -> DataFrame:
    """Totals and revenue shares, each fact summed on its own."""
    total = lambda mart, c: t.mart(mart).agg(F.coalesce(F.sum(c), F.lit(0))).scalar()
    games = t["games"].agg(F.count("*").alias("n")).scalar()
    df = t["attendance"].agg(F.sum("actual_attendance").alias("total_attendance"), exact_avg("capacity_pct").alias("avg_capacity_pct")).select(
        games.alias("total_games"), "*", total("tickets_by_game", "ticket_rev").alias("a"),
        total("concessions_by_game", "con_rev").alias("b"), total("merchandise_by_game", "merch_rev").alias("c"))
    whole = F.col("a") + F.col("b") + F.col("c")
    d = lambda c: F.col(c).cast("double")
    return df.select(
        "total_games", "total_attendance", "avg_capacity_pct", d("a").alias("ticket_revenue"), d("b").alias("concession_revenue"),
        d("c").alias("merchandise_revenue"), whole.cast("double").alias("total_revenue"),
        *[half_up(safe_div(c, whole) * 100, 1).alias(n) for c, n in (("a", "ticket_share_pct"), ("b", "concession_share_pct"), ("c", "merch_share_pct"))])


# ---- dashboard: landing, executive ---------------------------------------------------------------
def landing_kpis(t) -> DataFrame:
    att = t["attendance"].agg(F.struct(F.sum("actual_attendance").alias("a"), exact_avg("capacity_pct").alias("c"))).scalar()
    tickets = t.mart("tickets_by_game").agg(F.sum("ticket_rev")).scalar()
    df = t["games"].agg(F.count("*").alias("total_games"), F.count_distinct("season").alias("seasons"))
    df = df.withColumn("x", att).withColumn("rev", tickets)
    return df.select(
        "total_games", "seasons", F.col("x.a").alias("total_attendance"), F.col("x.c").alias("avg_capacity_pct"),
        F.col("rev").cast("double").alias("ticket_revenue"), rules.compact_currency("rev").alias("ticket_revenue_label"),
        rules.pct_label("x.c").alias("avg_capacity_label"))


def executive_kpis(t) -> DataFrame:
    """The dashboard's headline numbers, every record counted once."""
    df = hub_with_revenue(t, "attendance")
    opponent = _best(hub(t, "attendance"), "away_team_name", "capacity_pct").scalar()
    loyalty = _best(t["fan_profiles"], "loyalty_status", "fan_value_score").scalar()
    totals = df.agg(
        F.count("*").alias("total_games"), F.sum("actual_attendance").alias("total_attendance"),
        exact_avg("capacity_pct").alias("avg_capacity_pct"), sum_d("ticket_rev").alias("ticket_revenue"),
        sum_d("con_rev").alias("concession_revenue"), sum_d("merch_rev").alias("merchandise_revenue"),
        sum_d("total_revenue").alias("total_revenue"),
        half_up(F.avg(safe_div("total_revenue", "actual_attendance")), 2).alias("avg_revenue_per_attendee"))
    return totals.withColumns({"top_opponent": opponent, "top_loyalty": loyalty}).select(
        "*", rules.compact_currency("total_revenue").alias("total_revenue_label"), rules.shorten("top_loyalty", 16).alias("top_loyalty_label"))


def monthly_revenue_long(t) -> DataFrame:
    """period, revenue_type, revenue: monthly sums by season, unpivoted and relabelled."""
    sums = hub_with_revenue(t, "attendance").groupBy("season", "month").agg(
        sum_d("ticket_rev").alias("Tickets"), sum_d("con_rev").alias("Concessions"), sum_d("merch_rev").alias("Merchandise"))
    period = F.concat(F.col("season").cast("string"), F.lit("-M"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("period")
    wide = sums.select(period, "Tickets", "Concessions", "Merchandise")
    return wide.unpivot("period", ["Tickets", "Concessions", "Merchandise"], "revenue_type", "revenue").orderBy("period")


def top_revenue_games(t) -> DataFrame:
    out = hub_with_revenue(t, "attendance").orderBy(F.desc("total_revenue"), "game_id").limit(10)
    label = F.concat(F.substring("away_team_name", 1, 12), F.lit(" ("), F.date_format("game_date", "MM/dd"), F.lit(")"))
    return out.select("game_id", "game_date", "home_team_name", "away_team_name", "total_revenue", "capacity_pct", label.alias("label"))


# ---- dashboard: forecast -------------------------------------------------------------------------
def forecast_frame(t, predictions: DataFrame | None = None) -> DataFrame:
    """Games with predicted attendance: a model's where given, else the stored baseline.

    attendance_prediction_error keeps the source's two signs (predicted minus actual with a model, actual
    minus baseline without); actual_minus_predicted always has one. The underperforming flag is the
    source's: error below minus eight percent of actual; games without a prediction are not flagged.
    """
    df = hub(t, "attendance").join(t["promotions"].select("game_id", "promotion_type", "promotion_flag"), "game_id", "left")
    if predictions is None:
        df = df.withColumn("predicted_attendance", F.col("expected_attendance_baseline"))
        df = df.withColumn("attendance_prediction_error", F.col("actual_attendance") - F.col("predicted_attendance"))
    else:
        df = df.join(predictions.select("game_id", "predicted_attendance", "attendance_prediction_error"), "game_id", "left")
    # -(actual * 0.08), compared in whole hundredths so the bound is exact.
    low = F.col("attendance_prediction_error").cast("bigint") * 100 < F.col("actual_attendance").cast("bigint") * -8
    return df.select(
        "game_id", "game_date", "season", "home_team_name", "away_team_name", "day_of_week", "month", "actual_attendance",
        "predicted_attendance", "attendance_prediction_error",
        (F.col("actual_attendance") - F.col("predicted_attendance")).alias("actual_minus_predicted"),
        F.coalesce(low, F.lit(False)).alias("underperforming"), "capacity_pct", "attendance_tier", "promotion_type")


def worst_misses(t, predictions: DataFrame | None = None) -> DataFrame:
    df = forecast_frame(t, predictions).where("underperforming")
    return df.orderBy("attendance_prediction_error", "game_id").limit(30).select(
        "game_id", "game_date", "home_team_name", "away_team_name", "actual_attendance", "predicted_attendance",
        "attendance_prediction_error", "capacity_pct", "attendance_tier", "promotion_type", "day_of_week")


def forecast_kpis(t, predictions: DataFrame | None = None) -> DataFrame:
    return forecast_frame(t, predictions).agg(
        exact_avg("actual_attendance").alias("avg_actual"), exact_avg("predicted_attendance").alias("avg_predicted"),
        exact_avg(F.abs("attendance_prediction_error")).alias("mae"), exact_avg("capacity_pct").alias("avg_capacity_pct"),
        F.count_if("underperforming").alias("underperforming_games"))


def demand_predictions(t) -> DataFrame:
    """The demand baseline as a prediction table, its error predicted minus actual as a model's."""
    return demand_baseline(t).select(
        "game_id", F.col("expected_attendance").cast("int").alias("predicted_attendance"),
        (-F.col("variance")).cast("int").alias("attendance_prediction_error"))


def attendance_by_weekday(t) -> DataFrame:
    df = hub(t, "attendance").groupBy("day_of_week").agg(exact_avg("actual_attendance").alias("avg_attendance"))
    return df.withColumn("day_number", rules.dow_ordinal("day_of_week")).orderBy("day_number")


def attendance_by_month(t) -> DataFrame:
    df = hub(t, "attendance").groupBy("month").agg(exact_avg("actual_attendance").alias("avg_attendance"))
    return df.withColumn("month_name", rules.month_abbr("month")).orderBy("month")


def attendance_by_opponent(t) -> DataFrame:
    return _mean_by(hub(t, "attendance"), "away_team_name", "actual_attendance", "avg_attendance", 15)


def forecast_sample(t) -> DataFrame:
    """At most 800 games for a scatter plot, always the same ones."""
    return seeded_sample(forecast_frame(t), "game_id", 800).select("game_id", "actual_attendance", "predicted_attendance", "attendance_tier")


# ---- dashboard: tickets --------------------------------------------------------------------------
def ticket_kpis(t) -> DataFrame:
    by_segment = t.records("ticket_sales").groupBy("segment_name").agg(
        F.sum("net_ticket_revenue").alias("rev"), exact_avg("sell_through_rate").alias("st"),
        F.sum("avg_ticket_price").alias("price"), F.count("avg_ticket_price").alias("price_n"))
    first = lambda c: by_segment.orderBy(F.desc_nulls_last(c), "segment_name").limit(1).select("segment_name").scalar()
    per_game = t.mart("tickets_by_game").agg(exact_avg("ticket_rev")).scalar()
    return by_segment.agg(sum_d("rev").alias("total_net_revenue"), _weighted_avg("price", "price_n").alias("avg_ticket_price")).select(
        "*", per_game.alias("avg_revenue_per_game"), first("rev").alias("best_segment"), first("st").alias("best_sell_through_segment"))


def ticket_revenue_by_opponent(t) -> DataFrame:
    df = t["games"].join(t.mart("tickets_by_game"), "game_id").groupBy("away_team_name").agg(sum_d("ticket_rev").alias("net_revenue"))
    return df.orderBy(F.desc("net_revenue"), "away_team_name").limit(12)


def ticket_revenue_by_promotion(t) -> DataFrame:
    """Mean revenue of a ticket record by promotion type."""
    df = t["promotions"].select("game_id", "promotion_type").join(t.mart("tickets_by_game"), "game_id")
    return df.groupBy("promotion_type").agg(_weighted_avg("ticket_rev", "ticket_rows").alias("avg_net_revenue")).orderBy(F.desc("avg_net_revenue"))


def ticket_detail(t) -> DataFrame:
    """Two hundred game and segment combinations with the highest revenue."""
    parts = t.records("ticket_sales").groupBy("game_id", "segment_name").agg(
        F.sum("tickets_sold").alias("tickets_sold"), exact_avg("avg_ticket_price").alias("price"),
        F.sum("net_ticket_revenue").alias("rev"), exact_avg("sell_through_rate").alias("st"))
    # The games join drops nothing from the top list's order, so the cut comes after it.
    df = parts.join(t["games"].select("game_id", "game_date", "away_team_name"), "game_id")
    return df.orderBy(F.desc("rev"), "game_id", "segment_name").limit(200).select(
        "game_id", "game_date", "away_team_name", "segment_name", "tickets_sold", half_even("price", 2).alias("avg_ticket_price"),
        half_even(F.col("rev").cast("double"), 0).alias("net_ticket_revenue"), half_even("st", 1).alias("sell_through_rate"))


def discount_sample(t) -> DataFrame:
    """At most 2,000 ticket records for a scatter plot, always the same ones: the seeded sample by record id,
    which depends on the rows alone (portable: the statement draws the same)."""
    df = t["ticket_sales"].select("ticket_sale_id", "game_id", "segment_name", "discount_pct", "net_ticket_revenue")
    return seeded_sample(df, "ticket_sale_id", 2000).select(
        "game_id", "segment_name", F.col("discount_pct").cast("double").alias("discount_pct"),
        F.col("net_ticket_revenue").cast("double").alias("net_ticket_revenue"))


# ---- dashboard: concessions and merchandise ------------------------------------------------------
def _line_by_game(t, mart: str, short: str) -> DataFrame:
    venue = t["attendance"].select("game_id", "actual_attendance", "capacity_pct", "attendance_tier")
    df = t.mart(mart).join(venue, "game_id", "left")
    return df.select(
        "game_id", F.col(f"{short}_rev").cast("double").alias("revenue"), F.col(f"{short}_margin").cast("double").alias("margin"),
        F.col(f"{short}_units").alias("units"), F.col(f"{short}_inventory").alias("inventory"), "actual_attendance", "capacity_pct",
        "attendance_tier", safe_div(f"{short}_rev", "actual_attendance").alias("per_cap"))


def concession_games(t) -> DataFrame:
    return _line_by_game(t, "concessions_by_game", "con")


def merchandise_games(t) -> DataFrame:
    return _line_by_game(t, "merchandise_by_game", "merch")


def ancillary_kpis(t) -> DataFrame:
    """Revenue, mean of per-game spend per head and best category of both lines."""
    def part(line: str, games: DataFrame, fact: DataFrame) -> DataFrame:
        best = fact.groupBy("category").agg(F.sum("gross_revenue").alias("r")).orderBy(F.desc("r"), "category").limit(1).select("category").scalar()
        return games.agg(
            F.lit(line).alias("line"), F.sum(F.col("revenue").cast("decimal(38,2)")).cast("double").alias("total_revenue"),
            half_up(F.avg("per_cap"), 6).alias("avg_per_cap")).withColumn("top_category", best)

    return part("concessions", concession_games(t), t.records("concessions")).unionByName(part("merchandise", merchandise_games(t), t.records("merchandise")))


def category_totals(t) -> DataFrame:
    part = lambda table: t.records(table).groupBy(F.lit(table).alias("line"), "category").agg(
        sum_d("gross_revenue").alias("gross_revenue"), sum_d("gross_margin").alias("gross_margin"))
    return part("concessions").unionByName(part("merchandise")).orderBy(F.desc("gross_revenue"))


def per_cap_by_tier(t) -> DataFrame:
    """Mean concession spend per head of a record by demand tier and category, in tier order."""
    parts = t.records("concessions").groupBy("game_id", "category").agg(F.sum("gross_revenue").alias("rev"), F.count("*").alias("n"))
    df = parts.join(t["attendance"].select("game_id", "attendance_tier", "actual_attendance"), "game_id")
    df = df.where(F.col("actual_attendance") != 0)
    out = df.groupBy("attendance_tier", "category").agg(
        half_up(F.sum(safe_div("rev", "actual_attendance")) / F.sum("n"), 6).alias("per_cap"))
    return out.withColumn("tier_number", rules.tier_order("attendance_tier")).orderBy("tier_number", "category")


def _inventory(t) -> DataFrame:
    con = concession_games(t).select(
        "game_id", "attendance_tier", "actual_attendance", F.col("revenue").alias("con_rev"), F.col("per_cap").alias("con_per_cap"), F.col("inventory").alias("con_inventory"))
    mer = merchandise_games(t).select("game_id", F.col("revenue").alias("merch_rev"), F.col("per_cap").alias("merch_per_cap"), F.col("inventory").alias("merch_inventory"))
    games = t["games"].select("game_id", "away_team_name", "game_date", "rivalry_flag")
    return con.join(mer, "game_id").join(games, "game_id").withColumn("game_label", F.substring("away_team_name", 1, 10))


def top_inventory_games(t) -> DataFrame:
    return _inventory(t).orderBy(F.desc("con_inventory"), "game_id").limit(15).select("game_id", "game_label", "attendance_tier", "con_inventory")


def inventory_summary(t) -> DataFrame:
    df = _inventory(t).orderBy(F.desc("con_rev"), "game_id").limit(100)
    return df.select(
        "game_id", "game_date", "game_label", "actual_attendance", "attendance_tier", half_even("con_rev", 0).alias("con_rev"),
        half_even("con_per_cap", 2).alias("con_per_cap"), "con_inventory", half_even("merch_rev", 0).alias("merch_rev"),
        half_even("merch_per_cap", 2).alias("merch_per_cap"), "merch_inventory")


# ---- dashboard: fans -----------------------------------------------------------------------------
def with_segment(fans: DataFrame) -> DataFrame:
    """segment: the clustered segment where the frame has one, else the loyalty status."""
    return fans.withColumn("segment", F.col("fan_segment" if "fan_segment" in fans.columns else "loyalty_status"))


def segment_kpis(t, fans: DataFrame | None = None) -> DataFrame:
    df = with_segment(t["fan_profiles"] if fans is None else fans)
    best = _best(df, "segment", "fan_value_score").scalar()
    return df.agg(
        F.count("*").alias("total_fans"), exact_avg("fan_value_score").alias("avg_value"),
        (exact_avg("promotion_usage_rate") * 100).alias("avg_promo_pct"),
        (exact_avg((F.col("games_attended_last_12_months") >= 5).cast("int")) * 100).alias("repeat_pct"),
    ).withColumn("best_segment", best)


def segment_summary(t, fans: DataFrame | None = None) -> DataFrame:
    df = with_segment(t["fan_profiles"] if fans is None else fans)
    out = df.groupBy("segment").agg(
        F.count("fan_id").alias("fan_count"), exact_avg("games_attended_last_12_months").alias("avg_games"),
        exact_avg("avg_ticket_spend").alias("avg_ticket"), exact_avg("avg_concession_spend").alias("avg_concession"),
        exact_avg("avg_merchandise_spend").alias("avg_merch"), exact_avg("promotion_usage_rate").alias("avg_promo"),
        exact_avg("email_engagement_score").alias("avg_email"), exact_avg("fan_value_score").alias("avg_value"))
    return out.withColumn("avg_total_spend", F.col("avg_ticket") + F.col("avg_concession") + F.col("avg_merch")).orderBy(F.desc("avg_value"))


def segment_spend_long(t, fans: DataFrame | None = None) -> DataFrame:
    wide = segment_summary(t, fans).select(
        "segment", F.col("avg_ticket").alias("Tickets"), F.col("avg_concession").alias("Concessions"), F.col("avg_merch").alias("Merchandise"))
    return wide.unpivot("segment", ["Tickets", "Concessions", "Merchandise"], "category", "avg_spend").orderBy(F.desc("avg_spend"))


# ---- notebooks -----------------------------------------------------------------------------------
def describe_attendance(t) -> DataFrame:
    return describe(t["attendance"], ["actual_attendance", "capacity_pct"])


def describe_fans(t) -> DataFrame:
    return describe(t["fan_profiles"], FAN_FEATURES)


def describe_revenue(t) -> DataFrame:
    df = hub_with_revenue(t).where(F.col("total_revenue") > 0)
    return describe(df.select(F.col("total_revenue").cast("decimal(18,2)").alias("total_game_day_revenue")), ["total_game_day_revenue"])


def tier_distribution(t) -> DataFrame:
    df = t["attendance"].groupBy("attendance_tier").agg(F.count("*").alias("games"))
    return df.orderBy(F.desc("games"), "attendance_tier")


def histograms(t) -> DataFrame:
    """Fill (30 bins), baseline error (40), revenue (50) and every fan feature (30)."""
    # Joins that a range pass and a bin pass read, kept as one column each.
    error = t.keep("forecast_errors", lambda: forecast_frame(t).select(F.col("attendance_prediction_error")))
    revenue = t.keep("game_day_revenue", lambda: hub_with_revenue(t).where(F.col("total_revenue") > 0).select(F.col("total_revenue").alias("total_game_day_revenue")))
    parts = [histogram(t["attendance"], "capacity_pct", 30), histogram(error, "attendance_prediction_error", 40), histogram(revenue, "total_game_day_revenue", 50)]
    parts.append(several_histograms(t["fan_profiles"], [(c, 30) for c in FAN_FEATURES]))  # one range pass, one bin pass
    return reduce(DataFrame.unionByName, parts)


def feature_correlations(t) -> DataFrame:
    return correlations(attendance_features(build_features(t)), CORRELATED)


def monthly_mean_revenue(t) -> DataFrame:
    return full_revenue(t, "attendance", "promotions").groupBy("month").agg(
        exact_avg("ticket_rev").alias("net_ticket_revenue"), exact_avg("con_rev").alias("con_rev"), exact_avg("merch_rev").alias("merch_rev")).orderBy("month")


def revenue_shares(t) -> DataFrame:
    s = full_revenue(t, "attendance", "promotions").agg(F.sum("ticket_rev").alias("a"), F.sum("con_rev").alias("b"), F.sum("merch_rev").alias("c"))
    whole = F.col("a") + F.col("b") + F.col("c")
    rows = [F.struct(F.lit(n).alias("revenue_type"), F.col(c).cast("double").alias("revenue"), half_up(safe_div(c, whole) * 100, 1).alias("share_pct"))
            for c, n in (("a", "net_ticket_revenue"), ("b", "con_rev"), ("c", "merch_rev"))]
    return s.select(F.inline(F.array(*rows)))


def normalised_profile(t, fans: DataFrame | None = None) -> DataFrame:
    """Segment means rounded to cents and scaled to 0..1 across segments."""
    df = with_segment(t["fan_profiles"] if fans is None else fans)
    means = df.groupBy("segment").agg(*[half_even(exact_avg(c), 2).alias(c) for c in FAN_FEATURES])
    every = W.partitionBy()  # one row per segment
    scaled = lambda c: (F.col(c) - F.min(c).over(every)) / F.nullif(F.max(c).over(every) - F.min(c).over(every), F.lit(0.0))
    return means.select("segment", *[scaled(c).alias(c) for c in FAN_FEATURES])


QUERIES = {
    "r1_game_mart": game_mart,
    "r2_attendance_drivers": attendance_drivers,
    "r3_top_opponents": top_opponents_by_fill,
    "r3_top_months": top_months_by_fill,
    "r3_emptiest_games": emptiest_games,
    "r4_segment_totals": segment_totals,
    "r5_promotion_summary": promotion_summary,
    "r5_weekday_promotions": weekday_promotions,
    "r6_category_margins": category_margins,
    "r7_rivalry_merchandise_lift": rivalry_merchandise_lift,
    "r8_loyalty_profile": loyalty_profile,
    "r8_top_loyalty_tier": top_loyalty_tier,
    "r9_canned_scenarios": canned_scenarios,
    "r10_executive_summary": executive_summary,
    "d1_landing_kpis": landing_kpis,
    "d2_executive_kpis": executive_kpis,
    "d3_monthly_revenue_long": monthly_revenue_long,
    "d4_top_revenue_games": top_revenue_games,
    "d4_top_opponents": lambda t: top_opponents_by_fill(t, 10),
    "d5_forecast_frame": forecast_frame,
    "d6_worst_misses": worst_misses,
    "d7_forecast_kpis": forecast_kpis,
    "d5_forecast_frame_scored": lambda t: forecast_frame(t, demand_predictions(t)),
    "d6_worst_misses_scored": lambda t: worst_misses(t, demand_predictions(t)),
    "d7_forecast_kpis_scored": lambda t: forecast_kpis(t, demand_predictions(t)),
    "d8_attendance_by_weekday": attendance_by_weekday,
    "d8_attendance_by_month": attendance_by_month,
    "d8_attendance_by_opponent": attendance_by_opponent,
    "d9_forecast_sample": forecast_sample,
    "d9_discount_sample": discount_sample,
    "d10_ticket_kpis": ticket_kpis,
    "d11_revenue_by_opponent": ticket_revenue_by_opponent,
    "d11_revenue_by_promotion": ticket_revenue_by_promotion,
    "d12_ticket_detail": ticket_detail,
    "d13_concession_games": concession_games,
    "d13_merchandise_games": merchandise_games,
    "d13_ancillary_kpis": ancillary_kpis,
    "d14_category_totals": category_totals,
    "d15_per_cap_by_tier": per_cap_by_tier,
    "d16_top_inventory_games": top_inventory_games,
    "d16_inventory_summary": inventory_summary,
    "d18_segment_kpis": segment_kpis,
    "d19_segment_summary": segment_summary,
    "d19_segment_spend_long": segment_spend_long,
    "n1_describe_attendance": describe_attendance,
    "n1_describe_fans": describe_fans,
    "n1_describe_revenue": describe_revenue,
    "n1_tier_distribution": tier_distribution,
    "n2_histograms": histograms,
    "n3_correlations": feature_correlations,
    "n4_monthly_mean_revenue": monthly_mean_revenue,
    "n4_revenue_shares": revenue_shares,
    "n5_normalised_profile": normalised_profile,
}
