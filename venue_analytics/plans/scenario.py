"""What-if scenarios: a table of assumptions evaluated against the data's baselines in one job.

A scenario row holds scenario_id and five percent changes: att_change, price_change, promo_lift,
con_change and merch_change. Baselines are one-row aggregates attached as scalar subqueries, so nothing
is cross-joined and any number of scenarios is a single projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import exact_avg, safe_div

RESULT = [
    "scenario_id", "projected_attendance", "projected_capacity_pct", "ticket_revenue", "concession_revenue",
    "merchandise_revenue", "total_revenue", "revenue_change", "revenue_change_pct", "staffing_level",
    "inventory_buffer", "concession_inventory", "merchandise_inventory",
]


def baselines(t) -> DataFrame:
    """One row: mean attendance, capacity and fill, revenue per game and per head, mean unit prices."""
    venue = t["attendance"].agg(
        exact_avg("actual_attendance").alias("avg_att"), exact_avg("arena_capacity").alias("avg_cap"),
        exact_avg("capacity_pct").alias("avg_cap_pct"),
    )
    per_game = lambda mart, rev: t.mart(mart).agg(exact_avg(rev)).scalar()
    price = lambda table, column: t.records(table).agg(exact_avg(column)).scalar()
    df = venue.select(
        "*", per_game("tickets_by_game", "ticket_rev").alias("avg_ticket_rev"),
        price("ticket_sales", "avg_ticket_price").alias("avg_ticket_price"),
        per_game("concessions_by_game", "con_rev").alias("avg_con_rev"),
        per_game("merchandise_by_game", "merch_rev").alias("avg_merch_rev"),
        price("concessions", "avg_unit_price").alias("con_unit_price"),
        price("merchandise", "avg_unit_price").alias("merch_unit_price"),
    )
    head = lambda c: F.coalesce(safe_div(c, "avg_att"), F.lit(0.0))
    return df.select(
        "*", head("avg_con_rev").alias("con_per_cap"), head("avg_merch_rev").alias("merch_per_cap"),
        (F.col("avg_ticket_rev") + F.col("avg_con_rev") + F.col("avg_merch_rev")).alias("total_baseline"),
    )


def _pct(c: str) -> Column:
    return F.lit(1.0) + F.col(c).cast("double") / F.lit(100.0)


def _or_default(c: Column, default: float) -> Column:
    """A mean price of zero falls back to a default; a missing one stays missing."""
    return F.when(c == 0, F.lit(default)).otherwise(c)


def _projected(scenario_df: DataFrame, b: Column) -> DataFrame:
    """Scenarios with the baseline struct, projected attendance and fill (capped at 100; attendance is not)."""
    lift = F.lit(1.0) + (F.col("att_change") + F.col("promo_lift")).cast("double") / F.lit(100.0)
    df = scenario_df.withColumn("b", b).withColumn("projected_attendance", F.col("b.avg_att") * lift)
    full = safe_div("projected_attendance", "b.avg_cap") * 100.0
    fill = F.least(F.coalesce(full, F.col("b.avg_cap_pct")), F.lit(100.0))
    df = df.withColumn("projected_capacity_pct", fill)
    return df.withColumn("inventory_buffer", rules.scenario_buffer("projected_capacity_pct"))


def _baseline_struct(t) -> Column:
    frame = baselines(t)
    return frame.select(F.struct(*frame.columns)).scalar()


def scenarios(t, scenario_df: DataFrame) -> DataFrame:
    """Projected attendance, revenue, staffing and inventory of every scenario."""
    df = _projected(scenario_df, _baseline_struct(t))
    ratio = F.coalesce(safe_div("projected_attendance", "b.avg_att"), F.lit(1.0))
    df = df.withColumns({
        "ticket_revenue": F.col("b.avg_ticket_rev") * ratio * _pct("price_change"),
        "concession_revenue": F.col("b.avg_con_rev") * _pct("con_change") * ratio,
        "merchandise_revenue": F.col("b.avg_merch_rev") * _pct("merch_change") * ratio,
        "staffing_level": rules.staffing_level("projected_capacity_pct"),
    })
    df = df.withColumn("total_revenue", F.col("ticket_revenue") + F.col("concession_revenue") + F.col("merchandise_revenue"))
    df = df.withColumn("revenue_change", F.col("total_revenue") - F.col("b.total_baseline"))
    change = F.when(F.col("b.total_baseline") > 0, safe_div("revenue_change", "b.total_baseline") * 100.0).otherwise(0.0)

    def stock(head: str, price: str, default: float) -> Column:
        units = F.col("projected_attendance") * (F.col(f"b.{head}") / _or_default(F.col(f"b.{price}"), default))
        return (units * F.col("inventory_buffer")).cast("bigint")

    df = df.withColumns({
        "revenue_change_pct": change,
        "concession_inventory": stock("con_per_cap", "con_unit_price", 10.0),
        "merchandise_inventory": stock("merch_per_cap", "merch_unit_price", 30.0),
    })
    return df.select(*RESULT)


def category_baselines(t) -> DataFrame:
    """label, per_cap and unit_price per concession and merchandise category."""
    def part(table: str, prefix: str, default: float) -> DataFrame:
        means = t.records(table).groupBy("category").agg(
            exact_avg("per_cap_spend").alias("per_cap"), exact_avg("avg_unit_price").alias("price"))
        return means.select(
            F.concat(F.lit(prefix), "category").alias("label"), "per_cap", _or_default(F.col("price"), default).alias("unit_price"))

    return part("concessions", "Con: ", 10.0).unionByName(part("merchandise", "Merch: ", 30.0))


def scenario_inventory(t, scenario_df: DataFrame) -> DataFrame:
    """Recommended units per scenario and category."""
    # One entry per product category, attached as an array and unfolded per scenario.
    menu = category_baselines(t).agg(F.sort_array(F.collect_list(F.struct("label", "per_cap", "unit_price")))).scalar()
    df = _projected(scenario_df, _baseline_struct(t)).withColumn("item", F.explode(menu))
    units = F.col("projected_attendance") * (F.col("item.per_cap") / F.col("item.unit_price")) * F.col("inventory_buffer")
    return df.select("scenario_id", F.col("item.label").alias("category"), units.cast("bigint").alias("recommended_units"))


def part_scenarios(t) -> DataFrame:
    """One scenario per part key: percent changes inside the calculator's input ranges."""
    key = F.col("p_partkey")
    return t.adapter.source("part").select(
        key.alias("scenario_id"), (key % 41 - 20).alias("att_change"), (key * 7 % 41 - 20).alias("price_change"),
        (key * 3 % 26).alias("promo_lift"), (key * 11 % 51 - 20).alias("con_change"), (key * 13 % 51 - 20).alias("merch_change"),
    )


QUERIES = {
    "x1_baselines": baselines,
    "x3_scenarios": lambda t: scenarios(t, part_scenarios(t)),
    "x7_category_baselines": category_baselines,
    "x7_scenario_inventory": lambda t: scenario_inventory(t, part_scenarios(t)),
}
