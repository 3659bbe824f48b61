"""Headline queries timed on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

``_ingest`` is the one-off cost of storing the joined tables, the hub and the per-game roll-ups; the
queries after it read those. Each query's full result goes to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "q01_top_opponents", "q07_underperforming", "q10_price_by_segment_and_tier", "q12_top_ticket_games", "q14_discount_impact",
    "q17_revenue_by_promotion", "q21_concession_per_head", "q26_concession_margins", "q29_loyalty_contribution",
    "q34_game_breakdown", "q35_revenue_split", "q36_top_games", "q39_rivalry_spend", "q40_staffing",
    "v1_game_day_revenue", "v3_ticket_segment_performance", "v7_executive_dashboard", "c18_validate_all",
    "f13_features_full", "g6_team_form", "d2_executive_kpis", "d12_ticket_detail", "n1_describe_revenue", "x3_scenarios",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("venue-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from venue_analytics.plans.registry import all_queries
    from venue_analytics.sources.tables import workspace

    start = time.perf_counter()
    t = workspace(spark, folder)
    for name in (*t.HUB, *t.STORED_FACTS):
        t[name]
    for name in ("tickets_by_game", "concessions_by_game", "merchandise_by_game"):
        t.mart(name)
    times = {"_ingest": round(time.perf_counter() - start, 3)}
    queries = all_queries()
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(folder)}))
    spark.stop()


if __name__ == "__main__":
    main()
