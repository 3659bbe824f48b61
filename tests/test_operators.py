"""Operators on small fixtures, against hand-computed or brute-force results."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from venue_analytics.operators import distribution, features, forecast, quality, segments
from venue_analytics.operators.lagged import lagged_means, with_slices
from venue_analytics.operators.positions import dense_numbers, positions
from venue_analytics.sources.schemas import SCHEMAS
from venue_analytics.operators.ranking import dense_rank_desc
from venue_analytics.plans import ancillary, attendance, executive, insights, scenario, views

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


# ---- lagged means --------------------------------------------------------------------------------
def lagged(spark, rows, n=3, max_rows=1_000_000):
    df = spark.createDataFrame(rows, "team int, d date, id bigint, v int")
    out = lagged_means(df, "team", "d", "id", {"m": ("v", n)}, max_rows)
    return {r["id"]: r["m"] for r in out.collect()}


def test_lagged_first_partial_and_null(spark):
    rows = [(1, day(0), 1, 10), (1, day(1), 2, None), (1, day(2), 3, 40), (1, day(3), 4, 7)]
    assert lagged(spark, rows) == {1: None, 2: 10.0, 3: 10.0, 4: 25.0}


def test_lagged_same_day_orders_by_id(spark):
    assert lagged(spark, [(1, day(0), 5, 1), (1, day(0), 2, 9)]) == {2: None, 5: 9.0}


@pytest.mark.parametrize("max_rows", [1, 2, 3, 7, 50])
def test_lagged_slices_equal_one_window(spark, max_rows):
    """One team holds most rows and one date is crowded; every slicing gives the brute-force answer."""
    rng = random.Random(3)
    rows = [(0 if rng.random() < 0.8 else rng.randint(1, 3), day(0 if rng.random() < 0.3 else rng.randint(0, 9)), i, rng.choice([None, rng.randint(0, 99)])) for i in range(160)]
    want = {}
    for team in range(4):
        mine = sorted((r for r in rows if r[0] == team), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(mine):
            prior = [p[3] for p in mine[max(0, i - 5):i] if p[3] is not None]
            want[r[2]] = sum(prior) / len(prior) if prior else None
    assert lagged(spark, rows, 5, max_rows) == want


def test_positions_exact_with_a_crowded_date_and_a_far_outlier_id(spark):
    """One key holds a crowded date and an id far beyond the rest: places stay exact, slices stay bounded."""
    rows = [(0, day(0), i) for i in range(3000)] + [(0, day(0), 10**15), (0, day(1), 5), (1, day(0), 7), (None, day(2), 1), (None, day(2), 2)]
    df = spark.createDataFrame(rows, "team int, d date, id bigint")
    got = {(r["team"], r["id"]): r["_pos"] for r in positions(df, "team", ["d", "id"], parts=8).collect()}
    want = {}
    for team in {r[0] for r in rows}:
        for place, r in enumerate(sorted((r for r in rows if r[0] == team), key=lambda r: (r[1], r[2]))):
            want[(team, r[2])] = place
    assert got == want
    sizes = with_slices(df, "team", "d", "id", 500, 5).groupBy("team", "_slice").count().collect()
    assert max(r["count"] for r in sizes) <= 505 and len(sizes) >= 7


def test_positions_shuffle_the_rows_once(spark):
    """The numbered rows join the written, small frame of offsets by broadcast, without a second shuffle."""
    df = spark.createDataFrame([(i % 3, i) for i in range(50)], "k int, v int")
    plan = positions(df, "k", ["v"], parts=4)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_lagged_means_of_decimals_share_one_sort(spark):
    df = spark.sql("SELECT 1 AS team, DATE '2020-01-01' AS d, id, CAST(if(id = 2, NULL, id / 4) AS decimal(12,2)) AS v, CAST(id AS int) AS w FROM range(6)")
    out = lagged_means(df, "team", "d", "id", {"a": ("v", 2), "b": ("w", 3)})
    assert [(r["a"], r["b"]) for r in out.orderBy("id").collect()] == [
        (None, None), (0.0, 0.0), (0.125, 0.5), (0.25, 1.0), (0.75, 2.0), (0.875, 3.0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Union" not in plan and plan.count("Window ") == 1


def test_lagged_means_with_an_outlier_id_equal_one_window(spark):
    rows = [(0, day(0), i, i % 7) for i in range(300)] + [(0, day(0), 10**12, 50), (0, day(1), 3, 9)]
    mine = sorted(rows, key=lambda r: (r[1], r[2]))
    want = {}
    for i, r in enumerate(mine):
        prior = [p[3] for p in mine[max(0, i - 4):i]]
        want[r[2]] = sum(prior) / len(prior) if prior else None
    assert lagged(spark, rows, 4, 16) == want


# ---- ranking -------------------------------------------------------------------------------------
@pytest.mark.parametrize("single", [False, True])
def test_dense_rank_of_crowded_keys(spark, single):
    """One key holds most rows (and, in the second case, most of them one value); ranks equal a plain window."""
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.7 else rng.randint(1, 4), rng.choice([None, rng.randint(0, 40)]), i) for i in range(200)]
    if single:
        rows += [(5, 7, 1000 + i) for i in range(300)] + [(5, None, 2000), (None, 3, 2001), (None, 4, 2002)]
    df = spark.createDataFrame(rows, "k int, v int, id int")
    names = spark.createDataFrame([(k, f"n{k}") for k in [*range(6), None]], "k int, label string")
    got = {r["id"]: (r["r"], r["label"]) for r in dense_rank_desc(df, "k", "v", "r", attributes=names).collect()}
    want = {}
    for k in range(6):
        values = sorted({v for kk, v, _ in rows if kk == k}, key=lambda v: (v is not None, -(v or 0)))
        want.update({i: (values.index(v) + 1, f"n{k}") for kk, v, i in rows if kk == k})
    assert got == want


# ---- distribution --------------------------------------------------------------------------------
def test_exact_quantiles_with_a_far_outlier(spark):
    """One value of 2^60 beside many small ones: the descent narrows to single values, results exact."""
    x = [i % 977 for i in range(20000)] + [2**60, -(2**40)]
    df = spark.createDataFrame([(v,) for v in x], "x bigint")
    probs = [0.0, 0.001, 0.25, 0.5, 0.999, 1.0]
    got = distribution.exact_quantiles(df, ["x"], probs).collect()[0]
    data = sorted(x)
    for i, p in enumerate(probs):
        at = p * (len(data) - 1)
        lo, hi = data[math.floor(at)], data[math.ceil(at)]
        assert got[f"q{i}"] == float(lo) + (float(hi) - float(lo)) * (at - math.floor(at))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(0, 10**9, 500), np.full(400, 77)]).tolist()
    y = rng.integers(-50, 50, 900).tolist()
    df = spark.createDataFrame(list(zip(x, y)), "x bigint, y bigint")
    got = {r["column"]: r for r in distribution.exact_quantiles(df, ["x", "y"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for name, data in (("x", x), ("y", y)):
        want = np.quantile(data, [0.0, 0.25, 0.5, 0.9, 1.0])
        assert [got[name][f"q{i}"] for i in range(5)] == pytest.approx(want.tolist(), rel=1e-12)


def test_describe_matches_pandas(spark):
    x = [5, 1, 9, 9, 2, 8]
    row = distribution.describe(spark.createDataFrame([(v,) for v in x], "x int"), ["x"]).first()
    want = pd.Series(x).describe()
    assert [row[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(want.tolist(), abs=1e-6)


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 5, 9, 10, 10)], "x int")
    got = {r["bin"]: r["rows"] for r in distribution.histogram(df, "x", 10).collect()}
    assert got == {0: 1, 1: 1, 5: 1, 9: 3}


def test_seeded_sample_is_stable(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = {r["k"] for r in distribution.seeded_sample(df, "k", 50).collect()}
    b = {r["k"] for r in distribution.seeded_sample(df.repartition(7), "k", 50).collect()}
    assert a == b and len(a) == 50


# ---- quality -------------------------------------------------------------------------------------
def test_rules_count_bad_rows(spark, make):
    rows = [
        dict(game_id=1, arena_capacity=10, actual_attendance=5, attendance_tier="Low"),
        dict(game_id=1, arena_capacity=10, actual_attendance=11, attendance_tier="X"),
        dict(game_id=2, arena_capacity=10, actual_attendance=-1, attendance_tier=None),
    ]
    got = {r["rule"]: r["violations"] for r in quality.validate(make("attendance", rows), quality.table_rules()["attendance"], "attendance").collect()}
    assert {rule: n for rule, n in got.items() if n} == {
        "game_id is unique": 1, "actual_attendance is non-negative": 1, "actual_attendance within capacity": 1,
        "attendance_tier is a known value": 1,
    }
    declared = {f"{f.name} is not null" for f in SCHEMAS["attendance"].fields if not f.nullable}
    assert declared <= set(got)  # the declared NOT NULL constraints are rules too
    assert quality.offenders(make("attendance", rows), "game_id").collect() == [(1, 2)]


def test_unique_keys_are_counted_apart_from_the_row_rules(make):
    """No row rule's partial count goes through the shuffle with every key; surplus and null keys count as before."""
    rows = [{"ticket_sale_id": i, "tickets_sold": s} for i, s in ((1, 3), (1, -1), (2, -1), (3, 0), (3, 1), (3, 2))]
    out = quality.validate(make("ticket_sales", rows), quality.table_rules()["ticket_sales"], "ticket_sales")
    got = {r["rule"]: (r["violations"], r["passed"]) for r in out.collect()}
    assert got["ticket_sale_id is unique"] == (3, False) and got["tickets_sold >= 0"] == (2, False) and len(got) == out.count()
    distinct = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "distinct" in line]
    assert distinct and not any("tickets_sold" in line for line in distinct)


def test_orphans_are_counted(make):
    sales = make("ticket_sales", [dict(game_id=1), dict(game_id=9), dict(game_id=9)])
    ref = quality.Reference("game_id", "games", "game_id")
    row = quality.validate_reference(sales, ref, make("games", [dict(game_id=1)]), "ticket_sales").first()
    assert (row["violations"], row["passed"]) == (2, False)


def test_validate_all_and_summary(tables):
    row = quality.issue_summary(quality.validate_all(tables(games=[dict(game_id=1, month=13)]))).first()
    assert row["issues"] == 3 and not row["all_passed"]  # month and both missing teams


def test_cleaning(make):
    row = quality.clean("ticket_sales", make("ticket_sales", [dict(tickets_sold=9, tickets_available=5, discount_pct=120, net_ticket_revenue=-3)])).first()
    assert (row["tickets_sold"], float(row["discount_pct"]), float(row["net_ticket_revenue"])) == (5, 100.0, 0.0)
    row = quality.clean("attendance", make("attendance", [dict(actual_attendance=-4, arena_capacity=8, attendance_tier="High")])).first()
    assert (row["actual_attendance"], row["capacity_pct"], row["attendance_tier"]) == (0, 0.0, "High")
    row = quality.clean("fan_transactions", make("fan_transactions", [dict(ticket_spend=-1, concession_spend=2, merchandise_spend=3, total_spend=9)])).first()
    assert float(row["total_spend"]) == 5.0
    row = quality.clean("games", make("games", [dict(home_team_win_pct_entering_game=1.5, away_team_win_pct_entering_game=None)])).first()
    assert float(row["home_team_win_pct_entering_game"]) == 1.0 and row["away_team_win_pct_entering_game"] is None
    assert quality.clean("weather", make("weather", [dict(game_id=3)])).count() == 1


# ---- queries on fixtures -------------------------------------------------------------------------
@pytest.fixture(scope="module")
def fanout(tables):
    """One game with two ticket, three concession and two merchandise records."""
    sale = dict(game_id=1, gross_revenue=1, recommended_inventory_units=2, units_sold=1, category="Food")
    return tables(
        games=[dict(game_id=1, season=2020, month=5)], attendance=[dict(game_id=1, actual_attendance=100, arena_capacity=100, capacity_pct=100, attendance_tier="Sellout")],
        promotions=[dict(game_id=1, promotion_type="None")], ticket_sales=[dict(game_id=1, net_ticket_revenue=10)] * 2,
        concessions=[sale] * 3, merchandise=[dict(sale, gross_revenue=5)] * 2, fan_profiles=[dict(fan_id=1, loyalty_status="New Fan")])


def test_fan_out_as_written_and_fixed(fanout):
    row = executive.revenue_split(fanout).first()
    assert (row["total_ticket_revenue"], row["total_concession_revenue"], row["total_merchandise_revenue"]) == (120.0, 12.0, 60.0)
    row = executive.revenue_split_fixed(fanout).first()
    assert (row["total_ticket_revenue"], row["total_concession_revenue"], row["total_merchandise_revenue"]) == (20.0, 3.0, 10.0)
    row = executive.staffing(fanout).first()
    assert (row["ticket_rev"], row["total_con_inventory_rec"], row["total_merch_inventory_rec"]) == (120.0, 24, 24)
    assert views.executive_dashboard(fanout).first()["total_attendance"] == 1200.0
    assert views.executive_dashboard_fixed(fanout).first()["total_attendance"] == 100.0


def test_zero_attendance_gives_null_rate_first(tables):
    t = tables(games=[dict(game_id=1), dict(game_id=2)], attendance=[dict(game_id=1, actual_attendance=0), dict(game_id=2, actual_attendance=2)],
               concessions=[dict(game_id=1, gross_revenue=4), dict(game_id=2, gross_revenue=4)])
    assert [(r["game_id"], r["concession_per_cap"]) for r in ancillary.concession_per_head(t).collect()] == [(1, None), (2, 2.0)]


def test_zero_baseline_is_on_target(tables):
    one = dict(game_id=1)
    t = tables(games=[one], promotions=[one], weather=[one], attendance=[dict(game_id=1, actual_attendance=5, expected_attendance_baseline=0)])
    row = views.attendance_performance(t).first()
    assert row["variance_pct"] is None and row["performance_flag"] == "On Target"
    assert attendance.underperforming(t).count() == attendance.overperforming(t).count() == 0


def test_dense_rank_and_limit_of_top_games(tables):
    ids = range(1, 13)
    t = tables(games=[dict(game_id=i) for i in ids], attendance=[dict(game_id=i) for i in ids], promotions=[dict(game_id=i) for i in ids],
               ticket_sales=[dict(game_id=i, net_ticket_revenue=100 - i // 2) for i in ids], concessions=[dict(game_id=i) for i in ids], merchandise=[dict(game_id=i) for i in ids])
    got = [(r["game_id"], r["revenue_rank"]) for r in executive.top_games(t).orderBy("revenue_rank", "game_id").collect()]
    assert got == [(1, 1), (2, 2), (3, 2), (4, 3), (5, 3), (6, 4), (7, 4), (8, 5), (9, 5), (10, 6)]


def test_forecast_frame_with_and_without_predictions(spark, tables):
    t = tables(games=[dict(game_id=1), dict(game_id=2)], attendance=[dict(game_id=i, actual_attendance=100, expected_attendance_baseline=110) for i in (1, 2)])
    plain = {r["game_id"]: r for r in insights.forecast_frame(t).collect()}
    assert plain[1]["attendance_prediction_error"] == -10 and plain[1]["underperforming"]
    preds = spark.createDataFrame([(1, 108, 8)], "game_id bigint, predicted_attendance int, attendance_prediction_error int")
    scored = {r["game_id"]: r for r in insights.forecast_frame(t, preds).collect()}
    assert scored[1]["actual_minus_predicted"] == -8 and not scored[1]["underperforming"]
    assert scored[2]["predicted_attendance"] is None and not scored[2]["underperforming"]


def test_segment_source(make):
    fans = make("fan_profiles", [dict(fan_id=1, loyalty_status="New Fan")])
    assert insights.with_segment(fans).first()["segment"] == "New Fan"
    assert insights.with_segment(fans.withColumn("fan_segment", F.lit("Loyal"))).first()["segment"] == "Loyal"


def test_scenarios(spark, tables):
    t = tables(
        attendance=[dict(game_id=1, actual_attendance=80, arena_capacity=100, capacity_pct=80)], ticket_sales=[dict(game_id=1, net_ticket_revenue=1000, avg_ticket_price=10)],
        concessions=[dict(game_id=1, gross_revenue=400, avg_unit_price=0, per_cap_spend=5, category="Food")],
        merchandise=[dict(game_id=1, gross_revenue=200, avg_unit_price=20, per_cap_spend=2.5, category="Hats")])
    table = spark.createDataFrame([(1, 20, 10, 25, -10, 0)], "scenario_id int, att_change int, price_change int, promo_lift int, con_change int, merch_change int")
    r = scenario.scenarios(t, table).first()
    assert r["projected_attendance"] == pytest.approx(116.0) and r["projected_capacity_pct"] == 100.0
    assert r["ticket_revenue"] == pytest.approx(1000 * 1.45 * 1.1) and r["concession_revenue"] == pytest.approx(400 * 0.9 * 1.45)
    assert r["staffing_level"] == "Maximum Staffing" and r["inventory_buffer"] == 1.20
    # A zero mean unit price counts as 10.
    assert r["concession_inventory"] == int(116 * (5 / 10) * 1.2) and r["merchandise_inventory"] == int(116 * (2.5 / 20) * 1.2)
    items = {x["category"]: x["recommended_units"] for x in scenario.scenario_inventory(t, table).collect()}
    assert items == {"Con: Food": int(116 * 0.5 * 1.2), "Merch: Hats": int(116 * 0.125 * 1.2)}


# ---- features ------------------------------------------------------------------------------------
def season_tables(tables, games=24):
    rng = random.Random(11)
    ids = range(1, games + 1)
    return tables(
        teams=[dict(team_id=1, historical_popularity_score=0.9, arena_capacity=200), dict(team_id=2, historical_popularity_score=0.6, arena_capacity=300)],
        games=[dict(game_id=i, season=2019 + i % 3, game_date=dt.date(2019 + i % 3, 1 + i % 12, 1 + i % 28), home_team_id=1 + i % 2, away_team_id=2 - i % 2,
                    day_of_week="Friday", month=1 + i % 12, is_weekend=i % 2 == 0, rivalry_flag=i % 5 == 0, home_win_flag=i % 2) for i in ids],
        attendance=[dict(game_id=i, actual_attendance=rng.randint(50, 200)) for i in ids if i != 3],
        weather=[dict(game_id=i, temperature_f=50) for i in ids if i != 4],
        promotions=[dict(game_id=i, promotion_type="Theme Night" if i % 3 else "None", promotion_flag=i % 3 > 0) for i in ids if i != 5],
        ticket_segments=[dict(segment_id=1, avg_base_price=100), dict(segment_id=2, avg_base_price=50)],
        ticket_sales=[dict(game_id=i, net_ticket_revenue=rng.randint(1, 999)) for i in ids if i != 6],
        concessions=[dict(game_id=i, gross_revenue=rng.randint(1, 99)) for i in ids], merchandise=[dict(game_id=i, gross_revenue=rng.randint(1, 99)) for i in ids if i > 6])


def test_features_defaults_and_no_nulls(tables):
    df = features.build_features(season_tables(tables), max_rows=3).toPandas().set_index("game_id")
    assert len(df) == 24
    numeric = df.select_dtypes(include=["number"])
    assert not numeric.isna().any().any()
    assert df.loc[4, "temperature_f"] == 60.0 and df.loc[5, "promotion_type"] == "None" and df.loc[3, "actual_attendance"] == 0
    assert df.loc[2, "arena_capacity_feat"] == 200 and df.loc[1, "arena_capacity_feat"] == 300
    assert df.loc[5, "planned_avg_base_price"] == pytest.approx(75 * (1 + 0.15 + 0.12 * 0.6))
    for c in ("is_weekend", "rivalry_flag", "promotion_flag", "snow_flag"):
        assert set(df[c]) <= {0, 1}


def test_features_first_game_fill(tables):
    t = season_tables(tables)
    seen = t["attendance"].toPandas()["actual_attendance"]
    first = t["games"].orderBy("game_date", "game_id").where("home_team_id = 1").first()["game_id"]
    df = features.build_features(t).where(F.col("game_id") == first).first()
    assert df["rolling_att_3"] == pytest.approx(seen.mean())
    trained = features.build_features(t, fill="train_mean").where(F.col("game_id") == first).first()
    late = t["games"].where("season < 2021").join(t["attendance"], "game_id").toPandas()["actual_attendance"]
    assert trained["rolling_att_3"] == pytest.approx(late.mean())


def test_feature_projections_and_leakage(tables):
    df = features.build_features(season_tables(tables))
    att, rev = features.attendance_features(df), features.revenue_features(df)
    assert len(features.ATTENDANCE_FEATURES) == 22 and len(features.REVENUE_PREGAME_FEATURES) == 27
    assert len(att.columns) == 26 and len(rev.columns) == 31
    assert not set(features.POST_GAME_COLUMNS) & set(rev.columns)
    assert att.join(rev, "game_id").count() == rev.count() == 24
    with pytest.raises(ValueError, match="post-game"):
        features.assert_pregame(df)
    with pytest.raises(ValueError, match="unknown fill"):
        features.build_features(season_tables(tables), fill="zero")


def test_team_form(tables):
    g = [dict(game_id=i, game_date=day(i), home_team_id=1, away_team_id=2, home_win_flag=1) for i in range(1, 8)]
    got = {r["game_id"]: (r["home_team_recent_form"], r["away_team_recent_form"]) for r in features.team_form(tables(games=g), max_rows=2).collect()}
    assert got[1] == (0.5, 0.5) and got[2] == (1.0, 0.0) and got[7] == (1.0, 0.0)


# ---- forecasting and segments --------------------------------------------------------------------
def test_metrics_skip_zero_actuals(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 9.0)], "y double, p double")
    row = forecast.evaluate(df, "y", "p", "m").first()
    assert row["mape"] == pytest.approx(10.0) and row["mae"] == pytest.approx(3.0) and row["rmse"] == pytest.approx(13**0.5)
    assert row["r2"] == pytest.approx(1 - 26 / 50)
    assert forecast.mape(df, "y", "p").first()[0] == pytest.approx(10.0)


@pytest.fixture(scope="module")
def trained(spark):
    """Attendance driven by two signals and a promotion type; the last season has an unseen type."""
    rng = random.Random(2)
    rows = []
    for i in range(240):
        season = 2019 + i % 4
        kind = "New" if season == 2022 and i % 8 == 7 else rng.choice(["None", "Theme Night"])
        x, w = rng.random(), rng.randint(0, 1)
        rows.append((i, season, day(i), x, w, kind, int(1000 + 500 * x + 100 * w + (50 if kind == "Theme Night" else 0) + rng.randint(-5, 5))))
    df = spark.createDataFrame(rows, "game_id bigint, season int, game_date date, x double, w int, promotion_type string, actual_attendance int")
    task = forecast.Task("attendance", ["x", "w", "promotion_type"], "actual_attendance", 4)
    small = {"LinearRegression": forecast.estimators(task)["LinearRegression"],
             "RandomForest": forecast.estimators(task)["RandomForest"].copy().setNumTrees(5),
             "GradientBoosting": forecast.estimators(task)["GradientBoosting"].copy().setMaxIter(3)}
    out = forecast.train(df, task, small)
    yield out
    out.release()


def test_training_picks_the_best(trained):
    r2 = {r["model"]: r["r2"] for r in trained.metrics.collect()}
    assert trained.best == max(r2, key=r2.get) == "LinearRegression" and r2["LinearRegression"] > 0.95


def test_stored_features_prepare_alike_without_a_second_copy(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/features"
    kinds = {"promotion_type": "if(id % 2 = 0, 'None', 'Giveaway')"}
    columns = [f"{kinds.get(c, f'CAST(id * 7 % {i + 5} AS double)')} AS {c}" for i, c in enumerate(features.ATTENDANCE_FEATURES)]
    spark.range(40).selectExpr("id AS game_id", "CAST(2020 + id % 3 AS int) AS season", "CAST(id * 3 AS int) AS actual_attendance", *columns).write.parquet(path)
    df, kept = spark.read.parquet(path), []
    persist = type(df).persist
    monkeypatch.setattr(type(df), "persist", lambda self, *a: (kept.append(self.columns), persist(self, *a))[1])
    halves = [forecast.prepare(df, forecast.ATTENDANCE, stored)[1:] for stored in (True, False)]
    assert [len(c) for c in kept] == [5, 5, len(df.columns), 5, 5]  # stored: the two halves alone
    for a, b in zip(*halves):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() > 0
        a.unpersist(), b.unpersist()


def test_unseen_category_is_all_zeros(trained):
    assert forecast.feature_names(trained.preprocessor) == ["x", "w", "promotion_type_None", "promotion_type_Theme Night"]
    assert all(len(r["features"]) == 4 for r in trained.test.select("features").collect())
    tails = {tuple(r["features"].toArray()[2:]) for r in trained.test.collect()}
    assert (0.0, 0.0) in tails


def test_predictions_table(trained):
    rows = trained.predictions().collect()
    assert len(rows) == 60
    assert all(r["attendance_prediction_error"] == r["predicted_attendance"] - r["actual_attendance"] for r in rows)


def test_importances(trained, spark):
    assert trained.importances().count() == 0
    tree = forecast.feature_importances(spark, trained.models["RandomForest"], trained.preprocessor)
    assert tree.first()["feature"] == "x" and tree.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_model_and_metadata_round_trip(spark, trained, tmp_path):
    forecast.save_model(trained.best_model, str(tmp_path / "model"))
    assert len(forecast.load_model(str(tmp_path / "model")).stages) == len(trained.best_model.stages)
    path = str(tmp_path / "meta")
    forecast.save_metadata(spark, path, {"a": "1", "b": "2"})
    forecast.save_metadata(spark, path, {"b": "3"})
    assert {r["key"]: r["value"] for r in forecast.read_metadata(spark, path).collect()} == {"a": "1", "b": "3"}


def test_truncation_toward_zero(spark):
    scored = spark.createDataFrame([(1, -1.9, 5)], "game_id bigint, prediction double, actual_attendance int")
    assert forecast.attendance_predictions(scored).first()["predicted_attendance"] == -1


def test_kmeans_finds_separated_groups(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.1, (60, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["z_a", "z_b"]))
    centres = segments.kmeans(df, [2, 3], restarts=4)
    assert set(centres) == {2, 3}
    got = sorted(tuple(np.round(c).tolist()) for c in centres[3])
    assert got == [(0.0, 0.0), (0.0, 5.0), (5.0, 5.0)]
    sizes = segments.assign_clusters(df, centres[3], ["a", "b"]).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in sizes) == [60, 60, 60]


def test_kmeans_fits_share_their_passes_and_equal_mllib(spark, monkeypatch):
    """All fits iterate together (passes of the slowest fit, not the sum), with MLlib's own centres."""
    rng = np.random.default_rng(8)
    df = spark.createDataFrame(pd.DataFrame(rng.normal(size=(400, 3)), columns=["z_a", "z_b", "z_c"])).cache()
    vectors = VectorAssembler(inputCols=df.columns, outputCol="features").transform(df).cache()
    fits = {(k, r): KMeans(k=k, seed=segments.SEED + r, maxIter=300).fit(vectors) for k in (2, 4) for r in range(3)}
    passes, step = [], segments._lloyd_step
    monkeypatch.setattr(segments, "_lloyd_step", lambda *args: passes.append(1) or step(*args))
    centres = segments.kmeans(df, [2, 4], restarts=3)
    assert len(passes) == max(m.summary.numIter for m in fits.values())
    for k in (2, 4):
        best = min((fits[k, r] for r in range(3)), key=lambda m: m.summary.trainingCost)
        np.testing.assert_allclose(centres[k], np.array(best.clusterCenters()), atol=1e-9)


def test_labels_are_greedy_and_one_to_one():
    scores = [(0, 0, 5.0), (0, 1, 4.0), (1, 0, 5.0), (1, 1, 1.0), (2, 0, 0.0), (2, 2, -1.0)]
    # Tie at 5: the first pair wins; cluster 2 has nothing above -1 left and takes the spare label.
    assert segments.assign_labels(scores) == {0: segments.SEGMENT_LABELS[0], 1: segments.SEGMENT_LABELS[1], 2: segments.SEGMENT_LABELS[2]}


def test_segmentation_end_to_end(make):
    rng = random.Random(9)
    fans = make("fan_profiles", [dict(
        fan_id=i, loyalty_status=rng.choice(["New Fan", "Casual Fan", "Premium Member", "Other"]), distance_from_arena_bucket=rng.choice(["<5 miles", "60+ miles", "far"]),
        games_attended_last_12_months=rng.randint(1, 41), avg_ticket_spend=rng.randint(40, 450), avg_concession_spend=rng.randint(8, 45),
        avg_merchandise_spend=rng.randint(5, 80), promotion_usage_rate=round(rng.random(), 2), email_engagement_score=round(rng.random(), 2), fan_value_score=round(rng.random(), 2))
        for i in range(150)])
    out = segments.segment_fans(fans, restarts=3).cache()
    assert out.count() == 150 and out.where("fan_segment is null").count() == 0
    assert {r[0] for r in out.select("fan_segment").distinct().collect()} == set(segments.SEGMENT_LABELS)
    assert {r[0] for r in out.where("distance_from_arena_bucket = 'far'").select("distance_encoded").distinct().collect()} == {3.0}
    assert {r[0] for r in out.where("loyalty_status = 'Other'").select("loyalty_encoded").distinct().collect()} == {2.0}
    assert segments.segment_counts(out).agg(F.sum("share_pct")).first()[0] == pytest.approx(100.0)
    assert segments.segment_profile(out).count() == 6


def test_calendar_flags_take_pairs_in_either_order(tables):
    from venue_analytics.plans.preparation import calendar_flags

    t = tables(games=[dict(game_id=1, home_team_abbr="NYE", away_team_abbr="BOS", game_date=dt.date(2021, 1, 1)),
                      dict(game_id=2, home_team_abbr="DEN", away_team_abbr="UTA", game_date=dt.date(2021, 3, 1))])
    got = {r["game_id"]: tuple(r)[1:] for r in calendar_flags(t).collect()}
    assert got == {1: (True, True, True, True), 2: (False, False, False, False)}


def test_repeated_sums_survive_billions_of_records(spark):
    """Row counts whose product exceeds a long still multiply exactly."""
    df = spark.createDataFrame([(1, 2 * 10**11, 10**11, 10**11)], "game_id bigint, ticket_rows bigint, con_rows bigint, merch_rows bigint")
    df = df.withColumns({c: F.lit("5.25").cast("decimal(22,2)") for c in ("ticket_rev", "con_rev", "merch_rev")})
    row = executive.fanned(df).first()
    assert int(row["fan_rows"]) == 2 * 10**33 and row["fan_ticket"] == row["fan_con"] / 2 and int(row["fan_con"] * 100) == 525 * 2 * 10**22


def test_sold_tickets_stay_null_where_unknown(spark):
    from venue_analytics.operators.quality import clean_ticket_sales

    rows = [(i, s, a, 1.0, 1.0, 0.0) for i, (s, a) in enumerate([(None, 50), (60, 50), (40, 50), (40, None)])]
    frame = spark.createDataFrame(rows, "ticket_sale_id int, tickets_sold int, tickets_available int, gross_ticket_revenue double, net_ticket_revenue double, discount_pct double")
    assert {r.ticket_sale_id: r.tickets_sold for r in clean_ticket_sales(frame).collect()} == {0: None, 1: 50, 2: 40, 3: None}


def test_chosen_model_drives_predictions_and_importances(spark, monkeypatch):
    """m9 marks the candidate of the largest R2; m10 and m11 of the chosen model are that candidate's."""
    from venue_analytics.plans import modelling
    from venue_analytics.sources.tables import workspace

    full = forecast.estimators

    def small(task):
        e = full(task)
        return {"LinearRegression": e["LinearRegression"], "RandomForest": e["RandomForest"].copy().setNumTrees(4),
                "GradientBoosting": e["GradientBoosting"].copy().setMaxIter(3)}

    monkeypatch.setattr(forecast, "estimators", small)
    t = workspace(spark, "/root/testdata/sf0.001")
    t.__dict__.pop("_fitted", None)
    try:
        for task in (forecast.ATTENDANCE, forecast.REVENUE):
            metrics = modelling.chosen_metrics(task, t).collect()
            chosen = [r for r in metrics if r["chosen"]]
            assert len(metrics) == 3 and len(chosen) == 1
            assert chosen[0]["r2"] == max(r["r2"] for r in metrics)
            name = chosen[0]["model"]
            preds = modelling.QUERIES[f"m11_{task.name}_predictions_chosen"](t)
            assert preds.count() == modelling.prepared(t, task)[2].count() > 0
            assert sorted(preds.collect()) == sorted(modelling.model_predictions(task, name, t).collect())
            importances = modelling.QUERIES[f"m10_{task.name}_importances_chosen"](t).collect()
            if name == "LinearRegression":
                assert importances == []
            else:
                assert 0 < sum(r["importance"] for r in importances) <= 1 + 1e-9
    finally:
        t.__dict__.pop("_fitted", None)


@pytest.fixture(scope="module")
def vectors(spark):
    """Rows of three wide numbers, a flag, a code, a constant and a one-hot pair, with whole labels."""
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(1)
    rows = []
    for _ in range(2000):
        x = [*rng.normal(size=3).tolist(), float(rng.integers(0, 2)), float(rng.integers(0, 12)), 5.0]
        x += [1.0 - x[3], x[3] * (x[4] > 5)]
        rows.append((x, float(int(100 * x[0] + 50 * x[1] * x[3] + 7 * x[4] + rng.integers(-9, 9)))))
    df = spark.createDataFrame(rows, "x array<double>, y double").repartition(3)
    return df.select("x", "y", array_to_vector("x").alias("features"), F.col("y").alias("label")).persist()


def _scores(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("x").collect()])


@pytest.mark.parametrize("local_rows", [50, 10**6])
def test_forest_without_bags_is_mllibs_tree(vectors, local_rows, monkeypatch):
    """Whether rows or histograms travel, every tree over all rows is the tree that MLlib grows."""
    from pyspark.ml.regression import DecisionTreeRegressor
    from venue_analytics.operators import trees

    monkeypatch.setattr(trees, "LOCAL_ROWS", local_rows)
    one = DecisionTreeRegressor(maxDepth=6).fit(vectors)
    two = trees.Forest(numTrees=2, maxDepth=6, bootstrap=False, seed=3).fit(vectors)
    assert np.allclose(_scores(one, vectors), _scores(two, vectors), rtol=0, atol=1e-9)
    assert two.totalNumNodes >= 2 * one.numNodes and type(two).__name__ == "RandomForestRegressionModel"


def test_forest_predicts_from_arrays_as_mllibs_model_does(vectors, tmp_path):
    """No Java model is loaded to predict; what is saved and read back is MLlib's and predicts the same, missing numbers too."""
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import RandomForestRegressionModel
    from venue_analytics.operators import trees

    model = trees.Forest(numTrees=4, maxDepth=6, seed=3).fit(vectors)
    scores = _scores(model, vectors)
    assert model._loaded is None and model.transform(vectors.limit(0)).count() == 0
    model.write().save(str(tmp_path / "model"))
    saved = RandomForestRegressionModel.load(str(tmp_path / "model"))
    assert np.array_equal(scores, _scores(saved, vectors)) and saved.getNumTrees == 4
    assert model.copy().featureImportances == saved.featureImportances
    x = np.full((2, 8), np.nan)
    assert np.array_equal(trees.mean_prediction(x, model._trees.value), [saved.predict(Vectors.dense(x[0]))] * 2)


def test_large_nodes_grow_the_same_subtree_by_codes(monkeypatch):
    """Counted by code, of each split only the child of fewer rows, a subtree is the one whose features are all counted by themselves."""
    from venue_analytics.operators import trees

    rng = np.random.default_rng(5)
    m = 6000
    x = np.stack([*rng.normal(size=(4, m)), *rng.integers(0, 2, (11, m)), *rng.integers(0, 12, (2, m)), np.zeros(m)], axis=1)
    x[:, 5] = 1 - x[:, 4]  # equal splits: the first feature must win wherever it is counted
    y = np.rint(10000 * x[:, 0] + 4000 * x[:, 4] * x[:, 1] + x[:, 15])
    bins = trees.Bins(tuple(trees.feature_thresholds(c, 32) for c in x.T))
    codes, w = np.ascontiguousarray(bins.pack(x).T), rng.poisson(1.0, m).astype(np.uint8)
    codes, y, w = codes[:, w > 0], y[w > 0], w[w > 0]
    columns = np.stack([np.searchsorted(t, c, side="left") for t, c in zip(bins.thresholds, x.T)])
    assert np.array_equal(bins.unpack(np.ascontiguousarray(bins.pack(x).T)), columns)
    assert np.array_equal(bins.narrow.unpack(bins.narrowed(np.ascontiguousarray(bins.pack(x).T))), columns)
    assert len(bins.groups) < len(bins.narrow.groups) < x.shape[1]

    def grown(small, unit=1.0):
        monkeypatch.setattr(trees, "SMALL_ROWS", small)
        nodes = trees.grow(0, 1, 0, 7, bins, codes, y / unit, w)
        order = np.argsort(nodes["heap"])
        return {c: v[order] for c, v in nodes.items()}

    wanted = grown(10**6)
    assert len(wanted["heap"]) > 100 and 5 not in wanted["feature"]
    for small, unit in ((0, 1.0), (40, 1.0), (1000, 1.0), (40, 100.0)):
        got = grown(small, unit)
        for c in ("heap", "feature", "threshold", "n", "raw"):
            assert np.array_equal(got[c], wanted[c]), (small, c)
        for c, scale in (("prediction", unit), ("s", unit), ("q", unit ** 2), ("impurity", unit ** 2)):
            assert np.allclose(got[c] * scale, wanted[c], rtol=1e-9, atol=1e-3), (small, c)
        assert np.allclose(got["gain"] * np.where(got["feature"] < 0, 1.0, unit ** 2), wanted["gain"], rtol=1e-9)


def test_forest_bags_do_not_depend_on_where_nodes_finish(vectors, monkeypatch):
    from venue_analytics.operators import trees

    scores = []
    for local_rows in (100, 10**6):
        monkeypatch.setattr(trees, "LOCAL_ROWS", local_rows)
        scores.append(_scores(trees.Forest(numTrees=3, maxDepth=5, seed=3).fit(vectors), vectors))
    assert np.allclose(*scores, rtol=0, atol=1e-9)


def test_large_tasks_forests_move_rows(spark):
    """The registered candidates: a forest whose deep nodes travel as rows."""
    from venue_analytics.operators import trees

    found = forecast.estimators(forecast.REVENUE)
    assert isinstance(found["RandomForest"], trees.Forest) and found["RandomForest"].getNumTrees() == 200
    assert found["RandomForest"].getMaxDepth() == 14


@pytest.mark.parametrize("direct", [0, 10**6])
def test_boosting_is_mllibs(vectors, direct, monkeypatch):
    from pyspark.ml.regression import GBTRegressor
    from venue_analytics.operators import trees

    monkeypatch.setattr(trees, "REBUILD", 3)
    monkeypatch.setattr(trees, "DIRECT_ROWS", direct)
    options = {"maxIter": 5, "stepSize": 0.05, "maxDepth": 4, "seed": 42}
    old, new = GBTRegressor(**options).fit(vectors), trees.Boosting(**options).fit(vectors)
    assert np.allclose(_scores(old, vectors), _scores(new, vectors), rtol=0, atol=1e-6)
    assert list(new.treeWeights) == [1.0] + [0.05] * 4 and new.totalNumNodes == old.totalNumNodes


def test_large_tasks_boost_over_packed_blocks(spark):
    from venue_analytics.operators import trees

    found = forecast.estimators(forecast.REVENUE)["GradientBoosting"]
    assert isinstance(found, trees.Boosting) and found.getMaxIter() == 200
