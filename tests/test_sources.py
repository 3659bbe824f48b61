"""Catalog, sinks, views, ad-hoc SQL and the stored workspace."""

import os

import pytest
from pyspark.sql import functions as F

from venue_analytics.plans.views import VIEWS, register_views
from venue_analytics.sources.catalog import Catalog, MissingTable, load_into_session, read_csv
from venue_analytics.sources.schemas import SCHEMAS
from venue_analytics.sources.tables import Workspace, workspace

SMALL = "/root/testdata/sf0.001"


def write(path, text):
    path.write_text(text)
    return str(path)


PROMOTIONS = "promotion_id,game_id,promotion_flag,promotion_type,promotion_cost,expected_promotion_lift_pct,sponsor_category,sponsor_value_estimate\n"


def test_csv_is_typed_and_keeps_the_word_none(spark, tmp_path):
    path = write(tmp_path / "promotions.csv", PROMOTIONS + "1,7,False,None,0.0,0.0,,\n")
    row = read_csv(spark, path, "promotions").first()
    assert row["promotion_type"] == "None" and row["sponsor_category"] is None and row["promotion_flag"] is False
    assert read_csv(spark, path, "promotions").dtypes[4] == ("promotion_cost", "decimal(10,2)")


def test_csv_bad_cells_are_kept_not_nulled(spark, tmp_path):
    path = write(tmp_path / "promotions.csv", PROMOTIONS + "1,7,False,None,0.0,0.0,,\n2,8,True,Theme,lots,1.5,x,2.0\n3,9,,,,,,\n")
    rows = {r["promotion_id"]: r for r in read_csv(spark, path, "promotions", keep_corrupt=True).collect()}
    assert rows[1]["_corrupt_record"] is None and rows[3]["_corrupt_record"] is None and rows[3]["promotion_cost"] is None
    assert "lots" in rows[2]["_corrupt_record"] and rows[2]["promotion_cost"] is None


def test_missing_csv_raises(spark, tmp_path):
    with pytest.raises(MissingTable):
        read_csv(spark, str(tmp_path / "nothing.csv"), "games")


@pytest.fixture()
def folders(tmp_path):
    raw, cleaned = tmp_path / "raw", tmp_path / "cleaned"
    raw.mkdir()
    cleaned.mkdir()
    write(raw / "ticket_segments.csv", "segment_id,segment_name,avg_base_price,price_tier\n1,Raw,10.0,Value\n")
    write(cleaned / "ticket_segments.csv", "segment_id,segment_name,avg_base_price,price_tier\n1,Clean,10.0,Value\n")
    write(raw / "promotions.csv", PROMOTIONS)
    return str(raw), str(cleaned)


def test_lookup_order(spark, folders):
    name = lambda **kw: Catalog(spark, *folders, **kw).load("ticket_segments").first()["segment_name"]
    assert name() == "Clean" and name(prefer="raw") == "Raw"
    assert Catalog(spark, *folders).load("promotions").count() == 0
    spark.createDataFrame([(1, "Session")], "segment_id int, segment_name string").createOrReplaceTempView("ticket_segments")
    assert name(use_session_tables=True) == "Session"
    spark.catalog.dropTempView("ticket_segments")


def test_missing_table(spark, folders):
    with pytest.raises(MissingTable):
        Catalog(spark, *folders).load("games")
    empty = Catalog(spark, *folders, on_missing="empty").load("games")
    assert empty.count() == 0 and empty.schema == SCHEMAS["games"]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_sink_round_trip(spark, folders, make, fmt):
    catalog = Catalog(spark, *folders)
    catalog.save("weather", make("weather", [dict(game_id=5, weather_condition=None)]), fmt)
    catalog.save("weather", make("weather", [dict(game_id=6, weather_condition="Clear"), dict(game_id=7, weather_condition=None)]), fmt)
    rows = {r["game_id"]: r["weather_condition"] for r in catalog.load("weather").collect()}
    assert rows == {6: "Clear", 7: None}


def test_views_and_adhoc_sql(spark, folders, tables):
    one = dict(game_id=1)
    t = tables(games=[one], attendance=[one], promotions=[one], weather=[one], ticket_sales=[one], concessions=[one], merchandise=[one], fan_profiles=[dict(fan_id=1)])
    catalog = Catalog(spark, *folders)
    catalog.register(t)
    assert catalog.query("SELECT COUNT(*) AS n FROM games JOIN attendance USING (game_id)").first()["n"] == 1
    assert register_views(t) == list(VIEWS)
    assert spark.sql("SELECT total_games FROM vw_executive_dashboard").first()[0] == 1
    for name in [*SCHEMAS, *VIEWS]:
        spark.catalog.dropTempView(name)


def test_load_into_session_replaces(spark, make, tmp_path):
    for ids in ([1], [2, 3]):
        load_into_session({"venue_test_games": make("games", [dict(game_id=i) for i in ids])})
    assert sorted(r["game_id"] for r in spark.table("venue_test_games").collect()) == [2, 3]
    spark.sql("DROP TABLE venue_test_games")


def test_workspace_matches_schemas_and_reuses_tables(spark):
    t = workspace(spark, SMALL)
    assert workspace(spark, SMALL) is t
    for name in SCHEMAS:
        assert [(f.name, f.dataType) for f in t[name].schema] == [(f.name, f.dataType) for f in SCHEMAS[name]], name
    assert t["games"].where(F.col("home_team_id") == F.col("away_team_id")).count() == 0


def test_hub_joins_need_no_shuffle(spark):
    """Bucketed hub tables and roll-ups join on game_id in place, even when too large to broadcast."""
    from venue_analytics.operators.marts import full_revenue

    t = workspace(spark, SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = full_revenue(t, "attendance", "promotions")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 5 and "Exchange" not in plan


def test_scans_are_pruned_and_filtered(spark):
    from venue_analytics.plans.attendance import sellouts

    plan = sellouts(workspace(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "GreaterThanOrEqual(capacity_pct,97.00)" in plan
    assert "home_score" not in plan


def test_segment_joins_broadcast(spark):
    """A dimension of a few rows never makes the ticket fact shuffle on its handful of keys."""
    from venue_analytics.plans.tickets import revenue_by_segment

    plan = revenue_by_segment(workspace(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(segment_id" not in plan


def test_changed_folder_is_read_anew(spark, tmp_path):
    """A replaced source file never answers with the tables stored before."""
    import shutil

    from venue_analytics.sources.tables import Workspace, workspace

    source = "/root/testdata/sf0.001"
    for name in ("region", "nation", "customer", "orders", "lineitem"):
        shutil.copyfile(f"{source}/{name}.parquet", tmp_path / f"{name}.parquet")  # not the read-only mode
    first = workspace(spark, str(tmp_path))
    before = first["ticket_sales"].count()
    assert workspace(spark, str(tmp_path)) is first
    spark.read.parquet(f"{source}/lineitem.parquet").where("l_linenumber <= 3").toPandas().to_parquet(tmp_path / "lineitem.parquet", coerce_timestamps="us")
    after = workspace(spark, str(tmp_path))["ticket_sales"].count()
    assert 0 < after < before
    assert after == spark.read.parquet(str(tmp_path / "lineitem.parquet")).count()


def test_record_ids_do_not_depend_on_the_file_split(spark):
    """Record ids come from the source key: the same at 1, 3 and 8 input partitions, unique, none missing."""
    from venue_analytics.sources.adapter import SalesAdapter

    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    source = "/root/testdata/sf0.001"
    size = os.path.getsize(f"{source}/lineitem.parquet")
    seen = []
    try:
        for parts in (1, 3, 8):
            spark.conf.set(key, str(max(size // parts, 4096)))
            adapter = SalesAdapter(spark, source)
            ids = {
                name: sorted(r[0] for r in getattr(adapter, name)().select(SCHEMAS[name].fields[0].name).collect())
                for name in ("ticket_sales", "concessions", "merchandise")
            }
            seen.append(ids)
    finally:
        spark.conf.set(key, before)
    assert seen[0] == seen[1] == seen[2]
    assert all(len(v) == len(set(v)) > 0 for v in seen[0].values())


def test_fingerprint_reads_only_the_sources_and_lists_nothing(spark, tmp_path):
    """Many files of another table cost nothing; a change to lineitem still shows, one to pages doesn't."""
    import shutil
    import time

    from venue_analytics.sources.tables import source_fingerprint

    source = "/root/testdata/sf0.001"
    for name in ("region", "nation", "customer", "orders", "lineitem"):
        shutil.copyfile(f"{source}/{name}.parquet", tmp_path / f"{name}.parquet")
    (tmp_path / "pages.parquet").mkdir()
    for i in range(2000):
        (tmp_path / "pages.parquet" / f"part-{i:05d}.parquet").write_bytes(b"x")
    start = time.perf_counter()
    first = source_fingerprint(spark, str(tmp_path))
    assert time.perf_counter() - start < 5
    (tmp_path / "pages.parquet" / "part-99999.parquet").write_bytes(b"y")
    assert source_fingerprint(spark, str(tmp_path)) == first
    with open(tmp_path / "lineitem.parquet", "ab") as f:
        f.write(b"changed")
    assert source_fingerprint(spark, str(tmp_path)) != first


def test_marts_number_no_records(spark, tmp_path):
    """Roll-ups and questions that name no record never sort and write the line items for ids; their rows are the facts' own."""
    import datetime as dt

    lines = [(1, 5, 3, 1), (1, 5, 3, 1), (1, 6, 2, 2), (2, 7, 1, 1), (2, 7, 1, 2), (None, 7, 1, 2)]
    when = dt.datetime(2020, 1, 2)
    own = {
        "lineitem": ([(o, p, s, n, 1.0 + n, 100.0 * n + p, 0.05, "A", "F") for o, p, s, n in lines],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string"),
        "orders": ([(1, 1, 150.0, when, "1-URGENT"), (2, 1, 250.0, when, "5-LOW"), (2, 1, 250.0, when, "5-LOW")],
                   "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(1, 0)], "c_custkey bigint, c_nationkey int"),
        "nation": ([(i, f"N{i}", 0) for i in range(25)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in own.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Workspace(spark, str(tmp_path))
    try:
        assert t.mart("tickets_by_game").count() == 3 and t.mart("merchandise_by_game").count() == t.mart("concessions_by_game").count() > 0
        assert t.adapter._numbered is None
        for name in ("ticket_sales", "concessions", "merchandise"):
            numbered = t[name].drop(t[name].columns[0])
            assert t.records(name).dtypes == numbered.dtypes
            assert sorted(map(str, t.records(name).collect())) == sorted(map(str, numbered.collect()))
        assert t.adapter._numbered is not None
    finally:
        t.forget()


def test_rollups_and_features_store_only_what_is_read_again(spark):
    """A roll-up takes its records from their join, unwritten; the outcomes that features read three times are written once."""
    from venue_analytics.operators.features import build_features

    t = Workspace(spark, "/root/testdata/sf0.001")
    try:
        rows = t.mart("concessions_by_game").agg({"con_rows": "sum"}).first()[0]
        assert not any(name.endswith("_records") for name in t._made)
        assert t.records("concessions").count() == t.records("concessions", once=True).count() == rows
        build_features(t)
        assert any(name.endswith("_outcomes") for name in t._made)
        kept = t.keep("outcomes", lambda: pytest.fail("built twice"))
        assert kept.count() == t["games"].count()
    finally:
        t.forget()


def test_histograms_join_once(spark, monkeypatch):
    """The joined columns are kept, so the range pass and the bin pass don't both join."""
    from venue_analytics.plans import insights

    t = Workspace(spark, "/root/testdata/sf0.001")
    try:
        plan = insights.histograms(t)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and {"forecast_errors", "game_day_revenue"} <= {name.split("_", 2)[2] for name in t._made}
    finally:
        t.forget()
