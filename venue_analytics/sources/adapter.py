"""Derive the twelve venue tables from generic sales tables (orders, customers, line items, nations).

An order stands for a game, its customer for the fan and the venue, a line item for a ticket record and
for one concession or merchandise record. Everything is integer or decimal arithmetic, so the derived
values are exact. Row-wise tables are plain projections of one source, so column pruning and filters
reach its scan; only games and attendance (orders with customers) and the two category tables (line
items with attendance) need a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import clip, int_div, unit_amount
from ..operators.positions import positions
from .schemas import SCHEMAS


def _big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _money(c: str | Column, precision: int = 12) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({precision},2)")


def _dec(text: str) -> Column:
    """Exact decimal literal."""
    digits = text.replace(".", "").lstrip("0") or "0"
    scale = len(text.split(".")[1]) if "." in text else 0
    return F.lit(text).cast(f"decimal({max(len(digits), scale + 1)},{scale})")


def _scaled(c: Column, step: str, target: str) -> Column:
    """Integer column times a power-of-ten decimal step."""
    return (c * _dec(step)).cast(target)


def conform(df: DataFrame, name: str, numbered: bool = True) -> DataFrame:
    """Select and cast a frame to a declared schema, if not ``numbered`` without its first column, the record id."""
    fields = SCHEMAS[name].fields if numbered else SCHEMAS[name].fields[1:]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


class SalesAdapter:
    """Domain tables over a folder of Parquet files named after their tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._numbered: DataFrame | None = None

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- dimensions ------------------------------------------------------------------------------
    def teams(self) -> DataFrame:
        nation, region = self.source("nation"), self.source("region")
        team = F.col("n_nationkey")
        out = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            team.alias("team_id"),
            F.concat(F.lit("T"), F.lpad(team.cast("string"), 2, "0")).alias("team_abbr"),
            F.col("n_name").alias("team_name"),
            F.col("n_name").alias("team_city"),
            F.col("r_name").alias("conference"),
            F.concat(F.col("r_name"), F.lit(" Division")).alias("division"),
            F.concat(F.col("n_name"), F.lit(" Arena")).alias("arena_name"),
            self._capacity(team).alias("arena_capacity"),
            rules.pick(team % 3, ["Large", "Medium", "Small"]).alias("market_size_tier"),
            _scaled(57 + (team * 7) % 41, "0.01", "decimal(4,3)").alias("historical_popularity_score"),
        )
        return conform(out, "teams")

    @staticmethod
    def _capacity(team: Column) -> Column:
        return 17000 + team * 160

    def ticket_segments(self) -> DataFrame:
        # VALUES keeps its exact size in the plan, so joins with it broadcast instead of shuffling the fact.
        rows = ", ".join(f"({i}, '{name}', {price}, '{tier}')" for i, name, price, tier in rules.TICKET_SEGMENTS)
        values = self.spark.sql(f"SELECT * FROM VALUES {rows} AS s(segment_id, segment_name, avg_base_price, price_tier)")
        return conform(values, "ticket_segments")

    # ---- the game hub ----------------------------------------------------------------------------
    def _orders(self) -> DataFrame:
        """Orders with the row-wise signals every hub table shares."""
        ok, ck = _big("o_orderkey"), _big("o_custkey")
        promoted = ck % 16 < 8
        temp = 50 + (ok * 37) % 1001  # tenths of a degree
        snow = (temp < 350) & (ok % 4 == 0)
        day = F.to_date("o_orderdate")
        return self.source("orders").select(
            ok.alias("game_id"), ck.alias("fan_id"), _money("o_totalprice").alias("total"),
            day.alias("game_date"), F.month(day).alias("month"),
            (F.weekday(day) >= 4).alias("weekend"),
            F.month(day).isin(12, 1).alias("holiday"),
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("tv"),
            promoted.alias("promoted"),
            F.when(promoted, (ck % 7) * 100 + 300).otherwise(F.lit(0)).cast("bigint").alias("lift_bp"),
            temp.alias("temp10"), snow.alias("snow"),
            (ok % 30 == 0).alias("severe"), ((ok % 6 == 0) | snow).alias("precip"),
        )

    def _hub(self) -> DataFrame:
        """Orders with the venue: home team of the customer, the opponent and the rivalry flag."""
        customer = self.source("customer").select(
            _big("c_custkey").alias("fan_id"), F.col("c_nationkey").alias("home")
        )
        hub = self._orders().join(customer, "fan_id")
        hub = hub.withColumn("away", ((F.col("home") + 1 + F.col("fan_id") % 24) % 25).cast("int"))
        return hub.withColumn("rivalry", (F.col("home") + F.col("away")) % 8 == 0)

    def games(self) -> DataFrame:
        side = self.teams().select("team_id", "team_name", "team_abbr")
        home = side.select(*[F.col(c).alias("home_" + c) for c in side.columns])
        away = side.select(*[F.col(c).alias("away_" + c) for c in side.columns])
        hub = self._hub()
        gid = F.col("game_id")
        hub = hub.join(home, hub.home == home.home_team_id).join(away, hub.away == away.away_team_id)
        home_score = (95 + gid % 35).cast("int")
        gap = (1 + gid % 20).cast("int")
        win = (gid % 2).cast("int")
        out = hub.select(
            "game_id", F.year("game_date").alias("season"), "game_date", "home_team_id", "away_team_id",
            "home_team_name", "away_team_name", "home_team_abbr", "away_team_abbr",
            rules.pick(F.weekday("game_date"), rules.WEEKDAYS).alias("day_of_week"),
            "month",
            F.col("weekend").alias("is_weekend"), F.col("holiday").alias("is_holiday_period"),
            F.col("rivalry").alias("rivalry_flag"), F.col("tv").alias("nationally_televised_flag"),
            _scaled(300 + (gid * 13) % 401, "0.001", "decimal(5,4)").alias("home_team_win_pct_entering_game"),
            _scaled(300 + (gid * 17) % 401, "0.001", "decimal(5,4)").alias("away_team_win_pct_entering_game"),
            F.lit("0.5").alias("home_team_recent_form"), F.lit("0.5").alias("away_team_recent_form"),
            home_score.alias("home_score"),
            F.when(win == 1, home_score - gap).otherwise(home_score + gap).alias("away_score"),
            win.alias("home_win_flag"),
        )
        return conform(out, "games")

    def weather(self) -> DataFrame:
        temp = _scaled(F.col("temp10"), "0.1", "decimal(5,1)")
        out = self._orders().select(
            "game_id", temp.alias("temperature_f"), F.col("precip").alias("precipitation_flag"),
            F.col("snow").alias("snow_flag"), F.col("severe").alias("severe_weather_flag"),
            rules.weather_condition(temp, F.col("precip"), F.col("snow"), F.col("severe")).alias("weather_condition"),
        )
        return conform(out, "weather")

    def promotions(self) -> DataFrame:
        gid, ck, on = F.col("game_id"), F.col("fan_id"), F.col("promoted")
        none = F.lit("None")
        out = self._orders().select(
            gid.alias("promotion_id"), gid, on.alias("promotion_flag"),
            F.when(on, rules.pick(ck % 16 % 8, rules.PROMOTION_TYPES[1:])).otherwise(none).alias("promotion_type"),
            F.when(on, 3500 + (ck % 50) * 500).otherwise(0).alias("promotion_cost"),
            _scaled(F.col("lift_bp"), "0.01", "decimal(5,2)").alias("expected_promotion_lift_pct"),
            F.when(on, rules.pick(gid % 6, rules.SPONSOR_CATEGORIES)).otherwise(none).alias("sponsor_category"),
            F.when(on, 5000 + (gid * 37) % 70001).otherwise(0).alias("sponsor_value_estimate"),
        )
        return conform(out, "promotions")

    def attendance(self) -> DataFrame:
        hub = self._hub()
        base = (
            7400 + F.when(F.col("weekend"), 500).otherwise(0) + F.when(F.col("rivalry"), 700).otherwise(0)
            + F.when(F.col("tv"), 400).otherwise(0) + F.when(F.col("holiday"), 300).otherwise(0) + F.col("lift_bp")
        )
        noise = (F.col("total") * 100).cast("bigint") % 2401 - 1200
        hub = hub.select("game_id", _big(self._capacity(F.col("home"))).alias("cap"), base.alias("base"), noise.alias("noise"))
        hub = hub.withColumn("pct_bp", clip(F.col("base") + F.col("noise"), 5000, 10000))
        ten_k = F.lit(10000)
        actual = int_div(F.col("cap") * F.col("pct_bp"), ten_k)
        expected = int_div(F.col("cap") * clip("base", 5500, 10000), ten_k)
        out = hub.select(
            "game_id", F.col("cap").alias("arena_capacity"), actual.alias("actual_attendance"),
            _scaled(F.col("pct_bp"), "0.01", "decimal(6,2)").alias("capacity_pct"),
            expected.alias("expected_attendance_baseline"),
            (actual - expected).alias("attendance_variance"),
            rules.ladder("pct_bp", [(9500, "Sellout"), (8800, "High"), (7500, "Medium")], "Low").alias("attendance_tier"),
        )
        return conform(out, "attendance")

    def model_predictions(self) -> DataFrame:
        empty = [F.lit(None).alias(f.name) for f in SCHEMAS["model_predictions"].fields[1:]]
        return conform(self._orders().select("game_id", *empty), "model_predictions")

    # ---- facts -----------------------------------------------------------------------------------
    def ticket_sales(self, numbered: bool = True) -> DataFrame:
        """One record per line item; not ``numbered``: without its record id, a projection of the source."""
        price, qty = _money("l_extendedprice"), F.col("l_quantity").cast("int")
        seat = F.concat("l_returnflag", "l_linestatus")
        segment_of = {"AF": 1, "AO": 2, "NF": 3, "NO": 4, "RF": 8, "RO": 9}
        names = {key: rules.TICKET_SEGMENTS[i - 1][1] for key, i in segment_of.items()}
        out = self._lines(numbered).select(
            *([F.col("_record_id").alias("ticket_sale_id")] if numbered else []), _big("l_orderkey").alias("game_id"),
            rules.lookup(seat, segment_of, None).alias("segment_id"),
            rules.lookup(seat, names, None).alias("segment_name"),
            F.lit(50).alias("tickets_available"), qty.alias("tickets_sold"),
            unit_amount((price * 100).cast("bigint"), _big(qty)).alias("avg_ticket_price"),
            (F.col("l_discount").cast("decimal(5,2)") * 400).alias("discount_pct"),
            price.alias("gross_ticket_revenue"),
            F.round(price * (F.lit(1) - F.col("l_discount").cast("decimal(5,2)")), 2).alias("net_ticket_revenue"),
            (qty * 2).alias("sell_through_rate"),
        )
        return conform(out, "ticket_sales", numbered)

    def _lines(self, numbered: bool = True) -> DataFrame:
        """Line items, if ``numbered`` with ``_record_id``: the row's place in the whole table ordered by all its columns, nulls first.

        The source key (order, line number) repeats in the data, so the id is the row's place in that total
        order: it depends on the rows alone, not on how the files split or on retries, and rows equal in
        every column are interchangeable. ``positions`` spreads the order over range partitions (no task
        holds a crowded key) and writes the numbered table once for this adapter.
        """
        if not numbered:
            return self.source("lineitem")
        if self._numbered is None:
            lines = self.source("lineitem")
            order = [F.asc_nulls_first(c) for c in lines.columns]
            self._numbered = positions(lines.withColumn("_table", F.lit(0)), "_table", order, "_record_id").drop("_table")
        return self._numbered

    def _category_sales(self, name: str, odd: int, key: str, share: str, kinds: list, attendance: DataFrame, numbered: bool) -> DataFrame:
        """Concession or merchandise records: one per line item of the given parity."""
        ids = ["_record_id"] if numbered else []
        which = F.col(key) % len(kinds)
        gross = F.round(_money("l_extendedprice") * _dec(share), 2)
        cost_share = F.element_at(F.array(*[_dec(c) for _, _, c in kinds]), (which + 1).cast("int"))
        price = F.element_at(F.array(*[F.lit(p).cast("decimal(8,2)") for _, p, _ in kinds]), (which + 1).cast("int"))
        lines = self._lines(numbered).where(F.col("l_linenumber") % 2 == odd).select(
            *ids, _big("l_orderkey").alias("game_id"), rules.pick(which, [n for n, _, _ in kinds]).alias("category"),
            F.col("l_quantity").cast("int").alias("units_sold"), price.alias("avg_unit_price"),
            _money(gross).alias("gross_revenue"), _money(F.round(_money(gross) * cost_share, 2)).alias("estimated_cost"),
        )
        venue = attendance.select("game_id", "actual_attendance", "attendance_tier")
        out = lines.join(venue, "game_id").select(
            *[F.col(c).alias(SCHEMAS[name].fields[0].name) for c in ids], *[c for c in lines.columns if c not in ids], "actual_attendance", "attendance_tier",
            (F.col("gross_revenue") - F.col("estimated_cost")).alias("gross_margin"),
            unit_amount((F.col("gross_revenue") * 100).cast("bigint"), _big("actual_attendance")).alias("per_cap_spend"),
            rules.inventory_units("units_sold", "attendance_tier").alias("recommended_inventory_units"),
        )
        return conform(out, name, numbered)

    def concessions(self, attendance: DataFrame | None = None, numbered: bool = True) -> DataFrame:
        attendance = self.attendance() if attendance is None else attendance
        return self._category_sales("concessions", 1, "l_suppkey", "0.30", rules.CONCESSION_CATEGORIES, attendance, numbered)

    def merchandise(self, attendance: DataFrame | None = None, numbered: bool = True) -> DataFrame:
        attendance = self.attendance() if attendance is None else attendance
        return self._category_sales("merchandise", 0, "l_partkey", "0.20", rules.MERCHANDISE_CATEGORIES, attendance, numbered)

    # ---- fans ------------------------------------------------------------------------------------
    def fan_profiles(self) -> DataFrame:
        ck = _big("c_custkey")
        ticket, con, merch = 40 + (ck * 17) % 411, 8 + (ck * 11) % 38, 5 + (ck * 7) % 76
        games = 1 + ck % 41
        promo = _scaled((ck * 13) % 101, "0.01", "decimal(5,4)")
        email = _scaled((ck * 29) % 101, "0.01", "decimal(5,4)")
        score = F.floor(rules.fan_value(ticket, games, merch, con, email, promo) * 10000.0 + 0.5).cast("bigint")
        status = dict(zip(["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], rules.LOYALTY_STATUSES))
        out = self.source("customer").select(
            ck.alias("fan_id"), rules.pick(ck % 6, rules.AGE_GROUPS).alias("age_group"),
            rules.pick(F.col("c_nationkey") % 6, rules.HOUSEHOLD_TYPES).alias("household_type"),
            rules.pick(ck % 5, rules.DISTANCE_BUCKETS).alias("distance_from_arena_bucket"),
            rules.pick(ck % 6, [s[1] for s in rules.TICKET_SEGMENTS[:6]]).alias("preferred_ticket_segment"),
            rules.lookup("c_mktsegment", status, None).alias("loyalty_status"),
            games.alias("games_attended_last_12_months"), ticket.alias("avg_ticket_spend"),
            con.alias("avg_concession_spend"), merch.alias("avg_merchandise_spend"),
            promo.alias("promotion_usage_rate"), email.alias("email_engagement_score"),
            _scaled(score, "0.0001", "decimal(5,4)").alias("fan_value_score"),
        )
        return conform(out, "fan_profiles")

    def fan_transactions(self) -> DataFrame:
        part = lambda share: F.round(F.col("total") * _dec(share), 2)
        out = self._orders().select(
            F.col("game_id").alias("transaction_id"), "fan_id", "game_id",
            part("0.50").alias("ticket_spend"), part("0.30").alias("concession_spend"),
            part("0.20").alias("merchandise_spend"),
            (F.col("promoted") & (F.col("game_id") % 3 == 0)).alias("used_promotion"),
            (part("0.50") + part("0.30") + part("0.20")).alias("total_spend"),
            F.col("game_date").alias("transaction_date"),
        )
        return conform(out, "fan_transactions")

    def build(self, name: str) -> DataFrame:
        return getattr(self, name)()
