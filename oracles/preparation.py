"""Statements for the audit, validation, cleaning, feature and derived-column jobs."""

from __future__ import annotations

from venue_analytics.sources.schemas import SCHEMAS

from .base import avg, big, cnt, dbl, even, hu

TABLE_NAMES = [
    "teams", "games", "weather", "promotions", "attendance", "ticket_segments", "ticket_sales", "concessions",
    "merchandise", "fan_profiles", "fan_transactions", "model_predictions",
]


def _fails(condition: str, unknown_fails: bool) -> str:
    return f"COUNT(*) FILTER (WHERE NOT COALESCE({condition}, {'FALSE' if unknown_fails else 'TRUE'}))"


def must(table: str, name: str, condition: str) -> tuple[str, str, str]:
    return table, name, f"SELECT {_fails(condition, True)} FROM {table}"


def may(table: str, name: str, condition: str) -> tuple[str, str, str]:
    return table, name, f"SELECT {_fails(condition, False)} FROM {table}"


def uniq(table: str, c: str) -> tuple[str, str, str]:
    return table, f"{c} is unique", f"SELECT COUNT({c}) - COUNT(DISTINCT {c}) FROM {table}"


def present(table: str, c: str) -> tuple[str, str, str]:
    return table, f"{c} is not null", f"SELECT COUNT(*) - COUNT({c}) FROM {table}"


def ref(table: str, c: str, other: str, key: str) -> tuple[str, str, str]:
    return table, f"{c} exists in {other}", f"SELECT COUNT(*) FROM {table} x WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {other} y WHERE y.{key} = x.{c})"


def floor0(table: str, c: str) -> tuple[str, str, str]:
    return may(table, f"{c} >= 0", f"{c} >= 0")


def above0(table: str, c: str) -> tuple[str, str, str]:
    return may(table, f"{c} > 0", f"{c} > 0")


def unit(table: str, c: str) -> tuple[str, str, str]:
    return may(table, f"{c} in 0..1", f"{c} BETWEEN 0 AND 1")


def nonneg(table: str, c: str) -> tuple[str, str, str]:
    return must(table, f"{c} is non-negative", f"{c} >= 0")


RULES = [
    uniq("teams", "team_id"), uniq("teams", "team_name"), uniq("teams", "team_abbr"), above0("teams", "arena_capacity"),
    must("teams", "historical_popularity_score in 0..1", "historical_popularity_score BETWEEN 0 AND 1"),
    uniq("games", "game_id"), present("games", "home_team_id"), present("games", "away_team_id"),
    must("games", "game_date from 2019", "year(game_date) >= 2019"), may("games", "month in 1..12", "month BETWEEN 1 AND 12"),
    unit("games", "home_team_win_pct_entering_game"), unit("games", "away_team_win_pct_entering_game"),
    may("games", "home_win_flag is a known value", "home_win_flag IN (0, 1)"),
    uniq("weather", "game_id"), present("weather", "game_id"),
    uniq("promotions", "game_id"), present("promotions", "game_id"), present("promotions", "promotion_type"),
    uniq("attendance", "game_id"), nonneg("attendance", "actual_attendance"),
    must("attendance", "actual_attendance within capacity", "actual_attendance <= arena_capacity"),
    may("attendance", "attendance_tier is a known value", "attendance_tier IN ('Low', 'Medium', 'High', 'Sellout')"),
    uniq("ticket_segments", "segment_id"), uniq("ticket_segments", "segment_name"), above0("ticket_segments", "avg_base_price"),
    present("ticket_sales", "game_id"), present("ticket_sales", "segment_id"), above0("ticket_sales", "tickets_available"),
    floor0("ticket_sales", "tickets_sold"), floor0("ticket_sales", "avg_ticket_price"),
    nonneg("ticket_sales", "gross_ticket_revenue"), nonneg("ticket_sales", "net_ticket_revenue"),
    must("ticket_sales", "tickets_sold within available", "tickets_sold <= tickets_available"),
    *[r for f in ("concessions", "merchandise") for r in (present(f, "game_id"), floor0(f, "units_sold"), nonneg(f, "gross_revenue"), nonneg(f, "gross_margin"))],
    uniq("fan_profiles", "fan_id"), floor0("fan_profiles", "games_attended_last_12_months"), nonneg("fan_profiles", "avg_ticket_spend"),
    floor0("fan_profiles", "avg_concession_spend"), floor0("fan_profiles", "avg_merchandise_spend"), unit("fan_profiles", "promotion_usage_rate"),
    unit("fan_profiles", "email_engagement_score"), unit("fan_profiles", "fan_value_score"),
    uniq("fan_transactions", "transaction_id"), present("fan_transactions", "fan_id"), present("fan_transactions", "game_id"),
    floor0("fan_transactions", "ticket_spend"), floor0("fan_transactions", "concession_spend"), floor0("fan_transactions", "merchandise_spend"),
    nonneg("fan_transactions", "total_spend"),
    uniq("model_predictions", "game_id"), present("model_predictions", "game_id"),
    ref("games", "home_team_id", "teams", "team_id"), ref("games", "away_team_id", "teams", "team_id"),
    *[ref(f, "game_id", "games", "game_id") for f in ("weather", "promotions", "attendance", "concessions", "merchandise", "model_predictions")],
    ref("ticket_sales", "game_id", "games", "game_id"), ref("ticket_sales", "segment_id", "ticket_segments", "segment_id"),
    ref("fan_transactions", "fan_id", "fan_profiles", "fan_id"), ref("fan_transactions", "game_id", "games", "game_id"),
]
# The declared schema's constraints the cleaning rules leave out: NOT NULL of non-nullable columns, record ids as keys.
_NAMED = {(t, n) for t, n, _ in RULES}
RULES += [present(t, f.name) for t in dict.fromkeys(t for t, _, _ in RULES) for f in SCHEMAS[t].fields if not f.nullable and (t, f"{f.name} is not null") not in _NAMED]
RULES += [uniq(t, c) for t, c in (("ticket_sales", "ticket_sale_id"), ("concessions", "concession_id"), ("merchandise", "merchandise_id"))]
ALL_RULES = "\nUNION ALL ".join(
    f"SELECT '{name}' AS rule, '{table}' AS table_name, {big(f'({sql})')} AS violations" for table, name, sql in RULES
)


def bound(c: str, low: str | None = None, high: str | None = None) -> str:
    x = c
    if low is not None:
        x = f"CASE WHEN {c} < {low} THEN {low} ELSE {x} END"
    if high is not None:
        x = f"CASE WHEN {c} > {high} THEN {high} ELSE {x} END"
    return f"{dbl(x)} AS {c}"


def ints(*names: str) -> str:
    return ", ".join(f"{big(n)} AS {n}" for n in names)


def dbls(*names: str) -> str:
    return ", ".join(f"{dbl(n)} AS {n}" for n in names)


GAME_TEXT = "game_date, home_team_name, away_team_name, home_team_abbr, away_team_abbr, day_of_week"
CATEGORY = f"""SELECT game_id, category, {ints('units_sold', 'recommended_inventory_units')}, {dbls('avg_unit_price', 'estimated_cost', 'per_cap_spend')},
 {bound('gross_revenue', '0')}, {bound('gross_margin', '0')} FROM """

# ---- features ----
FLAGS = ["is_weekend", "is_holiday_period", "rivalry_flag", "nationally_televised_flag", "promotion_flag", "snow_flag", "severe_weather_flag", "precipitation_flag"]
FEATURE_BASE = f"""WITH fb AS (
 SELECT x.* EXCLUDE ({', '.join(FLAGS)}), {', '.join(f'{big(f)} AS {f}' for f in FLAGS)}, x.total_revenue AS tr,
  {dbl('h.historical_popularity_score')} AS home_team_popularity, {dbl('v.historical_popularity_score')} AS away_team_popularity,
  h.arena_capacity AS arena_capacity_feat
 FROM (SELECT r.*, w.* EXCLUDE (game_id) FROM rev0 r JOIN weather w USING (game_id)) x JOIN teams h ON h.team_id = home_team_id JOIN teams v ON v.team_id = away_team_id),
 gm AS (SELECT {avg('actual_attendance')} AS ga_att, {avg('tr')} AS ga_rev FROM fb @FILL@),
 bp AS (SELECT {avg('avg_base_price')} AS base FROM ticket_segments),
 fx AS (SELECT fb.*, {', '.join(
     f"COALESCE(CAST(SUM({c}) OVER w{n} AS DOUBLE) / NULLIF(CAST(COUNT({c}) OVER w{n} AS DOUBLE), 0e0), {g}) AS rolling_{s}_{n}"
     for s, c, g in (('att', 'actual_attendance', 'ga_att'), ('rev', 'tr', 'ga_rev')) for n in (3, 5))},
  base * (1e0 + 0.15e0 * {dbl('rivalry_flag')} + 0.10e0 * {dbl('nationally_televised_flag')} + 0.08e0 * {dbl('is_weekend')} + 0.12e0 * home_team_popularity) AS planned_avg_base_price,
  CASE day_of_week WHEN 'Monday' THEN 0 WHEN 'Tuesday' THEN 1 WHEN 'Wednesday' THEN 2 WHEN 'Thursday' THEN 3 WHEN 'Friday' THEN 4 WHEN 'Saturday' THEN 5 WHEN 'Sunday' THEN 6 END AS dow_ordinal
 FROM fb, gm, bp
 WINDOW w3 AS (PARTITION BY home_team_id ORDER BY game_date, game_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
  w5 AS (PARTITION BY home_team_id ORDER BY game_date, game_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
"""
SHARED = f"""{ints(*FLAGS, 'arena_capacity_feat', 'dow_ordinal', 'month', 'season')}, game_id, game_date, promotion_type, rolling_att_3, rolling_att_5,
 home_team_popularity, away_team_popularity, {dbls('expected_promotion_lift_pct', 'home_team_win_pct_entering_game', 'away_team_win_pct_entering_game',
 'home_team_recent_form', 'away_team_recent_form', 'temperature_f')}"""
EXTRA = f"{dbls('promotion_cost', 'sponsor_value_estimate')}, planned_avg_base_price, rolling_rev_3, rolling_rev_5, {dbl('tr')} AS total_game_day_revenue"
PLAIN = FEATURE_BASE.replace("@FILL@", "")
FORM = """WITH side AS (SELECT game_id, game_date, home_team_id AS team, home_win_flag AS won, 'h' AS s FROM games
 UNION ALL SELECT game_id, game_date, away_team_id, 1 - home_win_flag, 'a' FROM games),
 f AS (SELECT game_id, s, COALESCE(CAST(SUM(won) OVER w AS DOUBLE) / NULLIF(CAST(COUNT(won) OVER w AS DOUBLE), 0e0), 0.5e0) AS form FROM side
  WINDOW w AS (PARTITION BY team ORDER BY game_date, game_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
SELECT game_id, MAX(form) FILTER (WHERE s = 'h') AS home_team_recent_form, MAX(form) FILTER (WHERE s = 'a') AS away_team_recent_form FROM f GROUP BY game_id"""
DEMAND = """(0.72e0 + 0.08e0 * CAST(h.historical_popularity_score AS DOUBLE) + 0.06e0 * CAST(v.historical_popularity_score AS DOUBLE)
 + 0.04e0 * CAST(home_team_win_pct_entering_game AS DOUBLE) + 0.03e0 * CAST(away_team_win_pct_entering_game AS DOUBLE)
 + CASE WHEN is_weekend THEN 0.05e0 ELSE 0e0 END + CASE WHEN rivalry_flag THEN 0.07e0 ELSE 0e0 END + CASE WHEN nationally_televised_flag THEN 0.04e0 ELSE 0e0 END
 + CASE WHEN is_holiday_period THEN 0.03e0 ELSE 0e0 END + CASE WHEN promotion_flag THEN CAST(expected_promotion_lift_pct AS DOUBLE) / 100e0 ELSE 0e0 END
 - CASE WHEN severe_weather_flag THEN 0.08e0 WHEN snow_flag THEN 0.04e0 WHEN precipitation_flag THEN 0.02e0 ELSE 0e0 END)"""
SCORE = """(0.35e0 * (CAST(avg_ticket_spend AS DOUBLE) / 450e0) + 0.20e0 * (CAST(games_attended_last_12_months AS DOUBLE) / 41e0)
 + 0.15e0 * (CAST(avg_merchandise_spend AS DOUBLE) / 80e0) + 0.15e0 * (CAST(avg_concession_spend AS DOUBLE) / 45e0)
 + 0.10e0 * CAST(email_engagement_score AS DOUBLE) + 0.05e0 * (1e0 - CAST(promotion_usage_rate AS DOUBLE)))"""
PAIRS = "(1, 2), (1, 3), (4, 5), (6, 4), (7, 8), (24, 1)"
BUFFER = "CASE attendance_tier WHEN 'Sellout' THEN 120 WHEN 'High' THEN 115 WHEN 'Medium' THEN 110 ELSE 105 END"

SQL: dict[str, str] = {
    **{
        f"c16_{n}": "SELECT " + ", ".join(
            f"CAST({f.name} AS DOUBLE) AS {f.name}" if f.dataType.typeName() == "decimal"
            else f"CAST({f.name} AS BIGINT) AS {f.name}" if f.dataType.typeName() in ("integer", "short") else f.name
            for f in SCHEMAS[n].fields
        ) + f" FROM {n}"
        for n in ("weather", "promotions", "ticket_segments")
    },
    "s04_catalog_layers": """SELECT c.catalog, c.table_name, c.layer,
 CAST(CASE c.table_name WHEN 'promotions' THEN (SELECT COUNT(*) FROM promotions) WHEN 'ticket_segments' THEN (SELECT COUNT(*) FROM ticket_segments) ELSE 0 END AS BIGINT) AS rows
FROM (VALUES ('cleaned_first', 'promotions', 'cleaned'), ('cleaned_first', 'ticket_segments', 'raw'), ('cleaned_first', 'weather', 'empty'),
 ('raw_first', 'promotions', 'raw'), ('raw_first', 'ticket_segments', 'raw'), ('raw_first', 'weather', 'empty')) c(catalog, table_name, layer)""",
    "s01_csv_round_trip": f"""SELECT {cnt()} AS rows, CAST(0 AS BIGINT) AS bad_rows, CAST(COUNT(*) FILTER (WHERE segment_name IS NULL) AS BIGINT) AS null_segment_names,
 CAST(SUM(tickets_sold) AS BIGINT) AS tickets_sold, CAST(SUM(net_ticket_revenue) AS DOUBLE) AS net_ticket_revenue FROM ticket_sales""",
    "s03_row_counts": "\nUNION ALL ".join(f"SELECT '{n}' AS table_name, {cnt()} AS rows FROM {n}" for n in TABLE_NAMES),
    "c18_validate_all": f"SELECT *, violations = 0 AS passed FROM ({ALL_RULES})",
    "c17_issue_summary": f"SELECT {cnt()} AS rules, {cnt('NULLIF(violations, 0)')} AS issues, bool_and(violations = 0) AS all_passed FROM ({ALL_RULES})",
    "c_clean_teams": f"""SELECT {ints('team_id', 'arena_capacity')}, team_abbr, team_name, team_city, conference, division, arena_name, market_size_tier,
 {dbls('historical_popularity_score')} FROM teams WHERE team_id IS NOT NULL AND team_name IS NOT NULL""",
    "c_clean_games": f"""SELECT game_id, {ints('season', 'home_team_id', 'away_team_id', 'month', 'home_score', 'away_score', 'home_win_flag')}, {GAME_TEXT},
 is_weekend, is_holiday_period, rivalry_flag, nationally_televised_flag, {bound('home_team_win_pct_entering_game', '0', '1')},
 {bound('away_team_win_pct_entering_game', '0', '1')}, {dbls('home_team_recent_form', 'away_team_recent_form')} FROM games""",
    "c_clean_attendance": f"""SELECT game_id, {ints('arena_capacity', 'expected_attendance_baseline', 'attendance_variance')}, attendance_tier,
 {big('greatest(actual_attendance, 0)')} AS actual_attendance,
 {even('greatest(actual_attendance, 0) / CAST(arena_capacity AS DOUBLE) * 100e0', 2)} AS capacity_pct FROM attendance""",
    "c_clean_ticket_sales": f"""SELECT ticket_sale_id, game_id, {ints('segment_id', 'tickets_available')}, segment_name, {big('least(tickets_sold, tickets_available)')} AS tickets_sold,
 {dbls('avg_ticket_price', 'sell_through_rate')}, {bound('discount_pct', '0', '100')}, {bound('gross_ticket_revenue', '0')}, {bound('net_ticket_revenue', '0')} FROM ticket_sales""",
    "c_clean_concessions": CATEGORY.replace("SELECT ", "SELECT concession_id, ", 1) + "concessions",
    "c_clean_merchandise": CATEGORY.replace("SELECT ", "SELECT merchandise_id, ", 1) + "merchandise",
    "c_clean_fan_profiles": f"""SELECT fan_id, age_group, household_type, distance_from_arena_bucket, preferred_ticket_segment, loyalty_status,
 {ints('games_attended_last_12_months')}, {bound('avg_ticket_spend', '0')}, {bound('avg_concession_spend', '0')}, {bound('avg_merchandise_spend', '0')},
 {bound('promotion_usage_rate', '0', '1')}, {bound('email_engagement_score', '0', '1')}, {bound('fan_value_score', '0', '1')} FROM fan_profiles""",
    "c_clean_fan_transactions": f"""SELECT transaction_id, fan_id, game_id, {bound('ticket_spend', '0')}, {bound('concession_spend', '0')}, {bound('merchandise_spend', '0')},
 used_promotion, {dbl('greatest(ticket_spend, 0) + greatest(concession_spend, 0) + greatest(merchandise_spend, 0)')} AS total_spend, transaction_date FROM fan_transactions""",
    "f13_features_full": PLAIN + f"""SELECT {SHARED}, {EXTRA}, {ints('home_team_id', 'away_team_id', 'home_score', 'away_score', 'home_win_flag', 'actual_attendance')},
 home_team_name, away_team_name, home_team_abbr, away_team_abbr, day_of_week, attendance_tier, weather_condition, sponsor_category,
 {dbl('ticket_rev')} AS total_net_ticket_revenue, {dbl('con_rev')} AS total_concession_revenue, {dbl('merch_rev')} AS total_merchandise_revenue FROM fx""",
    "f13_features_attendance": PLAIN + f"SELECT {SHARED}, {ints('actual_attendance')} FROM fx",
    "f13_features_revenue": PLAIN + f"SELECT {SHARED}, {EXTRA} FROM fx WHERE tr > 0",
    "f10_features_train_fill": FEATURE_BASE.replace("@FILL@", "WHERE season < (SELECT MAX(season) FROM games)")
    + "SELECT game_id, rolling_att_3, rolling_att_5, rolling_rev_3, rolling_rev_5 FROM fx",
    "g1_attendance_tier": "SELECT game_id, attendance_tier FROM attendance",
    "g2_demand_baseline": f"""SELECT game_id, {hu('s', 6)} AS demand_share, {big('floor(cap * least(s, 1e0))')} AS expected_attendance,
 {big('actual_attendance - floor(cap * least(s, 1e0))')} AS variance
FROM (SELECT x.game_id, x.actual_attendance, h.arena_capacity AS cap, least(greatest({DEMAND}, 0.55e0), 1.02e0) AS s
 FROM gapw x JOIN teams h ON h.team_id = x.home_team_id JOIN teams v ON v.team_id = x.away_team_id)""",
    "g3_weather_condition": "SELECT game_id, weather_condition FROM weather",
    "g4_inventory_recommendation": f"""SELECT game_id, category, {ints('units_sold')}, {cnt()} AS records, {big(f'units_sold * {BUFFER} // 100')} AS recommended_inventory_units
FROM (SELECT game_id, category, units_sold FROM concessions UNION ALL SELECT game_id, category, units_sold FROM merchandise) JOIN attendance USING (game_id)
GROUP BY game_id, category, units_sold, attendance_tier""",
    "g5_margin_and_units": f"""SELECT category, {dbl('SUM(estimated_cost)')} AS cost, {dbl('SUM(gross_revenue - estimated_cost)')} AS margin,
 {big('SUM(greatest(1, CAST(gross_revenue * 100 AS BIGINT) // CAST(avg_unit_price * 100 AS BIGINT)))')} AS implied_units FROM concessions GROUP BY ALL""",
    "g6_team_form": FORM,
    "g7_fan_value_score": f"SELECT fan_id, {hu(SCORE, 4)} AS fan_value_score FROM fan_profiles",
    "g8_calendar_flags": f"""SELECT game_id, isodow(game_date) >= 5 AS is_weekend, month IN (12, 1) AS is_holiday_period,
 ((home_team_id, away_team_id) IN ({PAIRS}) OR (away_team_id, home_team_id) IN ({PAIRS})) AS rivalry_flag,
 (home_team_id IN (4, 6, 1, 7, 9, 2, 3) OR away_team_id IN (4, 6, 1, 7, 9, 2, 3)) AS nationally_televised_flag FROM games""",
    "g9_discounted_spend": f"""SELECT transaction_id, {dbl('greatest(t, 0)')} AS ticket_spend, {dbl('greatest(c, 0)')} AS concession_spend,
 {dbl('greatest(t + c + merchandise_spend, 0)')} AS total_spend
FROM (SELECT *, CASE WHEN used_promotion THEN round(ticket_spend * 0.88, 2) ELSE ticket_spend END AS t,
 CASE WHEN used_promotion THEN round(concession_spend * 1.15, 2) ELSE concession_spend END AS c FROM fan_transactions)""",
}
SQL["g5_merchandise_margin_and_units"] = SQL["g5_margin_and_units"].replace("FROM concessions", "FROM merchandise")
