"""Statements for the report, dashboard, notebook and scenario jobs."""

from __future__ import annotations

from itertools import combinations

from . import preparation
from .base import avg, avgr, big, cnt, dbl, div, even, hu
from .preparation import PLAIN

M4 = "game_id, game_date, home_team_name, away_team_name"
FAN = ["games_attended_last_12_months", "avg_ticket_spend", "avg_concession_spend", "avg_merchandise_spend",
       "promotion_usage_rate", "email_engagement_score", "fan_value_score"]
CORR = ["is_weekend", "rivalry_flag", "nationally_televised_flag", "promotion_flag", "home_team_win_pct_entering_game",
        "away_team_win_pct_entering_game", "home_team_popularity", "away_team_popularity", "temperature_f", "snow_flag",
        "rolling_att_3", "month", "actual_attendance"]

PAIRS = list(combinations(CORR, 2))


def dsum(x: str) -> str:
    return dbl(f"SUM({x})")


def driver(flag: str) -> str:
    on, off = (avg(f"CASE WHEN {p}{flag} THEN capacity_pct END") for p in ("", "NOT "))
    return f"SELECT '{flag}' AS driver, {on} AS avg_capacity_with, {off} AS avg_capacity_without, {on} - {off} AS lift FROM gap"


def top(key: str, value: str, name: str, n: int, source: str = "ga") -> str:
    return f"SELECT {key}, {avg(value)} AS {name} FROM {source} GROUP BY {key} ORDER BY {name} DESC, {key} LIMIT {n}"


ERR = "(actual_attendance - expected_attendance_baseline)"
FORECAST = f"""SELECT {M4}, season, day_of_week, month, actual_attendance, expected_attendance_baseline AS predicted_attendance,
 {ERR} AS attendance_prediction_error, {ERR} AS actual_minus_predicted, 100 * CAST({ERR} AS BIGINT) < -8 * CAST(actual_attendance AS BIGINT) AS underperforming,
 capacity_pct, attendance_tier, promotion_type FROM gap"""


def line(cte: str) -> str:
    return f"""SELECT game_id, {dbl('c.rev')} AS revenue, {dbl('c.margin')} AS margin, {big('c.units')} AS units, {big('c.inv')} AS inventory,
 {big('actual_attendance')} AS actual_attendance, {dbl('capacity_pct')} AS capacity_pct, attendance_tier, {div('c.rev', 'actual_attendance')} AS per_cap
 FROM {cte} c LEFT JOIN attendance USING (game_id)"""


def kpi_line(name: str, cte: str) -> str:
    return f"""SELECT '{name}' AS line, {dsum('rev')} AS total_revenue, {hu(f"avg({div('rev', 'actual_attendance')})", 6)} AS avg_per_cap,
 (SELECT category FROM {name} GROUP BY 1 ORDER BY SUM(gross_revenue) DESC, 1 LIMIT 1) AS top_category
 FROM {cte} JOIN attendance USING (game_id)"""


INV = f"""SELECT game_id, game_date, substr(away_team_name, 1, 10) AS game_label, {big('actual_attendance')} AS actual_attendance, attendance_tier,
 {even(dbl('c.rev'), 0)} AS con_rev, {even(div('c.rev', 'actual_attendance'), 2)} AS con_per_cap, {big('c.inv')} AS con_inventory,
 {even(dbl('m.rev'), 0)} AS merch_rev, {even(div('m.rev', 'actual_attendance'), 2)} AS merch_per_cap, {big('m.inv')} AS merch_inventory
FROM ga JOIN con c USING (game_id) JOIN mer m USING (game_id)"""
SEGMENT = f"""SELECT loyalty_status AS segment, {cnt('fan_id')} AS fan_count, {avg('games_attended_last_12_months')} AS avg_games, {avg('avg_ticket_spend')} AS avg_ticket,
 {avg('avg_concession_spend')} AS avg_concession, {avg('avg_merchandise_spend')} AS avg_merch, {avg('promotion_usage_rate')} AS avg_promo,
 {avg('email_engagement_score')} AS avg_email, {avg('fan_value_score')} AS avg_value,
 {avg('avg_ticket_spend')} + {avg('avg_concession_spend')} + {avg('avg_merchandise_spend')} AS avg_total_spend FROM fan_profiles GROUP BY loyalty_status"""


def described(source: str, c: str, scale: int) -> str:
    v = f"CAST({c} * {10**scale} AS HUGEINT)"
    n, s, q = dbl(f"COUNT({c})"), dbl(f"SUM({v})"), dbl(f"SUM({v} * {v})")
    spread = f"({q} - {s} * {s} / {n}) / ({n} - 1e0)"
    pct = ", ".join(f"{hu(f'quantile_cont({dbl(c)}, {p})', 6)} AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    return f"""SELECT '{c}' AS "column", {cnt(c)} AS count, {avgr(c, 6)} AS mean, {hu(f'(sqrt(greatest({spread}, 0e0)) / {10**scale}e0)', 6)} AS std,
 {dbl(f'MIN({c})')} AS min, {pct}, {dbl(f'MAX({c})')} AS max FROM {source}"""


def binned(source: str, c: str, bins: int) -> str:
    return f"""SELECT '{c}' AS "column", {big('b')} AS bin, {hu('(lo + b * w)', 6)} AS low, {hu('(lo + b * w + w)', 6)} AS high, {cnt()} AS rows
 FROM (SELECT lo, w, least(floor((x - lo) / w), {bins - 1}) AS b FROM (SELECT {dbl(c)} AS x FROM {source}),
  (SELECT {dbl(f'MIN({c})')} AS lo, ({dbl(f'MAX({c})')} - {dbl(f'MIN({c})')}) / {bins}e0 AS w FROM {source})) GROUP BY b, lo, w"""


REVENUE = "(SELECT total_revenue AS total_game_day_revenue FROM rev0 WHERE total_revenue > 0)"
BASE = f"""WITH b1 AS (SELECT {avg('actual_attendance')} AS avg_att, {avg('arena_capacity')} AS avg_cap, {avg('capacity_pct')} AS avg_cap_pct FROM attendance),
 b2 AS (SELECT {avg('rev')} AS avg_ticket_rev FROM tix), b3 AS (SELECT {avg('rev')} AS avg_con_rev FROM con), b4 AS (SELECT {avg('rev')} AS avg_merch_rev FROM mer),
 b5 AS (SELECT {avg('avg_ticket_price')} AS avg_ticket_price FROM ticket_sales), b6 AS (SELECT {avg('avg_unit_price')} AS con_unit_price FROM concessions),
 b7 AS (SELECT {avg('avg_unit_price')} AS merch_unit_price FROM merchandise),
 b AS (SELECT *, avg_con_rev / avg_att AS con_per_cap, avg_merch_rev / avg_att AS merch_per_cap, avg_ticket_rev + avg_con_rev + avg_merch_rev AS total_baseline
  FROM b1, b2, b3, b4, b5, b6, b7)"""
SCEN = BASE + """,
 sc AS (SELECT p_partkey AS scenario_id, p_partkey % 41 - 20 AS att_change, p_partkey * 7 % 41 - 20 AS price_change, p_partkey * 3 % 26 AS promo_lift,
  p_partkey * 11 % 51 - 20 AS con_change, p_partkey * 13 % 51 - 20 AS merch_change FROM part),
 s1 AS (SELECT *, avg_att * (1e0 + CAST(att_change + promo_lift AS DOUBLE) / 100e0) AS projected_attendance FROM sc, b),
 s2 AS (SELECT *, least(projected_attendance / avg_cap * 100e0, 100e0) AS projected_capacity_pct, projected_attendance / avg_att AS ratio FROM s1),
 s3 AS (SELECT *, CASE WHEN projected_capacity_pct >= 97 THEN 1.20e0 WHEN projected_capacity_pct >= 88 THEN 1.15e0 WHEN projected_capacity_pct >= 75 THEN 1.10e0 ELSE 1.05e0 END AS inventory_buffer,
  avg_ticket_rev * ratio * (1e0 + price_change::DOUBLE / 100e0) AS ticket_revenue, avg_con_rev * (1e0 + con_change::DOUBLE / 100e0) * ratio AS concession_revenue,
  avg_merch_rev * (1e0 + merch_change::DOUBLE / 100e0) * ratio AS merchandise_revenue FROM s2)
"""
CATS = f"""(SELECT 'Con: ' || category AS category, {avg('per_cap_spend')} AS per_cap, {avg('avg_unit_price')} AS unit_price FROM concessions GROUP BY category
 UNION ALL SELECT 'Merch: ' || category, {avg('per_cap_spend')}, {avg('avg_unit_price')} FROM merchandise GROUP BY category)"""


def trunc(x: str) -> str:
    return big(f"trunc({x})")


SQL: dict[str, str] = {
    "r1_game_mart": f"""SELECT {M4}, {big('season')} AS season, {big('month')} AS month, day_of_week, is_weekend, rivalry_flag, nationally_televised_flag, promotion_flag,
 promotion_type, {big('actual_attendance')} AS actual_attendance, {dbl('capacity_pct')} AS capacity_pct, {dbl('ticket_rev')} AS net_ticket_revenue,
 {dbl('con_rev')} AS con_rev, {dbl('merch_rev')} AS merch_rev, {dbl('total_revenue')} AS total_revenue FROM rev0""",
    "r2_attendance_drivers": "\nUNION ALL ".join(driver(f) for f in ("is_weekend", "rivalry_flag", "promotion_flag", "nationally_televised_flag")),
    "r3_top_opponents": top("away_team_name", "capacity_pct", "avg_capacity_pct", 5),
    "r3_top_months": f"SELECT {big('month')} AS month, avg_capacity_pct FROM ({top('month', 'capacity_pct', 'avg_capacity_pct', 3)})",
    "r3_emptiest_games": f"SELECT {M4}, {dbl('capacity_pct')} AS capacity_pct, promotion_type, day_of_week FROM gap x ORDER BY x.capacity_pct, game_id LIMIT 5",
    "r4_segment_totals": f"""SELECT segment_name, {dsum('net_ticket_revenue')} AS total_net_rev, {avg('avg_ticket_price')} AS avg_price, {avg('sell_through_rate')} AS avg_st
 FROM ticket_sales GROUP BY ALL""",
    "r5_promotion_summary": f"SELECT promotion_type, {cnt()} AS games, {avg('capacity_pct')} AS avg_cap, {avg('total_revenue')} AS avg_rev FROM rev0 GROUP BY ALL",
    "r5_weekday_promotions": f"SELECT promotion_type, {avg('capacity_pct')} AS avg_cap FROM gap WHERE NOT is_weekend GROUP BY ALL",
    "r6_category_margins": "\nUNION ALL ".join(
        f"SELECT '{f}' AS line, category, {dsum('gross_revenue')} AS revenue, {dsum('gross_margin')} AS margin, {avg('per_cap_spend')} AS avg_per_cap, "
        f"{even(div('SUM(gross_margin)', 'SUM(gross_revenue)') + ' * 100e0', 1)} AS margin_pct FROM {f} GROUP BY category" for f in ("concessions", "merchandise")),
    "r7_rivalry_merchandise_lift": f"""SELECT rivalry, regular, rivalry - regular AS lift FROM (SELECT {avg('CASE WHEN rivalry_flag THEN per_cap_spend END')} AS rivalry,
 {avg('CASE WHEN NOT rivalry_flag THEN per_cap_spend END')} AS regular FROM merchandise JOIN games USING (game_id))""",
    "r8_loyalty_profile": f"""SELECT loyalty_status, {cnt()} AS fans, {avg('avg_ticket_spend')} AS avg_ticket, {avg('avg_concession_spend')} AS avg_con,
 {avg('avg_merchandise_spend')} AS avg_merch, {avg('games_attended_last_12_months')} AS avg_games, {avg('promotion_usage_rate')} AS avg_promo FROM fan_profiles GROUP BY ALL""",
    "r8_top_loyalty_tier": f"SELECT loyalty_status AS top_loyalty FROM fan_profiles GROUP BY 1 ORDER BY {avg('avg_ticket_spend')} DESC, 1 LIMIT 1",
    "r9_canned_scenarios": f"""WITH z AS (SELECT {avg('actual_attendance')} AS att, {avg('arena_capacity')} AS cap, (SELECT {avg('total_revenue')} FROM rev0) AS rev FROM attendance)
SELECT 'Merchandise giveaway on a weak weekday' AS scenario, att * 0.72e0 AS baseline_attendance, att * 0.72e0 * 1.09e0 AS projected_attendance,
 rev * 0.85e0 AS baseline_revenue, rev * 0.85e0 * 1.09e0 AS projected_revenue FROM z
UNION ALL SELECT 'Rivalry game with higher prices', att, least(att * 1.07e0, cap), NULL, NULL FROM z
UNION ALL SELECT 'Ten percent attendance drop', att, att * 0.90e0, NULL, NULL FROM z""",
    "r10_executive_summary": f"""SELECT {big('(SELECT COUNT(*) FROM games)')} AS total_games, {big('total_attendance')} AS total_attendance, avg_capacity_pct,
 {dbl('a')} AS ticket_revenue, {dbl('b')} AS concession_revenue, {dbl('c')} AS merchandise_revenue, {dbl('a + b + c')} AS total_revenue,
 {hu(f"({div('a', 'a + b + c')} * 100e0)", 1)} AS ticket_share_pct, {hu(f"({div('b', 'a + b + c')} * 100e0)", 1)} AS concession_share_pct,
 {hu(f"({div('c', 'a + b + c')} * 100e0)", 1)} AS merch_share_pct
FROM (SELECT SUM(actual_attendance) AS total_attendance, {avg('capacity_pct')} AS avg_capacity_pct FROM attendance),
 (SELECT SUM(net_ticket_revenue) AS a FROM ticket_sales), (SELECT SUM(gross_revenue) AS b FROM concessions), (SELECT SUM(gross_revenue) AS c FROM merchandise)""",
    "d1_landing_kpis": f"""SELECT {big('n')} AS total_games, {big('s')} AS seasons, {big('a')} AS total_attendance, c AS avg_capacity_pct, {dbl('r')} AS ticket_revenue,
 CASE WHEN r >= 1000000000 THEN printf('$%.2fB', {dbl('r')} / 1e9) WHEN r >= 1000000 THEN printf('$%.1fM', {dbl('r')} / 1e6) ELSE printf('$%.1fK', {dbl('r')} / 1e3) END AS ticket_revenue_label,
 printf('%.1f%%', c) AS avg_capacity_label
FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT season) AS s FROM games), (SELECT SUM(actual_attendance) AS a, {avg('capacity_pct')} AS c FROM attendance),
 (SELECT SUM(net_ticket_revenue) AS r FROM ticket_sales)""",
    "d2_executive_kpis": f"""SELECT *, CASE WHEN total_revenue >= 1e9 THEN printf('$%.2fB', total_revenue / 1e9) ELSE printf('$%.1fM', total_revenue / 1e6) END AS total_revenue_label,
 CASE WHEN length(top_loyalty) <= 16 THEN top_loyalty ELSE substr(top_loyalty, 1, 15) || '…' END AS top_loyalty_label
FROM (SELECT {cnt()} AS total_games, {big('SUM(actual_attendance)')} AS total_attendance, {avg('capacity_pct')} AS avg_capacity_pct, {dsum('ticket_rev')} AS ticket_revenue,
 {dsum('con_rev')} AS concession_revenue, {dsum('merch_rev')} AS merchandise_revenue, {dsum('total_revenue')} AS total_revenue,
 {hu(f"avg({div('total_revenue', 'actual_attendance')})", 2)} AS avg_revenue_per_attendee,
 (SELECT away_team_name FROM ga GROUP BY 1 ORDER BY {avg('capacity_pct')} DESC, 1 LIMIT 1) AS top_opponent,
 (SELECT loyalty_status FROM fan_profiles GROUP BY 1 ORDER BY {avg('fan_value_score')} DESC, 1 LIMIT 1) AS top_loyalty FROM rev0)""",
    "d3_monthly_revenue_long": "\nUNION ALL ".join(
        f"SELECT season || '-M' || lpad(month::VARCHAR, 2, '0') AS period, '{n}' AS revenue_type, {dsum(c)} AS revenue FROM rev0 z GROUP BY z.season, z.month"
        for n, c in (("Tickets", "ticket_rev"), ("Concessions", "con_rev"), ("Merchandise", "merch_rev"))),
    "d4_top_revenue_games": f"""SELECT {M4}, {dbl('total_revenue')} AS total_revenue, {dbl('capacity_pct')} AS capacity_pct,
 substr(away_team_name, 1, 12) || ' (' || strftime(game_date, '%m/%d') || ')' AS label FROM rev0 x ORDER BY x.total_revenue DESC, game_id LIMIT 10""",
    "d4_top_opponents": top("away_team_name", "capacity_pct", "avg_capacity_pct", 10),
    "d5_forecast_frame": f"""SELECT * REPLACE ({big('season')} AS season, {big('month')} AS month, {big('actual_attendance')} AS actual_attendance,
 {big('predicted_attendance')} AS predicted_attendance, {big('attendance_prediction_error')} AS attendance_prediction_error,
 {big('actual_minus_predicted')} AS actual_minus_predicted, {dbl('capacity_pct')} AS capacity_pct) FROM ({FORECAST})""",
    "d6_worst_misses": f"""SELECT {M4}, {big('actual_attendance')} AS actual_attendance, {big('predicted_attendance')} AS predicted_attendance,
 {big('attendance_prediction_error')} AS attendance_prediction_error, {dbl('capacity_pct')} AS capacity_pct, attendance_tier, promotion_type, day_of_week
FROM ({FORECAST}) x WHERE underperforming ORDER BY x.attendance_prediction_error, game_id LIMIT 30""",
    "d7_forecast_kpis": f"""SELECT {avg('actual_attendance')} AS avg_actual, {avg('predicted_attendance')} AS avg_predicted, {avg('abs(attendance_prediction_error)')} AS mae,
 {avg('capacity_pct')} AS avg_capacity_pct, {big('COUNT(*) FILTER (WHERE underperforming)')} AS underperforming_games FROM ({FORECAST})""",
    "d8_attendance_by_weekday": f"SELECT day_of_week, {avg('actual_attendance')} AS avg_attendance, {big('isodow(any_value(game_date)) - 1')} AS day_number FROM ga GROUP BY day_of_week",
    "d8_attendance_by_month": f"""SELECT {big('month')} AS month, {avg('actual_attendance')} AS avg_attendance,
 CASE WHEN month BETWEEN 7 AND 9 THEN month::VARCHAR ELSE strftime(make_date(2000, month, 1), '%b') END AS month_name FROM ga GROUP BY ga.month""",
    "d8_attendance_by_opponent": top("away_team_name", "actual_attendance", "avg_attendance", 15),
    "d9_forecast_sample": f"""SELECT game_id, {big('actual_attendance')} AS actual_attendance, {big('expected_attendance_baseline')} AS predicted_attendance, attendance_tier
FROM ga ORDER BY ((game_id + 42) % 2147483648) * 2654435761 % 4294967296, game_id LIMIT 800""",
    "d9_discount_sample": """SELECT game_id, segment_name, CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(net_ticket_revenue AS DOUBLE) AS net_ticket_revenue
FROM ticket_sales ORDER BY ((ticket_sale_id + 42) % 2147483648) * 2654435761 % 4294967296, ticket_sale_id LIMIT 2000""",
    "d10_ticket_kpis": f"""SELECT {dsum('net_ticket_revenue')} AS total_net_revenue, {avg('avg_ticket_price')} AS avg_ticket_price, (SELECT {avg('rev')} FROM tix) AS avg_revenue_per_game,
 (SELECT segment_name FROM ticket_sales GROUP BY 1 ORDER BY SUM(net_ticket_revenue) DESC, 1 LIMIT 1) AS best_segment,
 (SELECT segment_name FROM ticket_sales GROUP BY 1 ORDER BY {avg('sell_through_rate')} DESC, 1 LIMIT 1) AS best_sell_through_segment FROM ticket_sales""",
    "d11_revenue_by_opponent": f"""SELECT away_team_name, {dsum('net_ticket_revenue')} AS net_revenue FROM ticket_sales JOIN games USING (game_id)
GROUP BY 1 ORDER BY SUM(net_ticket_revenue) DESC, 1 LIMIT 12""",
    "d11_revenue_by_promotion": f"SELECT promotion_type, {avg('net_ticket_revenue')} AS avg_net_revenue FROM ticket_sales JOIN promotions USING (game_id) GROUP BY 1",
    "d12_ticket_detail": f"""SELECT game_id, game_date, away_team_name, segment_name, {big('SUM(tickets_sold)')} AS tickets_sold, {even(avg('avg_ticket_price'), 2)} AS avg_ticket_price,
 {even(dsum('k.net_ticket_revenue'), 0)} AS net_ticket_revenue, {even(avg('k.sell_through_rate'), 1)} AS sell_through_rate
FROM ticket_sales k JOIN games USING (game_id) GROUP BY game_id, game_date, away_team_name, segment_name ORDER BY SUM(k.net_ticket_revenue) DESC, game_id, segment_name LIMIT 200""",
    "d13_concession_games": line("con"),
    "d13_merchandise_games": line("mer"),
    "d13_ancillary_kpis": kpi_line("concessions", "con") + "\nUNION ALL " + kpi_line("merchandise", "mer"),
    "d14_category_totals": "\nUNION ALL ".join(
        f"SELECT '{f}' AS line, category, {dsum('x.gross_revenue')} AS gross_revenue, {dsum('x.gross_margin')} AS gross_margin FROM {f} x GROUP BY category" for f in ("concessions", "merchandise")),
    "d15_per_cap_by_tier": f"""SELECT attendance_tier, category, {hu(f"avg({div('gross_revenue', 'actual_attendance')})", 6)} AS per_cap,
 {big("CASE attendance_tier WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 ELSE 4 END")} AS tier_number FROM concessions JOIN attendance USING (game_id) GROUP BY ALL""",
    "d16_top_inventory_games": f"SELECT game_id, game_label, attendance_tier, con_inventory FROM ({INV}) ORDER BY con_inventory DESC, game_id LIMIT 15",
    "d16_inventory_summary": f"{INV} ORDER BY c.rev DESC, game_id LIMIT 100",
    "d18_segment_kpis": f"""SELECT {cnt()} AS total_fans, {avg('fan_value_score')} AS avg_value, {avg('promotion_usage_rate')} * 100e0 AS avg_promo_pct,
 {avg('CAST(games_attended_last_12_months >= 5 AS INTEGER)')} * 100e0 AS repeat_pct,
 (SELECT loyalty_status FROM fan_profiles GROUP BY 1 ORDER BY {avg('fan_value_score')} DESC, 1 LIMIT 1) AS best_segment FROM fan_profiles""",
    "d19_segment_summary": SEGMENT,
    "d19_segment_spend_long": "\nUNION ALL ".join(
        f"SELECT loyalty_status AS segment, '{n}' AS category, {avg(c)} AS avg_spend FROM fan_profiles GROUP BY loyalty_status"
        for n, c in (("Tickets", "avg_ticket_spend"), ("Concessions", "avg_concession_spend"), ("Merchandise", "avg_merchandise_spend"))),
    "n1_describe_attendance": described("attendance", "actual_attendance", 0) + "\nUNION ALL " + described("attendance", "capacity_pct", 2),
    "n1_describe_fans": "\nUNION ALL ".join(described("fan_profiles", c, 0 if i == 0 else 2 if i < 4 else 4) for i, c in enumerate(FAN)),
    "n1_describe_revenue": described(REVENUE, "total_game_day_revenue", 2),
    "n1_tier_distribution": f"SELECT attendance_tier, {cnt()} AS games FROM attendance GROUP BY 1",
    "n2_histograms": "\nUNION ALL ".join(
        [binned("attendance", "capacity_pct", 30), binned(f"(SELECT {ERR} AS attendance_prediction_error FROM attendance)", "attendance_prediction_error", 40),
         binned(REVENUE, "total_game_day_revenue", 50)] + [binned("fan_profiles", c, 30) for c in FAN]),
    "n3_correlations": PLAIN + f"""SELECT unnest([{', '.join(f"'{a}'" for a, _ in PAIRS)}]) AS feature_a, unnest([{', '.join(f"'{b}'" for _, b in PAIRS)}]) AS feature_b,
 unnest([{', '.join(hu(f'corr({dbl(a)}, {dbl(b)})', 6) for a, b in PAIRS)}]) AS corr FROM fx""",
    "n4_monthly_mean_revenue": f"""SELECT {big('month')} AS month, {avg('ticket_rev')} AS net_ticket_revenue, {avg('z.con_rev')} AS con_rev, {avg('z.merch_rev')} AS merch_rev
FROM rev3 z GROUP BY z.month""",
    "n4_revenue_shares": "\nUNION ALL ".join(
        f"SELECT '{n}' AS revenue_type, {dsum(c)} AS revenue, {hu('(' + div(f'SUM({c})', 'SUM(total_rev)') + ' * 100e0)', 1)} AS share_pct FROM rev3"
        for n, c in (("net_ticket_revenue", "ticket_rev"), ("con_rev", "con_rev"), ("merch_rev", "merch_rev"))),
    "n5_normalised_profile": f"""SELECT segment, {', '.join(f'(m_{c} - MIN(m_{c}) OVER ()) / NULLIF(MAX(m_{c}) OVER () - MIN(m_{c}) OVER (), 0e0) AS {c}' for c in FAN)}
FROM (SELECT loyalty_status AS segment, {', '.join(f'{even(avg(c), 2)} AS m_{c}' for c in FAN)} FROM fan_profiles GROUP BY 1)""",
    "x1_baselines": BASE + " SELECT * FROM b",
    "x3_scenarios": SCEN + f"""SELECT scenario_id, projected_attendance, projected_capacity_pct, ticket_revenue, concession_revenue, merchandise_revenue,
 ticket_revenue + concession_revenue + merchandise_revenue AS total_revenue, ticket_revenue + concession_revenue + merchandise_revenue - total_baseline AS revenue_change,
 (ticket_revenue + concession_revenue + merchandise_revenue - total_baseline) / total_baseline * 100e0 AS revenue_change_pct,
 CASE WHEN projected_capacity_pct >= 95 THEN 'Maximum Staffing' WHEN projected_capacity_pct >= 85 THEN 'High Staffing' WHEN projected_capacity_pct >= 70 THEN 'Medium Staffing' ELSE 'Standard Staffing' END AS staffing_level,
 inventory_buffer, {trunc('projected_attendance * (con_per_cap / con_unit_price) * inventory_buffer')} AS concession_inventory,
 {trunc('projected_attendance * (merch_per_cap / merch_unit_price) * inventory_buffer')} AS merchandise_inventory FROM s3""",
    "x7_category_baselines": f"SELECT category AS label, per_cap, unit_price FROM {CATS}",
    "x7_scenario_inventory": SCEN + f"SELECT scenario_id, category, {trunc('projected_attendance * (per_cap / unit_price) * inventory_buffer')} AS recommended_units FROM s3, {CATS}",
}

# The forecast page over a prediction table: the demand baseline, its error predicted minus actual.
SCORED = f"""SELECT {M4}, season, day_of_week, month, actual_attendance, expected_attendance AS predicted_attendance,
 -variance AS attendance_prediction_error, variance AS actual_minus_predicted, 100 * -variance < -8 * CAST(actual_attendance AS BIGINT) AS underperforming,
 capacity_pct, attendance_tier, promotion_type FROM gap JOIN ({preparation.SQL["g2_demand_baseline"]}) demand USING (game_id)"""
for _name in ("d5_forecast_frame", "d6_worst_misses", "d7_forecast_kpis"):
    SQL[f"{_name}_scored"] = SQL[_name].replace(FORECAST, SCORED)
