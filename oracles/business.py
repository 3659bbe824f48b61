"""Statements for the forty business questions and the KPI views."""

from __future__ import annotations

from .base import avg, avgr, big, cnt, dbl, div, hu, month9, sumr

M4 = "game_id, game_date, home_team_name, away_team_name"
RATIO = div("actual_attendance - expected_attendance_baseline", "expected_attendance_baseline")
CAP1 = dbl("round(capacity_pct, 1)") + " AS capacity_pct"
SPEND3 = (
    f"{avgr('avg_ticket_spend', 2)} AS avg_ticket_spend, {avgr('avg_concession_spend', 2)} AS avg_concession_spend, "
    f"{avgr('avg_merchandise_spend', 2)} AS avg_merch_spend"
)
SPEND = "(avg_ticket_spend + avg_concession_spend + avg_merchandise_spend)"


def r0(x: str, n: int = 0) -> str:
    return f"CAST(round({x}, {n}) AS DOUBLE)"


def means(key: str, alias: str, n: int = 1) -> str:
    return (
        f"{key} AS {alias}, {cnt()} AS games, {avgr('actual_attendance')} AS avg_attendance, "
        f"{avgr('capacity_pct', n)} AS avg_capacity_pct"
    )


def _margin(fact: str) -> str:
    share = div("gross_margin", "gross_revenue")
    return f"""SELECT category, {sumr('gross_revenue')} AS total_revenue, {sumr('estimated_cost')} AS total_cost,
 {sumr('gross_margin')} AS total_margin, {hu(f'(avg({share}) * 100e0)', 1)} AS avg_margin_pct,
 {avgr('per_cap_spend', 2)} AS avg_per_cap_spend FROM {fact} GROUP BY ALL"""


def _fill_by_type(where: str, name: str) -> str:
    return f"""SELECT promotion_type, {cnt()} AS {name}, {avgr('capacity_pct', 2)} AS avg_capacity_pct,
 {avgr('actual_attendance')} AS avg_attendance FROM gap WHERE promotion_flag AND {where} GROUP BY ALL"""


TRIPLE = "ticket_sales k JOIN concessions c USING (game_id) JOIN merchandise m USING (game_id)"
TRIPLE_SUM = "k.net_ticket_revenue + c.gross_revenue + m.gross_revenue"


def _split(source: str, a: str, b: str, c: str) -> str:
    total = f"({a} + {b} + {c})"
    share = lambda x: hu(f"({div(f'SUM({x})', f'SUM({total})')} * 100e0)", 1)
    return f"""SELECT {sumr(a)} AS total_ticket_revenue, {sumr(b)} AS total_concession_revenue,
 {sumr(c)} AS total_merchandise_revenue, {sumr(total)} AS total_game_day_revenue, {share(a)} AS ticket_share_pct,
 {share(b)} AS concession_share_pct, {share(c)} AS merch_share_pct FROM {source}"""


def _ready(ticket: str, con: str, mer: str, source: str, group: str, kind: str = "BIGINT") -> str:
    return f"""SELECT {M4}, {big('actual_attendance')} AS actual_attendance, {big('arena_capacity')} AS arena_capacity, {CAP1},
 attendance_tier, promotion_type, {r0(ticket)} AS ticket_rev, CAST({con} AS {kind}) AS total_con_inventory_rec,
 CAST({mer} AS {kind}) AS total_merch_inventory_rec,
 CASE WHEN x.capacity_pct >= 95 THEN 'Maximum Staffing' WHEN x.capacity_pct >= 85 THEN 'High Staffing'
  WHEN x.capacity_pct >= 70 THEN 'Medium Staffing' ELSE 'Standard Staffing' END AS staffing_level
 FROM {source} WHERE attendance_tier IN ('High', 'Sellout') {group}
 ORDER BY round(x.capacity_pct, 1) DESC, game_id LIMIT 20"""


def _effect(revenue: str) -> str:
    return f"""WITH base AS (SELECT {avg('capacity_pct')} AS b FROM gap WHERE NOT promotion_flag),
 gr AS ({revenue})
SELECT promotion_type, {cnt()} AS games, {avgr('capacity_pct', 2)} AS avg_capacity_pct, {hu('any_value(b)', 2)} AS baseline_capacity_pct,
 {hu('(' + avg('capacity_pct') + ' - any_value(b))', 2)} AS estimated_att_lift_pct_pts, {avgr('promotion_cost')} AS avg_promo_cost,
 {avgr('sponsor_value_estimate')} AS avg_sponsor_value, {avgr('game_rev')} AS avg_game_revenue
FROM gap JOIN gr USING (game_id), base GROUP BY promotion_type"""


def _dashboard(totals: str) -> str:
    return f"""WITH tot AS ({totals}),
 opp AS (SELECT away_team_name AS o FROM ga GROUP BY 1 ORDER BY {avg('capacity_pct')} DESC, 1 LIMIT 1),
 seg AS (SELECT loyalty_status AS s FROM fan_profiles GROUP BY 1 ORDER BY {avg('fan_value_score')} DESC, 1 LIMIT 1)
SELECT {big('n')} AS total_games, {dbl('att')} AS total_attendance, {hu('cap', 1)} AS avg_capacity_pct,
 {r0('a')} AS total_ticket_revenue, {r0('b')} AS total_concession_revenue, {r0('c')} AS total_merchandise_revenue,
 {r0('a + b + c')} AS total_game_day_revenue, {hu(div('round(a + b + c, 0)', 'att'), 2)} AS avg_revenue_per_attendee,
 o AS top_opponent, s AS top_fan_segment FROM tot, opp, seg"""


SQL: dict[str, str] = {
    "q01_top_opponents": f"""SELECT away_team_name AS opponent, {cnt()} AS games_played, {avgr('actual_attendance')} AS avg_attendance,
 {avgr('capacity_pct', 1)} AS avg_capacity_pct, {big('MAX(actual_attendance)')} AS max_attendance
FROM ga GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""",
    "q02_attendance_by_weekday": f"SELECT {means('day_of_week', 'day_of_week')} FROM ga GROUP BY day_of_week",
    "q03_attendance_by_month": f"SELECT {means(big('month'), 'month')}, {month9('month')} AS month_name FROM ga GROUP BY month",
    "q04_weekend_vs_weekday": f"""SELECT {means("CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END", 'game_type')},
 {big('MIN(actual_attendance)')} AS min_attendance, {big('MAX(actual_attendance)')} AS max_attendance FROM ga GROUP BY is_weekend""",
    "q05_capacity_by_opponent_tier": f"""SELECT market_size_tier AS opponent_market_tier, {dbl('historical_popularity_score')} AS avg_opp_popularity,
 {cnt()} AS games, {avgr('capacity_pct', 2)} AS avg_capacity_pct FROM ga JOIN teams ON team_id = away_team_id
GROUP BY market_size_tier, historical_popularity_score""",
    "q06_sellouts": f"""SELECT {M4}, {big('actual_attendance')} AS actual_attendance, {big('arena_capacity')} AS arena_capacity, {CAP1},
 attendance_tier, promotion_type FROM gap x WHERE x.capacity_pct >= 97 ORDER BY x.capacity_pct DESC, game_id LIMIT 25""",
    "q07_underperforming": f"""SELECT {M4}, {big('actual_attendance')} AS actual_attendance, {big('expected_attendance_baseline')} AS expected_attendance_baseline,
 {big('attendance_variance')} AS attendance_variance, {hu(f'({RATIO} * 100e0)', 1)} AS variance_pct, attendance_tier, promotion_type, weather_condition
FROM gapw WHERE {RATIO} < -0.10e0 ORDER BY variance_pct, game_id LIMIT 20""",
    "q08_overperforming": f"""SELECT {M4}, {big('actual_attendance')} AS actual_attendance, {big('expected_attendance_baseline')} AS expected_attendance_baseline,
 {hu(f'({RATIO} * 100e0)', 1)} AS variance_pct, rivalry_flag, nationally_televised_flag, promotion_type
FROM gap WHERE {RATIO} > 0.10e0 ORDER BY variance_pct DESC, game_id LIMIT 20""",
    "q09_revenue_by_segment": f"""SELECT s.segment_name, s.price_tier, {cnt()} AS game_records, {big('SUM(tickets_sold)')} AS total_tickets_sold,
 {avgr('avg_ticket_price', 2)} AS avg_ticket_price, {sumr('gross_ticket_revenue')} AS total_gross_revenue,
 {sumr('net_ticket_revenue')} AS total_net_revenue, {avgr('sell_through_rate', 1)} AS avg_sell_through_pct
FROM ticket_sales k JOIN ticket_segments s USING (segment_id) GROUP BY ALL""",
    "q10_price_by_segment_and_tier": f"""SELECT segment_name, attendance_tier, {avgr('avg_ticket_price', 2)} AS avg_ticket_price,
 {avgr('sell_through_rate', 1)} AS avg_sell_through_pct, {cnt()} AS records FROM ticket_sales JOIN attendance USING (game_id) GROUP BY ALL""",
    "q11_sell_through_ranking": f"""SELECT *, {big('RANK() OVER (ORDER BY avg_sell_through DESC)')} AS sell_through_rank FROM (
 SELECT segment_name, {avgr('sell_through_rate', 2)} AS avg_sell_through, {dbl('MIN(sell_through_rate)')} AS min_sell_through,
 {dbl('MAX(sell_through_rate)')} AS max_sell_through FROM ticket_sales GROUP BY ALL)""",
    "q12_top_ticket_games": f"""SELECT {M4}, rivalry_flag, nationally_televised_flag, {r0('t.rev')} AS total_net_ticket_revenue,
 {big('t.sold')} AS total_tickets_sold, {dbl('capacity_pct')} AS capacity_pct, promotion_type
FROM gap JOIN tix t USING (game_id) ORDER BY round(t.rev, 0) DESC, game_id LIMIT 15""",
    "q13_bottom_ticket_games": f"""SELECT {M4}, day_of_week, {r0('t.rev')} AS total_net_ticket_revenue, {dbl('capacity_pct')} AS capacity_pct, promotion_type
FROM gap JOIN tix t USING (game_id) ORDER BY round(t.rev, 0), game_id LIMIT 15""",
    "q14_discount_impact": f"""SELECT segment_name, CASE WHEN discount_pct = 0 THEN 'No Discount' WHEN discount_pct < 10 THEN '1-9%'
  WHEN discount_pct < 20 THEN '10-19%' WHEN discount_pct < 30 THEN '20-29%' ELSE '30%+' END AS discount_bucket, {cnt()} AS records,
 {avgr('tickets_sold')} AS avg_tickets_sold, {avgr('gross_ticket_revenue')} AS avg_gross_revenue, {avgr('net_ticket_revenue')} AS avg_net_revenue,
 {avgr('sell_through_rate', 1)} AS avg_sell_through FROM ticket_sales GROUP BY ALL""",
    "q15_corporate_value": f"""SELECT {M4}, {r0('rev')} AS corporate_ticket_revenue, {hu('sv')} AS sponsor_value_estimate,
 {hu(f"({dbl('rev')} + sv)")} AS total_partner_value FROM games
JOIN (SELECT game_id, SUM(net_ticket_revenue) AS rev FROM ticket_sales WHERE segment_name = 'Corporate Partner Allocation' GROUP BY ALL) USING (game_id)
JOIN (SELECT game_id, {dbl('sponsor_value_estimate')} AS sv FROM promotions) USING (game_id) ORDER BY total_partner_value DESC, game_id LIMIT 20""",
    "q16_lift_by_promotion": f"""SELECT promotion_type, {cnt()} AS games, {avgr('capacity_pct', 2)} AS avg_capacity_pct,
 {avgr('expected_promotion_lift_pct', 2)} AS avg_expected_lift_pct, {avgr('actual_attendance')} AS avg_actual_attendance FROM gap GROUP BY ALL""",
    "q17_revenue_by_promotion": f"""SELECT promotion_type, {cnt()} AS games, {avgr('tot')} AS avg_total_revenue, {sumr('tot')} AS total_revenue
FROM (SELECT promotion_type, t.rev + COALESCE((SELECT SUM(gross_revenue) FROM concessions c WHERE c.game_id = p.game_id), 0)
  + COALESCE((SELECT SUM(gross_revenue) FROM merchandise m WHERE m.game_id = p.game_id), 0) AS tot
 FROM promotions p JOIN tix t USING (game_id)) GROUP BY ALL""",
    "q18_promotion_roi": f"""SELECT promotion_type, {cnt()} AS games, {avgr('promotion_cost')} AS avg_promo_cost, {avgr('sponsor_value_estimate')} AS avg_sponsor_value,
 {avgr('capacity_pct', 1)} AS avg_capacity_pct, {hu(f"({avg('sponsor_value_estimate')} - {avg('promotion_cost')})")} AS avg_net_sponsor_gain
FROM gap WHERE promotion_flag GROUP BY ALL""",
    "q19_best_weekday_promotion": _fill_by_type("NOT is_weekend", "weekday_games"),
    "q20_best_low_demand_promotion": _fill_by_type("attendance_tier = 'Low'", "low_demand_games"),
    "q21_concession_per_head": f"""SELECT {M4}, {big('actual_attendance')} AS actual_attendance, attendance_tier, {r0('c.rev')} AS total_concession_revenue,
 {hu(div('c.rev', 'actual_attendance'), 2)} AS concession_per_cap FROM ga JOIN con c USING (game_id)
ORDER BY concession_per_cap DESC NULLS FIRST, game_id LIMIT 20""",
    "q22_merchandise_per_head": f"""SELECT {M4}, {big('actual_attendance')} AS actual_attendance, rivalry_flag, {r0('c.rev')} AS total_merch_revenue,
 {hu(div('c.rev', 'actual_attendance'), 2)} AS merch_per_cap FROM ga JOIN mer c USING (game_id)
ORDER BY merch_per_cap DESC NULLS FIRST, game_id LIMIT 20""",
    "q23_top_food_demand": f"""SELECT {M4}, {big('actual_attendance')} AS actual_attendance, {big('u')} AS food_bev_units, {r0('r')} AS food_bev_revenue,
 {big('i')} AS food_bev_inventory_rec FROM ga JOIN (SELECT game_id, COALESCE(SUM(units_sold) FILTER (WHERE f), 0) AS u,
  COALESCE(SUM(gross_revenue) FILTER (WHERE f), 0) AS r, COALESCE(SUM(recommended_inventory_units) FILTER (WHERE f), 0) AS i
  FROM (SELECT *, category IN ('Food', 'Beverage', 'Combo Meals') AS f FROM concessions) GROUP BY ALL) USING (game_id)
ORDER BY u DESC, game_id LIMIT 20""",
    "q24_top_merchandise_demand": f"""SELECT {M4}, rivalry_flag, {big('actual_attendance')} AS actual_attendance, {big('m.units')} AS total_merch_units,
 {r0('m.rev')} AS total_merch_revenue, {big('m.inv')} AS total_inventory_rec FROM ga JOIN mer m USING (game_id)
ORDER BY m.units DESC, game_id LIMIT 20""",
    "q25_stock_by_tier": f"""SELECT attendance_tier, {cnt('DISTINCT game_id')} AS games, {avgr('actual_attendance')} AS avg_attendance,
 {avgr('c.inv')} AS avg_concession_inventory_rec, {avgr('m.inv')} AS avg_merch_inventory_rec
FROM attendance JOIN con c USING (game_id) JOIN mer m USING (game_id) GROUP BY ALL""",
    "q26_concession_margins": _margin("concessions"),
    "q27_merchandise_margins": _margin("merchandise"),
    "q28_spend_ranking": f"""SELECT loyalty_status, {cnt()} AS fan_count, {SPEND3}, {avgr(SPEND, 2)} AS avg_total_spend,
 {big(f'RANK() OVER (ORDER BY {avg(SPEND)} DESC)')} AS spend_rank FROM fan_profiles GROUP BY loyalty_status""",
    "q29_loyalty_contribution": f"""SELECT loyalty_status, {big('f')} AS unique_fans, {r0('r')} AS total_revenue,
 {hu(f"({div('r', 'SUM(r) OVER ()')} * 100e0)", 1)} AS revenue_share_pct, {hu(div('r', 'f'), 2)} AS revenue_per_fan
FROM (SELECT loyalty_status, SUM(total_spend) AS r, COUNT(DISTINCT fan_id) AS f FROM fan_transactions JOIN fan_profiles USING (fan_id) GROUP BY ALL)""",
    "q30_promotion_usage": f"""SELECT loyalty_status, {cnt()} AS fans, {hu(f"({avg('promotion_usage_rate')} * 100e0)", 1)} AS avg_promo_usage_pct,
 {avgr('avg_ticket_spend', 2)} AS avg_ticket_spend, {avgr('games_attended_last_12_months', 1)} AS avg_games_attended FROM fan_profiles GROUP BY ALL""",
    "q31_spend_by_frequency": f"""SELECT CASE WHEN n >= 20 THEN 'High Frequency (20+)' WHEN n >= 8 THEN 'Regular (8-19)' WHEN n >= 3 THEN 'Occasional (3-7)'
  ELSE 'Casual (1-2)' END AS frequency_tier, {cnt()} AS fans, {SPEND3}, {avgr('fan_value_score', 3)} AS avg_fan_value_score
FROM (SELECT *, games_attended_last_12_months AS n FROM fan_profiles) GROUP BY ALL""",
    "q32_spend_by_distance": f"""SELECT distance_from_arena_bucket, {cnt()} AS fans, {SPEND3},
 {avgr('games_attended_last_12_months', 1)} AS avg_games_attended FROM fan_profiles GROUP BY ALL""",
    "q33_value_by_household": f"""SELECT household_type, {cnt()} AS fans, {avgr('fan_value_score', 3)} AS avg_fan_value_score, {SPEND3},
 {big(f"RANK() OVER (ORDER BY {avg('fan_value_score')} DESC)")} AS value_rank FROM fan_profiles GROUP BY household_type""",
    "q34_game_breakdown": f"""SELECT {M4}, {big('season')} AS season, {big('actual_attendance')} AS actual_attendance, {CAP1}, {r0('ticket_rev')} AS ticket_revenue,
 {r0('con_rev')} AS concession_revenue, {r0('merch_rev')} AS merchandise_revenue, {r0('total_rev')} AS total_game_day_revenue FROM rev3""",
    "q35_revenue_split": _split(TRIPLE, "k.net_ticket_revenue", "c.gross_revenue", "m.gross_revenue"),
    "q35_revenue_split_fixed": _split("rev3", "ticket_rev", "con_rev", "merch_rev"),
    "q36_top_games": f"""SELECT {M4}, rivalry_flag, nationally_televised_flag, {big('actual_attendance')} AS actual_attendance, {CAP1}, promotion_type,
 {r0('ticket_rev')} AS ticket_rev, {r0('con_rev')} AS con_rev, {r0('merch_rev')} AS merch_rev,
 round(ticket_rev, 0) + round(con_rev, 0) + round(merch_rev, 0) AS whole, {dbl('whole')} AS total_revenue,
 {big('DENSE_RANK() OVER (ORDER BY whole DESC)')} AS revenue_rank FROM rev3 ORDER BY whole DESC, game_id LIMIT 10""",
    "q37_missed_potential": f"""SELECT {M4}, {dbl('capacity_pct')} AS capacity_pct, attendance_tier,
 {big('rivalry_flag::INT + nationally_televised_flag::INT + is_weekend::INT')} AS demand_signal_score, ({RATIO} * 100e0) AS variance_pct
FROM ga WHERE rivalry_flag::INT + nationally_televised_flag::INT + is_weekend::INT >= 2 AND ({RATIO} * 100e0) < -5 ORDER BY variance_pct, game_id LIMIT 20""",
    "q38_monthly_trend": f"""SELECT {big('season')} AS season, {big('month')} AS month, {month9('month')} AS month_name, {cnt('DISTINCT game_id')} AS games,
 {sumr('ticket_rev')} AS ticket_revenue, {r0('con_rev')} AS concession_revenue, {r0('merch_rev')} AS merchandise_revenue,
 {r0('SUM(ticket_rev) + con_rev + merch_rev')} AS total_revenue
FROM (SELECT season, month, game_id, k.net_ticket_revenue AS ticket_rev, c.rev AS con_rev, m.rev AS merch_rev
 FROM games JOIN ticket_sales k USING (game_id) JOIN con c USING (game_id) JOIN mer m USING (game_id)) z
GROUP BY z.season, z.month, z.con_rev, z.merch_rev""",
    "q38_monthly_trend_fixed": f"""SELECT {big('season')} AS season, {big('month')} AS month, {month9('month')} AS month_name, {cnt()} AS games,
 {sumr('ticket_rev')} AS ticket_revenue, {sumr('con_rev')} AS concession_revenue, {sumr('merch_rev')} AS merchandise_revenue,
 {sumr('total_rev')} AS total_revenue FROM rev3 z GROUP BY z.season, z.month""",
    "q39_rivalry_spend": f"""SELECT CASE WHEN rivalry_flag THEN 'Rivalry Game' ELSE 'Regular Game' END AS game_type, {cnt('DISTINCT transaction_id')} AS transactions,
 {cnt('DISTINCT fan_id')} AS unique_fans, {avgr('total_spend', 2)} AS avg_total_spend_per_txn, {avgr('ticket_spend', 2)} AS avg_ticket_spend,
 {avgr('concession_spend', 2)} AS avg_concession_spend, {avgr('merchandise_spend', 2)} AS avg_merch_spend
FROM fan_transactions JOIN games USING (game_id) GROUP BY rivalry_flag""",
    "q40_staffing": _ready(
        "SUM(k.net_ticket_revenue)", "SUM(c.recommended_inventory_units)", "SUM(m.recommended_inventory_units)",
        f"gap x JOIN {TRIPLE.replace('ticket_sales k', 'ticket_sales k USING (game_id)')}",
        f"GROUP BY {M4}, actual_attendance, arena_capacity, x.capacity_pct, attendance_tier, promotion_type", "DOUBLE",
    ),
    "q40_staffing_fixed": _ready("ticket_rev", "con_inv", "mer_inv", "rev3 x", ""),
    # ---- views ----
    "v1_game_day_revenue": f"""SELECT {M4}, {big('season')} AS season, day_of_week, {big('month')} AS month, is_weekend, rivalry_flag, nationally_televised_flag,
 {big('actual_attendance')} AS actual_attendance, {big('arena_capacity')} AS arena_capacity, {dbl('capacity_pct')} AS capacity_pct, attendance_tier,
 promotion_type, promotion_flag, {dbl('ticket_rev')} AS net_ticket_revenue, {dbl('con_rev')} AS concession_revenue, {dbl('merch_rev')} AS merchandise_revenue,
 {dbl('total_rev')} AS total_game_day_revenue, {hu(div('total_rev', 'actual_attendance'), 2)} AS revenue_per_attendee FROM rev3""",
    "v2_attendance_performance": f"""SELECT {M4}, {big('season')} AS season, day_of_week, {big('month')} AS month, is_weekend, rivalry_flag, nationally_televised_flag,
 {dbl('home_team_win_pct_entering_game')} AS home_team_win_pct_entering_game, {big('actual_attendance')} AS actual_attendance,
 {big('arena_capacity')} AS arena_capacity, {dbl('capacity_pct')} AS capacity_pct, {big('expected_attendance_baseline')} AS expected_attendance_baseline,
 {big('attendance_variance')} AS attendance_variance, attendance_tier, {hu(f'({RATIO} * 100e0)', 2)} AS variance_pct,
 CASE WHEN {RATIO} < -0.10e0 THEN 'Underperforming' WHEN {RATIO} > 0.10e0 THEN 'Overperforming' ELSE 'On Target' END AS performance_flag,
 promotion_type, weather_condition, {dbl('temperature_f')} AS temperature_f, snow_flag, severe_weather_flag FROM gapw""",
    "v3_ticket_segment_performance": f"""SELECT {M4}, attendance_tier, {big('segment_id')} AS segment_id, k.segment_name, s.price_tier,
 {big('tickets_available')} AS tickets_available, {big('tickets_sold')} AS tickets_sold, {dbl('avg_ticket_price')} AS avg_ticket_price,
 {dbl('discount_pct')} AS discount_pct, {dbl('gross_ticket_revenue')} AS gross_ticket_revenue, {dbl('net_ticket_revenue')} AS net_ticket_revenue,
 {dbl('sell_through_rate')} AS sell_through_rate, {big('DENSE_RANK() OVER (PARTITION BY game_id ORDER BY net_ticket_revenue DESC)')} AS segment_revenue_rank
FROM ticket_sales k JOIN ga USING (game_id) JOIN ticket_segments s USING (segment_id)""",
    "v4_promotion_effectiveness": _effect(f"SELECT game_id, SUM(k.net_ticket_revenue) + SUM(c.gross_revenue) + SUM(m.gross_revenue) AS game_rev FROM {TRIPLE} GROUP BY ALL"),
    "v4_promotion_effectiveness_fixed": _effect("SELECT game_id, total_rev AS game_rev FROM rev3"),
    "v5_concession_merchandise_demand": f"""SELECT {M4}, {big('actual_attendance')} AS actual_attendance, attendance_tier, {dbl('c.rev')} AS total_concession_revenue,
 {hu(div('c.rev', 'actual_attendance'), 2)} AS concession_per_cap, {big('c.inv')} AS total_con_inventory_rec, {dbl('m.rev')} AS total_merchandise_revenue,
 {hu(div('m.rev', 'actual_attendance'), 2)} AS merchandise_per_cap, {big('m.inv')} AS total_merch_inventory_rec, {dbl('c.rev + m.rev')} AS total_ancillary_revenue
FROM ga JOIN con c USING (game_id) JOIN mer m USING (game_id)""",
    "v6_fan_segment_value": f"""SELECT loyalty_status, {cnt()} AS fan_count, {avgr('games_attended_last_12_months', 1)} AS avg_games_attended,
 {SPEND3.replace('avg_merch_spend', 'avg_merchandise_spend')}, {avgr(SPEND, 2)} AS avg_total_spend,
 {hu(f"({avg('promotion_usage_rate')} * 100e0)", 1)} AS avg_promo_usage_pct, {hu(f"({avg('email_engagement_score')} * 100e0)", 1)} AS avg_email_engagement_pct,
 {avgr('fan_value_score', 3)} AS avg_fan_value_score, {big(f"RANK() OVER (ORDER BY {avg('fan_value_score')} DESC)")} AS value_rank
FROM fan_profiles GROUP BY loyalty_status""",
    "v7_executive_dashboard": _dashboard(
        f"""SELECT COUNT(DISTINCT game_id) AS n, SUM(actual_attendance) AS att, {avg('capacity_pct')} AS cap, SUM(k.net_ticket_revenue) AS a,
 SUM(c.gross_revenue) AS b, SUM(m.gross_revenue) AS c FROM ga JOIN {TRIPLE.replace('ticket_sales k', 'ticket_sales k USING (game_id)')}"""
    ),
    "v7_executive_dashboard_fixed": _dashboard(
        f"SELECT COUNT(*) AS n, SUM(actual_attendance) AS att, {avg('capacity_pct')} AS cap, SUM(ticket_rev) AS a, SUM(con_rev) AS b, SUM(merch_rev) AS c FROM rev3"
    ),
}
SQL["q36_top_games"] = f"SELECT * EXCLUDE (whole) FROM ({SQL['q36_top_games']})"
