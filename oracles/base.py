"""The domain tables as SQL over the generic sales tables, and the helpers the statements share.

Every statement is the CTEs it needs plus its own body. Averages are one exact sum and one division;
non-decimal values are rounded by ``floor(|x| * 10^n + 0.5)``, which gives the same bits in any engine.
"""

from __future__ import annotations

import re

# --- fixed values ---------------------------------------------------------------------------------
PROMOTION_NAMES = [
    "Family Night", "Student Discount", "Merchandise Giveaway", "Food Voucher", "Theme Night",
    "Corporate Partner Night", "Community Night", "Premium Experience",
]
SPONSORS = ["Beverage", "Financial", "Healthcare", "Tech", "Auto", "Retail"]
SEGMENTS = """(1, 'Premium Courtside', 450.00, 'Ultra Premium'), (2, 'Lower Bowl', 185.00, 'Premium'),
 (3, 'Club Level', 220.00, 'Premium'), (4, 'Upper Bowl', 65.00, 'Value'), (5, 'Family Pack', 55.00, 'Value'),
 (6, 'Student Promo', 30.00, 'Discount'), (7, 'Group Sales', 72.00, 'Mid-Tier'),
 (8, 'Season Ticket', 140.00, 'Mid-Tier'), (9, 'Corporate Partner Allocation', 310.00, 'Premium')"""
CON_NAMES = ["Food", "Beverage", "Snacks", "Combo Meals", "Premium Dining"]
CON_PRICE, CON_COST = ["12", "9", "6", "18", "35"], ["0.38", "0.22", "0.30", "0.35", "0.40"]
MER_NAMES = ["Jerseys", "Hats", "T-Shirts", "Collectibles", "Game-Day Specials"]
MER_PRICE, MER_COST = ["110", "32", "28", "45", "20"], ["0.42", "0.35", "0.32", "0.38", "0.30"]
AGES = ["18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
HOUSEHOLDS = ["Single", "Couple", "Family with Kids", "Empty Nester", "Student", "Corporate"]
DISTANCES = ["<5 miles", "5-15 miles", "15-30 miles", "30-60 miles", "60+ miles"]
# --------------------------------------------------------------------------------------------------


def pick(index: str, values: list[str], quote: bool = True) -> str:
    items = ", ".join(f"'{v}'" if quote else v for v in values)
    return f"list_extract([{items}], CAST({index} AS BIGINT) + 1)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def hu(x: str, n: int = 0) -> str:
    """Half-up rounding of a double expression."""
    s = f"{10**n}e0"
    return f"(sign({x}) * floor(abs({x}) * {s} + 0.5e0) / {s} + 0e0)"


def even(x: str, n: int = 0) -> str:
    """Half-even rounding of a double expression."""
    y = f"(({x}) * {10**n}e0)"
    tie = f"abs({y}) - floor(abs({y})) = 0.5e0 AND floor(abs({y})) % 2 = 0"
    return f"(sign({y}) * CASE WHEN {tie} THEN floor(abs({y})) ELSE floor(abs({y}) + 0.5e0) END / {10**n}e0)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0e0))"


def avg(x: str) -> str:
    return div(f"SUM({x})", f"COUNT({x})")


def avgr(x: str, n: int = 0) -> str:
    return hu(avg(x), n)


def sumr(x: str, n: int = 0) -> str:
    return f"CAST(round(SUM({x}), {n}) AS DOUBLE)"


def cnt(x: str = "*") -> str:
    return f"CAST(COUNT({x}) AS BIGINT)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


MONTH9 = "rpad(monthname(make_date(2000, CAST({m} AS INTEGER), 1)), 9, ' ')"


def month9(m: str) -> str:
    return MONTH9.format(m=m)


LINE_COLUMNS = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()
# A line item's record id: its place in the whole table ordered by all its columns, nulls first.
NUMBERED_LINES = (
    "(SELECT *, row_number() OVER (ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in LINE_COLUMNS) + ") - 1 AS record_id FROM lineitem)"
)


def _category(name: str, parity: int, key: str, share: str, names: list, price: list, cost: list) -> str:
    which = f"({key} % 5)"
    money = pick(which, [f"CAST({p} AS DECIMAL(8,2))" for p in price], quote=False)
    part = pick(which, [f"CAST({c} AS DECIMAL(3,2))" for c in cost], quote=False)
    return f"""
SELECT c.record_id AS {"concession_id" if name == "concessions" else "merchandise_id"}, c.game_id, c.category, c.units_sold, c.avg_unit_price, c.gross_revenue, c.estimated_cost,
  CAST(c.gross_revenue - c.estimated_cost AS DECIMAL(12,2)) AS gross_margin,
  CAST(((2 * CAST(c.gross_revenue * 100 AS BIGINT) + a.actual_attendance) // (2 * NULLIF(a.actual_attendance, 0))) * 0.01 AS DECIMAL(8,2)) AS per_cap_spend,
  CAST(c.units_sold * (100 + CASE a.attendance_tier WHEN 'Sellout' THEN 20 WHEN 'High' THEN 15 WHEN 'Medium' THEN 10 ELSE 5 END) // 100 AS INTEGER) AS recommended_inventory_units
FROM (SELECT *, CAST(round(gross_revenue * cost_part, 2) AS DECIMAL(12,2)) AS estimated_cost FROM (
  SELECT record_id, l_orderkey AS game_id, {pick(which, names)} AS category, CAST(l_quantity AS INTEGER) AS units_sold,
    {money} AS avg_unit_price, {part} AS cost_part,
    CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * {share}, 2) AS DECIMAL(12,2)) AS gross_revenue
  FROM {NUMBERED_LINES} WHERE l_linenumber % 2 = {parity})) c
JOIN attendance a ON a.game_id = c.game_id"""


CTES: dict[str, str] = {
    "teams": """
SELECT n_nationkey AS team_id, 'T' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS team_abbr, n_name AS team_name,
  n_name AS team_city, r_name AS conference, r_name || ' Division' AS division, n_name || ' Arena' AS arena_name,
  17000 + 160 * n_nationkey AS arena_capacity,
  list_extract(['Large', 'Medium', 'Small'], n_nationkey % 3 + 1) AS market_size_tier,
  CAST((57 + 7 * n_nationkey % 41) * 0.01 AS DECIMAL(4,3)) AS historical_popularity_score
FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "ord": """
SELECT o_orderkey AS game_id, o_custkey AS fan_id, CAST(o_totalprice AS DECIMAL(12,2)) AS total,
  CAST(o_orderdate AS DATE) AS game_date, o_custkey % 16 < 8 AS promoted,
  isodow(CAST(o_orderdate AS DATE)) >= 5 AS weekend, month(o_orderdate) IN (12, 1) AS holiday,
  o_orderpriority IN ('1-URGENT', '2-HIGH') AS tv,
  CASE WHEN o_custkey % 16 < 8 THEN 300 + 100 * (o_custkey % 7) ELSE 0 END AS lift_bp,
  50 + (37 * o_orderkey) % 1001 AS temp10,
  (50 + (37 * o_orderkey) % 1001 < 350 AND o_orderkey % 4 = 0) AS snow
FROM orders""",
    "hub0": """
SELECT o.*, c_nationkey AS home, CAST((c_nationkey + 1 + fan_id % 24) % 25 AS INTEGER) AS away,
  (c_nationkey + (c_nationkey + 1 + fan_id % 24) % 25) % 8 = 0 AS rivalry
FROM ord o JOIN customer ON c_custkey = o.fan_id""",
    "games": """
SELECT b.game_id, CAST(year(game_date) AS INTEGER) AS season, game_date, home AS home_team_id, away AS away_team_id,
  h.team_name AS home_team_name, v.team_name AS away_team_name, h.team_abbr AS home_team_abbr,
  v.team_abbr AS away_team_abbr, dayname(game_date) AS day_of_week, CAST(month(game_date) AS INTEGER) AS month,
  weekend AS is_weekend, holiday AS is_holiday_period, rivalry AS rivalry_flag, tv AS nationally_televised_flag,
  CAST((300 + (13 * b.game_id) % 401) * 0.001 AS DECIMAL(5,4)) AS home_team_win_pct_entering_game,
  CAST((300 + (17 * b.game_id) % 401) * 0.001 AS DECIMAL(5,4)) AS away_team_win_pct_entering_game,
  CAST(0.5 AS DECIMAL(5,4)) AS home_team_recent_form, CAST(0.5 AS DECIMAL(5,4)) AS away_team_recent_form,
  CAST(95 + b.game_id % 35 AS INTEGER) AS home_score,
  CAST(95 + b.game_id % 35 + CASE WHEN b.game_id % 2 = 1 THEN -1 ELSE 1 END * (1 + b.game_id % 20) AS INTEGER) AS away_score,
  CAST(b.game_id % 2 AS INTEGER) AS home_win_flag
FROM hub0 b JOIN teams h ON h.team_id = home JOIN teams v ON v.team_id = away""",
    "weather": """
SELECT game_id, CAST(temp10 * 0.1 AS DECIMAL(5,1)) AS temperature_f, (game_id % 6 = 0 OR snow) AS precipitation_flag,
  snow AS snow_flag, game_id % 30 = 0 AS severe_weather_flag,
  CASE WHEN game_id % 30 = 0 THEN 'Severe Storm' WHEN snow THEN 'Snow'
    WHEN game_id % 6 = 0 THEN CASE WHEN temp10 < 500 THEN 'Rain/Cold' ELSE 'Rain' END
    WHEN temp10 > 850 THEN 'Hot/Sunny' ELSE 'Clear' END AS weather_condition
FROM ord""",
    "promotions": f"""
SELECT game_id AS promotion_id, game_id, promoted AS promotion_flag,
  CASE WHEN promoted THEN {pick('fan_id % 8', PROMOTION_NAMES)} ELSE 'None' END AS promotion_type,
  CAST(CASE WHEN promoted THEN 3500 + 500 * (fan_id % 50) ELSE 0 END AS DECIMAL(10,2)) AS promotion_cost,
  CAST(lift_bp * 0.01 AS DECIMAL(5,2)) AS expected_promotion_lift_pct,
  CASE WHEN promoted THEN {pick('game_id % 6', SPONSORS)} ELSE 'None' END AS sponsor_category,
  CAST(CASE WHEN promoted THEN 5000 + (37 * game_id) % 70001 ELSE 0 END AS DECIMAL(12,2)) AS sponsor_value_estimate
FROM ord""",
    "attendance": """
SELECT game_id, CAST(cap AS INTEGER) AS arena_capacity, CAST(cap * pct // 10000 AS INTEGER) AS actual_attendance,
  CAST(pct * 0.01 AS DECIMAL(6,2)) AS capacity_pct,
  CAST(cap * least(greatest(base, 5500), 10000) // 10000 AS INTEGER) AS expected_attendance_baseline,
  CAST(cap * pct // 10000 - cap * least(greatest(base, 5500), 10000) // 10000 AS INTEGER) AS attendance_variance,
  CASE WHEN pct >= 9500 THEN 'Sellout' WHEN pct >= 8800 THEN 'High' WHEN pct >= 7500 THEN 'Medium' ELSE 'Low' END AS attendance_tier
FROM (SELECT game_id, cap, base, least(greatest(base + CAST(total * 100 AS BIGINT) % 2401 - 1200, 5000), 10000) AS pct
  FROM (SELECT game_id, total, CAST(17000 + 160 * home AS BIGINT) AS cap,
      7400 + 500 * CAST(weekend AS INTEGER) + 700 * CAST(rivalry AS INTEGER) + 400 * CAST(tv AS INTEGER)
      + 300 * CAST(holiday AS INTEGER) + lift_bp AS base FROM hub0))""",
    "ticket_segments": f"""
SELECT segment_id, segment_name, CAST(p AS DECIMAL(8,2)) AS avg_base_price, price_tier
FROM (VALUES {SEGMENTS}) s(segment_id, segment_name, p, price_tier)""",
    "ticket_sales": """
SELECT record_id AS ticket_sale_id, l_orderkey AS game_id, s.segment_id, s.segment_name, 50 AS tickets_available,
  CAST(l_quantity AS INTEGER) AS tickets_sold,
  CAST(((2 * CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) + CAST(l_quantity AS BIGINT)) // NULLIF(2 * CAST(l_quantity AS BIGINT), 0)) * 0.01 AS DECIMAL(8,2)) AS avg_ticket_price,
  CAST(CAST(l_discount AS DECIMAL(5,2)) * 400 AS DECIMAL(5,2)) AS discount_pct,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_ticket_revenue,
  CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))), 2) AS DECIMAL(12,2)) AS net_ticket_revenue,
  CAST(2 * CAST(l_quantity AS INTEGER) AS DECIMAL(6,2)) AS sell_through_rate
FROM """ + NUMBERED_LINES + """ LEFT JOIN ticket_segments s ON s.segment_id =
  CASE l_returnflag || l_linestatus WHEN 'AF' THEN 1 WHEN 'AO' THEN 2 WHEN 'NF' THEN 3 WHEN 'NO' THEN 4 WHEN 'RF' THEN 8 WHEN 'RO' THEN 9 END""",
    "concessions": _category("concessions", 1, "l_suppkey", "0.30", CON_NAMES, CON_PRICE, CON_COST),
    "merchandise": _category("merchandise", 0, "l_partkey", "0.20", MER_NAMES, MER_PRICE, MER_COST),
    "fan_profiles": f"""
SELECT *, CAST(CAST(floor((0.35e0 * (CAST(avg_ticket_spend AS DOUBLE) / 450e0) + 0.20e0 * (CAST(games_attended_last_12_months AS DOUBLE) / 41e0)
    + 0.15e0 * (CAST(avg_merchandise_spend AS DOUBLE) / 80e0) + 0.15e0 * (CAST(avg_concession_spend AS DOUBLE) / 45e0)
    + 0.10e0 * CAST(email_engagement_score AS DOUBLE) + 0.05e0 * (1e0 - CAST(promotion_usage_rate AS DOUBLE))) * 10000e0 + 0.5e0) AS BIGINT) * 0.0001 AS DECIMAL(5,4)) AS fan_value_score
FROM (SELECT c_custkey AS fan_id, {pick('c_custkey % 6', AGES)} AS age_group, {pick('c_nationkey % 6', HOUSEHOLDS)} AS household_type,
  {pick('c_custkey % 5', DISTANCES)} AS distance_from_arena_bucket,
  {pick('c_custkey % 6', ['Premium Courtside', 'Lower Bowl', 'Club Level', 'Upper Bowl', 'Family Pack', 'Student Promo'])} AS preferred_ticket_segment,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'New Fan' WHEN 'BUILDING' THEN 'Casual Fan' WHEN 'FURNITURE' THEN 'Repeat Buyer'
    WHEN 'HOUSEHOLD' THEN 'Season Ticket Holder' WHEN 'MACHINERY' THEN 'Premium Member' END AS loyalty_status,
  CAST(1 + c_custkey % 41 AS INTEGER) AS games_attended_last_12_months,
  CAST(40 + (17 * c_custkey) % 411 AS DECIMAL(8,2)) AS avg_ticket_spend,
  CAST(8 + (11 * c_custkey) % 38 AS DECIMAL(8,2)) AS avg_concession_spend,
  CAST(5 + (7 * c_custkey) % 76 AS DECIMAL(8,2)) AS avg_merchandise_spend,
  CAST(((13 * c_custkey) % 101) * 0.01 AS DECIMAL(5,4)) AS promotion_usage_rate,
  CAST(((29 * c_custkey) % 101) * 0.01 AS DECIMAL(5,4)) AS email_engagement_score
FROM customer)""",
    "fan_transactions": """
SELECT game_id AS transaction_id, fan_id, game_id, ticket_spend, concession_spend, merchandise_spend,
  (promoted AND game_id % 3 = 0) AS used_promotion,
  CAST(ticket_spend + concession_spend + merchandise_spend AS DECIMAL(10,2)) AS total_spend, game_date AS transaction_date
FROM (SELECT *, CAST(round(total * 0.50, 2) AS DECIMAL(10,2)) AS ticket_spend,
  CAST(round(total * 0.30, 2) AS DECIMAL(10,2)) AS concession_spend,
  CAST(round(total * 0.20, 2) AS DECIMAL(10,2)) AS merchandise_spend FROM ord)""",
    "model_predictions": "\nSELECT game_id, CAST(NULL AS INTEGER) AS predicted_attendance FROM ord",
    # ---- derived, used by several statements ----
    "tix": """
SELECT game_id, COUNT(*) AS n, SUM(tickets_sold) AS sold, SUM(net_ticket_revenue) AS rev FROM ticket_sales GROUP BY ALL""",
    "con": """
SELECT game_id, COUNT(*) AS n, SUM(gross_revenue) AS rev, SUM(gross_margin) AS margin, SUM(units_sold) AS units,
  SUM(recommended_inventory_units) AS inv FROM concessions GROUP BY ALL""",
    "mer": """
SELECT game_id, COUNT(*) AS n, SUM(gross_revenue) AS rev, SUM(gross_margin) AS margin, SUM(units_sold) AS units,
  SUM(recommended_inventory_units) AS inv FROM merchandise GROUP BY ALL""",
    "ga": """
SELECT g.*, a.* EXCLUDE (game_id) FROM games g JOIN attendance a USING (game_id)""",
    "gap": """
SELECT x.*, p.* EXCLUDE (game_id) FROM ga x JOIN promotions p USING (game_id)""",
    "gapw": """
SELECT x.*, w.* EXCLUDE (game_id) FROM gap x JOIN weather w USING (game_id)""",
    # hub with every game, missing revenue as zero
    "rev0": """
SELECT x.*, COALESCE(t.rev, 0) AS ticket_rev, COALESCE(c.rev, 0) AS con_rev, COALESCE(m.rev, 0) AS merch_rev,
  COALESCE(t.rev, 0) + COALESCE(c.rev, 0) + COALESCE(m.rev, 0) AS total_revenue
FROM gap x LEFT JOIN tix t USING (game_id) LEFT JOIN con c USING (game_id) LEFT JOIN mer m USING (game_id)""",
    # hub with games that have all three facts
    "rev3": """
SELECT x.*, t.rev AS ticket_rev, c.rev AS con_rev, m.rev AS merch_rev, t.rev + c.rev + m.rev AS total_rev,
  t.n AS nt, c.n AS nc, m.n AS nm, t.sold AS sold, c.inv AS con_inv, m.inv AS mer_inv
FROM gap x JOIN tix t USING (game_id) JOIN con c USING (game_id) JOIN mer m USING (game_id)""",
}
_WORD = re.compile(r"[a-z_0-9]+")


def _needs(sql: str) -> list[str]:
    words = set(_WORD.findall(sql))
    return [name for name in CTES if name in words]


def statement(body: str) -> str:
    """Body plus, in dependency order, the CTEs it names."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _needs(CTES[name]):
            if dep != name:
                visit(dep)
        order.append(name)

    body = body.strip()
    for name in _needs(body):
        visit(name)
    ctes = [f"{name} AS ({CTES[name].strip()})" for name in order]
    for head in ("WITH RECURSIVE ", "WITH "):
        if body[: len(head)].upper() == head:
            ctes.append(body[len(head):])
            return head + ",\n".join(ctes)
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
