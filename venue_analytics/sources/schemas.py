"""Declared schemas of the twelve domain tables. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_SHORT = {
    "int": T.IntegerType(), "long": T.LongType(), "str": T.StringType(), "bool": T.BooleanType(),
    "date": T.DateType(),
}


def _schema(spec: str) -> T.StructType:
    """'name type; name! type' -> StructType; a decimal is written p.s, '!' marks not null."""
    fields = []
    for item in spec.replace("\n", " ").split(";"):
        name, kind = item.split()
        dtype = _SHORT.get(kind) or T.DecimalType(*(int(x) for x in kind.split(".")))
        fields.append(T.StructField(name.rstrip("!"), dtype, not name.endswith("!")))
    return T.StructType(fields)


SALES_BY_CATEGORY = """game_id! long; category! str; units_sold! int; avg_unit_price 8.2; gross_revenue! 12.2;
    estimated_cost 12.2; gross_margin 12.2; per_cap_spend 8.2; recommended_inventory_units int"""

SCHEMAS: dict[str, T.StructType] = {
    "teams": _schema(
        """team_id! int; team_abbr! str; team_name! str; team_city! str; conference! str; division! str;
        arena_name! str; arena_capacity! int; market_size_tier! str; historical_popularity_score! 4.3"""
    ),
    "games": _schema(
        """game_id! long; season! int; game_date! date; home_team_id! int; away_team_id! int;
        home_team_name str; away_team_name str; home_team_abbr str; away_team_abbr str; day_of_week str;
        month int; is_weekend bool; is_holiday_period bool; rivalry_flag bool; nationally_televised_flag bool;
        home_team_win_pct_entering_game 5.4; away_team_win_pct_entering_game 5.4; home_team_recent_form 5.4;
        away_team_recent_form 5.4; home_score int; away_score int; home_win_flag int"""
    ),
    "weather": _schema(
        """game_id! long; temperature_f 5.1; precipitation_flag bool; snow_flag bool;
        severe_weather_flag bool; weather_condition str"""
    ),
    "promotions": _schema(
        """promotion_id! long; game_id! long; promotion_flag bool; promotion_type! str; promotion_cost 10.2;
        expected_promotion_lift_pct 5.2; sponsor_category str; sponsor_value_estimate 12.2"""
    ),
    "attendance": _schema(
        """game_id! long; arena_capacity! int; actual_attendance! int; capacity_pct 6.2;
        expected_attendance_baseline int; attendance_variance int; attendance_tier str"""
    ),
    "ticket_segments": _schema("segment_id! int; segment_name! str; avg_base_price! 8.2; price_tier! str"),
    "ticket_sales": _schema(
        """ticket_sale_id! long; game_id! long; segment_id! int; segment_name str; tickets_available! int;
        tickets_sold! int; avg_ticket_price! 8.2; discount_pct 5.2; gross_ticket_revenue! 12.2;
        net_ticket_revenue! 12.2; sell_through_rate 6.2"""
    ),
    "concessions": _schema("concession_id! long; " + SALES_BY_CATEGORY),
    "merchandise": _schema("merchandise_id! long; " + SALES_BY_CATEGORY),
    "fan_profiles": _schema(
        """fan_id! long; age_group str; household_type str; distance_from_arena_bucket str;
        preferred_ticket_segment str; loyalty_status str; games_attended_last_12_months int;
        avg_ticket_spend 8.2; avg_concession_spend 8.2; avg_merchandise_spend 8.2; promotion_usage_rate 5.4;
        email_engagement_score 5.4; fan_value_score 5.4"""
    ),
    "fan_transactions": _schema(
        """transaction_id! long; fan_id! long; game_id! long; ticket_spend 10.2; concession_spend 10.2;
        merchandise_spend 10.2; used_promotion bool; total_spend 10.2; transaction_date date"""
    ),
    "model_predictions": _schema(
        """game_id! long; predicted_attendance int; predicted_ticket_revenue 12.2;
        predicted_concessions_revenue 12.2; predicted_merchandise_revenue 12.2; predicted_total_revenue 12.2;
        actual_total_revenue 12.2; attendance_prediction_error int; revenue_prediction_error 12.2;
        model_run_date date"""
    ),
}
