"""Validation rules and cleaning of the domain tables.

Validation never stops a job: it returns one row per rule with its number of violations. All row rules of a
table are counted in a single aggregation pass; a unique key adds a count by that key alone, since a distinct
count beside the row rules would send all their partial counts through the shuffle with every key.
References to other tables add one anti-join each, on keys that are deduplicated with their counts first so
a hot key crosses the network once per task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.numeric import clip, half_even
from ..sources.schemas import SCHEMAS


@dataclass(frozen=True)
class Rule:
    """A named count of offending rows (or surplus keys) over one table."""

    name: str
    violations: Column
    key: str | None = None  # the column whose surplus values ``violations`` counts, for a unique key


@dataclass(frozen=True)
class Reference:
    """A foreign key: every non-null value of column must exist in other.key."""

    column: str
    other: str
    key: str


def holds(name: str, condition: Column) -> Rule:
    """Rows where the condition is false or unknown."""
    return Rule(name, F.count_if(~F.coalesce(condition, F.lit(False))))


def check(name: str, condition: Column) -> Rule:
    """Rows where the condition is false; unknown passes, like an SQL CHECK."""
    return Rule(name, F.count_if(~F.coalesce(condition, F.lit(True))))


def unique(column: str) -> Rule:
    return Rule(f"{column} is unique", F.count(column) - F.count_distinct(column), column)


def not_null(column: str) -> Rule:
    return Rule(f"{column} is not null", F.count_if(F.col(column).isNull()))


def at_least(column: str, low: float, strict: bool = False) -> Rule:
    c = F.col(column)
    return check(f"{column} {'>' if strict else '>='} {low}", c > low if strict else c >= low)


def in_range(column: str, low: float, high: float) -> Rule:
    return check(f"{column} in {low}..{high}", F.col(column).between(low, high))


def one_of(column: str, values: list) -> Rule:
    return check(f"{column} is a known value", F.col(column).isin(*values))


def _sales_rules() -> list[Rule]:
    return [
        not_null("game_id"), at_least("units_sold", 0),
        holds("gross_revenue is non-negative", F.col("gross_revenue") >= 0),
        holds("gross_margin is non-negative", F.col("gross_margin") >= 0),
    ]


# Record ids, the primary keys of the fact tables that have one of their own.
RECORD_KEYS = {"ticket_sales": "ticket_sale_id", "concessions": "concession_id", "merchandise": "merchandise_id"}


def declared_rules(name: str, rules: list[Rule]) -> list[Rule]:
    """The declared schema's constraints the cleaning rules leave out: NOT NULL of every non-nullable
    column, and the table's record id as its primary key."""
    known = {r.name for r in rules}
    extra = [not_null(f.name) for f in SCHEMAS[name].fields if not f.nullable and f"{f.name} is not null" not in known]
    if name in RECORD_KEYS and f"{RECORD_KEYS[name]} is unique" not in known:
        extra.append(unique(RECORD_KEYS[name]))
    return rules + extra


def table_rules() -> dict[str, list[Rule]]:
    """Rules of the cleaning job and of the declared schema, per table."""
    return {name: declared_rules(name, rules) for name, rules in _cleaning_rules().items()}


def _cleaning_rules() -> dict[str, list[Rule]]:
    return {
        "teams": [
            unique("team_id"), unique("team_name"), unique("team_abbr"), at_least("arena_capacity", 0, strict=True),
            holds("historical_popularity_score in 0..1", F.col("historical_popularity_score").between(0, 1)),
        ],
        "games": [
            unique("game_id"), not_null("home_team_id"), not_null("away_team_id"),
            holds("game_date from 2019", F.year("game_date") >= 2019), in_range("month", 1, 12),
            in_range("home_team_win_pct_entering_game", 0, 1), in_range("away_team_win_pct_entering_game", 0, 1),
            one_of("home_win_flag", [0, 1]),
        ],
        "weather": [unique("game_id"), not_null("game_id")],
        "promotions": [unique("game_id"), not_null("game_id"), not_null("promotion_type")],
        "attendance": [
            unique("game_id"),
            holds("actual_attendance is non-negative", F.col("actual_attendance") >= 0),
            holds("actual_attendance within capacity", F.col("actual_attendance") <= F.col("arena_capacity")),
            one_of("attendance_tier", R.TIERS),
        ],
        "ticket_segments": [unique("segment_id"), unique("segment_name"), at_least("avg_base_price", 0, strict=True)],
        "ticket_sales": [
            not_null("game_id"), not_null("segment_id"), at_least("tickets_available", 0, strict=True),
            at_least("tickets_sold", 0), at_least("avg_ticket_price", 0),
            holds("gross_ticket_revenue is non-negative", F.col("gross_ticket_revenue") >= 0),
            holds("net_ticket_revenue is non-negative", F.col("net_ticket_revenue") >= 0),
            holds("tickets_sold within available", F.col("tickets_sold") <= F.col("tickets_available")),
        ],
        "concessions": _sales_rules(),
        "merchandise": _sales_rules(),
        "fan_profiles": [
            unique("fan_id"), at_least("games_attended_last_12_months", 0),
            holds("avg_ticket_spend is non-negative", F.col("avg_ticket_spend") >= 0),
            at_least("avg_concession_spend", 0), at_least("avg_merchandise_spend", 0),
            in_range("promotion_usage_rate", 0, 1), in_range("email_engagement_score", 0, 1),
            in_range("fan_value_score", 0, 1),
        ],
        "fan_transactions": [
            unique("transaction_id"), not_null("fan_id"), not_null("game_id"), at_least("ticket_spend", 0),
            at_least("concession_spend", 0), at_least("merchandise_spend", 0),
            holds("total_spend is non-negative", F.col("total_spend") >= 0),
        ],
        "model_predictions": [unique("game_id"), not_null("game_id")],
    }


REFERENCES: dict[str, list[Reference]] = {
    "games": [Reference("home_team_id", "teams", "team_id"), Reference("away_team_id", "teams", "team_id")],
    **{name: [Reference("game_id", "games", "game_id")] for name in ("weather", "promotions", "attendance", "concessions", "merchandise", "model_predictions")},
    "ticket_sales": [Reference("game_id", "games", "game_id"), Reference("segment_id", "ticket_segments", "segment_id")],
    "fan_transactions": [Reference("fan_id", "fan_profiles", "fan_id"), Reference("game_id", "games", "game_id")],
}


def validate(df: DataFrame, rules: list[Rule], table: str) -> DataFrame:
    """rule, table_name, violations, passed: one row per rule, one pass over df and one over each unique key."""
    by_row = [r for r in rules if r.key is None]
    parts = [by_row] * bool(by_row) + [[r] for r in rules if r.key is not None]
    return reduce(DataFrame.unionByName, [_counted(df, part, table) for part in parts])


def _counted(df: DataFrame, rules: list[Rule], table: str) -> DataFrame:
    counted = df.agg(*[r.violations.alias(f"r{i}") for i, r in enumerate(rules)])
    rows = [F.struct(F.lit(r.name).alias("rule"), F.lit(table).alias("table_name"), F.col(f"r{i}").alias("violations")) for i, r in enumerate(rules)]
    return counted.select(F.inline(F.array(*rows))).withColumn("passed", F.col("violations") == 0)


def validate_reference(df: DataFrame, ref: Reference, other: DataFrame, table: str) -> DataFrame:
    """One row: how many rows of df point to a missing key."""
    keys = df.where(F.col(ref.column).isNotNull()).groupBy(F.col(ref.column).alias("_key")).agg(F.count("*").alias("_n"))
    known = other.select(F.col(ref.key).alias("_key"))
    orphans = keys.join(known, "_key", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))
    return orphans.select(
        F.lit(f"{ref.column} exists in {ref.other}").alias("rule"), F.lit(table).alias("table_name"),
        "violations", (F.col("violations") == 0).alias("passed"),
    )


def validate_all(t) -> DataFrame:
    """Every rule and reference of every table."""
    parts = [validate(t[name], rules, name) for name, rules in table_rules().items()]
    parts += [validate_reference(t[name], ref, t[ref.other], name) for name, refs in REFERENCES.items() for ref in refs]
    return reduce(DataFrame.unionByName, parts)


def offenders(df: DataFrame, key: str) -> DataFrame:
    """Values of a key that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count("*").alias("occurrences")).where(F.col("occurrences") > 1)


def issue_summary(results: DataFrame) -> DataFrame:
    """One row: rules run, rules broken and whether all passed."""
    return results.agg(
        F.count("*").alias("rules"), F.count_if(~F.col("passed")).alias("issues"),
        F.bool_and("passed").alias("all_passed"),
    )


# ---- cleaning ------------------------------------------------------------------------------------
def _clip(df: DataFrame, low: float | None, high: float | None, *columns: str) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({c: clip(c, low, high).cast(types[c]) for c in columns})


def clean_teams(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["team_id", "team_name"])


def clean_games(df: DataFrame) -> DataFrame:
    """Parse the date and bound the winning percentages."""
    df = df.withColumn("game_date", F.to_date("game_date"))
    return _clip(df, 0, 1, "home_team_win_pct_entering_game", "away_team_win_pct_entering_game")


def clean_attendance(df: DataFrame) -> DataFrame:
    """Floor attendance at zero and recompute the fill; the stored tier stays as it is."""
    df = _clip(df, 0, None, "actual_attendance")
    pct = F.col("actual_attendance") / F.nullif(F.col("arena_capacity").cast("double"), F.lit(0.0)) * 100
    return df.withColumn("capacity_pct", half_even(pct, 2))


def clean_ticket_sales(df: DataFrame) -> DataFrame:
    both = F.col("tickets_sold").isNotNull() & F.col("tickets_available").isNotNull()  # least() would skip a null
    df = df.withColumn("tickets_sold", F.when(both, F.least("tickets_sold", "tickets_available")))
    df = _clip(df, 0, None, "gross_ticket_revenue", "net_ticket_revenue")
    return _clip(df, 0, 100, "discount_pct")


def clean_concessions(df: DataFrame) -> DataFrame:
    return _clip(df, 0, None, "gross_revenue", "gross_margin")


clean_merchandise = clean_concessions


def clean_fan_profiles(df: DataFrame) -> DataFrame:
    df = _clip(df, 0, None, "avg_ticket_spend", "avg_concession_spend", "avg_merchandise_spend")
    return _clip(df, 0, 1, "promotion_usage_rate", "email_engagement_score", "fan_value_score")


def clean_fan_transactions(df: DataFrame) -> DataFrame:
    """Floor the parts at zero and recompute the total from them."""
    df = _clip(df, 0, None, "ticket_spend", "concession_spend", "merchandise_spend")
    return df.withColumn("total_spend", F.col("ticket_spend") + F.col("concession_spend") + F.col("merchandise_spend"))


CLEANERS = {
    "teams": clean_teams, "games": clean_games, "attendance": clean_attendance, "ticket_sales": clean_ticket_sales,
    "concessions": clean_concessions, "merchandise": clean_merchandise, "fan_profiles": clean_fan_profiles,
    "fan_transactions": clean_fan_transactions,
}


def clean(name: str, df: DataFrame) -> DataFrame:
    """Cleaned copy of a table; tables without a cleaner pass through."""
    return CLEANERS.get(name, lambda frame: frame)(df)
