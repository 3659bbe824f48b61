"""Model-ready game features: pre-game signals, lagged history and the two targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.numeric import exact_avg
from .lagged import lagged_means
from .marts import ROLLUPS

# --- fixed values: feature lists and defaults -----------------------------------------------------
ATTENDANCE_FEATURES = [
    "is_weekend", "is_holiday_period", "rivalry_flag", "nationally_televised_flag", "promotion_flag",
    "expected_promotion_lift_pct", "home_team_win_pct_entering_game", "away_team_win_pct_entering_game",
    "home_team_recent_form", "away_team_recent_form", "home_team_popularity", "away_team_popularity",
    "temperature_f", "snow_flag", "severe_weather_flag", "precipitation_flag", "arena_capacity_feat",
    "rolling_att_3", "rolling_att_5", "dow_ordinal", "month", "promotion_type",
]
REVENUE_PREGAME_FEATURES = ATTENDANCE_FEATURES + [
    "promotion_cost", "sponsor_value_estimate", "planned_avg_base_price", "rolling_rev_3", "rolling_rev_5",
]
ATTENDANCE_TARGET = "actual_attendance"
REVENUE_TARGET = "total_game_day_revenue"
POST_GAME_COLUMNS = [
    "actual_attendance", "capacity_pct", "total_tickets_sold", "avg_ticket_price_all", "total_gross_ticket_revenue",
    "total_net_ticket_revenue", "total_concession_revenue", "total_merchandise_revenue",
]
DEFAULT_POPULARITY, DEFAULT_CAPACITY, DEFAULT_TEMPERATURE, DEFAULT_BASE_PRICE = 0.65, 18000, 60.0, 140.0
# --------------------------------------------------------------------------------------------------
KEYS = ["game_id", "season", "game_date"]
HISTORY = {
    "rolling_att_3": (ATTENDANCE_TARGET, 3), "rolling_att_5": (ATTENDANCE_TARGET, 5),
    "rolling_rev_3": (REVENUE_TARGET, 3), "rolling_rev_5": (REVENUE_TARGET, 5),
}


REVENUE_NAMES = {"ticket_rev": "total_net_ticket_revenue", "con_rev": "total_concession_revenue", "merch_rev": "total_merchandise_revenue"}


def _outcomes(t) -> DataFrame:
    """Per game: team and date, attendance, the three revenues (missing as zero) and their total."""
    out = t["games"].select("game_id", "game_date", "season", "home_team_id").join(
        t["attendance"].select("game_id", ATTENDANCE_TARGET), "game_id", "left")
    for mart, source in zip(ROLLUPS, REVENUE_NAMES):
        out = out.join(t.mart(mart).select("game_id", source), "game_id", "left")
    out = out.withColumns({name: F.coalesce(F.col(source), F.lit(0)) for source, name in REVENUE_NAMES.items()})
    total = F.col("total_net_ticket_revenue") + F.col("total_concession_revenue") + F.col("total_merchandise_revenue")
    return out.withColumn(REVENUE_TARGET, total).drop(*REVENUE_NAMES)


def _signals(t) -> DataFrame:
    """Games left-joined with their tier, weather, promotion and both teams."""
    out = (
        t["games"]
        .join(t["attendance"].select("game_id", "attendance_tier"), "game_id", "left")
        .join(t["weather"], "game_id", "left")
        .join(t["promotions"].drop("promotion_id"), "game_id", "left")
    )
    team = t["teams"].select("team_id", "historical_popularity_score", "arena_capacity")
    home = team.toDF("home_team_id", "home_team_popularity", "arena_capacity_feat")
    away = team.select("team_id", "historical_popularity_score").toDF("away_team_id", "away_team_popularity")
    return out.join(home, "home_team_id", "left").join(away, "away_team_id", "left")


def _defaults(df: DataFrame) -> DataFrame:
    def flag(c: str):
        return F.coalesce(F.col(c), F.lit(False)).cast("int")

    return df.withColumns({
        "home_team_popularity": F.coalesce(F.col("home_team_popularity").cast("double"), F.lit(DEFAULT_POPULARITY)),
        "away_team_popularity": F.coalesce(F.col("away_team_popularity").cast("double"), F.lit(DEFAULT_POPULARITY)),
        "arena_capacity_feat": F.coalesce(F.col("arena_capacity_feat"), F.lit(DEFAULT_CAPACITY)),
        "temperature_f": F.coalesce(F.col("temperature_f").cast("double"), F.lit(DEFAULT_TEMPERATURE)),
        "promotion_type": F.coalesce(F.col("promotion_type"), F.lit("None")),
        **{c: flag(c) for c in ("precipitation_flag", "snow_flag", "severe_weather_flag", "promotion_flag", "is_weekend", "is_holiday_period", "rivalry_flag", "nationally_televised_flag")},
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in ("expected_promotion_lift_pct", "promotion_cost", "sponsor_value_estimate")},
        "dow_ordinal": rules.dow_ordinal("day_of_week"),
    })


def build_features(t, fill: str = "global_mean", max_rows: int = 1_000_000) -> DataFrame:
    """One row per game with every feature and both targets, no nulls among numbers.

    ``fill`` says what a team's first game gets for its missing history: ``global_mean`` is the mean over
    all games, which looks ahead into the test season; ``train_mean`` uses earlier seasons only.
    """
    outcomes = t.keep("outcomes", lambda: _outcomes(t))  # read by the means, the range sampling and the history
    known = outcomes
    if fill == "train_mean":
        known = outcomes.where(F.col("season") < t["games"].agg(F.max("season")).scalar())
    elif fill != "global_mean":
        raise ValueError(f"unknown fill {fill!r}")
    means = known.agg(F.struct(exact_avg(ATTENDANCE_TARGET).alias("att"), exact_avg(REVENUE_TARGET).alias("rev"))).scalar()
    # History runs on the narrow outcome columns; the wide signals join afterwards, one row per game.
    history = lagged_means(outcomes, "home_team_id", "game_date", "game_id", HISTORY, max_rows, counted=t["games"])
    history = history.withColumn("_mean", means).withColumns({
        name: F.coalesce(F.col(name), F.col("_mean")["att" if value == ATTENDANCE_TARGET else "rev"])
        for name, (value, _) in HISTORY.items()
    }).drop("_mean", "home_team_id", "game_date", "season")
    df = _defaults(_signals(t)).join(history, "game_id")
    price = t["ticket_segments"].agg(F.coalesce(exact_avg("avg_base_price"), F.lit(DEFAULT_BASE_PRICE))).scalar()
    lift = (
        F.lit(1.0) + F.lit(0.15) * F.col("rivalry_flag").cast("double")
        + F.lit(0.10) * F.col("nationally_televised_flag").cast("double")
        + F.lit(0.08) * F.col("is_weekend").cast("double") + F.lit(0.12) * F.col("home_team_popularity")
    )
    df = df.withColumn("planned_avg_base_price", price * lift)
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    decimals = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double") if c in decimals else F.col(c), F.lit(0)) for c in numeric
    })


def attendance_features(df: DataFrame) -> DataFrame:
    """The 22 attendance features, their target and the keys."""
    columns = list(dict.fromkeys([*ATTENDANCE_FEATURES, ATTENDANCE_TARGET, *KEYS]))
    return df.select(*columns).dropna(subset=[ATTENDANCE_TARGET])


def revenue_features(df: DataFrame) -> DataFrame:
    """The 27 pre-game revenue features, their target and the keys; games without revenue are left out."""
    columns = list(dict.fromkeys([*REVENUE_PREGAME_FEATURES, REVENUE_TARGET, *KEYS]))
    out = df.select(*columns).dropna(subset=[REVENUE_TARGET]).where(F.col(REVENUE_TARGET) > 0)
    assert_pregame(out)
    return out


def assert_pregame(df: DataFrame) -> None:
    """Fail if a column only known after the game is among the revenue features."""
    leaked = sorted(set(df.columns) & set(POST_GAME_COLUMNS))
    if leaked:
        raise ValueError(f"post-game columns in revenue features: {leaked}")


def team_form(t, games: int = 5, default: float = 0.5, max_rows: int = 1_000_000) -> DataFrame:
    """Share of wins over each team's last games, home and away, before every game."""
    g = t["games"]
    side = lambda team, won, place: g.select(
        "game_id", "game_date", F.col(team).alias("team_id"), won.alias("won"), F.lit(place).alias("side")
    )
    win = F.col("home_win_flag")
    rows = side("home_team_id", win, "home").unionByName(side("away_team_id", 1 - win, "away"))
    form = lagged_means(rows, "team_id", "game_date", "game_id", {"form": ("won", games)}, max_rows)
    form = form.withColumn("form", F.coalesce("form", F.lit(default)))
    return form.groupBy("game_id").agg(*[
        F.max(F.when(F.col("side") == s, F.col("form"))).alias(f"{s}_team_recent_form") for s in ("home", "away")
    ])
