"""Ranks within a key that may hold a very large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import positions


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """key, rows: how many rows each key holds (combined map-side)."""
    return df.groupBy(key).agg(F.count("*").alias("rows"))


def dense_rank_desc(df: DataFrame, key: str, value: str, name: str, attributes: DataFrame | None = None) -> DataFrame:
    """DENSE_RANK() OVER (PARTITION BY key ORDER BY value DESC NULLS FIRST), for keys of any size and shape.

    Equal values share a rank, so only the distinct (key, value) pairs are ranked: partial aggregation
    folds a crowded value map-side, the pairs are numbered by their exact place in falling order
    (``positions``: range partitions and prefix sums, no window over a key, no size switch), and the
    numbers join back on (key, value), null-safe. A single-valued key of any size is one pair; its rows
    meet that one pair in a join that adaptive execution splits when skewed. ``attributes`` has one row
    per key and is inner-joined.
    """
    pairs = df.select(key, value).distinct()
    numbered = positions(pairs, key, [F.desc_nulls_first(value)], "_place").select(
        F.col(key).alias("_key"), F.col(value).alias("_value"), (F.col("_place") + 1).cast("int").alias(name)
    )
    ranked = df.join(numbered, F.col(key).eqNullSafe(F.col("_key")) & F.col(value).eqNullSafe(F.col("_value"))).drop("_key", "_value")
    return ranked.join(attributes, key) if attributes is not None else ranked
