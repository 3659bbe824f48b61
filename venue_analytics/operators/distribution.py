"""Descriptive statistics, histograms, exact quantiles and correlations, all by aggregation."""

from __future__ import annotations

import math
from decimal import Decimal
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import exact_avg, half_up

LEVEL_BINS = 4096  # bins a counting pass of the quantile descent cuts a segment into


def _as_integer(df: DataFrame, column: str) -> tuple[Column, float]:
    """The column as an exact integer and the factor that turns it back."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.DecimalType):
        return (F.col(column) * F.lit(10**dtype.scale).cast("decimal(12,0)")).cast("bigint"), float(10**dtype.scale)
    return F.col(column).cast("bigint"), 1.0


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """column, q0, q1, ...: exact quantiles with linear interpolation, for any number of rows and any spread.

    Radix descent by counting: a pass counts the values of every open segment in LEVEL_BINS equal-width
    bins; the bins that hold a wanted rank become the next pass's segments, until a bin is one value
    wide and so names the value. A 64-bit range takes at most six passes, whatever the outliers; every
    pass is an aggregation (combined map-side), so no task sorts or holds the rows of a crowded bin, and
    the driver sees at most LEVEL_BINS counts per open segment (two segments per probability and column
    at most). A column without values gets no row.
    """
    spark = df.sparkSession
    entries = [(c, *_as_integer(df, c)) for c in columns]
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), value.alias("v"), F.lit(factor).alias("factor")) for c, value, factor in entries
    ]))).where(F.col("v").isNotNull())
    stats = long.groupBy("column", "factor").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("total")).collect()

    found: dict[tuple[str, int], int] = {}
    # Open segments: (column, low, high inclusive, rows before it, wanted ranks inside).
    todo = []
    for s in stats:
        last = float(s["total"] - 1)
        ranks = sorted({r(p * last) for p in probs for r in (math.floor, math.ceil)})
        todo.append((s["column"], int(s["low"]), int(s["high"]), 0, ranks))
    while todo:
        widths = [(high - low) // LEVEL_BINS + 1 for _, low, high, _, _ in todo]
        segments = spark.createDataFrame(
            [(i, c, Decimal(low), Decimal(high), Decimal(w)) for i, ((c, low, high, _, _), w) in enumerate(zip(todo, widths))],
            "seg int, column string, low decimal(20,0), high decimal(20,0), width decimal(20,0)",
        )
        v = F.col("v").cast("decimal(20,0)")
        # At most two segments per probability and column: a broadcast of bounded size.
        inside = long.join(F.broadcast(segments), "column").where((v >= F.col("low")) & (v <= F.col("high")))
        counts = inside.groupBy("seg", F.floor((v - F.col("low")) / F.col("width")).cast("long").alias("b")).agg(F.count("*").alias("n")).collect()
        by_segment: dict[int, list[tuple[int, int]]] = {}
        for r in counts:
            by_segment.setdefault(r["seg"], []).append((r["b"], r["n"]))
        following = []
        for i, (c, low, high, before, ranks) in enumerate(todo):
            width, start, pending = widths[i], before, list(ranks)
            for b, n in sorted(by_segment.get(i, [])):
                here = [r for r in pending if start <= r < start + n]
                if here:
                    lo = low + b * width
                    if width == 1:
                        found.update({(c, r): lo for r in here})
                    else:
                        following.append((c, lo, min(lo + width - 1, high), start, here))
                    pending = [r for r in pending if r not in here]
                start += n
        todo = following

    rows = []
    for s in stats:
        last = float(s["total"] - 1)
        values = []
        for p in probs:
            a = float(found[(s["column"], math.floor(p * last))]) / s["factor"]
            b = float(found[(s["column"], math.ceil(p * last))]) / s["factor"]
            values.append(a + (b - a) * (p * last - float(math.floor(p * last))))
        rows.append((s["column"], *values))
    return spark.createDataFrame(rows, ", ".join(["column string", *[f"q{i} double" for i in range(len(probs))]]))


def describe(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """column, count, mean, std, min, p25, p50, p75, max of integer or decimal columns."""
    aggs, rows = [], []
    for i, c in enumerate(columns):
        value, factor = _as_integer(df, c)
        wide = value.cast("decimal(38,0)")
        aggs += [
            F.count(c).alias(f"n{i}"), exact_avg(c).alias(f"m{i}"), F.sum(wide).cast("double").alias(f"s{i}"),
            F.sum(wide * wide).cast("double").alias(f"q{i}"), F.min(c).cast("double").alias(f"a{i}"), F.max(c).cast("double").alias(f"z{i}"),
        ]
        n = F.col(f"n{i}").cast("double")
        total = F.col(f"s{i}")
        spread = (F.col(f"q{i}") - total * total / F.nullif(n, F.lit(0.0))) / F.nullif(n - 1, F.lit(0.0))
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), half_up(f"m{i}", digits).alias("mean"),
            half_up(F.sqrt(F.greatest(spread, F.lit(0.0))) / factor, digits).alias("std"), F.col(f"a{i}").alias("min"), F.col(f"z{i}").alias("max")))
    base = df.agg(*aggs).select(F.inline(F.array(*rows)))
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", *[half_up(f"q{i}", digits).alias(name) for i, name in enumerate(("p25", "p50", "p75"))])
    return base.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """column, bin, low, high, rows: equal-width bins between minimum and maximum, the last one closed."""
    x = F.col(column).cast("double")
    edges = df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high"))).scalar()
    width = (edges["high"] - edges["low"]) / F.lit(float(bins))
    place = F.floor((x - edges["low"]) / F.nullif(width, F.lit(0.0))).cast("bigint")
    index = F.least(F.coalesce(place, F.lit(0).cast("bigint")), F.lit(bins - 1).cast("bigint"))
    counted = df.where(F.col(column).isNotNull()).groupBy(index.alias("bin")).agg(F.count("*").alias("rows"))
    low = edges["low"] + F.col("bin") * width
    return counted.select(
        F.lit(column).alias("column"), "bin", half_up(low, 6).alias("low"), half_up(low + width, 6).alias("high"), "rows"
    )


def histograms(df: DataFrame, specs: list[tuple[str, int]]) -> DataFrame:
    """``histogram`` of several columns of one frame in two passes: one for all ranges, one for all bins.

    The columns are unfolded into (column, value) rows once; each value's bin comes from its column's
    low edge and width, given as literals (two numbers a column), with the same arithmetic as
    ``histogram``.
    """
    x = {c: F.col(c).cast("double") for c, _ in specs}
    edges = df.agg(*[F.struct(F.min(x[c]).alias("low"), F.max(x[c]).alias("high")).alias(f"e{i}") for i, (c, _) in enumerate(specs)]).head()
    parts = []
    for i, (c, bins) in enumerate(specs):
        low, high = edges[f"e{i}"]["low"], edges[f"e{i}"]["high"]
        width = (high - low) / float(bins) if low is not None else None
        parts.append((c, bins, low, width))
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), x[c].alias("v")) for c, _ in specs]))).where(F.col("v").isNotNull())
    pick = lambda values: F.element_at(F.create_map(*[F.lit(z) for c, *rest in parts for z in (c, rest[values])]), F.col("column"))
    bins_of, low_of, width_of = pick(0), pick(1).cast("double"), pick(2).cast("double")
    place = F.floor((F.col("v") - low_of) / F.nullif(width_of, F.lit(0.0))).cast("bigint")
    index = F.least(F.coalesce(place, F.lit(0).cast("bigint")), (bins_of - 1).cast("bigint"))
    counted = long.groupBy("column", index.alias("bin")).agg(F.count("*").alias("rows"))
    lower = low_of + F.col("bin") * width_of
    return counted.select("column", "bin", half_up(lower, 6).alias("low"), half_up(lower + width_of, 6).alias("high"), "rows")


def correlations(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """feature_a, feature_b, corr for every pair of columns, from one aggregation pass."""
    pairs = list(combinations(columns, 2))
    x = {c: F.col(c).cast("double") for c in columns}
    wide = df.agg(*[F.corr(x[a], x[b]).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), half_up(f"c{i}", digits).alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*rows)))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """At most n rows, the same ones for the same keys and seed (a sampling operator: top n by key hash)."""
    mixed = (F.pmod(F.col(key).cast("bigint") + seed, F.lit(2**31)) * F.lit(2654435761)) % F.lit(2**32)
    return df.orderBy(mixed, key).limit(n)
