"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by (source, language, topic). Languages and topics have a fixed list of classes, so a
source is one row with languages x topics sums, and raking never needs a shuffle: in each round every
source's factor is its target over its weighted row sum, and one aggregate returns languages x topics
numbers from which the driver updates the two short factor lists. Documents are then sampled with
probability min(1, c * factor); c gives the expected share of tokens, and ``weight`` carries what the
clipping at 1 leaves, so weighted expected tokens meet the targets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

LANGUAGES = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
TOPICS = ("tabular", "legal", "contact", "listing", "prose")
OTHER = "other"
KEEP = 0.5
ROUNDS = 100
TOLERANCE = 1e-5
BROADCAST_ROWS = 100_000


def topic(text: Column) -> Column:
    """Content class of a text by its form; the last class takes the rest, null and empty texts too."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "tabular")
        .when(text.rlike("(?i)licensed under|all rights reserved|public license"), "legal")
        .when(F.contains(text, F.lit("@")), "contact")
        .when(F.regexp_count(text, F.lit("\n")) * 120 > F.length(text), "listing")
        .otherwise("prose")
    )


def tokens(text: Column) -> Column:
    """White-space separated words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@dataclass
class Mix:
    """A fitted mix: the factor of each source (a frame: __source, __factor), language and topic, and what it reached."""

    sources: DataFrame
    n_sources: int
    languages: dict[str, float]
    topics: dict[str, float]
    scale: float
    rounds: int
    error: float


def _targets(spec: dict[str, float] | float, names: list[str], sums: np.ndarray) -> np.ndarray:
    """Target shares of classes: a dictionary, whose unnamed classes keep their natural share; or a power of the natural share."""
    natural = sums / sums.sum()
    if isinstance(spec, dict):
        named = np.array([n in spec for n in names]) & (sums > 0)
        wanted = np.array([spec.get(n, 0.0) for n in names]) * named
        left = natural[~named].sum()
        out = np.where(named, wanted / max(wanted.sum(), 1e-300) * (1 - left), natural)
        return out / out.sum()
    raised = np.where(natural > 0, natural, 1) ** spec * (natural > 0)
    return raised / raised.sum()


def fit(cells: DataFrame, languages: list[str], topics: list[str], source_power: float, language_targets: dict[str, float] | float, topic_targets: dict[str, float] | float, keep: float) -> Mix:
    """Rake stored cells (__source, w: one sum for each language and topic; one row a source) to the three marginals.

    Ends when language and topic shares are within TOLERANCE of their targets; ``error`` tells where
    it ended after ROUNDS otherwise (targets that exclude each other).
    """
    n = len(languages) * len(topics)
    w = [F.col("w")[i] for i in range(n)]
    cells = cells.withColumn("own", F.aggregate("w", F.lit(0.0), lambda a, x: a + x))
    first = cells.agg(F.count("*"), F.sum(F.pow("own", F.lit(source_power))), *[F.sum(c) for c in w]).head()
    if not first[0] or not sum(first[2:]):
        return Mix(cells.select("__source", F.lit(1.0).alias("__factor")), first[0], dict.fromkeys(languages, 1.0), dict.fromkeys(topics, 1.0), keep, 0, 0.0)
    sums = np.array(first[2:], dtype=np.float64).reshape(len(languages), len(topics))
    total = sums.sum()
    want_l, want_t = _targets(language_targets, languages, sums.sum(1)), _targets(topic_targets, topics, sums.sum(0))
    by_l, by_t = (sums.sum(1) > 0).astype(float), (sums.sum(0) > 0).astype(float)
    cells = cells.withColumn("target", F.pow("own", F.lit(source_power)) / F.lit(float(first[1])))

    def row_dot(c: str, factors: np.ndarray) -> Column:
        """Sum of an array column times a list of factors; a list, not code, so that no round compiles anew."""
        return F.aggregate(F.zip_with(c, F.array(*[F.lit(float(g)) for g in factors.ravel()]), lambda x, g: x * g), F.lit(0.0), lambda a, x: a + x)

    def with_factor(by_l: np.ndarray, by_t: np.ndarray) -> DataFrame:
        inner = cells.withColumn("inner", row_dot("w", np.outer(by_l, by_t)))
        return inner.withColumn("__factor", F.when(F.col("inner") > 0, F.col("target") / F.col("inner")).otherwise(0.0))

    rounds, error = 0, 1.0
    while rounds < ROUNDS:
        rounds += 1
        raked = np.array(with_factor(by_l, by_t).agg(*[F.sum(c * F.col("__factor")) for c in w]).head(), dtype=np.float64).reshape(sums.shape)
        now = raked * np.outer(by_l, by_t)
        error = max(abs(now.sum(1) - want_l).max(), abs(now.sum(0) - want_t).max())
        if error <= TOLERANCE:
            break
        row = (raked * by_t).sum(1)
        by_l = np.divide(want_l, row, out=np.zeros_like(row), where=row > 0)
        column = (raked.T * by_l).sum(1)
        by_t = np.divide(want_t, column, out=np.zeros_like(column), where=column > 0)
    done = with_factor(by_l, by_t)
    scale = keep * total
    for _ in range(ROUNDS):  # the least scale at which clipped probabilities give the expected share
        scaled = F.array(*[F.lit(float(g * scale)) for g in np.outer(by_l, by_t).ravel()])
        wanted = F.zip_with("w", scaled, lambda x, g: F.struct(x.alias("x"), (g * F.col("__factor")).alias("p")))
        full, rest = done.withColumn("v", wanted).agg(
            F.sum(F.aggregate("v", F.lit(0.0), lambda a, v: a + F.when(v["p"] >= 1, v["x"]).otherwise(0.0))),
            F.sum(F.aggregate("v", F.lit(0.0), lambda a, v: a + F.when(v["p"] >= 1, 0.0).otherwise(v["x"] * v["p"]))),
        ).head()
        better = (keep * total - full) / rest * scale if rest > 0 else scale
        if better <= scale * (1 + TOLERANCE):
            break
        scale = better
    return Mix(done.select("__source", "__factor"), first[0], dict(zip(languages, by_l.tolist())), dict(zip(topics, by_t.tolist())), scale, rounds, float(error))


def draw(key: str, text: str) -> Column:
    """A row's uniform draw in [0, 1): a hash of its key and text, so equal rows draw alike and reruns agree."""
    return F.pmod(F.xxhash64(key, text), F.lit(1 << 40)) / F.lit(float(1 << 40))


def mix(docs: DataFrame, keep: float = KEEP, source_power: float = 0.5, language_targets: dict[str, float] | float | None = None, topic_targets: dict[str, float] | float = 0.7, text: str = "text", source: str = "source", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """docs with topic, n_tokens, weight, probability and sampled.

    A null source is the empty one; a null or unlisted language is `other`, which keeps its natural
    share. Rows without tokens get their cell's probability, and so do ties and repeated rows: a row is
    drawn by a hash of its key and text, so equal rows are drawn alike and a rerun draws the same.
    An empty frame stays empty. Columns of the five names are replaced.
    """
    language_targets = language_targets or LANGUAGES
    languages = [*(language_targets if isinstance(language_targets, dict) else LANGUAGES), OTHER]
    topics = list(TOPICS)
    added = ("topic", "n_tokens", "weight", "probability", "sampled")
    kept = [c for c in docs.columns if c.lower() not in added]
    of = F.when(F.col(lang).isin(languages[:-1]), F.col(lang)).otherwise(OTHER)
    marked = docs.select(*[F.col(f"`{c}`") for c in kept], topic(F.col(text)).alias("topic"), tokens(F.col(text)).alias("n_tokens"), F.coalesce(F.col(source), F.lit("")).alias("__source"), of.alias("__lang"))
    narrow = marked.select("__source", "__lang", "topic", "n_tokens")
    pairs = [(a, b) for a in languages for b in topics]
    cells = narrow.groupBy("__source").agg(*[
        F.sum(F.when((F.col("__lang") == a) & (F.col("topic") == b), F.col("n_tokens")).otherwise(0)).cast("double").alias(f"w{i}")
        for i, (a, b) in enumerate(pairs)
    ]).select("__source", F.array(*[f"w{i}" for i in range(len(pairs))]).alias("w"))
    fitted = fit(stored(cells, "mix-cells"), languages, topics, source_power, language_targets, topic_targets, keep)
    pick = lambda c, factors: F.element_at(F.create_map(*[F.lit(x) for kv in factors.items() for x in kv]), c)
    salts = 64
    if fitted.n_sources <= BROADCAST_ROWS:
        joined = marked.join(F.broadcast(fitted.sources), "__source")
    else:  # more sources than may be broadcast: a shuffle in which a hot source is spread over salts
        spread = fitted.sources.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = marked.withColumn("__salt", F.pmod(F.xxhash64(key, text), F.lit(salts)).cast("int")).join(spread, ["__source", "__salt"])
    wanted = F.lit(fitted.scale) * F.col("__factor") * pick(F.col("__lang"), fitted.languages) * pick(F.col("topic"), fitted.topics)
    drawn = draw(key, text)
    return (
        joined.withColumn("__wanted", wanted).withColumn("probability", F.least(F.lit(1.0), F.col("__wanted")))
        .withColumn("weight", F.when(F.col("probability") > 0, F.col("__wanted") / F.col("probability")).otherwise(0.0))
        .withColumn("sampled", drawn < F.col("probability"))
        .select(*[F.col(f"`{c}`") for c in kept], *added)
    )


def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Calibrated probability, weight and draw of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    return mix(docs).select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled")


QUERIES = {"op4_source_mixing": op4_source_mixing}
SQL: dict[str, str] = {}
