"""From raw documents to sharded training data: five stages, each stored and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venue_analytics.llm import decontaminate, language, mixing, sharding, shingle_join
from venue_analytics.llm.common import remainder_is, stored, table

SURE = 0.5  # posterior below which a document's language counts as unknown
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _row(docs: DataFrame, *drop: str) -> F.Column:
    """The documents' own columns in one struct: stages compute into names of their own beside it."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in drop]).alias("__row")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with it in ``lang``; `und` (null, no letter) and unsure ones go.

    The model learns from the rows whose crc32(doc_id) mod 4 isn't 2. The decision takes effect twice:
    rejected rows go, and a kept row's ``lang`` becomes the predicted language, which mixing then
    targets. Every other column stays as it is, whatever its name (``score``, ``lang_pred`` ...).
    Null or empty texts are `und` and go; an empty table gives an empty table.
    """
    model = language.fit(docs, ~remainder_is("doc_id", 4, 2))
    base = docs.select(_row(docs, "text"), F.col("text").alias("__text"))  # each text crosses to Python once
    known = language.predict(base, model, text="__text").where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= SURE))
    out = known.select("__row.*", F.col("__text").alias("text"), F.col("lang_pred").alias("__lang"))
    return out.withColumn("lang", F.col("__lang")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component under links of 5-word shingles at 80 %: the one of least doc_id."""
    return shingle_join.drop_near_copies(docs, NEAR_WORDS, NEAR_PERCENT)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its error budget."""
    return decontaminate.flag(docs, table(spark, sf_dir, "benchmark"), column="__hits").where(F.size("__hits") == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that their expected tokens meet the target mix exactly.

    Raking gives each row a wanted probability c * factor at keep rate ``mixing.KEEP``; where that
    passes 1 somewhere, all are scaled down by the largest, so no probability is clipped and the
    expected mix is the target's (fewer rows are kept instead). Rows are drawn by the operator's own
    hash of doc_id and text: equal rows alike, reruns the same. The documents' columns stay as they
    are, whatever their names (``topic``, ``weight``, ``sampled`` ...); an empty table stays empty.
    """
    base = docs.select(
        _row(docs, "text"), F.col("doc_id").alias("__key"), F.col("text").alias("__text"),
        F.col("source").alias("__source_name"), F.col("lang").alias("__lang_name"),
    )
    mixed = mixing.mix(base, text="__text", source="__source_name", lang="__lang_name", key="__key")
    wanted = F.col("probability") * F.col("weight")
    largest = mixed.agg(F.max(wanted)).head()[0] or 0.0
    share = wanted / F.lit(max(float(largest), 1.0))
    drawn = mixed.where(mixing.draw("__key", "__text") < share)
    return drawn.select("__row.*", F.col("__text").alias("text")).select(*docs.columns)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn documents with their slot and shard."""
    return sharding.place(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("source_mixing", mix_sources),
    ("sharding", place_in_shards),
]

#: The fitted language model and the raking can't be written in SQL; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}
