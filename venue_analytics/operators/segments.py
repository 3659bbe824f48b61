"""Customer segmentation: encoding, K-Means with restarts, silhouettes and business labels."""

from __future__ import annotations

import logging
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import exact_avg, half_even

log = logging.getLogger(__name__)

# --- fixed values ---------------------------------------------------------------------------------
BEHAVIOURAL_FEATURES = [
    "games_attended_last_12_months", "avg_ticket_spend", "avg_concession_spend", "avg_merchandise_spend",
    "promotion_usage_rate", "email_engagement_score", "fan_value_score",
]
SEGMENTATION_FEATURES = [*BEHAVIOURAL_FEATURES, "distance_encoded", "loyalty_encoded"]
SEGMENT_LABELS = [
    "High-Value Loyalists", "Premium Experience Buyers", "Promo-Sensitive Fans", "Family Night Buyers",
    "Merchandise-Heavy Fans", "Casual Low-Frequency Fans",
]
BUSINESS_K = 6
SEED = 42
# --------------------------------------------------------------------------------------------------


def encode_features(df: DataFrame) -> DataFrame:
    """Distance and loyalty as ordinals; unknown values get the middle distance and casual loyalty."""
    return df.withColumns({
        "distance_encoded": rules.lookup("distance_from_arena_bucket", rules.DISTANCE_RANK, 3).cast("double"),
        "loyalty_encoded": rules.lookup("loyalty_status", rules.LOYALTY_RANK, 2).cast("double"),
    })


def scale_features(df: DataFrame, columns: list[str] = SEGMENTATION_FEATURES) -> DataFrame:
    """Add ``z_<column>``: nulls as zero, then mean zero and unit (population) deviation; constants stay zero."""
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    stats = df.agg(F.struct(*[
        f for c in columns for f in (F.avg(value[c]).alias(f"m_{c}"), F.stddev_pop(value[c]).alias(f"s_{c}"))
    ])).scalar()
    scaled = df.withColumn("_stats", stats)
    deviation = lambda c: F.when(F.col("_stats")[f"s_{c}"] == 0, 1.0).otherwise(F.col("_stats")[f"s_{c}"])
    return scaled.withColumns({f"z_{c}": (value[c] - F.col("_stats")[f"m_{c}"]) / deviation(c) for c in columns}).drop("_stats")


def _blocks(features: DataFrame) -> DataFrame:
    """The rows as binary blocks (a row-major matrix of doubles per Arrow batch), spread over at least one partition per core."""
    columns = features.columns

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
                yield pa.RecordBatch.from_pydict({"block": [np.ascontiguousarray(x, dtype=np.float64).tobytes()]})

    blocks = features.mapInArrow(pack, "block binary")
    cores = features.sparkSession.sparkContext.defaultParallelism
    return blocks.repartition(cores) if features.rdd.getNumPartitions() < cores else blocks


def _lloyd_step(blocks: DataFrame, width: int, centres: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """One pass over all rows for several fits at once: per fit its clusters' sums, row counts and the cost.

    A partition sends one record of (clusters x (width + 1)) + 1 numbers a fit, whatever its rows.
    """
    def step(batches):
        sums = [np.zeros((len(c), width + 1)) for c in centres]
        costs = np.zeros(len(centres))
        norms = [(c * c).sum(axis=1) for c in centres]
        for batch in batches:
            for block in batch.column("block"):
                every = np.frombuffer(block.as_buffer(), dtype=np.float64).reshape(-1, width)
                for at in range(0, len(every), 4096):  # a slice's distances stay in the processor's cache
                    x = every[at:at + 4096]
                    squares, ones = np.einsum("ij,ij->i", x, x), np.column_stack([x, np.ones(len(x))])
                    for i, c in enumerate(centres):
                        gaps = norms[i][:, None] - 2.0 * (c @ x.T)
                        best, place = gaps[0].copy(), np.zeros(len(x), dtype=np.int64)
                        for j in range(1, len(c)):  # the first centre wins a tie
                            place[gaps[j] < best] = j
                            np.minimum(best, gaps[j], out=best)
                        sums[i] += (place == np.arange(len(c))[:, None]).astype(np.float64) @ ones
                        costs[i] += np.maximum(best + squares, 0.0).sum()
        yield pa.RecordBatch.from_pydict({"sums": [np.concatenate([s.ravel() for s in sums] + [costs]).tobytes()]})

    parts = [np.frombuffer(r["sums"], dtype=np.float64) for r in blocks.mapInArrow(step, "sums binary").collect()]
    total, out, at = np.sum(parts, axis=0), [], 0
    for i, c in enumerate(centres):
        table = total[at:at + len(c) * (width + 1)].reshape(len(c), width + 1)
        at += table.size
        out.append((table[:, :width], table[:, width], float(total[i - len(centres)])))
    return out


def kmeans(
    features: DataFrame, ks: list[int], restarts: int, seed: int = SEED, max_iter: int = 300, tol: float = 1e-4, parallelism: int = 8
) -> dict[int, np.ndarray]:
    """Centres of the lowest-cost fit per k; every fit seeds (MLlib's k-means||) and iterates over all rows.

    Up to ``parallelism`` fits are seeded at a time over the same persisted vectors. Then all fits iterate
    together: one pass over the rows assigns them to the centres of every fit that has not settled, so the
    passes are as many as the slowest fit's iterations, not the sum over the fits. Rules are MLlib's: a fit
    settles when no centre moves farther than ``tol``, an empty cluster keeps its centre, the cost is the
    last pass's. A chosen fit that used all its iterations may not have settled; that is logged.
    """
    vectors = VectorAssembler(inputCols=features.columns, outputCol="features").transform(features).select("features").persist()
    vectors.count()  # stored before the fits start together

    def start(task: tuple[int, int]) -> np.ndarray:
        k, restart = task
        return np.array(KMeans(k=k, seed=seed + restart, maxIter=0, initMode="k-means||").fit(vectors).clusterCenters())

    tasks = [(k, r) for k in ks for r in range(restarts)]
    with ThreadPool(parallelism) as pool:
        centres = dict(zip(tasks, pool.map(start, tasks)))
    vectors.unpersist()
    blocks = _blocks(features).persist()
    costs, iterations, active = dict.fromkeys(tasks, float("inf")), dict.fromkeys(tasks, 0), list(tasks)
    for _ in range(max_iter):
        if not active:
            break
        moving = []
        for task, (sums, counts, cost) in zip(active, _lloyd_step(blocks, len(features.columns), [centres[x] for x in active])):
            old = centres[task]
            centres[task] = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1.0)[:, None], old)
            costs[task], iterations[task] = cost, iterations[task] + 1
            if (((centres[task] - old) ** 2).sum(axis=1) > tol * tol).any():
                moving.append(task)
        active = moving
    blocks.unpersist()
    best = {}
    for k in ks:
        chosen = min((task for task in tasks if task[0] == k), key=costs.get)
        best[k] = centres[chosen]
        if iterations[chosen] >= max_iter:
            log.warning("K-Means of %d clusters had not settled after %d iterations", k, max_iter)
    return best


def assign_clusters(df: DataFrame, centres: np.ndarray, columns: list[str] = SEGMENTATION_FEATURES) -> DataFrame:
    """Add ``cluster``: the nearest centre in scaled space, the first one on a tie."""
    def gap(c: np.ndarray) -> Column:
        return sum(((F.col(f"z_{name}") - F.lit(float(v))) * (F.col(f"z_{name}") - F.lit(float(v))) for name, v in zip(columns, c)), F.lit(0.0))

    gaps = df.withColumn("_gaps", F.array(*[gap(c) for c in centres]))
    return gaps.withColumn("cluster", (F.array_position("_gaps", F.array_min("_gaps")) - 1).cast("int")).drop("_gaps")


def centre_table(spark: SparkSession, centres: np.ndarray, columns: list[str] = SEGMENTATION_FEATURES) -> DataFrame:
    """cluster and one column per feature: the model as a small table."""
    rows = [(i, *map(float, c)) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, "cluster int, " + ", ".join(f"{c} double" for c in columns))


def _scaled_only(df: DataFrame, columns: list[str]) -> DataFrame:
    return scale_features(df, columns).select(*[f"z_{c}" for c in columns])


def silhouettes(df: DataFrame, columns: list[str] = SEGMENTATION_FEATURES, ks: range = range(3, 9), restarts: int = 10, seed: int = SEED) -> DataFrame:
    """k, silhouette, is_best: mean silhouette (squared Euclidean) of the best fit per k, over all rows."""
    scaled = _scaled_only(df, columns).persist()
    models = kmeans(scaled, list(ks), restarts, seed)
    judge = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
    vectors = VectorAssembler(inputCols=scaled.columns, outputCol="features")
    rows = [(k, float(judge.evaluate(vectors.transform(assign_clusters(scaled, centres, columns))))) for k, centres in models.items()]
    scaled.unpersist()
    out = df.sparkSession.createDataFrame(rows, "k int, silhouette double")
    return out.withColumn("is_best", F.col("silhouette") == F.max("silhouette").over(W.partitionBy()))


def cluster_profiles(df: DataFrame, columns: list[str] = SEGMENTATION_FEATURES) -> DataFrame:
    """Mean of every feature per cluster."""
    return df.groupBy("cluster").agg(*[_mean(df, c).alias(c) for c in columns])


def _mean(df: DataFrame, column: str) -> Column:
    """Exact mean for integer and decimal columns; whole-valued doubles are summed as integers too."""
    kind = dict(df.dtypes)[column]
    return exact_avg(F.col(column).cast("bigint") if kind == "double" and column.endswith("_encoded") else F.col(column))


def normalise_profiles(profiles: DataFrame) -> DataFrame:
    """Every feature scaled to 0..1 across clusters (one row per cluster)."""
    every = W.partitionBy()
    scaled = {c: (F.col(c) - F.min(c).over(every)) / (F.max(c).over(every) - F.min(c).over(every) + 1e-8) for c in profiles.columns if c != "cluster"}
    return profiles.select("cluster", *[x.alias(c) for c, x in scaled.items()])


def label_scores(normalised: DataFrame) -> DataFrame:
    """cluster, label_no, label, score: how well each cluster fits each business label."""
    fv, ga, le = F.col("fan_value_score"), F.col("games_attended_last_12_months"), F.col("loyalty_encoded")
    ts, cs, ms = F.col("avg_ticket_spend"), F.col("avg_concession_spend"), F.col("avg_merchandise_spend")
    pu = F.col("promotion_usage_rate")
    formulas = [
        fv * 2.0 + ga * 1.5 + le * 1.0, ts * 2.5 + fv * 1.0 - pu * 0.5, pu * 3.0, cs * 2.0 + ms * 0.5 - ts * 0.3,
        ms * 3.0, (F.lit(1.0) - fv) * 1.5 + (F.lit(1.0) - ga) * 1.5,
    ]
    rows = [F.struct(F.lit(i).alias("label_no"), F.lit(label).alias("label"), f.alias("score")) for i, (label, f) in enumerate(zip(SEGMENT_LABELS, formulas))]
    return normalised.select("cluster", F.inline(F.array(*rows)))


def assign_labels(scores: list[tuple[int, int, float]]) -> dict[int, str]:
    """One label per cluster: repeatedly the best remaining (cluster, label_no, score), ties to the first pair.

    Scores at or below -1 are never chosen; clusters left over take the unused labels in order.
    """
    clusters = sorted({c for c, _, _ in scores})
    usable = range(min(len(clusters), len(SEGMENT_LABELS)))
    ranked = sorted((s for s in scores if s[1] in usable and s[2] > -1.0), key=lambda s: (-s[2], s[0], s[1]))
    chosen: dict[int, str] = {}
    for cluster, number, _ in ranked:
        if cluster not in chosen and SEGMENT_LABELS[number] not in chosen.values():
            chosen[cluster] = SEGMENT_LABELS[number]
    spare = iter([label for label in SEGMENT_LABELS if label not in chosen.values()])
    return {c: chosen.get(c) or next(spare, f"Segment {c}") for c in clusters}


def assign_segment_labels(df: DataFrame) -> dict[int, str]:
    """Label of every cluster of a clustered frame (clusters times labels scores reach the driver)."""
    scores = label_scores(normalise_profiles(cluster_profiles(df)))
    return assign_labels([(r["cluster"], r["label_no"], r["score"]) for r in scores.collect()])


def segment_fans(fans: DataFrame, k: int = BUSINESS_K, restarts: int = 20, seed: int = SEED) -> DataFrame:
    """Profiles with encoded columns, cluster and fan_segment."""
    encoded = encode_features(fans)
    centres = kmeans(_scaled_only(encoded, SEGMENTATION_FEATURES), [k], restarts, seed)[k]
    clustered = assign_clusters(scale_features(encoded), centres).select(*encoded.columns, "cluster")
    labels = assign_segment_labels(clustered)
    return clustered.withColumn("fan_segment", rules.lookup("cluster", labels, None))


def segment_counts(segmented: DataFrame) -> DataFrame:
    """fan_segment, fans, share_pct."""
    total = segmented.agg(F.count("*")).scalar()
    out = segmented.groupBy("fan_segment").agg(F.count("*").alias("fans"))
    return out.withColumn("share_pct", F.col("fans").cast("double") / total.cast("double") * 100).orderBy(F.desc("fans"), "fan_segment")


def segment_profile(segmented: DataFrame) -> DataFrame:
    """Mean behaviour per segment, to cents."""
    return segmented.groupBy("fan_segment").agg(*[half_even(exact_avg(c), 2).alias(c) for c in BEHAVIOURAL_FEATURES])
