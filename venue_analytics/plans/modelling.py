"""Registered jobs of forecasting and segmentation."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..operators import forecast as fc
from ..operators import segments as sg
from ..operators.features import attendance_features, build_features, revenue_features
from ..sources.tables import shared_root
from . import insights


def _once(t, key: str, build: Callable):
    """Keep a fitted result with its tables, so the jobs that read it do not train again."""
    store = t.__dict__.setdefault("_fitted", {})
    if key not in store:
        store[key] = build()
    return store[key]


def prepared(t, task: fc.Task):
    """Preprocessor and the two persisted halves of a task's data."""
    select = attendance_features if task is fc.ATTENDANCE else revenue_features
    stored = lambda: t.keep(f"features_{task.name}", lambda: select(build_features(t)))
    return _once(t, f"data/{task.name}", lambda: fc.prepare(stored(), task, t.stores))


def candidate(t, task: fc.Task, name: str):
    """A fitted candidate model of a task."""
    _, train, _ = prepared(t, task)
    return _once(t, f"model/{task.name}/{name}", lambda: fc.Pipeline(stages=[fc.estimators(task)[name]]).fit(train))


def model_metrics(task: fc.Task, name: str, t) -> DataFrame:
    """MAE, RMSE, R2 and MAPE of one candidate on the last season."""
    _, _, test = prepared(t, task)
    return fc.evaluate(candidate(t, task, name).transform(test), "label", "prediction", name)


def model_importances(task: fc.Task, name: str, t) -> DataFrame:
    """The fifteen strongest features of one candidate."""
    preprocessor, _, _ = prepared(t, task)
    return fc.feature_importances(t["games"].sparkSession, candidate(t, task, name), preprocessor)


def model_predictions(task: fc.Task, name: str, t) -> DataFrame:
    """Test-season predictions of one candidate."""
    _, _, test = prepared(t, task)
    scored = candidate(t, task, name).transform(test)
    return fc.attendance_predictions(scored) if task is fc.ATTENDANCE else fc.revenue_predictions(scored)


def candidate_metrics(t, task: fc.Task) -> list:
    """Every candidate's row of metrics, in ``fc.estimators``' order; kept, so that nothing predicts twice."""
    return _once(t, f"metrics/{task.name}", lambda: [model_metrics(task, name, t).first() for name in fc.estimators(task)])


def chosen_name(t, task: fc.Task) -> str:
    """The candidate of the largest R2 on the last season; ties (and a missing R2, counted lowest) go to
    the earlier candidate in ``fc.estimators``' order. Metrics are one row a candidate."""
    rows = candidate_metrics(t, task)
    score = lambda r: r["r2"] if r["r2"] is not None else float("-inf")
    top = max(score(r) for r in rows)
    return next(r["model"] for r in rows if score(r) == top)


def chosen_metrics(task: fc.Task, t) -> DataFrame:
    """Every candidate's metrics on the last season, and ``chosen``: the one whose predictions are used."""
    best = chosen_name(t, task)
    table = t["games"].sparkSession.createDataFrame(candidate_metrics(t, task), fc.METRICS_SCHEMA)
    return table.withColumn("chosen", F.col("model") == F.lit(best))


def model_round_trip(t, name: str = "LinearRegression") -> DataFrame:
    """S14: a fitted attendance pipeline (preprocessing and regressor) and its metadata, written to the shared
    folder, read back through another session and compared: one row of the model, the test rows scored,
    how many predictions differ, and how many metadata entries read back equal."""
    task = fc.ATTENDANCE
    spark = t["games"].sparkSession
    preprocessor, _, _ = prepared(t, task)
    fitted = fc.PipelineModel(stages=[*preprocessor.stages, *candidate(t, task, name).stages])
    path = f"{shared_root(spark)}/models/{task.name}-{uuid.uuid4().hex}"
    entries = {"task": task.name, "model": name, "target": task.target, "features": ",".join(task.features)}
    fc.save_model(fitted, f"{path}/model")
    fc.save_metadata(spark, f"{path}/metadata", entries)
    other = spark.newSession()
    loaded = fc.load_model(f"{path}/model")
    read = {r["key"]: r["value"] for r in fc.read_metadata(other, f"{path}/metadata").collect()}
    _, test = fc.split_by_season(t.keep(f"features_{task.name}", lambda: attendance_features(build_features(t))))
    test = test.withColumn("label", F.col(task.target).cast("double"))
    a = fitted.transform(test).select("game_id", F.col("prediction").alias("a"))
    b = loaded.transform(test).select("game_id", F.col("prediction").alias("b"))
    compared = a.join(b, "game_id", "full")
    return compared.agg(
        F.lit(name).alias("model"),
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(~F.col("a").eqNullSafe(F.col("b")), 1)).alias("differing"),
        F.lit(sum(read.get(k) == v for k, v in entries.items())).cast("long").alias("metadata_equal"),
    )


def season_split(t) -> DataFrame:
    """Rows and season range of the two halves."""
    train, test = fc.split_by_season(t["games"])
    part = lambda df, name: df.agg(
        F.lit(name).alias("part"), F.count("*").alias("rows"), F.min("season").alias("first_season"), F.max("season").alias("last_season"))
    return part(train, "train").unionByName(part(test, "test"))


def baseline_metrics(t) -> DataFrame:
    """The metric functions applied to the stored baseline forecast of the last season."""
    _, test = fc.split_by_season(t["games"].join(t["attendance"], "game_id"))
    out = fc.evaluate(test, "actual_attendance", "expected_attendance_baseline", "StoredBaseline")
    return out.select("model", *[half_up(c, 6).alias(c) for c in ("mae", "rmse", "r2", "mape")])


def encoded_fans(t) -> DataFrame:
    return sg.encode_features(t["fan_profiles"]).select("fan_id", "distance_encoded", "loyalty_encoded")


def _distance_clusters(t) -> DataFrame:
    """Profiles grouped by distance band instead of K-Means, for checking the profile arithmetic."""
    df = sg.encode_features(t["fan_profiles"])
    return df.withColumn("cluster", F.col("distance_encoded").cast("int") - 1)


def profile_scores(t) -> DataFrame:
    """Label scores of the distance bands."""
    return sg.label_scores(sg.normalise_profiles(sg.cluster_profiles(_distance_clusters(t))))


def band_labels(t) -> DataFrame:
    """M18 over the distance bands' scores: cluster, label by repeated best remaining (cluster, label) pair.

    The score table has clusters x six rows, so it is collected; the greedy choice is ``assign_labels``.
    """
    scores = profile_scores(t).collect()
    labels = sg.assign_labels([(r["cluster"], r["label_no"], r["score"]) for r in scores])
    return t["games"].sparkSession.createDataFrame(sorted(labels.items()), "cluster bigint, fan_segment string")


def banded_fans(t) -> DataFrame:
    """Fan profiles with ``fan_segment`` from a fixed clustering: the distance band, labelled by M18.

    A deterministic stand-in for the K-Means segments, so the segment dashboards can be checked against
    statements; the label table has one row a band and is broadcast.
    """
    fans = t["fan_profiles"]
    bands = _distance_clusters(t).select("fan_id", F.col("cluster").cast("bigint").alias("cluster"))
    return fans.join(bands, "fan_id").join(F.broadcast(band_labels(t)), "cluster").select(*fans.columns, "fan_segment")


def scaled_fans(t) -> DataFrame:
    """Standardised segmentation features, to six decimals."""
    df = sg.scale_features(sg.encode_features(t["fan_profiles"]))
    return df.select("fan_id", *[half_up(f"z_{c}", 6).alias(f"z_{c}") for c in sg.SEGMENTATION_FEATURES])


def segmented_fans(t) -> DataFrame:
    """Profiles with cluster and business segment."""
    return _once(t, "segments", lambda: sg.segment_fans(t["fan_profiles"]))


QUERIES = {
    "m1_season_split": season_split,
    "m7_baseline_metrics": baseline_metrics,
    "m3_attendance_linear": partial(model_metrics, fc.ATTENDANCE, "LinearRegression"),
    "m3_revenue_linear": partial(model_metrics, fc.REVENUE, "LinearRegression"),
    "m11_attendance_predictions": partial(model_predictions, fc.ATTENDANCE, "LinearRegression"),
    "m11_revenue_predictions": partial(model_predictions, fc.REVENUE, "LinearRegression"),
    "m12_encoded_fans": encoded_fans,
    "m13_scaled_fans": scaled_fans,
    "m14_silhouettes": lambda t: sg.silhouettes(sg.encode_features(t["fan_profiles"])),
    "m14_silhouettes_behavioural": lambda t: sg.silhouettes(t["fan_profiles"], sg.BEHAVIOURAL_FEATURES),
    "m15_segmented_fans": segmented_fans,
    "m17_profile_scores": profile_scores,
    "m18_band_labels": band_labels,
    "d18_segment_kpis_segmented": lambda t: insights.segment_kpis(t, banded_fans(t)),
    "d19_segment_summary_segmented": lambda t: insights.segment_summary(t, banded_fans(t)),
    "d19_segment_spend_long_segmented": lambda t: insights.segment_spend_long(t, banded_fans(t)),
    "n5_normalised_profile_segmented": lambda t: insights.normalised_profile(t, banded_fans(t)),
    "m19_segment_counts": lambda t: sg.segment_counts(segmented_fans(t)),
    "m19_segment_profile": lambda t: sg.segment_profile(segmented_fans(t)),
    "m4_attendance_forest": partial(model_metrics, fc.ATTENDANCE, "RandomForest"),
    "m5_attendance_boosting": partial(model_metrics, fc.ATTENDANCE, "GradientBoosting"),
    "m4_revenue_forest": partial(model_metrics, fc.REVENUE, "RandomForest"),
    "m5_revenue_boosting": partial(model_metrics, fc.REVENUE, "GradientBoosting"),
    "m10_revenue_importances": partial(model_importances, fc.REVENUE, "GradientBoosting"),
    "m10_attendance_importances": partial(model_importances, fc.ATTENDANCE, "GradientBoosting"),
    "s14_model_round_trip": model_round_trip,
    # The chosen model (largest R2 on the last season) and what follows from it.
    "m9_chosen_attendance": partial(chosen_metrics, fc.ATTENDANCE),
    "m9_chosen_revenue": partial(chosen_metrics, fc.REVENUE),
    "m10_attendance_importances_chosen": lambda t: model_importances(fc.ATTENDANCE, chosen_name(t, fc.ATTENDANCE), t),
    "m10_revenue_importances_chosen": lambda t: model_importances(fc.REVENUE, chosen_name(t, fc.REVENUE), t),
    "m11_attendance_predictions_chosen": lambda t: model_predictions(fc.ATTENDANCE, chosen_name(t, fc.ATTENDANCE), t),
    "m11_revenue_predictions_chosen": lambda t: model_predictions(fc.REVENUE, chosen_name(t, fc.REVENUE), t),
}
