"""Time-split regression forecasts of attendance and revenue with MLlib pipelines."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import half_even, safe_div
from .features import ATTENDANCE_FEATURES, ATTENDANCE_TARGET, REVENUE_PREGAME_FEATURES, REVENUE_TARGET
from .trees import Boosting, Forest

SEED = 42
METRICS_SCHEMA = "model string, mae double, rmse double, r2 double, mape double"


@dataclass(frozen=True)
class Task:
    """What to forecast, from which features, with which forest depth."""

    name: str
    features: list[str]
    target: str
    forest_depth: int


ATTENDANCE = Task("attendance", ATTENDANCE_FEATURES, ATTENDANCE_TARGET, 12)
REVENUE = Task("revenue", REVENUE_PREGAME_FEATURES, REVENUE_TARGET, 14)


def split_by_season(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Earlier seasons for training, the last season for testing."""
    last = df.agg(F.max("season")).scalar()
    return df.where(F.col("season") < last), df.where(F.col("season") == last)


def build_preprocessor(df: DataFrame, features: list[str]) -> list:
    """Stages that standardise numbers and one-hot encode strings; an unseen category encodes as all zeros."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    text = [c for c in features if isinstance(kinds[c], T.StringType)]
    numbers = [c for c in features if c not in text]
    stages: list = [
        VectorAssembler(inputCols=numbers, outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
    ]
    for c in text:
        # The indexer's extra slot for unseen values comes last and is the one the encoder drops.
        stages.append(StringIndexer(inputCol=c, outputCol=f"_{c}_index", handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCol=f"_{c}_index", outputCol=f"_{c}_hot", dropLast=True))
    stages.append(VectorAssembler(inputCols=["_scaled", *[f"_{c}_hot" for c in text]], outputCol="features"))
    return stages


def estimators(task: Task) -> dict[str, Estimator]:
    """The candidate models, in the order that decides ties."""
    common = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}
    return {
        "LinearRegression": LinearRegression(regParam=0.0, **common),
        "RandomForest": Forest(
            numTrees=200, maxDepth=task.forest_depth, featureSubsetStrategy="all", seed=SEED,
            cacheNodeIds=True, **common),
        "GradientBoosting": Boosting(maxIter=200, stepSize=0.05, maxDepth=5, seed=SEED, **common),
    }


def evaluate(df: DataFrame, actual: str | Column, predicted: str | Column, model: str) -> DataFrame:
    """model, mae, rmse, r2, mape in one aggregation; MAPE skips rows whose actual is zero."""
    y = (F.col(actual) if isinstance(actual, str) else actual).cast("double")
    p = (F.col(predicted) if isinstance(predicted, str) else predicted).cast("double")
    err = p - y
    return df.agg(
        F.lit(model).alias("model"), F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.lit(1.0) - F.sum(err * err) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))).alias("r2"),
        (F.avg(F.abs(safe_div(y - p, y))) * 100).alias("mape"),
    )


def mape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row with the mean absolute percentage error over rows whose actual is not zero."""
    return evaluate(df, actual, predicted, "").select("mape")


@dataclass
class Forecast:
    """Fitted candidates of a task, their test metrics, and the best by R2 (the first on a tie)."""

    task: Task
    test: DataFrame
    models: dict[str, PipelineModel]
    metrics: DataFrame
    best: str
    preprocessor: PipelineModel
    _cached: list[DataFrame] = field(default_factory=list)

    @property
    def best_model(self) -> PipelineModel:
        """Preprocessing and the best regressor as one pipeline."""
        return PipelineModel(stages=[*self.preprocessor.stages, *self.models[self.best].stages])

    def predictions(self) -> DataFrame:
        """The task's prediction table for the test season."""
        scored = self.models[self.best].transform(self.test)
        return attendance_predictions(scored) if self.task.name == "attendance" else revenue_predictions(scored)

    def importances(self, top: int = 15) -> DataFrame:
        """feature, importance: the best model's strongest features; empty for a linear model."""
        return feature_importances(self.test.sparkSession, self.models[self.best], self.preprocessor, top)

    def release(self) -> None:
        for df in self._cached:
            df.unpersist()


def prepare(df: DataFrame, task: Task, stored: bool = False) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Preprocessor fitted on the training seasons, and both transformed halves.

    The halves are the input of every candidate's many passes, so they are persisted, spilling to disk; so is
    ``df`` while the halves are made, unless it is ``stored``, where a pass reads just the columns it needs.
    """
    if not stored:
        df = df.persist()
    train, test = split_by_season(df.withColumn("label", F.col(task.target).cast("double")))
    fitted = Pipeline(stages=build_preprocessor(df, task.features)).fit(train)
    keep = ["game_id", "season", task.target, "label", "features"]
    halves = [fitted.transform(half).select(*keep).persist() for half in (train, test)]
    for half in halves:
        half.count()
    if not stored:
        df.unpersist()
    return fitted, *halves


def train(df: DataFrame, task: Task, candidates: dict[str, Estimator] | None = None) -> Forecast:
    """Fit every candidate on the earlier seasons and score it on the last one."""
    fitted, fit_df, test = prepare(df, task)
    models, rows = {}, []
    for name, estimator in (candidates or estimators(task)).items():
        models[name] = Pipeline(stages=[estimator]).fit(fit_df)
        rows.append(evaluate(models[name].transform(test), "label", "prediction", name).first())
    # A handful of metric rows, one per candidate.
    best = max(rows, key=lambda r: r["r2"])["model"]
    metrics = df.sparkSession.createDataFrame(rows, METRICS_SCHEMA)
    return Forecast(task, test, models, metrics, best, fitted, [fit_df, test])


def attendance_predictions(scored: DataFrame) -> DataFrame:
    """Predictions cut to whole people, and predicted minus actual."""
    predicted = F.col("prediction").cast("int")
    return scored.select(
        "game_id", predicted.alias("predicted_attendance"), F.col(ATTENDANCE_TARGET),
        (predicted - F.col(ATTENDANCE_TARGET)).alias("attendance_prediction_error"))


def revenue_predictions(scored: DataFrame) -> DataFrame:
    """Predictions rounded to cents, and predicted minus actual."""
    predicted = half_even("prediction", 2)
    return scored.select(
        "game_id", F.col(REVENUE_TARGET), predicted.alias("predicted_total_revenue"),
        (predicted - F.col(REVENUE_TARGET)).alias("revenue_prediction_error"))


def feature_names(preprocessor: PipelineModel) -> list[str]:
    """Names of the assembled vector's slots: the numeric columns, then one per known category."""
    stages = preprocessor.stages
    names = list(stages[0].getInputCols())
    for stage in stages:
        if isinstance(stage, StringIndexerModel):
            names += [f"{stage.getInputCol()}_{label}" for label in stage.labels]
    return names


def feature_importances(spark: SparkSession, model: PipelineModel, preprocessor: PipelineModel, top: int = 15) -> DataFrame:
    """feature, importance of a tree model, strongest first; no rows for a linear model."""
    regressor = model.stages[-1]
    schema = "feature string, importance double"
    if not hasattr(regressor, "featureImportances"):
        return spark.createDataFrame([], schema)
    # One value per feature slot.
    pairs = zip(feature_names(preprocessor), regressor.featureImportances.toArray().tolist())
    return spark.createDataFrame(list(pairs), schema).orderBy(F.desc("importance"), "feature").limit(top)


# ---- persistence ---------------------------------------------------------------------------------
METADATA_SCHEMA = "key string, value string"


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_metadata(spark: SparkSession, path: str, entries: dict[str, str]) -> None:
    """Merge entries into the metadata table at path; other keys keep their values.

    Every save appends a numbered batch and readers take the newest value per key, so nothing is rewritten.
    """
    version = F.unix_micros(F.current_timestamp())
    spark.createDataFrame(list(entries.items()), METADATA_SCHEMA).coalesce(1).withColumn("version", version).write.mode("append").parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """key, value: the newest value of every key."""
    df = spark.read.schema(METADATA_SCHEMA + ", version bigint").parquet(path)
    return df.groupBy("key").agg(F.max_by("value", "version").alias("value"))
