"""All registered queries by name, and the output types the correctness check expects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import workspace
from . import ancillary, attendance, executive, fans, insights, modelling, preparation, promotions, scenario, tickets, views

MODULES = [attendance, tickets, promotions, ancillary, fans, executive, views, preparation, insights, scenario, modelling]


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles and small integers as longs, so results compare across engines."""
    def cast(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def _runner(build: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(build(workspace(spark, folder)))

    run.__doc__ = build.__doc__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for module in MODULES:
        for name, build in module.QUERIES.items():
            out[name] = _runner(build)
    return out
