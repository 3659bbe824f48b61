"""Exact places of rows within a key, for keys of any size.

A window over a key sends the whole key to one task. Here the rows are range-partitioned on the key
and the sort order, so a crowded key, a crowded date or a far outlier id is spread over as many
partitions as its rows fill, in order. Each partition is sorted and numbered where it lies; a small
frame, one row per (partition, key), holds how many rows (or distinct values) of the key each
partition has, and its running sum over the partitions gives every row its global place. No task ever
sees more than one partition's rows, whatever the shape of the key.

The numbered rows are written once, as Parquet, to the folder that spark.checkpoint.dir names: the counts
and the rows must come from one partitioning, which a second run of the range exchange needn't reproduce,
and the copy survives lost executors. Later passes read only the columns they name. The small frame has at
most partitions + keys rows; it is written too, so its size is known and Spark's size check broadcasts it
before the rows would be shuffled to join it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder (spark.checkpoint.dir; a local session naming none gets a temporary one,
    a cluster must name a shared one)."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not root:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            import tempfile

            root = tempfile.mkdtemp(prefix="positions-")
        context.setCheckpointDir(root)
    return context.getCheckpointDir()


def _checkpointed(df: DataFrame) -> DataFrame:
    """df written once to the session's checkpoint folder and read from there."""
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _written(df: DataFrame) -> DataFrame:
    """df written once, as Parquet, to the session's checkpoint folder and read from there."""
    spark = df.sparkSession
    path = f"{_checkpoint_folder(spark).rstrip('/')}/positions-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _parts(df: DataFrame, parts: int | None) -> int:
    return parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _order_columns(order: list[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def positions(df: DataFrame, key: str, order: list[Column | str], name: str = "_pos", parts: int | None = None) -> DataFrame:
    """df with ``name`` (long): the row's place, from 0, among its key's rows in ``order``.

    Rows equal in key and order get consecutive places in some order. A null key is a key of its own.
    """
    keyed = [F.col(key), *_order_columns(order)]
    numbered = _written(
        df.repartitionByRange(_parts(df, parts), *keyed)
        .sortWithinPartitions(*keyed)
        .withColumn("_part", F.spark_partition_id())
        # Counts up by one a row in this partition's sorted order (the partition index sits in the high bits).
        .withColumn("_local", F.monotonically_increasing_id())
        # Written once to the session's checkpoint folder: counts and rows must see the same partitions,
        # and two runs of a range exchange needn't cut alike.
    )
    counts = numbered.groupBy("_part", key).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    earlier = F.sum("_n").over(W.partitionBy(key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = _written(counts.select(F.col("_part").alias("_at"), F.col(key).alias("_key"), "_first", F.coalesce(earlier, F.lit(0)).alias("_before")))
    placed = numbered.join(offsets, (F.col("_part") == F.col("_at")) & F.col(key).eqNullSafe(F.col("_key")))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_local") - F.col("_first")).alias(name))


def dense_numbers(df: DataFrame, key: str, order: Column, value: str, name: str, parts: int | None = None) -> DataFrame:
    """df with ``name`` (int): DENSE_RANK() OVER (PARTITION BY key ORDER BY order), ``order`` a sort order of ``value``.

    Equal (key, value) rows always land in one range partition, so the distinct values of a key in a
    partition add up exactly across partitions. A partition's own ranks come from a window over
    (partition, key), which holds at most one partition's rows.
    """
    numbered = df.repartitionByRange(_parts(df, parts), F.col(key), order).withColumn("_part", F.spark_partition_id())
    local = _checkpointed(numbered.withColumn("_local", F.dense_rank().over(W.partitionBy("_part", key).orderBy(order))))
    counts = local.groupBy("_part", key).agg(F.max("_local").alias("_values"))
    earlier = F.sum("_values").over(W.partitionBy(key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(F.col("_part").alias("_at"), F.col(key).alias("_key"), F.coalesce(earlier, F.lit(0)).alias("_above"))
    joined = local.join(offsets, (F.col("_part") == F.col("_at")) & F.col(key).eqNullSafe(F.col("_key")))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_above") + F.col("_local")).cast("int").alias(name))
