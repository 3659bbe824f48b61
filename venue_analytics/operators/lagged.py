"""Means over a group's previous rows, for groups of any size.

A plain window would send a whole group to one task. Here every row gets its exact place in its group
(``positions``: range partitioning, counts per partition summed in order), the places are cut into
slices of ``max_rows`` rows, and each slice is one task's window. The ``depth`` rows before a slice are
copied into it as its halo, chosen by place too, so neither a crowded date nor a far outlier id can
make a slice larger than ``max_rows + depth`` rows. Results equal the unsliced window exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from .positions import positions


def with_slices(df: DataFrame, key: str, date: str, row_id: str, max_rows: int, depth: int = 0) -> DataFrame:
    """Rows with ``_pos`` (place in the key by date, row_id), ``_slice`` and ``_halo``.

    Every row appears once in its own slice (``_halo`` false) and once more in each later slice whose
    first ``depth`` predecessors it belongs to (``_halo`` true): at most ceil(depth / max_rows) copies.
    """
    placed = positions(df, key, [date, row_id])
    own, last = F.floor(F.col("_pos") / max_rows), F.floor((F.col("_pos") + depth) / max_rows)
    sliced = placed.select("*", F.explode(F.sequence(own, last)).alias("_slice"))
    return sliced.withColumn("_halo", F.col("_slice") != own)


def _exact_type(dtype: T.DataType) -> T.DataType:
    return T.DecimalType(38, dtype.scale) if isinstance(dtype, T.DecimalType) else T.LongType()


def _mean_before(value: str, n: int, dtype: T.DataType, order: WindowSpec) -> Column:
    """Mean of a column over the n rows before this one, nulls skipped; null when nothing is left."""
    last = order.rowsBetween(-n, -1)
    total = F.sum(F.col(value).cast(_exact_type(dtype))).over(last)
    return total.cast("double") / F.nullif(F.count(value).over(last).cast("double"), F.lit(0.0))


def lagged_means(
    df: DataFrame, key: str, date: str, row_id: str, outputs: dict[str, tuple[str, int]], max_rows: int = 1_000_000,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add, per output name, the mean of a column over the n rows of the same key before this one.

    Rows are ordered by (date, row_id). Missing values inside the n rows are skipped, and fewer than n
    previous rows are enough; a first row gets null. All outputs share one sort. Value columns must be
    integer or decimal, so the means do not depend on summation order. ``counted`` is no longer needed
    (places are counted exactly on ``df``) and is accepted for callers that pass it.
    """
    depth = max(n for _, n in outputs.values())
    types = {f.name: f.dataType for f in df.schema.fields}
    sliced = with_slices(df, key, date, row_id, max_rows, depth)
    order = W.partitionBy(key, "_slice").orderBy("_pos")
    means = {name: _mean_before(value, n, types[value], order) for name, (value, n) in outputs.items()}
    return sliced.withColumns(means).where(~F.col("_halo")).select(*df.columns, *outputs)
