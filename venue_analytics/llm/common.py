"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def remainder_is(key: str, divisor: int, value: int) -> Column:
    """Whether crc32 of the key's text leaves this remainder; a null key never does."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(divisor)) == value, F.lit(False))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below spark.checkpoint.dir, the folder every executor of a cluster reaches.

    Only a local session that names none (a test) gets one from the machine; a cluster must set it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        import tempfile

        root = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write go as soon as it ends, so a chain of stored steps holds one step's.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def located(docs: DataFrame, *columns: Column) -> DataFrame:
    """The columns and each row's locator, file and row number in it; a frame that isn't a plain file scan is stored first."""
    where = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        return docs.select(*columns, *where)
    except AnalysisException:
        return stored(docs.select(*columns), "located").select("*", *where)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BROADCAST_ROWS = 100_000  # of narrow rows (a key, a locator or a few numbers): about 20 MB


def narrow(side: DataFrame) -> DataFrame:
    """A stored narrow side of a join with wide rows: broadcast if it has few rows; beyond, hashed after a shuffle."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side.hint("shuffle_hash")


ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Have the session hand rows to Python in small batches: texts are long rows, and both sides hold a whole batch."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(rows, str(min(ARROW_ROWS, int(spark.conf.get(rows)) if int(spark.conf.get(rows)) > 0 else ARROW_ROWS)))
    spark.conf.set(size, str(ARROW_BYTES))


def release() -> None:
    """Give memory that a Python worker has freed back to the machine; workers live on through later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def append(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]], inputs: list[Column | str], outputs: T.StructType) -> DataFrame:
    """df with the columns that ``work`` computes, batch by batch, from the input expressions.

    ``work`` gets the batches of the inputs and yields one list of arrays per batch, in the outputs'
    order and of the batch's length. An existing column of an output's name is replaced. An input given
    by the name of a column that stays is read from that column, so a long text crosses to Python once.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    bounded_batches(df.sparkSession)

    new = {f.name.lower() for f in outputs.fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    n = len(kept)
    at = {f.name: i for i, f in enumerate(kept)}
    extra: list[Column] = []
    chosen: list[int] = []
    for c in inputs:
        if isinstance(c, str) and c in at:
            chosen.append(at[c])
        else:
            chosen.append(n + len(extra))
            extra.append(F.col(f"`{c}`") if isinstance(c, str) else c)
    picked = df.select(*[F.col(f"`{f.name}`") for f in kept], *[c.alias(f"__in{i}") for i, c in enumerate(extra)])
    schema = T.StructType(kept + list(outputs.fields))
    arrow_outputs = to_arrow_schema(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def feed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                waiting.append(batch)
                yield batch.select(chosen)

        for arrays in work(feed()):
            batch = waiting.pop(0)
            names = batch.schema.names[:n] + arrow_outputs.names
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *[a.cast(f.type) for a, f in zip(arrays, arrow_outputs)]], names)
        release()

    return picked.mapInArrow(run, schema)


def small_batches(batches: Iterator[pa.RecordBatch], column: int = 0, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded bytes (a longer single row stays one batch)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes) or not sizes:
            yield batch.slice(start)
