"""Exact deduplication as a stateful stream.

Pass one writes a narrow log: digest of the normalised text, code points of the original, identifier and
content locator (file and row). The log is streamed into keyed state on disk (RocksDB, checkpointed to
the shared folder, never expired) that holds one entry a digest: the row that stays and the group's
size. New files of a later run can be streamed into the same state. Rows whose digest was seen more than
once, and only those, are then compared by full bytes; a digest shared by different texts is regrouped
by the bytes themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import located, narrow, shared_folder, stored

SPACES = " \t\n\x0b\x0c\r"
FILES_PER_BATCH = 32
STATE_PARTITIONS = 24  # each a store of its own with files of its own; fixed for the life of the state, so set it for the size expected
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normal(text: Column) -> Column:
    """The text without ASCII white space; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha256(normalised: Column) -> Column:
    return F.sha2(normalised, 256)


def locate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, file, at): the rows with their locators, taken once; a frame that is no file scan is stored here."""
    return located(docs, F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def write_log(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The narrow log of a table located by ``locate``, appended to ``path``."""
    if not {"file", "at"} <= set(docs.columns):
        docs = locate(docs, key, text)
        key, text = "doc_id", "text"
    log = docs.select(F.col(key).alias("doc_id"), digest(normal(F.col(text))).alias("digest"), F.length(F.coalesce(text, F.lit(""))).cast("long").alias("points"), "file", "at")
    log.write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(log.schema).parquet(path)


def stream_log(spark: SparkSession, log: DataFrame, path: str, checkpoint: str, files_per_batch: int = FILES_PER_BATCH, state_partitions: int = STATE_PARTITIONS) -> DataFrame:
    """Run the log's new files through the state at ``checkpoint``; the state as (digest, keep, group_size).

    ``keep`` orders by most code points, then smallest doc_id (null last), then locator.
    """
    session = spark.newSession()  # the store is set for this stream alone
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    session.conf.set("spark.sql.streaming.internal.stateStore.partitions", str(state_partitions))
    rank = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "at")
    entries = (
        session.readStream.schema(log.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        .groupBy("digest").agg(F.min(rank).alias("keep"), F.count("*").alias("group_size"))
    )
    query = entries.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    state = spark.read.format("statestore").load(checkpoint)
    keep, size = state.schema["value"].dataType.names
    return state.select("key.digest", F.col(f"value.{keep}").alias("keep"), F.col(f"value.{size}").alias("group_size"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept and the digest of every row of a Parquet table.

    Texts are equal when they are the same bytes without ASCII white space; null is empty. Of equal
    texts the row with most code points, then smallest doc_id stays (a null id comes last); among rows
    with one id and equal texts, the first by file and row. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = shared_folder(spark, "dedup-log")
    docs = locate(docs, key, text)  # once: log and byte check must name the same rows
    log = write_log(docs, path, "doc_id", "text", digest)
    if log.isEmpty():
        empty = log.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
        return empty
    state = stored(stream_log(spark, log, path, shared_folder(spark, "dedup-state")), "dedup-entries")
    seen_again = stored(log.join(state.where("group_size > 1").select("digest"), "digest", "left_semi").select("file", "at", "digest"), "dedup-hits")
    texts = docs.select(normal(F.col("text")).alias("normal"), "file", "at").join(narrow(seen_again), ["file", "at"])
    clash = stored(texts.groupBy("digest").agg(F.min("normal").alias("a"), F.max("normal").alias("b")).where("a <> b").select("digest"), "dedup-clashes")
    joined = log.join(state, "digest")
    if not clash.isEmpty():
        joined = joined.join(clash, "digest", "left_anti").unionByName(_by_bytes(docs, log, texts, clash))
    return joined.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        ((F.col("file") == F.col("keep.file")) & (F.col("at") == F.col("keep.at"))).alias("kept"), "digest",
    )


def _by_bytes(docs: DataFrame, log: DataFrame, texts: DataFrame, clash: DataFrame) -> DataFrame:
    """The rows of clashing digests, grouped by digest and full bytes."""
    rows = stored(texts.join(clash, "digest", "left_semi").join(log.select("file", "at", "doc_id", "points"), ["file", "at"]), "dedup-clashing-rows")
    rank = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "at")
    groups = rows.groupBy("digest", "normal").agg(F.min(rank).alias("keep"), F.count("*").alias("group_size"))
    return rows.join(groups, ["digest", "normal"]).select("digest", "doc_id", "points", "file", "at", "keep", "group_size")


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one of its equals that stays."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return deduplicate(docs).withColumnRenamed("digest", "text_sha256")


QUERIES = {"op7_exact_dedup": op7_exact_dedup}
SQL = {
    "op7_exact_dedup": r"""
        WITH normal AS (SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
        ranked AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, row_number() OVER w AS place
                   FROM normal WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, text_sha256 FROM ranked"""
}
