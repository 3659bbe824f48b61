"""Sharding by a permutation-filled lookup table.

Each shard has its own preference order over the slots of a prime-sized table, (offset + j * skip) mod
size. The shards take turns, each claiming its next free slot, until the table is full: every shard
gets its share to within one slot, and a change of the shard list moves few slots besides those of the
shard that came or went. The table has a fixed number of rows, so it is broadcast; placing a document
is one hash and one look-up, without a shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SHARDS = 32
SLOTS = 4099  # a prime, more than a hundred slots for each shard


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(names: list[str], size: int = SLOTS) -> list[int]:
    """slot -> index of the shard that holds it. size must be a prime of at least the number of shards."""
    if not names or len(set(names)) != len(names) or len(names) > size:
        raise ValueError("shard names must be distinct, at least one and at most as many as slots")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table's size must be a prime")
    place = [_number(f"offset:{n}") % size for n in names]
    skip = [_number(f"skip:{n}") % (size - 1) + 1 for n in names]
    owner = [-1] * size
    free = size
    while free:
        for shard in range(len(names)):
            if not free:
                break
            while owner[place[shard]] >= 0:
                place[shard] = (place[shard] + skip[shard]) % size
            owner[place[shard]] = shard
            free -= 1
    return owner


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def place(df: DataFrame, key: str = "doc_id", names: list[str] | None = None, size: int = SLOTS) -> DataFrame:
    """df with ``slot`` and ``shard`` (both long) by the key's text.

    A null key counts as the empty text; equal keys share a shard; an empty frame stays empty. Columns
    named slot or shard are replaced. Nothing is shuffled; the broadcast table has ``size`` rows.
    """
    names = names or shard_names(SHARDS)
    owners = df.sparkSession.createDataFrame(list(enumerate(fill(names, size))), "slot long, shard long")
    digest = F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    slot = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]
    return df.select(*kept, slot.alias("slot")).join(F.broadcast(owners), "slot").select(*kept, "slot", "shard")


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Place the rows and write one folder a shard. Rows aren't shuffled: each task adds a file to each shard."""
    place(df, **options).write.partitionBy("shard").parquet(path)


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's slot and shard, with its bytes (null text: 0)."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return place(docs)


def _sql() -> str:
    """The lookup table is filled anew here, slot by slot, from each shard's whole permutation."""
    orders = []
    for name in shard_names(SHARDS):
        a = int(hashlib.md5(f"offset:{name}".encode()).hexdigest()[:15], 16) % SLOTS
        b = int(hashlib.md5(f"skip:{name}".encode()).hexdigest()[:15], 16) % (SLOTS - 1) + 1
        orders.append(iter([(a + j * b) % SLOTS for j in range(SLOTS)]))
    owner: dict[int, int] = {}
    turn = 0
    while len(owner) < SLOTS:
        slot = next(s for s in orders[turn % SHARDS] if s not in owner)
        owner[slot] = turn % SHARDS
        turn += 1
    listed = ",".join(str(owner[s]) for s in range(SLOTS))
    return f"""
        WITH placed AS (
            SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
                   CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {SLOTS} AS slot
            FROM documents)
        SELECT doc_id, n_bytes, slot, CAST([{listed}][slot + 1] AS BIGINT) AS shard FROM placed"""


QUERIES = {"op5_sharding": op5_sharding}
SQL = {"op5_sharding": _sql()}
