"""Where operators get their tables from.

``Tables`` is a mapping of domain tables plus the per-game roll-ups (``mart``) that most outputs start
from. ``Workspace`` is the same mapping over a sales folder, with the joined tables, the game hub and
the roll-ups written once to the cluster's shared folder and read back.
"""

from __future__ import annotations

import hashlib
import tempfile
import threading
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators import marts
from .adapter import SalesAdapter
from .schemas import SCHEMAS


LAYOUT = 3  # raised when the stored tables' columns or rules change


class Tables(Mapping):
    """Domain tables by name. Values may be frames or zero-argument builders."""

    stores = False  # whether ``keep`` writes its results

    def __init__(self, frames: Mapping):
        self._frames = dict(frames)
        self._marts: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        value = self._frames[name]
        if callable(value):
            value = self._frames[name] = value()
        return value

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def records(self, name: str, once: bool = False) -> DataFrame:
        """A fact table (ticket_sales, concessions or merchandise) without its record id, for outputs that don't name records.

        ``once`` says that one pass reads it, so that it isn't worth storing.
        """
        return self[name].drop(SCHEMAS[name].fields[0].name)

    def mart(self, name: str) -> DataFrame:
        """Per-game roll-up of a fact table: tickets_by_game, concessions_by_game or merchandise_by_game."""
        if name not in self._marts:
            self._marts[name] = marts.ROLLUPS[name](self)
        return self._marts[name]

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A result many later passes read. Here it is just built; a workspace stores it."""
        return build()


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for local sessions that name none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="venue-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


class Workspace(Tables):
    """Tables derived from a sales folder, the costly ones stored.

    The hub tables (one row per game) and the roll-ups are bucketed by game_id: their keys are unique, so
    buckets stay even, and the joins among them need no shuffle. The fact tables are written as plain
    Parquet, never bucketed by game, so one huge game spreads over many files and tasks; storing them pays
    their arithmetic once and fixes their surrogate ids. Record ids need the whole line-item table sorted
    and written, so only ``t[fact]`` has them; ``records`` derives the same rows without, from the source
    itself: ticket records are a projection of it, the two category tables (a join) are stored unless read
    ``once``: a roll-up takes them straight from their join with attendance, whose buckets are its own.
    """

    stores = True
    HUB = ("games", "attendance", "promotions", "weather")
    STORED_FACTS = ("ticket_sales", "concessions", "merchandise")

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark = spark
        self.adapter = SalesAdapter(spark, folder)
        self.buckets = buckets or self._bucket_count()
        self.fingerprint = source_fingerprint(spark, folder)
        stamp = hashlib.md5(f"{LAYOUT}|{folder}|{self.buckets}|{self.fingerprint}".encode()).hexdigest()[:16]
        self._prefix = f"venue_{stamp}"
        self._root = f"{shared_root(spark)}/venue_analytics/{spark.sparkContext.applicationId}/{stamp}"
        self._made: set[str] = set()
        self._lock = threading.RLock()
        super().__init__({name: self._builder(name) for name in SCHEMAS})

    def _bucket_count(self, bytes_per_bucket: int = 256 << 20) -> int:
        """Buckets by the size of the hub's source: one per 256 MB, at least one per core on small data."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.adapter.folder}/orders.parquet")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        size = files.getContentSummary(path).getLength()
        small = min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.spark.sparkContext.defaultParallelism)
        return min(max(small, -(-size // bytes_per_bucket)), int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))

    def _builder(self, name: str):
        def build() -> DataFrame:
            if name in self.HUB:
                return self._stored(name, self.adapter.build(name), bucketed=True)
            if name in self.STORED_FACTS:
                frame = self.adapter.build(name) if name == "ticket_sales" else getattr(self.adapter, name)(self["attendance"])
                return self._stored(name, frame, bucketed=False)
            return self.adapter.build(name)

        return build

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            return super().__getitem__(name)

    def records(self, name: str, once: bool = False) -> DataFrame:
        with self._lock:
            if name == "ticket_sales":
                return self.adapter.ticket_sales(numbered=False)
            frame = getattr(self.adapter, name)(self["attendance"], numbered=False)
            if once and f"{self._prefix}_{name}_records" not in self._made:
                return frame
            return self._stored(f"{name}_records", frame, bucketed=False)

    def mart(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._marts:
                self._marts[name] = self._stored(name, marts.ROLLUPS[name](self), bucketed=True)
            return self._marts[name]

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Store a result in the shared folder, so passes over it survive lost executors without rebuilding it."""
        with self._lock:
            if (table := f"{self._prefix}_{name}") in self._made:
                return self.spark.table(table)
            return self._stored(name, build(), bucketed=False)

    def _stored(self, name: str, frame: DataFrame, bucketed: bool) -> DataFrame:
        path, table = f"{self._root}/{name}", f"{self._prefix}_{name}"
        if table not in self._made:  # only what this workspace wrote itself counts, not a table of that name
            if bucketed:
                writer = frame.repartition(self.buckets, "game_id").write.bucketBy(self.buckets, "game_id").sortBy("game_id")
            else:
                writer = frame.write
            writer.mode("overwrite").option("path", path).saveAsTable(table)
            self._made.add(table)
        return self.spark.table(table)


    def forget(self) -> None:
        """Drop the stored tables' names; a source that has changed gets a new workspace."""
        with self._lock:
            for table in self._made:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self._made.clear()


# The source tables the workspace's tables are built from; a change elsewhere in the folder doesn't count.
SOURCES = ("region", "nation", "customer", "orders", "lineitem")


def source_fingerprint(spark: SparkSession, folder: str, sources: tuple[str, ...] = SOURCES) -> str:
    """A digest of the source tables a workspace reads: per table, its length, number of files and folders
    (one content summary, summed by the file system itself) and its modification time.

    A constant number of file-system calls, whatever the number of files: nothing is listed in the driver.
    A table that is a folder changes its time when files come or go, and its length when one is rewritten.
    """
    jvm = spark._jvm
    seen = []
    for name in sources:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.parquet")
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(path):
            seen.append(f"{name}|missing")
            continue
        summary, status = system.getContentSummary(path), system.getFileStatus(path)
        seen.append(f"{name}|{summary.getLength()}|{summary.getFileCount()}|{summary.getDirectoryCount()}|{status.getModificationTime()}")
    return hashlib.md5("\n".join(seen).encode()).hexdigest()


_OPEN: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """The session's workspace over a folder, created on first use and again whenever the folder's files have changed."""
    key = (spark.sparkContext.applicationId, folder)
    known = _OPEN.get(key)
    if known is not None and known.fingerprint != source_fingerprint(spark, folder):
        known.forget()
        known = None
    if known is None:
        known = _OPEN[key] = Workspace(spark, folder)
    return known
