"""Table catalog over layered folders: typed CSV or Parquet reads, sinks, views and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .schemas import SCHEMAS
from .tables import Tables

# --- fixed values: columns of the derived tables, by name -----------------------------------------
DERIVED_SINKS = [
    "features_attendance", "features_revenue", "features_full", "attendance_predictions", "revenue_predictions",
    "fan_profiles_segmented",
]
# --------------------------------------------------------------------------------------------------


class MissingTable(FileNotFoundError):
    """A table was found in none of the places it may live."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, name: str, keep_corrupt: bool = False) -> DataFrame:
    """Header CSV of a domain table with its declared schema.

    An empty cell is null; any other text, the promotion type "None" included, stays text. A file that
    does not exist raises. With ``keep_corrupt`` a line whose cell doesn't parse as its declared type
    keeps its raw text in ``_corrupt_record`` (its fields null), so bad cells are counted, not silently
    nulled.
    """
    if not path_exists(spark, path):
        raise MissingTable(f"no such file: {path}")
    schema = SCHEMAS[name]
    reader = spark.read.option("header", True).option("nullValue", "").option("enforceSchema", False)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    # enforceSchema off: header names are checked against the schema instead of being trusted by position.
    return reader.schema(schema).csv(path)


class Catalog:
    """Tables of a project: a cleaned folder, a raw folder and the session's own tables.

    ``prefer`` names the folder that is tried first: ``cleaned`` (analysis jobs) or ``raw``. With
    ``use_session_tables`` a session table of that name wins over both. ``on_missing`` is ``raise`` or
    ``empty``, which gives a typed frame without rows.
    """

    def __init__(
        self, spark: SparkSession, raw: str, cleaned: str, prefer: str = "cleaned", on_missing: str = "raise",
        use_session_tables: bool = False,
    ):
        if prefer not in ("cleaned", "raw") or on_missing not in ("raise", "empty"):
            raise ValueError("prefer is cleaned or raw; on_missing is raise or empty")
        self.spark, self.on_missing, self.use_session_tables = spark, on_missing, use_session_tables
        self.folders = [cleaned, raw] if prefer == "cleaned" else [raw, cleaned]
        self.cleaned = cleaned

    def load(self, name: str) -> DataFrame:
        """The first existing copy of a table, Parquet before CSV within a folder."""
        if self.use_session_tables and self.spark.catalog.tableExists(name):
            return self.spark.table(name)
        for folder in self.folders:
            if path_exists(self.spark, f"{folder}/{name}.parquet"):
                return self.spark.read.parquet(f"{folder}/{name}.parquet")
            if name in SCHEMAS and path_exists(self.spark, f"{folder}/{name}.csv"):
                return read_csv(self.spark, f"{folder}/{name}.csv", name)
        if self.on_missing == "empty" and name in SCHEMAS:
            return self.spark.createDataFrame([], SCHEMAS[name])
        raise MissingTable(f"table {name!r} is in none of {self.folders}")

    def tables(self, names: Iterable[str] = SCHEMAS) -> Tables:
        """All tables as a mapping that loads each one on first use."""
        return Tables({name: (lambda n=name: self.load(n)) for name in names})

    def save(self, name: str, df: DataFrame, fmt: str = "parquet", mode: str = "overwrite") -> str:
        """Write a table (cleaned copy, features, predictions, segments) to the cleaned folder; returns its path."""
        path = f"{self.cleaned}/{name}.{fmt}"
        writer = df.write.mode(mode)
        if fmt == "csv":
            # Empty strings keep their quotes so they stay apart from nulls.
            writer = writer.option("header", True).option("emptyValue", '""')
        writer.format(fmt).save(path)
        return path

    def register(self, tables: Mapping[str, DataFrame] | None = None) -> list[str]:
        """Make every table queryable by name from SQL text."""
        tables = self.tables() if tables is None else tables
        for name in tables:
            tables[name].createOrReplaceTempView(name)
        return list(tables)

    def query(self, sql: str) -> DataFrame:
        """SQL text over the registered tables and views."""
        return self.spark.sql(sql)


def load_into_session(tables: Mapping[str, DataFrame], mode: str = "overwrite") -> list[str]:
    """Store every table under its name in the session catalog, replacing earlier contents."""
    for name in tables:
        tables[name].write.mode(mode).saveAsTable(name)
    return list(tables)
