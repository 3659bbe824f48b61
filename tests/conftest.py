"""One local session and small hand-made tables for all tests."""

from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.compare import session  # noqa: E402
from venue_analytics.sources.schemas import SCHEMAS  # noqa: E402
from venue_analytics.sources.tables import Tables  # noqa: E402

DEFAULTS = {"int": 0, "bigint": 0, "string": "x", "boolean": False, "date": dt.date(2020, 1, 1)}


@pytest.fixture(scope="session")
def spark():
    spark = session(compiled=False)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def make(spark):
    """make(table, rows): a typed domain frame; columns a row leaves out get plain defaults."""
    def build(name: str, rows: list[dict]):
        schema = SCHEMAS[name]

        def value(field, row):
            if field.name in row:
                v = row[field.name]
                return Decimal(str(v)) if v is not None and field.dataType.typeName() == "decimal" else v
            kind = field.dataType.simpleString()
            return Decimal(0) if kind.startswith("decimal") else DEFAULTS[kind]

        return spark.createDataFrame([tuple(value(f, r) for f in schema.fields) for r in rows], schema)

    return build


@pytest.fixture(scope="session")
def tables(make):
    """tables(name=[rows], ...): a mapping of domain frames, unnamed tables empty."""
    def build(**rows):
        return Tables({name: make(name, rows.get(name, [])) for name in SCHEMAS})

    return build
