"""Every registered query against its DuckDB statement, values and types, on the smallest folder."""

import pytest

import __spark_entry__ as entry
from tests.compare import check, duck

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = {n: s for n, s in entry.oracle_sql().items() if not n.startswith("op")}
QUERIES = {n: q for n, q in entry.queries().items() if n != "pipeline" and not n.startswith("op")}  # those have tests of their own
# Tree ensembles with their full size take minutes; test_operators.py covers them with a few trees.
SLOW = {f"{m}_{t}" for m, t in (
    ("m4", "attendance_forest"), ("m5", "attendance_boosting"), ("m10", "attendance_importances"),
    ("m4", "revenue_forest"), ("m5", "revenue_boosting"), ("m10", "revenue_importances"),
    ("m9", "chosen_attendance"), ("m9", "chosen_revenue"), ("m10", "attendance_importances_chosen"), ("m10", "revenue_importances_chosen"),
    ("m11", "attendance_predictions_chosen"), ("m11", "revenue_predictions_chosen"))}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_statement(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert check(spark, con, FOLDER, lambda *_: df, STATEMENTS[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STATEMENTS) - SLOW))
def test_query_without_statement_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
