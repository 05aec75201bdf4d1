"""Every query against its SQL twin at the smallest scale."""

import inspect
import re

import pytest

import __spark_entry__ as contract
import oracle
from demandloom.functions import ordered

# The text operators have tests of their own.
QUERIES, SQL = (
    {name: found for name, found in known.items() if not re.match(r"op\d+_|pipeline$", name)}
    for known in (contract.queries(), contract.oracle_sql())
)
UNCHECKED_HERE = {"random_forest", "gradient_boosting", "model_training"}  # long fits; see test_regression


@pytest.fixture(scope="module")
def connection(sf_dir):
    con = oracle.connect(sf_dir)
    yield con
    con.close()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert all(len(inspect.signature(f).parameters) >= 2 for f in QUERIES.values())


#: Trees and exact searches walk in Python tasks.
IN_PYTHON = {"tree_fit", "boosted_fit", "forest_tables", "given_forest_scores", "upload_forest_scores"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, connection, name):
    rows = QUERIES[name](spark, sf_dir)
    assert oracle.differences(rows, connection, SQL[name]) == []
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert name in IN_PYTHON or "Python" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - UNCHECKED_HERE))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize(
    "name, scans",
    [
        ("validation_verdict", 2), ("validation_verdict_clean", 2), ("forecast_metrics", 1), ("correlations", 1), ("store_season", 1),
        ("weekly_summary", 1), ("sales_histogram", 1), ("monthly_boxes", 1), ("average_percentiles", 1),
    ],
)
def test_source_scans(spark, sf_dir, name, scans, monkeypatch):
    """How often the largest table is read, by the executed plan and by what is stored while it is made."""
    eager, store = [], ordered.stored_in_order

    def counted(df, *order):
        eager.extend(scans_of(df, "lineitem"))
        return store(df, *order)

    monkeypatch.setattr(ordered, "stored_in_order", counted)
    rows = QUERIES[name](spark, sf_dir)
    rows.collect()
    assert 1 <= len(scans_of(rows, "lineitem")) + len(eager) <= scans


def scans_of(rows, table):
    """Scan nodes of a table in the executed plan and its subqueries, without reused ones."""
    found, todo = [], [rows._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "FileSourceScanExec" and f"{table}.parquet" in node.toString():
            found.append(node)
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif not kind.startswith("Reused"):
            children, queries = node.children(), node.subqueries()
            todo += [children.apply(i) for i in range(children.size())] + [queries.apply(i) for i in range(queries.size())]
    return found


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.count() == 951 and len(rows.columns) == 15
