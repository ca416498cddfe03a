"""Every registered query against its DuckDB oracle on sf0.001 (row count,
column names and an order-insensitive value hash)."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from gridwise.plans.registry import all_queries
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                "FlatMapGroupsInPandas", "MapInArrow")
PYTHON_ALLOWED = {"zip_members"}   # S9 expands archives in mapInPandas


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# the training-data queries have their own cases in tests/llm
@pytest.mark.parametrize("key", sorted(all_queries()))
def test_query(spark, con, key):
    df = E.queries()[key](spark, SF)
    plan = _plan(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if key not in PYTHON_ALLOWED:
        assert not any(n in plan for n in PYTHON_NODES), plan
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(df.columns) > 0
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_flagship_plan(spark):
    df = E.queries()["inspections_total_areas"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # score options, hierarchy cells and working-area cells are broadcast;
    # the inspection rows are never shuffled for a join
    assert plan.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in plan
    # the part scan reads only the columns the staging rows use
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_size:int>" in \
        df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "buurtcode" in df.columns and len(df.columns) == 28


def test_entry_without_the_training_data_queries():
    """The entry module imports and keeps the engine's queries where the subpackage,
    or a library that only it needs, is absent."""
    code = (
        "import sys, warnings; warnings.simplefilter('ignore')\n"
        "sys.modules[{name!r}] = None\n"
        "import __spark_entry__ as e; print(sorted(e.queries()))")
    root = os.path.dirname(os.path.abspath(E.__file__))
    for name in ("gridwise.llm", "corpus_pipeline", "xxhash"):
        out = subprocess.run([sys.executable, "-c", code.format(name=name)], cwd=root,
                             capture_output=True, text=True, check=True)
        assert out.stdout.strip().splitlines()[-1] == str(sorted(all_queries()))
