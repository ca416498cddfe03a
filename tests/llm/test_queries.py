"""The registered training-data queries on sf0.001: against their DuckDB SQL where they
have one, and without Python where they are to be native."""

import os

import corpus_pipeline
import duckdb
import pytest

from gridwise.llm.queries import QUERIES, SQL
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")
NATIVE = {"op7_pii", "op8_mixing"}
PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "MapInArrow")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", [*QUERIES, "pipeline"])
def test_query(spark, con, key):
    df = QUERIES[key](spark, SF) if key in QUERIES else corpus_pipeline.run(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if key in NATIVE:
        assert not any(n in plan for n in PYTHON_NODES), plan
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if key in SQL:
        res = con.execute(SQL[key])
        names = [d[0] for d in res.description]
        expected = res.fetchall()
        assert sorted(df.columns) == sorted(names)
        assert len(rows) == len(expected)
        assert digest(df.columns, rows) == digest(names, expected)
