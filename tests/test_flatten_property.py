"""Property: flatten_long then rebuilding the documents from the
dotted paths gives back the input documents (no dotted keys, no empty
containers, no null leaves)."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridwise.operators import shape

LEAF = st.integers(min_value=-1000, max_value=1000)


@st.composite
def documents(draw):
    docs = []
    for i in range(draw(st.integers(min_value=1, max_value=6))):
        d = {"id": i}
        if draw(st.booleans()):
            d["a"] = draw(LEAF)
        if draw(st.booleans()):
            inner = {"x": draw(LEAF)}
            if draw(st.booleans()):
                inner["y"] = {"z": draw(LEAF)}
            d["b"] = inner
        if draw(st.booleans()):
            d["c"] = draw(st.lists(LEAF, min_size=1, max_size=3))
        if draw(st.booleans()):
            d["p"] = [{"u": draw(LEAF)} for _ in range(draw(st.integers(1, 3)))]
        docs.append(d)
    return docs


def _rebuilt(rows):
    """A document from its (path, value) rows; a step of digits is a list position."""
    top = {}
    for path, value in rows:
        node = top
        *steps, last = path.split(".")
        for step in steps:
            node = node.setdefault(step, {})
        node[last] = value

    def lists(node):
        if not isinstance(node, dict):
            return node
        if node and all(k.isdigit() for k in node):
            return [lists(node[k]) for k in sorted(node, key=int)]
        return {k: lists(v) for k, v in node.items()}

    return lists(top)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=documents())
def test_documents_come_back_from_their_paths(spark, docs):
    schema = ("id long, a long, b struct<x:long, y:struct<z:long>>, c array<long>, "
              "p array<struct<u:long>>")
    df = spark.read.schema(schema).json(spark.sparkContext.parallelize(
        [json.dumps(d) for d in docs]))
    nested = df.select("id", F.struct("a", "b", "c", "p").alias("r"))
    rows = {d["id"]: [] for d in docs}
    for r in shape.flatten_long(nested, "id", "r", keep_nulls=False).collect():
        rows[r.id].append((r.path, int(r.value)))
    assert {i: {"id": i} | _rebuilt(found) for i, found in rows.items()} == {d["id"]: d for d in docs}
    # null leaves stay by default: every document has the same paths
    every = shape.flatten_long(nested, "id", "r").groupBy("id").count().collect()
    assert len({r["count"] for r in every}) == 1
