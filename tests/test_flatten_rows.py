"""Flattening to rows: long lists, mixed types, odd documents, against a plain
recursive flattening in Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gridwise.operators import flatten as L


def plain(value, path=()):
    """{path: text} of the leaves, in the document's order; later ones replace."""
    out = {}

    def walk(v, steps):
        if isinstance(v, dict):
            for key in v:
                walk(v[key], (*steps, key))
        elif isinstance(v, list):
            for i, x in enumerate(v):
                walk(x, (*steps, str(i)))
        else:
            out[".".join(steps)] = (None if v is None else v if isinstance(v, str)
                                    else json.dumps(v))

    walk(value, path)
    return out


def rows_of(spark, docs, **kw):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, t string")
    found = [{} for _ in docs]
    for r in L.flatten_json_long(df, ["id"], "t", **kw).collect():
        assert r.path not in found[r.id]
        found[r.id][r.path] = r.value
    return found


ODD = [5, "s", None, True, [], {}, [[], {}, [[]]], {"a": None}, {"": {"": 1}}, {"a": {"": [0]}},
       {"a": {"b": 1}, "a.b": 2}, {"a.b": 2, "a": {"b": 1}}, {"a": [7], "a.0": 8}, {"a.0": 8, "a": [7]},
       {"x": {"a.b": {"c": 1}, "a": {"b.c": 2, "b": {"c": 3}}}}, {"x": {"a": {"b": {"c": 3}, "b.c": 2}}},
       {"t": '{"a": [1]}', "u": "[1,2]", "q": 'say "a.b": "x\\\\', "é.ü": 1, "it's": {"a.b": 1}},
       {"n": [1, -2, 12345678901234567890, "1", False, None, {"k": [None]}]}]


def test_odd_documents(spark):
    assert rows_of(spark, ODD) == [plain(d) for d in ODD]


def test_random_documents(spark):
    rng = random.Random(11)
    keys = ["a", "b", "a.b", "b.a", "0", "x y"]

    def make(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.35:
            return rng.choice([1, 0, "text", "1", None, True, '{"a":1}'])
        if kind < 0.6:
            return [make(depth - 1) for _ in range(rng.randint(0, 4))]
        chosen = rng.sample(keys, rng.randint(0, 4))
        return {k: make(depth - 1) for k in chosen}

    docs = [make(rng.randint(0, 5)) for _ in range(150)]
    assert rows_of(spark, docs) == [plain(d) for d in docs]


def test_long_list_keeps_the_plan_small(spark):
    def plan_size(length):
        df = spark.createDataFrame([(0, json.dumps({"l": list(range(length)), "m": [{"k": [1]}]}))],
                                   "id int, t string")
        out = L.flatten_json_long(df, ["id"], "t")
        assert out.count() == length + 1
        return len(out._jdf.queryExecution().optimizedPlan().toString())

    assert plan_size(100_000) <= plan_size(3) + 50


def test_typed_long_list_keeps_the_plan_small(spark):
    def plan_size(length):
        df = spark.range(1).select("id", F.struct(
            F.transform(F.sequence(F.lit(1), F.lit(length)),
                        lambda x: F.struct(x.alias("v"))).alias("l")).alias("r"))
        sizes = []
        for keep in (False, True):
            out = L.flatten_long(df, "id", "r", keep_nulls=keep)
            assert out.count() == length
            sizes.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
        return max(sizes)

    assert plan_size(100_000) <= plan_size(3) + 50


def test_depth_given_leaves_the_rest_as_text(spark):
    docs = [{"a": {"b": [1, {"c": 2}]}, "d": 1}]
    assert rows_of(spark, docs, depth=1) == [{"a": '{"b":[1,{"c":2}]}', "d": "1"}]
    assert rows_of(spark, docs, depth=9) == [plain(docs[0])]


def test_no_json(spark):
    df = spark.createDataFrame([(1, "{"), (2, None), (3, '{"a":1}')], "id int, t string")
    assert [tuple(r) for r in L.flatten_json_long(df, ["id"], "t", mode="permissive").collect()] == \
        [(3, "a", "1")]
    with pytest.raises(Exception):
        L.flatten_json_long(df, ["id"], "t").collect()
    assert L.flatten_json_long(df.where("false"), ["id"], "t").collect() == []


def test_repeated_documents_stay(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":1},"a.b":2}')] * 3, "id int, t string")
    assert sorted(tuple(r) for r in L.flatten_json_long(df, ["id"], "t").collect()) == [(1, "a.b", "2")] * 3


def test_typed_paths_that_collide(spark):
    df = spark.createDataFrame([(1, ((5,), 6))], "id int, r struct<a:struct<b:int>, `a.b`:int>")
    assert [tuple(r) for r in L.flatten_long(df, "id", "r").collect()] == [(1, "a.b", "6")]


def test_depth(spark):
    texts = ['5', '"[[["', '[[1],{"a":"}{"}]', '{"a":"x\\\\"}', '[' * 50 + ']' * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(L.json_depth(F.col("t"))).collect()] == [0, 0, 2, 1, 50]
