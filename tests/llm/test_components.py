import random

from brute import components as brute_components

from gridwise.llm import common
from gridwise.llm.common import _attach_min, components, group_min_by_salt, materialize


def test_components_equal_brute_force(spark):
    draw = random.Random(4)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(150)]  # a long path
    links += [(2000 + i, 2500) for i in range(400)]  # a hub
    links += [(7777, 7777)]
    want = brute_components({x for p in links for x in p}, links)
    edges = spark.createDataFrame(links + [(None, 3)], "u long, v long")
    got = components(edges).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(edges.where("false")).count() == 0


def test_group_min_gives_a_row_per_salt(spark):
    rows = [("a", i % 4, 10 + i) for i in range(40)] + [("b", 1, 5), (None, 0, 2)]
    got = group_min_by_salt(spark.createDataFrame(rows, "k string, s int, v long"),
                            ["k"], "s", "v", "m").collect()
    assert sorted((str(r.k), r.s, r.m, r.m_rows) for r in got) == sorted(
        [("a", s, 10, 40) for s in range(4)] + [("b", 1, 5, 1), ("None", 0, 2, 1)])


def test_a_round_deals_its_edges_once_and_broadcasts_nothing(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long")
    step = _attach_min(edges, 8)
    assert {(r.u, r.v, r.m) for r in step.collect()} == {(i, i + 1, i) for i in range(300)}
    plan = step._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("REPARTITION_BY_COL") - plan.count("ReusedExchange") == 1
    assert "BroadcastExchange" not in plan


def test_links_of_a_task_take_no_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(common, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    edges = spark.createDataFrame([(i, i + 1) for i in range(500)], "u long, v long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {(i, 0) for i in range(501)}
    assert len(written) <= 3  # a path of 2000 links took 13 before


def test_links_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(common, "EDGES_AT_ONCE", 40)  # tasks give their stars away several times
    draw = random.Random(9)
    links = [(draw.randrange(-400, 400), draw.randrange(-400, 400)) for _ in range(420)]
    links += [(1000 + i, 1001 + i) for i in range(300)] + [(2000 + i, 2500) for i in range(300)]
    want = brute_components({x for p in links for x in p}, links)
    got = components(spark.createDataFrame(links, "u long, v long").repartition(3)).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
