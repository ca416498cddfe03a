"""Vector near-duplicates and code search against brute force."""

import numpy as np
import pytest
from brute import components as brute_components

from gridwise.llm import hamming, rp_forest


def brute_join(rows, least=0.93):
    good = {}
    for k, (_, v, label) in enumerate(rows):
        if v is None or label is None or not len(v) or any(x is None for x in v):
            continue
        x = np.array(v, float)
        if np.isfinite(x).all() and x.any():
            good[k] = (label, x / np.linalg.norm(x))
    links = [(a, b) for a in good for b in good if a < b and good[a][0] == good[b][0]
             and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= least]
    n = [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return links, n


def vectors(seed, groups, size, spread, dims=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = rng.standard_normal(dims)
        for _ in range(size):
            v = base + spread * rng.standard_normal(dims)
            rows.append((len(rows), [float(np.float32(x)) for x in v], g % 2))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def run(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as size", "2 as node")
    return rp_forest.join(df.repartition(4), **settings).collect()


def test_small_labels_are_exact(spark):
    rows = vectors(1, 12, 8, 0.2)
    rows += [(500 + i, rows[3][1], rows[3][2]) for i in range(30)]  # copies
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, rows[0][1], None),
             (904, [float("nan")] + [1.0] * 15, 1), (905, [None] + [1.0] * 15, 1),
             (906, [float("inf")] + [1.0] * 15, 0), (907, [1.0, 2.0], 0), (908, [2.0, 4.0], 0)]
    links, n = brute_join(rows)
    named = brute_components([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in links])
    got = {r.vec_id: r for r in run(spark, rows)}
    assert len(got) == len(rows)
    for k, (vec_id, _, _) in enumerate(rows):
        r = got[vec_id]
        assert (r.n_links, r.component_id, r.kept) == (n[k], named[vec_id], named[vec_id] == vec_id)


def test_forest_recall(spark, monkeypatch):
    rows = vectors(2, 150, 8, 0.12)
    links, n = brute_join(rows)
    monkeypatch.setattr(rp_forest.leaves, "__defaults__", (rp_forest.TREES, 64))
    got = {r.vec_id: r for r in run(spark, rows)}
    found = sum(r.n_links for r in got.values()) / 2
    assert 0.9 * len(links) <= found <= len(links)
    assert all(got[v].n_links <= n[v] for v in got)


def test_equal_projections_still_split(spark, monkeypatch):
    # multiples of one vector: all are linked, none can be told apart by a projection
    rows = [(i, [float(i + 1)] * 16, 1) for i in range(200)]
    monkeypatch.setattr(rp_forest.leaves, "__defaults__", (rp_forest.TREES, 32))
    got = run(spark, rows)
    assert len(got) == 200 and {r.component_id for r in got} == {0}


def test_exact_multiples_are_one_class(spark, monkeypatch):
    rows = [(i, [float(x * (-1) ** j * 2.0 ** (i % 100 - 50)) for j, x in enumerate(range(1, 17))], 1)
            for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rp_forest.classes(df)[1].count() == 1
    monkeypatch.setattr(rp_forest.leaves, "__defaults__", (rp_forest.TREES, 32))
    assert {(r.n_links, r.component_id) for r in run(spark, rows)} == {(199, 0)}


def test_flat_splits_differ_by_tree(spark):
    rows = spark.range(200).selectExpr("id as class_id", "explode(array(0, 1)) as tree",
                                       "7L as node", "array(1D) as vector", "0.5D as at")
    halves = {}
    for r in rp_forest._split(rows).collect():
        halves.setdefault((r.tree, r.node), set()).add(r.class_id)
    first, second = ({frozenset(v) for (t, _), v in halves.items() if t == tree} for tree in (0, 1))
    assert len(first) == len(second) == 2 and first != second


def test_group_of_several_leaves_is_exact(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = vectors(6, 20, 8, 0.12)
    for at, spread in ((rng.standard_normal(16), 0.05), (rng.standard_normal(16), 0.15)):
        rows += [(len(rows) + i, [float(np.float32(x)) for x in at + spread * rng.standard_normal(16)], 1)
                 for i in range(400)]
    links, n = brute_join(rows)
    named = brute_components([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in links])
    monkeypatch.setattr(rp_forest.leaves, "__defaults__", (rp_forest.TREES, 64))
    monkeypatch.setattr(rp_forest, "LEAF", 64)
    got = {r.vec_id: r for r in run(spark, rows)}
    assert {v: got[v].component_id for v in got} == named
    assert [got[i].n_links for i in range(160, 560)] == n[160:560]
    found = sum(r.n_links for r in got.values()) / 2
    assert 0.999 * len(links) <= found <= len(links)
    assert all(got[v].n_links <= n[v] for v in got)


def test_rows_left_after_the_last_level_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(rp_forest.leaves, "__defaults__", (rp_forest.TREES, 16))
    monkeypatch.setattr(rp_forest, "MOST_LEVELS", 2)
    with pytest.raises(RuntimeError, match="levels"):
        run(spark, vectors(7, 100, 2, 0.12))


def test_null_ids_and_empty_table(spark):
    rows = [(None, [1.0] * 16, 1), (4, [1.0] * 16, 1), (4, [1.0] * 16, 1), (None, [-1.0] * 16, 1)]
    got = run(spark, rows)
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == [
        ("4", 2, "4", True), ("4", 2, "4", True), ("None", 0, "None", False),
        ("None", 2, "4", False)]
    assert run(spark, []) == []


@pytest.mark.parametrize("n, k", [(3, 10), (400, 5), (400, 1)])
def test_nearest_codes_equal_brute_force(spark, n, k):
    rng = np.random.default_rng(n)
    codes = rng.integers(-2 ** 63, 2 ** 63 - 1, n)
    codes[n // 2:] = codes[0] ^ (1 << rng.integers(0, 63, n - n // 2))  # a dense corner
    codes[-1] = codes[0]
    rows = [(i, int(c)) for i, c in enumerate(codes)] + [(1000, None), (1, int(codes[1]))]
    df = spark.createDataFrame(rows, "id long, code long").selectExpr("*", "'x' as q")
    queries = df.where("id % 50 = 0").selectExpr("id as query_id", "code")
    got = sorted((r.query_id, r["rank"], r.id, r.distance) for r in
                 hamming.nearest(df, queries, k).collect())
    want = []
    for q, code in rows:
        if q % 50 or code is None:
            continue
        near = sorted((bin((code ^ c) & (2 ** 64 - 1)).count("1"), i) for i, c in rows
                      if c is not None)[:k]
        want += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    assert got == sorted(want)


def test_nearest_of_nothing(spark):
    df = spark.createDataFrame([], "id long, code long")
    assert hamming.nearest(df, df.selectExpr("id as query_id", "code")).count() == 0
