"""The forest's work over its levels and leaves follows the rows and the links."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from gridwise.llm import rp_forest

SCHEMA = "vec_id long, embedding array<float>, label int"


def near_pairs(seed, n, dims=32):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dims))
    x = np.concatenate([base, base + 0.05 * rng.standard_normal((n, dims))]).astype(np.float32)
    return [(i, v.tolist(), 1) for i, v in enumerate(x)]


def test_levels_hold_no_vectors_and_few_are_searched(spark, monkeypatch):
    written = []
    write = rp_forest.materialize

    def spy(df, name):
        written.append((name, df.columns))
        return write(df, name)

    monkeypatch.setattr(rp_forest, "materialize", spy)
    monkeypatch.setattr(rp_forest.leaves, "__defaults__", (rp_forest.TREES, 256))
    rows = near_pairs(8, 600)
    got = {r.vec_id: r for r in rp_forest.join(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].n_links == got[i + 600].n_links == 1 for i in range(600))
    assert all(got[i].component_id == got[i + 600].component_id == i for i in range(600))
    levels = [columns for name, columns in written if name == "forest-level"]
    assert len(levels) > rp_forest.AHEAD  # the projections are taken anew on the way
    assert not any("vector" in columns for columns in levels)
    assert sum(name == "forest-pivots" for name, _ in written) <= len(levels) // 2


def test_a_group_that_grows_dense_below_is_searched_again(spark, monkeypatch):
    # 90 of 1,500: no eighth of the label, but of a node two levels below
    rng = np.random.default_rng(9)
    group = rng.standard_normal(32) + 0.1 * rng.standard_normal((90, 32))
    x = np.concatenate([group, rng.standard_normal((1410, 32))]).astype(np.float32)
    monkeypatch.setattr(rp_forest.leaves, "__defaults__", (rp_forest.TREES, 64))
    monkeypatch.setattr(rp_forest, "LEAF", 64)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in rp_forest.join(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {(got[i].n_links, got[i].component_id) for i in range(90)} == {(89, 0)}
    assert all(got[i].n_links == 0 for i in range(90, 1500))


def test_zeros_of_either_sign_are_one_class(spark):
    df = spark.createDataFrame([(1, [0.0, 2.0], 1), (2, [-0.0, 1.0], 1), (3, [0.0, -1.0], 1)], SCHEMA)
    assert sorted(r["size"] for r in rp_forest.classes(df)[1].collect()) == [1, 2]


def earlier(lists, node):
    return rp_forest._earlier(pa.chunked_array([pa.array(lists, pa.list_(pa.int64()))]), node)


@pytest.mark.parametrize("rows, names, pairs", [(40, 30, 5), (40, 30, 700), (60, 5000, 20), (30, 10, 0)])
def test_pairs_that_share_an_earlier_leaf(rows, names, pairs):
    rng = np.random.default_rng(rows + names + pairs)
    own, fringe = ([rng.choice(names, rng.integers(0, 9), replace=False).tolist() for _ in range(rows)]
                   for _ in range(2))
    a, b = np.nonzero(np.triu(np.ones((rows, rows), bool), 1))
    some = np.sort(rng.permutation(len(a))[:pairs])
    a, b, node = a[some], b[some], names // 2
    cut = lambda names: {x for x in names if x < node}
    want = [bool(cut(own[u]) & cut(own[v]) or cut(own[u]) & cut(fringe[v]) or cut(fringe[u]) & cut(own[v]))
            for u, v in zip(a, b)]
    got = rp_forest._share_earlier(earlier(own, node), earlier(fringe, node), rows, a, b)
    assert got.tolist() == want


def test_memory_of_a_leaf_does_not_follow_the_leaves_of_its_label():
    lists = [list(range(i * 60, i * 60 + 60)) for i in range(1000)]
    held = earlier(lists, 10 ** 6), earlier([[]] * 1000, 10 ** 6)
    a = np.arange(0, 999, 2)
    tracemalloc.start()
    assert not rp_forest._share_earlier(*held, 1000, a, a + 1).any()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 50e6


def test_links_at_the_threshold_are_taken_in_double_precision():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((200, 8))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    cosine = x @ x.T
    for least in (0.6, float(np.sort(cosine[np.triu_indices(200, 1)])[-40]) - 1e-12):
        a, b = rp_forest._linked(x, least)
        want = np.nonzero(np.triu(cosine >= least, 1))
        assert (sorted(zip(a.tolist(), b.tolist())) == list(zip(want[0].tolist(), want[1].tolist())))
