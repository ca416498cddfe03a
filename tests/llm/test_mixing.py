import math
import random

import pytest

from gridwise.llm import mixing


def brute_targets(sizes):
    """Share by weight, hold what is over its limit, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    held, out = set(), {}
    while True:
        open_ = [s for s in names if s not in held]
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in held)
        total = sum(weight[s] for s in open_)
        out = {s: 3 * sizes[s] if s in held else left * weight[s] / total for s in names}
        over = [s for s in open_ if out[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return out
        held.update(over)


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_sharing_step_by_step(spark, seed):
    draw = random.Random(seed)
    sizes = {f"s{i}": draw.choice([0, 1, 5, 100, 5000]) * draw.randrange(1, 9) for i in range(11)}
    sizes[None] = 17
    sizes["é"] = 40
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    for s, want in brute_targets(sizes).items():
        assert got[s] == pytest.approx(want, abs=1e-6)


def test_mix(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice(["a", "a", "a", "b", "c", None, "d"]), "w " * draw.randrange(0, 60))
            for i in range(3000)]
    rows += [(9000, "a", None), (9001, "e", ""), (None, "b", "x y"), (7, "zz", "one two")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    docs = docs.selectExpr("*", "1 as size", "2 as target", "3 as key")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = {}, {}, {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
        # complete epochs come first
        epochs = math.floor(r.target / r.source_size) if r.source_size else 0
        assert r.taken in (epochs * r.size, (epochs + 1) * r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(docs.where("false")).count() == 0


def test_heavier_documents_are_drawn_first(spark):
    good = [(i, "a", "word " * 20) for i in range(400)]
    odd = [(1000 + i, "a", "x " * 20) for i in range(400)]  # words too short: weight 0.5
    other = [(5000 + i, "b", "word " * 20) for i in range(200)]
    got = mixing.mix(spark.createDataFrame(good + odd + other,
                                           "doc_id long, source string, text string")).collect()
    share = lambda lo: sum(r.taken > 0 for r in got if lo <= r.doc_id < lo + 400) / 400
    assert 0 < share(1000) < share(0) < 1


def test_plan_has_no_python(spark):
    df = mixing.mix(spark.createDataFrame([(1, "a", "x")], "doc_id long, source string, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
