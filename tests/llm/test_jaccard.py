import random

import numpy as np
import pytest
from brute import jaccard_join, shingle_set
from hypothesis import given, settings
from hypothesis import strategies as st

from gridwise.llm import jaccard, shingles


def test_sets_have_the_size_of_the_brute_force_sets():
    draw = random.Random(1)
    texts = [None, "", " \t\n ", "one", "A b C d", "a b c d e", "é ß É  x\ty z\x0bw"]
    texts += ["".join(draw.choice(["ab", "AB", " ", "  ", "\n", "c", "é", "dd "])
                      for _ in range(draw.randrange(200))) for _ in range(300)]
    texts.append(" ".join(str(draw.randrange(50)) for _ in range(600000)))
    texts.append("x" * 3_000_000 + " y")
    got = shingles.sets(texts)
    for text, one in zip(texts, got):
        want = shingle_set(text)
        assert len(one) == len(want)
        assert (np.diff(one.astype(object)) > 0).all() if len(one) < 1000 else True
    # alike in white space and case only
    same = shingles.sets(["A b  c\nd E", "a B c d e"])
    assert (same[0] == same[1]).all()


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 120), st.integers(0, 120), st.integers(0, 10 ** 6), st.randoms())
def test_similar_sets_share_a_signature(n, common, seed, draw):
    """Prefix guarantee for any frequent class: sets at the threshold share one."""
    rng = np.random.default_rng(seed)
    universe = np.unique(rng.integers(0, 2 ** 63, 4 * n + 8, dtype=np.uint64))
    x = set(universe[:n].tolist())
    # y keeps as many tokens of x as similarity asks for and adds others
    lose = draw.randint(0, n - (75 * n + 99) // 100)
    y = set(draw.sample(sorted(x), n - lose))
    extra = universe[n:].tolist()
    while extra and 100 * len(x & y) >= 75 * (len(x | y) + 1) and draw.random() < 0.9:
        y.add(extra.pop())
    assert 100 * len(x & y) >= 75 * len(x | y)
    share = draw.random()
    frequent = {t for t in x | y if draw.random() < share}

    def signatures(s):
        rare = sorted(s - frequent)
        often = np.array(sorted(s & frequent), np.uint64)
        loss = jaccard.allowed_loss(len(s))
        out = {("one", t) for t in rare[:loss + 1]}
        if len(rare) <= loss:
            for c in jaccard.size_steps(len(s)):
                out |= {("two", t) for t in
                        jaccard.token_pairs(len(rare), often, len(s), c).tolist()}
        return out

    if x != y:
        assert signatures(x) & signatures(y)


def texts_with_copies(seed):
    """Groups of near copies, larger than the bound for rare tokens, chains of
    them, exact copies, and a passage that unrelated texts share."""
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghij") + str(draw.randrange(400))
    rows, i = [], 0
    passage = [word() for _ in range(30)]

    def add(words):
        nonlocal i
        rows.append((i * 7 % 1009, " ".join(words)))
        i += 1

    for size, edits in ((40, 2), (25, 3), (6, 1), (3, 4)):
        base = [word() for _ in range(80)]
        for _ in range(size):
            copy = list(base)
            for _ in range(draw.randrange(edits + 1)):
                copy[draw.randrange(len(copy))] = word()
            add(copy)
    chain = [word() for _ in range(90)]
    for _ in range(25):
        chain = list(chain)
        chain[draw.randrange(len(chain))] = word()
        add(chain)
    for _ in range(30):
        add(passage + [word() for _ in range(draw.randrange(0, 14))])
    for _ in range(40):
        add([word() for _ in range(draw.randrange(1, 60))])
    for _ in range(20):
        add(passage[:12])
    add(["one", "two"])
    add(["One", "TWO"])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed):
    rows = texts_with_copies(seed) + [(5000, None), (5001, ""), (5002, " \n")]
    want = jaccard_join(rows)
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    docs = docs.selectExpr("*", "doc_id as component_id", "'x' as rep").repartition(4)
    got = jaccard.join(docs).collect()
    assert len(got) == len(rows) + 5
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id


def test_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (2, "A B C D E F"), (None, "only here it is so")]
    got = sorted(jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect(),
                 key=str)
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [
        ("2", "2"), ("3", "2"), ("None", "2"), ("None", "None")]
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_heavy_cells_count_all_sets(spark):
    rows = [(i, f"a b c d e f u{i} v{i} w{i} x{i} y{i}") for i in range(50)]
    docs = spark.createDataFrame(rows + rows, "doc_id long, text string").repartition(8)
    heavy = np.unpackbits(jaccard.heavy_cells(docs, 1000), bitorder="little")
    common = shingles.sets(["a b c d e f"])[0]
    assert np.flatnonzero(heavy).tolist() == sorted(
        {int(t) >> (64 - jaccard.CELL_BITS) for t in common.tolist()})
