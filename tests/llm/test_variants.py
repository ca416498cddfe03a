"""Spelling variants against a brute-force comparison of all word pairs."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridwise.llm import variants as V


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(counts: dict[str, int], factor: int = V.FORM_FACTOR) -> dict[str, tuple]:
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form[w], counts[form[w]] if form[w] else None, root(w))
            for w, n in counts.items()}


def as_rows(df) -> dict[str, tuple]:
    rows = df.collect()
    found = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("gap,letters,sizes", [(1, "ab", (3, 7)), (2, "ab", (5, 9)), (2, "aé÷z", (7, 9)),
                                               (3, "abc", (5, 8)), (4, "ab", (4, 10))])
def test_near_words_equal_brute_force(spark, gap, letters, sizes):
    rng = random.Random(gap * 7 + len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(400)}
    counts = {w: rng.choice([2, 2, 3, 25, 30, 300, 4000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_rows(V.variants(df, gap)) == brute(counts)


def test_blocks_beyond_a_tile(spark, monkeypatch):
    """All words share one prefix, so blocks are larger than a tile of four."""
    monkeypatch.setattr(V, "TILE", 4)
    words = ["".join(p) + "sharedend" for p in itertools.product("abcdef", repeat=2)]
    words += [w[1:] for w in words]
    counts = {w: 2 + i for i, w in enumerate(dict.fromkeys(words))}
    ordered = sorted(counts)
    rows = V._Rows(**_block(ordered, counts))
    got = {frozenset((ordered[x], ordered[y])) for i, j in rows.pairs() for x, y in zip(i, j)}
    m = max(map(len, ordered))
    expected = {frozenset(p) for p in itertools.combinations(ordered, 2)
                if one_edit(*p) and max(map(len, p)) == m}
    assert got == expected


def _block(ordered, counts):
    size = len(ordered)
    m = max(map(len, ordered))
    return {"k": np.zeros(size, dtype=np.int64), "m": np.full(size, m), "a": np.zeros(size, dtype=np.int64),
            "words": ordered, "n": np.array([counts[w] for w in ordered]), "gap": 2}


def test_forms_are_followed_to_the_last(spark):
    counts = {"abcdefg": 2, "abcdefh": 20, "abcdeih": 200, "abcdjih": 2000, "zzzzzzz": 5,
              "abcdefgh": 19}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = as_rows(V.variants(df))
    assert got == brute(counts)
    assert got["abcdefg"][4] == "abcdjih"


def slipped(doc_id, text) -> list[str]:
    out = []
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(c.lower() if c.isascii() else c for c in run)
        if doc_id is not None:
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
        out.append(run)
    return out


def test_words_of_documents(spark):
    rng = random.Random(3)
    vocabulary = ["Während", "stretching", "STRETCHING", "naïveté÷", "Öffnung", "abcdefg", "short", "x"]
    rows = [(i, " ".join(rng.choice(vocabulary) + rng.choice(["", ".", "1", "—"]) for _ in range(40)))
            for i in range(60)]
    rows += [(None, "stretching Während"), (7, None), (8, ""), (9, "12 34"), (3, rows[3][1]),
             (99, "öffnungsstunde " * 20_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    expected = Counter(w for i, t in rows for w in slipped(i, t))
    expected = {w: n for w, n in expected.items() if len(w) >= 7 and n >= 2}
    got = {r.word: r.n for r in V.word_counts(V.with_slips(V.runs(df))).collect()}
    assert got == expected


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert V.variants(V.word_counts(V.with_slips(V.runs(empty)))).collect() == []


def test_tied_forms_take_the_smallest_word(spark):
    counts = {"zzzzzzz": 2, "azzzzzz": 30, "bzzzzzz": 30, "ézzzzzz": 30}
    got = as_rows(V.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got["zzzzzzz"] == (2, 3, "azzzzzz", 30, "azzzzzz")
