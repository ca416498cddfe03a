"""Collocations against plain counting of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridwise.llm import collocations as C


def brute(rows, threshold=100, longest=5, top=2000) -> set[tuple]:
    """rows of (lang, text) -> (lang, rank, phrase, a, l, r, n, score)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        longer = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i:i + k]] = max(longer[p[i:i + k]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * longer[p] >= 100 * a:
                continue
            cuts = []
            for k in range(1, len(p)):
                left, right = counts[p[:k]], counts[p[k:]]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def corpus(seed: int, docs: int, vocabulary: int = 12):
    rng = random.Random(seed)
    words = [f"W{i}é" if i % 5 == 0 else f"w{i}" for i in range(vocabulary)]
    phrases = [" ".join(rng.choice(words) for _ in range(rng.randint(2, 6))) for _ in range(6)]

    def text():
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts.append(rng.choice(phrases) if rng.random() < 0.4 else rng.choice(words))
            parts.append(rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  ", "\x0b", "\x1c "]))
        return "".join(parts)

    return [(rng.choice(["en", "en", "de", None, "und"]), text()) for _ in range(docs)]


def found(spark, rows, parts=7, **kw) -> set[tuple]:
    df = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)],
                               "lang string, text string, doc_id long, word string").repartition(parts)
    out = C.collocations(df, **kw).collect()
    assert len({(r.lang, r["rank"]) for r in out}) == len(out)
    return {tuple(r) for r in out}


@pytest.mark.parametrize("seed,threshold,shards,longest", [(1, 6, 3, 5), (2, 9, 2, 4), (3, 20, 3, 5),
                                                            (4, 300, 1, 5)])
def test_equal_to_plain_counting(spark, seed, threshold, shards, longest):
    rows = corpus(seed, 300)
    got = found(spark, rows, threshold=threshold, shards=shards, longest=longest)
    assert got == brute(rows, threshold, longest)
    assert got


def test_top_and_ties(spark):
    rows = corpus(5, 200)
    assert found(spark, rows, threshold=5, top=4) == brute(rows, 5, top=4)


def test_odd_rows(spark, monkeypatch):
    """Nulls, empty texts, only separators, repeated rows, a text cut in segments."""
    monkeypatch.setattr(C, "CHUNK_WORDS", 64)
    long = " ".join(f"a{i % 7} b{i % 3}" for i in range(3000))
    rows = [("en", None), (None, ""), ("en", "., ;!"), ("en", "one two"), ("en", "one two"),
            ("en", "x" * 5000), ("en", long), ("fr", long.replace(" ", " . "))] * 3
    assert found(spark, rows, threshold=6) == brute(rows, 6)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert C.collocations(empty).collect() == []


def test_segments_keep_every_word():
    text = "Alpha beta\tgamma. delta  epsilon\x0bzeta,eta " * 50
    whole = [w for part in C.segments(text.encode(), 1 << 30) for w in part]
    cut = [w for part in C.segments(text.encode(), 17) for w in part]
    assert cut == whole
    assert b"alpha" in whole and C.BORDER in whole


def test_phrases_across_a_chunk_count_once():
    layout = C.Layout(buckets=4, cell_bits=16, threshold=1)
    rng = np.random.default_rng(0)
    ids = rng.integers(1, 5, 200).astype(np.uint64)
    cells = np.zeros(1 << 16, dtype=np.uint8)

    def count(chunks):
        seen = Counter()
        for words, lead in chunks:
            for length, place, first, _ in C.active_phrases(words, lead, cells, layout):
                seen.update((length, int(p)) for p in place[first != C.UNREACHED])
        return seen

    assert count([(ids[:90], 0), (ids[86:], 4)]) == count([(ids, 0)])


def test_packed_keys_return():
    keys = np.array([5, (1 << 40) - 1, 1 << 39], dtype=np.uint64)
    assert C._from_five_bytes(C._five_bytes(keys)).tolist() == keys.tolist()


def test_words_that_share_a_hash_take_another_seed(spark, monkeypatch):
    seeds = []

    def encode(docs, seed, *a, **kw):
        seeds.append(seed)
        return plain(docs, seed, *a, **kw)

    plain, told = C.encode, C.spellings

    def clash_once(*args):
        out = told(*args)
        return out.withColumn("clash", C.F.lit(True)) if len(seeds) == 1 else out

    monkeypatch.setattr(C, "encode", encode)
    monkeypatch.setattr(C, "spellings", clash_once)
    rows = corpus(6, 100)
    assert found(spark, rows, threshold=6) == brute(rows, 6)
    assert seeds == [0, 1]


def test_only_words_of_candidates_are_spelled(spark, monkeypatch):
    told, spellings = [], C.spellings
    monkeypatch.setattr(C, "spellings", lambda *a: told.append(spellings(*a)) or told[-1])
    # each other word is as frequent, but stands alone in its piece
    rows = [("en", "green tea. " + ". ".join(f"w{i}" for i in range(300)))] * 20
    got = found(spark, rows, threshold=20, shards=2, longest=3)
    assert {r[2] for r in got} == {"green tea"}
    words = {r.word for r in told[0].collect()}
    assert {"green", "tea"} <= words and len(words) < 20  # all 302 before


def test_words_are_cut_at_blanks_and_tabs_only():
    text = "a\t b\x1cc\x85\u00a0d  e\nf\x0b\x0cg\r\t\th,".encode()
    assert [w for part in C.segments(text) for w in part] == [
        b"a", "b\x1cc\x85\u00a0d".encode(), b"e", C.BORDER, b"f", C.BORDER, C.BORDER, b"g", C.BORDER,
        b"h", C.BORDER]


def test_rows_that_share_a_hash_stay_apart(monkeypatch):
    words = np.array([[1, 2], [3, 0], [1, 2], [2, 1], [3, 0], [1, 2]], dtype=np.int64)
    counts = np.arange(1, 7, dtype=np.int64)
    want = {(1, 2): 10, (3, 0): 7, (2, 1): 4}
    for hash_of in (C._row_hash, lambda w: np.zeros(len(w), dtype=np.uint64)):
        monkeypatch.setattr(C, "_row_hash", hash_of)
        rows, sums = C._tallied(words, counts)
        assert dict(zip(map(tuple, rows.tolist()), sums.tolist())) == want and len(rows) == 3
