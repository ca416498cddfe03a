"""Toxicity: the automaton against plain edit distances, and learned models on
small labelled corpora."""

import random
import zlib

import numpy as np
import pytest

from gridwise.llm import toxicity as T
from gridwise.llm.common import held_out


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def matches(word: str, entries) -> tuple:
    out = []
    for number, e in enumerate(entries):
        edits = (min(distance(word[:k], e.text) for k in range(len(word) + 1)) if e.stem
                 else distance(word, e.text))
        if edits <= e.edits:
            out.append((number, edits))
    return tuple(out)


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_automaton_equals_edit_distances(limit):
    rng = random.Random(4)
    entries = [T.Entry("".join(rng.choice("abc") for _ in range(rng.randint(3, 10))), rng.random() < 0.3)
               for _ in range(25)]
    entries = list(dict.fromkeys(entries))
    automaton = T.Automaton(entries, limit)
    for _ in range(800):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 13)))
        if rng.random() < 0.5:
            word = list(rng.choice(entries).text)
            for _ in range(rng.randint(0, 3)):
                word[rng.randrange(len(word))] = rng.choice(["", "a", "x", "bb"])
            word = "".join(word) + rng.choice(["", "", "abc"])
        assert automaton.matches(word) == matches(word, entries)
    assert automaton.matches("a" * 100_000) == matches("a" * 30, entries)
    assert T.Automaton([]).matches("anything") == ()


def fold(i: int) -> int:
    return zlib.crc32(str(i).encode()) % 5


VOCABULARY = [a + b for a in ("ban", "kel", "mor", "tis", "vun", "dra") for b in
              ("do", "fel", "gan", "hu", "jin", "kop", "lam")]
RUDE = ["blockhead", "nitwit", "scoundrel"]
STEM = "gromp"


def corpus(size=1500, seed=1):
    """(doc_id, text, toxic): toxic texts hold rude words, some misspelled, or words
    that begin with one stem."""
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        words = [rng.choice(VOCABULARY) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                word = rng.choice(RUDE) if rng.random() < 0.6 else STEM + rng.choice(VOCABULARY)[:3]
                words.insert(rng.randrange(len(words)), word.title() if rng.random() < 0.3 else word)
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").cache()
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int").cache()
    return rows, docs, labels, T.fit(docs, labels)


def test_lexicon(learned):
    _, _, _, model = learned
    texts = {e.text for e in model.entries}
    assert set(RUDE) <= texts
    assert any(e.stem and STEM.startswith(e.text) for e in model.entries)
    assert not texts & set(VOCABULARY)


def test_held_out_accuracy(spark, learned):
    rows, docs, _, model = learned
    got = {r.doc_id: r for r in T.score(docs, model).withColumn("out", held_out(T.F.col("doc_id"))).collect()}
    for i, _, y in rows:
        assert got[i].out == (fold(i) == 0)
        assert 0.0 <= got[i].score <= 1.0
        assert got[i].predicted == int(got[i].score >= 0.5)
    held = [(got[i].predicted, y) for i, _, y in rows if fold(i) == 0]
    assert np.mean([p == y for p, y in held]) > 0.97


def test_scores_equal_plain_python(spark, learned):
    """Brute force: edit distances word by word, the curve by hand."""
    rows, docs, _, model = learned
    got = {r.doc_id: r.score for r in T.score(docs.where("doc_id < 150"), model).collect()}
    for i, text, _ in rows[:150]:
        words = T.WORD.findall(text.lower())
        values = [max((model.weights[m] for m in matches(w, model.entries)), default=0.0) for w in words]
        total, largest = np.log1p(sum(values)), max(values)
        a, b, c = model.curve
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(a * total + b * largest + c))), abs=1e-9)


def test_misspelled_words_are_caught(spark, learned):
    _, _, _, model = learned
    texts = ["you blokhead bando kelfel", "you scoundrl bando", "a scuondrel bando", "bando kelfel tishu"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.score for r in T.score(df, model).select("score").collect()]
    assert got[0] > 0.5 and got[1] > 0.5
    assert 0.5 > got[2] > got[3]  # two edits weigh less than one, and more than none


def test_context_separates_quotation_from_abuse(learned):
    _, _, _, model = learned
    abuse = T.measure("you are a nitwit and bando", model)
    plain = T.measure("bando is a nitwit and bando", model)
    quoted = T.measure('bando kelfel "nitwit" bando', model)
    reported = T.measure('the word “nitwit” was said', model)
    after = T.measure('"bando" nitwit "kelfel"', model)
    assert abuse[0] > plain[0] > quoted[0] > reported[0] > 0
    assert after[0] == plain[0]


def test_texts_without_words_and_odd_rows(spark, learned):
    _, _, _, model = learned
    long = "bando " * 200_000 + "nitwit " * 3
    rows = [(1, None), (2, ""), (3, "123 ..."), (None, "nitwit"), (4, long), (4, long)]
    df = spark.createDataFrame([(*r, 9.0, 7, "m") for r in rows],
                               "doc_id long, text string, score double, predicted int, matches string")
    got = T.score(df, model).collect()
    assert len(got) == len(rows)
    empty = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert all(r.matches == 3 for r in got if r.doc_id == 4)
    assert T.score(df.where("false"), model).collect() == []


@pytest.mark.parametrize("labelled,expected", [([], 0.5), ([(1, 1), (2, 1), (3, 1)], None),
                                               ([(1, None), (2, 5)], 0.5)])
def test_one_class_or_none(spark, labelled, expected):
    docs = spark.createDataFrame([(i, "nitwit") for i in range(9)], "doc_id long, text string")
    labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
    scores = {r.score for r in T.score(docs, T.fit(docs, labels)).collect()}
    assert len(scores) == 1
    known = sum(fold(i) != 0 for i, y in labelled if y == 1)
    assert scores.pop() == pytest.approx(expected if expected else (known + 1) / (known + 2))


def test_held_out_rows_teach_nothing(spark, learned):
    rows, docs, labels, model = learned
    turned = spark.createDataFrame(
        [(i, 1 - y if fold(i) == 0 else y) for i, _, y in rows], "doc_id long, toxic int")
    again = T.fit(docs, turned)
    assert again.entries == model.entries and again.curve == pytest.approx(model.curve)
