"""Toxicity by a lexicon matched with Levenshtein automata, weighted by context.

The lexicon is learned from labelled texts: words, and stems (word beginnings
with several endings), whose texts are toxic far more often than others are.
Its trie is intersected with Levenshtein automata: a state holds the trie nodes
reachable with the letters read so far and the fewest edits for each; states are
determinised as words ask for them and remembered.  A word thus matches each
entry within the edits its length allows (see ``Entry.edits``).  Entry and
number of edits have a weight, the smoothed log odds of the labelled
texts' places that hold such words; a misspelling never seen gets half the weight per edit.

Each match is weighted by its context window: less between quotation marks or
next to words that report speech, more next to words that address a person.  The
logarithm of the sum and the largest single weight of a text go through a
logistic curve fitted on other labelled texts, weighted to the class shares.

Defined results: null and empty texts have no match and get the curve's value
there.  Rows without an id are held out.  With labels of one class only, or none,
every score is the smoothed share of label 1 (0.5 without labels).  Label values
other than 0 and 1 are ignored; an id gives one text to the sample, and equal
texts one.  Texts are read whole, however long.  Extra columns pass through
``score``; columns named score or predicted are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.llm.common import held_out, table

THRESHOLD = 0.5
WORD = re.compile(r"[^\W\d_]+")
WINDOW_WORDS = 6
WINDOW_CHARS = 60
QUOTED, REPORTED, ADDRESSED = 0.4, 0.6, 1.3
OPENING, CLOSING = "\"“„«‹", "\"”“»›"
REPORTING = frozenset(
    "said says saying quote quoted quotes called wrote writes word words term insult insults "
    "sagte sagt nannte schrieb wort dit disait mot dijo dice palabra llamado".split())
ADDRESSING = frozenset(
    "you your yours yourself du dich dein deine ihr euch tu te toi vous votre usted ustedes".split())
MAX_REMEMBERED = 200_000


@dataclass(frozen=True)
class Entry:
    text: str
    stem: bool

    @property
    def edits(self) -> int:
        """Edits within which a word matches: short entries none, long ones two;
        a stem one less, as its word may go on freely."""
        size = len(self.text)
        return max(0, (size >= 5) + (size >= 8) - self.stem)


class Automaton:
    """The lexicon's trie intersected with Levenshtein automata."""

    def __init__(self, entries: list[Entry], limit: int = MAX_REMEMBERED):
        self.entries, self.limit = entries, limit
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.reach = [0]  # most edits of an entry at or below the node
        for number, entry in enumerate(entries):
            node = 0
            self.reach[0] = max(self.reach[0], entry.edits)
            for letter in entry.text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], entry.edits)
            self.ends[node].append(number)
        self._forget()

    def _forget(self) -> None:
        """(Re)start the remembered states; state 0 is the start."""
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.words: dict[str, tuple] = {}
        self._number(self._closed({0: 0}), {})

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the nodes that skipping letters of the entry reaches."""
        todo = list(nodes.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits + 1 <= self.reach[child] and edits + 1 < nodes.get(child, 99):
                    nodes[child] = edits + 1
                    todo.append((child, edits + 1))
        return nodes

    def _number(self, nodes: dict[int, int], stems: dict[int, int]) -> int:
        stems = dict(stems)
        for node, edits in nodes.items():
            for entry in self.ends[node]:
                allowed = self.entries[entry]
                if allowed.stem and edits <= allowed.edits and edits < stems.get(entry, 99):
                    stems[entry] = edits
        state = tuple(sorted(nodes.items())), tuple(sorted(stems.items()))
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        return number

    def _step(self, number: int, letter: str) -> int:
        """The state after ``letter``: a match, another letter instead, or one more."""
        nodes, stems = self.states[number]
        after: dict[int, int] = {}
        for node, edits in nodes:
            if edits + 1 <= self.reach[node]:
                after[node] = min(after.get(node, 99), edits + 1)
            for on, child in self.children[node].items():
                cost = edits + (on != letter)
                if cost <= self.reach[child]:
                    after[child] = min(after.get(child, 99), cost)
        target = self._number(self._closed(after), dict(stems))
        self.steps[number][letter] = target
        return target

    def matches(self, word: str) -> tuple[tuple[int, int], ...]:
        """(entry, edits) of every entry that ``word`` matches."""
        known = self.words.get(word)
        if known is not None:
            return known
        if len(self.words) + len(self.states) > self.limit:
            self._forget()
        number = 0
        for letter in word:
            after = self.steps[number].get(letter)
            number = self._step(number, letter) if after is None else after
            if not self.states[number][0]:
                break  # no entry is in reach any more
        nodes, stems = self.states[number]
        found = dict(stems)
        for node, edits in nodes:
            for entry in self.ends[node]:
                allowed = self.entries[entry]
                if not allowed.stem and edits <= allowed.edits:
                    found[entry] = min(found.get(entry, 99), edits)
        out = tuple(sorted(found.items()))
        if len(word) <= 64:
            self.words[word] = out
        return out


@dataclass
class ToxicityModel:
    entries: list[Entry]
    weights: dict[tuple[int, int], float]  # (entry, edits) -> weight
    curve: tuple[float, float, float]  # of log1p(sum), of the largest, constant
    _automaton: Automaton | None = field(default=None, repr=False, compare=False)

    @property
    def automaton(self) -> Automaton:
        if self._automaton is None:
            self._automaton = Automaton(self.entries)
        return self._automaton

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def weight(self, word: str) -> float:
        """The largest weight among the entries that ``word`` matches."""
        return max((self.weights.get(m, 0.0) for m in self.automaton.matches(word)), default=0.0)


def context_factor(text: str, words: list[str], at: int, start: int, end: int) -> float:
    """Weight of the context of the word ``words[at]`` = ``text[start:end]``."""
    near = set(words[max(0, at - WINDOW_WORDS):at] + words[at + 1:at + 1 + WINDOW_WORDS])
    factor = 1.0
    before, after = text[max(0, start - WINDOW_CHARS):start], text[end:end + WINDOW_CHARS]
    opened = max((before.rfind(c) for c in OPENING), default=-1)
    shut = max((before.rfind(c) for c in CLOSING if c not in OPENING), default=-1)
    # a mark that opens and closes alike opens when its number before the word is odd
    alike = before[opened] if opened >= 0 and before[opened] in CLOSING else ""
    is_open = opened > shut and (not alike or before.count(alike) % 2 == 1)
    if is_open and any(c in after for c in CLOSING):
        factor *= QUOTED
    if near & REPORTING:
        factor *= REPORTED
    if near & ADDRESSING:
        factor *= ADDRESSED
    return factor


def measure(text: str | None, model: ToxicityModel) -> tuple[float, float, int]:
    """(log1p of the sum, largest, number) of the weighted matches of the whole text."""
    if not text:
        return 0.0, 0.0, 0
    lowered = text.lower()
    words = WORD.findall(lowered)
    hits = {w: v for w in set(words) if (v := model.weight(w)) > 0}
    if not hits:
        return 0.0, 0.0, 0
    total = largest = 0.0
    count = 0
    for at, found in enumerate(WORD.finditer(lowered)):
        value = hits.get(found.group())
        if value:
            value *= context_factor(lowered, words, at, found.start(), found.end())
            total, largest, count = total + value, max(largest, value), count + 1
    return float(np.log1p(total)), largest, count


def measured(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with _total, _largest and _matches of each text."""

    @F.pandas_udf("total double, largest double, matches bigint")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([measure(t, model) for t in texts],
                               columns=["total", "largest", "matches"])

    return (docs.withColumn("_m", features(F.col("text")))
            .select(*docs.columns, F.col("_m.total").alias("_total"),
                    F.col("_m.largest").alias("_largest"), F.col("_m.matches").alias("_matches")))


def curve_fit(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-3,
              rounds: int = 60) -> tuple[float, ...]:
    """Coefficients (one per column of ``x``, then the constant) of a weighted
    logistic regression with a small ridge, by Newton's method."""
    mean, scale = x.mean(axis=0), np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    beta = np.zeros(a.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [0.0])
    w = w / w.sum()
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ beta, -35, 35)))
        gradient = a.T @ (w * (y - p)) - penalty @ beta
        hessian = (a * (w * p * (1 - p))[:, None]).T @ a + penalty + 1e-9 * np.eye(len(beta))
        step = np.clip(np.linalg.solve(hessian, gradient), -3, 3)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    slopes = beta[:-1] / scale
    return (*map(float, slopes), float(beta[-1] - (slopes * mean).sum()))


def _log_odds(bad: Column, clean: Column, bad_all: int, clean_all: int) -> Column:
    return (F.log((bad + 0.5) / (bad_all + 1.0)) - F.log((clean + 0.5) / (clean_all + 1.0)))


def _words_by_label(texts: DataFrame) -> DataFrame:
    """(word, bad, clean): in how many contexts (the words before and after) each word
    occurs in toxic and in other texts.  A passage that many copies share counts once."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for text, toxic in zip(part["text"], part["toxic"]):
                words = WORD.findall(text.lower())
                places = set(zip(words, ["", *words], [*words[1:], ""]))
                yield pd.DataFrame([(w, f"{x} {y}", toxic) for w, x, y in places],
                                   columns=["word", "place", "toxic"])

    return (texts.select("text", "toxic").mapInPandas(rows, "word string, place string, toxic int")
            .distinct().groupBy("word").agg(F.sum("toxic").alias("bad"),
                                            F.sum(1 - F.col("toxic")).alias("clean")))


def choose_entries(words: DataFrame, bad_all: int, clean_all: int, max_entries: int,
                   least_log_odds: float, least_ratio: float) -> list[Entry]:
    """The words and stems with log odds of ``least_log_odds`` and a likelihood ratio
    (G squared) of ``least_ratio`` at least, best ratio first, at most ``max_entries``.

    A stem has 4 to 8 letters and at least three words.  What a better stem
    covers is left out.
    """
    whole = words.select("word", F.lit(False).alias("stem"), "bad", "clean")
    ends = F.sequence(F.lit(4), F.least(F.length("word") - 1, F.lit(8)))
    stems = (words.where((F.length("word") > 4) & (F.col("bad") > 0))
             .select("word", F.explode(ends).alias("size"))
             .select(F.expr("substring(word, 1, size)").alias("stem_text")).distinct())
    sized = (words.where(F.length("word") > 4)
             .select("bad", "clean", "word", F.explode(ends).alias("size"))
             .select(F.expr("substring(word, 1, size)").alias("stem_text"), "bad", "clean"))
    stems = (sized.join(stems, "stem_text", "left_semi").groupBy("stem_text")
             .agg(F.sum("bad").alias("bad"), F.sum("clean").alias("clean"),
                  F.count(F.lit(1)).alias("words")).where("words >= 3")
             .select(F.col("stem_text").alias("word"), F.lit(True).alias("stem"), "bad", "clean"))
    odds = _log_odds(F.col("bad"), F.col("clean"), bad_all, clean_all)
    share = bad_all / (bad_all + clean_all)

    def term(seen: str, part: float) -> Column:
        return F.when(F.col(seen) > 0, F.col(seen) * F.log(
            F.col(seen) / ((F.col("bad") + F.col("clean")) * part))).otherwise(0.0)

    ranked = (whole.unionByName(stems).where(F.length("word").between(3, 24))
              .withColumn("odds", odds)
              .withColumn("ratio", 2 * (term("bad", share) + term("clean", 1 - share)))
              .where((F.col("odds") >= least_log_odds) & (F.col("ratio") >= least_ratio))
              .orderBy(F.desc("ratio"), "word", "stem").limit(20 * max_entries).collect())
    chosen: list[Entry] = []
    covering: set[str] = set()
    for row in ranked:
        if any(row["word"][:size] in covering for size in range(4, len(row["word"]) + 1)):
            continue
        chosen.append(Entry(row["word"], row["stem"]))
        if row["stem"]:
            covering.add(row["word"])
        if len(chosen) == max_entries:
            break
    return chosen


def match_weights(words: DataFrame, entries: list[Entry], bad_all: int, clean_all: int
                  ) -> dict[tuple[int, int], float]:
    """Weight of every (entry, edits): log odds of the words that match so, smoothed
    by one toxic text at the weight expected (the exact one, halved per edit)."""
    automaton = Automaton(entries)

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = [(e, d, b, c) for w, b, c in zip(part["word"], part["bad"], part["clean"])
                   for e, d in automaton.matches(w)]
            yield pd.DataFrame(out, columns=["entry", "edits", "bad", "clean"]).astype("int64")

    # at most three rows per entry
    counts = {(r["entry"], r["edits"]): (r["bad"], r["clean"]) for r in
              words.mapInPandas(rows, "entry bigint, edits bigint, bad bigint, clean bigint")
              .groupBy("entry", "edits").agg(F.sum("bad").alias("bad"), F.sum("clean").alias("clean"))
              .collect()}
    ratio = (clean_all + 1.0) / (bad_all + 1.0)
    weights = {}
    for number, entry in enumerate(entries):
        bad, clean = counts.get((number, 0), (0, 0))
        exact = max(0.0, float(np.log((bad + 0.5) / (clean + 0.5) * ratio)))
        weights[number, 0] = exact
        for edits in range(1, entry.edits + 1):
            bad, clean = counts.get((number, edits), (0, 0))
            expected = np.exp(-exact * 0.5 ** edits) * ratio
            weights[number, edits] = max(0.0, float(np.log((bad + 1.0) / (clean + expected) * ratio)))
    return weights


def fit(docs: DataFrame, labels: DataFrame, texts_per_class: int = 12_000,
        curve_share: float = 0.4, max_entries: int = 300, least_log_odds: float = 1.5,
        least_ratio: float = 25.0) -> ToxicityModel:
    """Learn from the labelled rows outside the held-out fold.

    Bounded sample, by parameter: the texts of the ``texts_per_class`` labelled ids
    of each class that come first by hash; ``curve_share`` of them fit the curve, the
    others the lexicon and its weights.  Class shares count all training labels.
    """
    known = (labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
             .select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in
              known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean_n, bad_n = counts.get(0, 0), counts.get(1, 0)
    prior = (0.0, 0.0, float(np.log((bad_n + 1) / (clean_n + 1))))
    if not bad_n or not clean_n:
        return ToxicityModel([], {}, prior)
    ids = [known.where(F.col("toxic") == c).distinct()
           .withColumn("k", F.xxhash64("doc_id")).orderBy("k", "doc_id").limit(texts_per_class)
           for c in (0, 1)]
    # at most 2 * texts_per_class small rows are broadcast
    drawn = docs.where("text is not null").select("doc_id", "text").join(
        F.broadcast(ids[0].unionByName(ids[1])), "doc_id")
    curve = F.pmod(F.xxhash64("h"), F.lit(1000)) < int(1000 * curve_share)
    texts = (drawn.groupBy(F.xxhash64("text").alias("h"), "toxic").agg(F.min("text").alias("text"))
             .withColumn("curve", curve)).persist()
    try:
        sizes = {(r["curve"], r["toxic"]): r["n"] for r in
                 texts.groupBy("curve", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not sizes.get((False, 1)) or not sizes.get((False, 0)):
            return ToxicityModel([], {}, prior)
        words = _words_by_label(texts.where(~F.col("curve"))).persist()
        bad_all, clean_all = words.agg(F.sum("bad"), F.sum("clean")).first()
        entries = choose_entries(words, bad_all, clean_all, max_entries, least_log_odds, least_ratio)
        weights = match_weights(words, entries, bad_all, clean_all)
        words.unpersist()
        model = ToxicityModel(entries, weights, prior)
        # at most 2 * texts_per_class rows of four numbers
        found = (measured(texts.where("curve"), model).select("toxic", "_total", "_largest", "h")
                 .orderBy("h", "toxic").toPandas())
    finally:
        texts.unpersist()
    y = found["toxic"].to_numpy(dtype=float)
    n_clean, n_bad = int((y == 0).sum()), int((y == 1).sum())
    if not n_clean or not n_bad:
        return model
    w = np.where(y == 1, bad_n / n_bad, clean_n / n_clean)
    model.curve = curve_fit(found[["_total", "_largest"]].to_numpy(), y, w)
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with score (probability of label 1), predicted and matches added."""
    of_total, of_largest, constant = model.curve
    keep = [c for c in docs.columns if c not in ("score", "predicted", "matches")]
    value = 1 / (1 + F.exp(-(of_total * F.col("_total") + of_largest * F.col("_largest") + constant)))
    return (measured(docs.select(*keep), model)
            .select(*keep, value.alias("score"), F.col("_matches").alias("matches"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
