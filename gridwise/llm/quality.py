"""Quality classifier by compression.

Two Zstandard raw-content dictionaries are built from pieces of good and of
bad labelled texts.  A text is compressed whole with each; the difference of
the two sizes divided by the bytes of the text is mapped to a probability by a
logistic curve fitted on other labelled texts (Platt scaling), weighted so
that the sample has the class shares of all training rows.

Defined results: null and empty texts have difference 0 and get the curve's
value there.  Rows without an id are held out.  With labels of one class only,
or none, every score is the smoothed share of label 1 (0.5 without labels).
Repeated labels count as often as they occur in the class shares; an id gives
one text to the sample however often it occurs.  Label values other than 0 and 1
are ignored.  Extra columns pass through ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.llm.common import held_out, table
from gridwise.llm.langid import compressed_size, compressor

THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    bad: bytes
    good: bytes
    slope: float
    intercept: float
    level: int = 6
    block_bytes: int = 2048


def logistic_fit(x: np.ndarray, y: np.ndarray, w: np.ndarray,
                 ridge: float = 1e-3, rounds: int = 50) -> tuple[float, float]:
    """(slope, intercept) of a weighted logistic regression on one feature,
    by Newton's method on the standardised feature."""
    mean, scale = x.mean(), x.std() or 1.0
    a = np.stack([(x - mean) / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    penalty = np.diag([ridge, 0.0])
    w = w / w.sum()
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ beta, -35, 35)))
        gradient = a.T @ (w * (y - p)) - penalty @ beta
        hessian = (a * (w * p * (1 - p))[:, None]).T @ a + penalty + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * mean / scale)


def difference(docs: DataFrame, bad: bytes, good: bytes, level: int, block: int) -> DataFrame:
    """``docs`` with the normalised size difference of each whole text."""

    @F.pandas_udf("double")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        packers = compressor(bad, level), compressor(good, level)
        for texts in batches:
            out = []
            for text in texts:
                data = (text or "").encode("utf-8", "surrogatepass")
                b, g = (compressed_size(p, data, block) for p in packers)
                out.append((b - g) / max(1, len(data)))
            yield pd.Series(out, dtype="float64")

    keep = [c for c in docs.columns if c != "difference"]
    return docs.select(*keep, measure(F.col("text")).alias("difference"))


def fit(docs: DataFrame, labels: DataFrame, pieces_per_class: int = 3500,
        piece_chars: int = 300, curve_texts_per_class: int = 1500,
        level: int = 6, block_bytes: int = 2048) -> QualityModel:
    """Learn from the labelled rows outside the held-out fold.

    Bounded sample, by parameter: the labelled ids that come first by hash,
    ``pieces_per_class`` of each class for the dictionaries (one piece of
    ``piece_chars`` characters each, at an offset set by the text's hash) and
    the next ``curve_texts_per_class`` whole texts for the curve.  Of an id with
    several texts the one with the smallest hash is drawn.  Class shares count all
    training labels.
    """
    known = (labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
             .select("doc_id", "quality"))
    counts = {r["quality"]: r["n"] for r in
              known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad_n, good_n = counts.get(0, 0), counts.get(1, 0)
    prior = float(np.log((good_n + 1) / (bad_n + 1)))
    if not bad_n or not good_n:
        return QualityModel(b"bad", b"good", 0.0, prior, level, block_bytes)
    wanted = pieces_per_class + curve_texts_per_class
    ids = [known.where(F.col("quality") == c).distinct()
           .select("doc_id", "quality", F.xxhash64("doc_id").alias("k"))
           .orderBy("k", "doc_id").limit(wanted) for c in (0, 1)]
    # of every five drawn ids (by hash, so independent of class) some draw the curve
    curve_share = curve_texts_per_class / wanted
    chosen = ids[0].unionByName(ids[1]).withColumn(
        "curve", F.pmod(F.xxhash64("k"), F.lit(1000)) < int(curve_share * 1000))
    offset = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - piece_chars, F.lit(0)) + 1)
    piece = F.substring(F.col("text"), (offset + 1).cast("int"), F.lit(piece_chars))
    # at most 2 * wanted small rows are broadcast
    drawn = docs.where("text is not null").select("doc_id", "text").join(
        F.broadcast(chosen), "doc_id")

    def one_each(curve: bool, value) -> DataFrame:
        """One row (quality, k, value) of each drawn id, so at most 2 * wanted."""
        return (drawn.where(F.col("curve") == curve)
                .groupBy("quality", "doc_id", "k")
                .agg(F.min(F.struct(F.xxhash64("text").alias("h"), value.alias("value"))).alias("m"))
                .select("quality", "k", F.col("m.value").alias("text")))

    rows = one_each(False, piece).orderBy("k", "text").limit(2 * wanted).collect()
    content = ["\n".join(r["text"] for r in rows if r["quality"] == c).encode() or b"-"
               for c in (0, 1)]
    curve = (difference(one_each(True, F.col("text")), *content, level, block_bytes)
             .select("quality", "k", "difference").orderBy("k", "quality", "difference")
             .limit(2 * wanted).toPandas())
    y = curve["quality"].to_numpy(dtype=float)
    n_bad, n_good = int((y == 0).sum()), int((y == 1).sum())
    if not n_bad or not n_good:
        return QualityModel(*content, 0.0, prior, level, block_bytes)
    w = np.where(y == 1, good_n / n_good, bad_n / n_bad)
    slope, intercept = logistic_fit(curve["difference"].to_numpy(), y, w)
    return QualityModel(*content, slope, intercept, level, block_bytes)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with score (probability of label 1) and predicted added."""
    measured = difference(docs, model.bad, model.good, model.level, model.block_bytes)
    keep = [c for c in docs.columns if c not in ("score", "predicted", "difference")]
    value = 1 / (1 + F.exp(-(F.lit(model.slope) * F.col("difference") + model.intercept)))
    return (measured.select(*keep, value.alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
