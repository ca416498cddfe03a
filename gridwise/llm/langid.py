"""Language identification by compression.

A text is compressed once per language with a Zstandard compressor primed
with raw text of that language; the language whose dictionary gives the fewest
bytes wins.  The decision is rejected when the runner-up comes within a narrow
margin.

Defined results: a null text or one without any letter is ``und`` with score
0 and is rejected.  Equal sizes go to the smaller language value.  With no
labelled rows at all every text is ``und``.  Texts of any length are compressed
whole, block by block; case is folded first, so capitals are no evidence.  Extra columns pass through; columns named like an
output of ``identify`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwise.llm.common import held_out, table

UNKNOWN = "und"
OUTPUTS = ("lang_pred", "score", "margin", "rejected")


@dataclass(frozen=True)
class LanguageModel:
    """Raw-content dictionaries by language, in order of the language value."""

    langs: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    level: int = 5
    block_bytes: int = 4096
    min_margin: float = 0.004


def fit(train: DataFrame, texts_per_lang: int = 2000, piece_chars: int = 300,
        **settings) -> LanguageModel:
    """Dictionaries from the rows (text, lang) of ``train``.

    The bounded sample: about ``4 * texts_per_lang`` distinct texts of a
    language are drawn by hash, the first ``texts_per_lang`` of them in hash
    order each give one piece of ``piece_chars`` characters.  Counting the
    distinct texts per language covers all data; the count is approximate (a few
    percent), which the factor 4 makes up for, and copies do not change it.
    """
    train = train.where("text is not null and lang is not null and length(trim(text)) > 0")
    counts = {r["lang"]: r["n"] for r in
              train.groupBy("lang").agg(F.approx_count_distinct("text").alias("n")).collect()}
    if not counts:
        return LanguageModel((), (), **settings)
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items())
                           for x in (k, int(min(1.0, 4 * texts_per_lang / n) * (1 << 30)))])
    key = F.xxhash64("text")
    offset = F.pmod(key, F.greatest(F.length("text") - piece_chars, F.lit(0)) + 1)
    drawn = (train.where(F.pmod(key, F.lit(1 << 30)) < share[F.col("lang")])
             .select("lang", key.alias("k"),
                     F.substring(F.col("text"), (offset + 1).cast("int"),
                                 F.lit(piece_chars)).alias("piece"))
             .groupBy("lang", "k").agg(F.min("piece").alias("piece")))
    first = drawn.withColumn("r", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.col("k"))))
    rows = first.where(F.col("r") <= texts_per_lang).select("lang", "r", "piece").collect()
    pieces: dict[str, list[tuple[int, str]]] = {}
    for row in rows:
        pieces.setdefault(row["lang"], []).append((row["r"], row["piece"]))
    langs = tuple(sorted(pieces))
    return LanguageModel(langs, tuple(folded("\n".join(p for _, p in sorted(pieces[k])))
                                      for k in langs), **settings)


def folded(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=primed, level=level, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


def compressed_size(packer: zstandard.ZstdCompressor, data: bytes, block: int) -> int:
    """Bytes of ``data`` compressed in blocks that each start from the dictionary."""
    return sum(len(packer.compress(data[i:i + block])) for i in range(0, len(data), block))


def decide(sizes: np.ndarray) -> tuple[int, float, float]:
    """(index of the winner, score, margin) for the sizes by language."""
    best = int(np.argmin(sizes))
    if len(sizes) == 1:
        return best, 1.0, 1.0
    spread = (sizes - sizes[best]) / max(1.0, float(sizes[best]))
    others = np.delete(spread, best)
    return best, float(1.0 / np.exp(-spread * 50.0).sum()), float(others.min())


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1), margin and rejected added."""
    keep = [c for c in docs.columns if c not in OUTPUTS]
    if not model.langs:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0.0).alias("margin"), F.lit(True).alias("rejected"))

    @F.pandas_udf("best int, score double, margin double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        packers = [compressor(d, model.level) for d in model.dictionaries]
        for texts in batches:
            out = []
            for text in texts:
                data = folded(text or "")
                sizes = np.array([compressed_size(p, data, model.block_bytes) for p in packers],
                                 dtype=float)
                out.append(decide(sizes))
            yield pd.DataFrame(out, columns=["best", "score", "margin"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    # a text without letters goes through as empty: it costs nothing and is decided below
    found = docs.select(*keep, lettered.alias("_lettered"),
                        classify(F.when(lettered, F.col("text"))).alias("_c"))
    names = F.array(*[F.lit(x) for x in model.langs])
    none = ~F.col("_lettered")
    return found.select(
        *keep,
        F.when(none, UNKNOWN).otherwise(F.get(names, F.col("_c.best"))).alias("lang_pred"),
        F.when(none, 0.0).otherwise(F.col("_c.score")).alias("score"),
        F.when(none, 0.0).otherwise(F.col("_c.margin")).alias("margin"),
        (none | (F.col("_c.margin") < model.min_margin)).alias("rejected"))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out(F.col("doc_id"))).select("text", "lang")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(training_rows(docs))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
        "margin", "rejected")
