"""Language identification and quality by compression: held-out accuracy."""

import zlib

import pytest
from pyspark.sql import functions as F

from gridwise.llm import langid, quality
from gridwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_held_out_accuracy(spark, documents):
    rows = (QUERIES["op10_language_id"](spark, SF)
            .join(documents.select("doc_id", "lang"), "doc_id").toPandas())
    assert len(rows) == documents.count()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows["doc_id"]]).all()
    assert rows["score"].between(0, 1).all()
    held = rows[rows["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert rows["rejected"].mean() < 0.02


def test_language_defined_results(spark):
    train = spark.createDataFrame([("the cat and the dog " * 9, "en"), ("der hund und die katze " * 9, "de"),
                                   (None, "fr"), ("x", None)], "text string, lang string")
    model = langid.fit(train)
    assert model.langs == ("de", "en")
    docs = spark.createDataFrame(
        [(1, "und die katze der hund", "a"), (2, None, "b"), (3, "", "c"), (4, "12 34 !!", "d"),
         (5, "the dog and the cat " * 40000, "e"), (1, "und die katze der hund", "a")],
        "doc_id long, text string, score string")
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5)] == ["de", "und", "und", "und", "en"]
    assert got[2].score == 0 and got[2].rejected and got[4].rejected and not got[1].rejected
    none = langid.fit(train.where("false"))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.where("false"), model).count() == 0


def test_language_sample_does_not_shrink_with_copies(spark):
    copies = spark.range(4000).selectExpr("'die katze und der hund' as text", "'de' as lang")
    others = spark.range(30).selectExpr("concat('der text hat nummer ', id) as text", "'de' as lang")
    few = spark.createDataFrame([("the cat and the dog", "en")], "text string, lang string")
    rare = few.unionByName(spark.range(4000).selectExpr("'the cat' as text", "'en' as lang"))
    model = langid.fit(copies.unionByName(others).unionByName(rare), texts_per_lang=5)
    assert model.langs == ("de", "en")
    assert [len(d.split(b"\n")) for d in model.dictionaries] == [5, 2]


def test_language_equal_sizes_go_to_the_smaller_value():
    import numpy as np

    assert langid.decide(np.array([7.0, 5.0, 5.0]))[0] == 1
    assert langid.decide(np.array([5.0, 5.0]))[2] == 0.0


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op6_quality"](spark, SF).join(labels, "doc_id").toPandas()
    assert rows["score"].between(0, 1).all()
    assert (rows["predicted"] == (rows["score"] >= 0.3)).all()
    held = rows[rows["held_out"]]
    good, bad = held[held["quality"] == 1], held[held["quality"] == 0]
    assert (good["predicted"] == 1).mean() > 0.97
    assert (bad["predicted"] == 0).mean() > 0.8
    # the score is a probability: its mean is near the share of label 1
    assert abs(held["score"].mean() - held["quality"].mean()) < 0.05


def test_quality_defined_results(spark):
    docs = spark.createDataFrame([(i, f"good words here {i} " * 5) for i in range(40)]
                                 + [(100 + i, f"$$ %% ** {i} " * 5) for i in range(40)]
                                 + [(None, "x"), (500, None), (501, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)]
                                   + [(None, 0), (7, None), (8, 5)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert got[1] > 0.8 > 0.2 > got[101]
    assert got[500] == got[501]
    one = quality.fit(docs, labels.where("quality = 1"))
    assert len({r.score for r in quality.score(docs, one).collect()}) == 1
    none = quality.fit(docs, labels.where("false"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.where("false"), model).count() == 0


def test_quality_sample_is_cut_by_ids(spark):
    docs = spark.createDataFrame([(i, f"good words here {i} " * 5) for i in range(40)]
                                 + [(100 + i, f"$$ %% ** {i} " * 5) for i in range(40)],
                                 "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id < 100) as quality")
    settings = {"pieces_per_class": 12, "curve_texts_per_class": 8}
    want = quality.fit(docs, labels, **settings)
    assert want.slope != 0
    copied = docs.withColumn("copy", F.explode(F.sequence(
        F.lit(0), F.when(F.col("doc_id") < 100, 60).otherwise(0)))).drop("copy").repartition(4)
    assert quality.fit(copied, labels, **settings) == want
    again = quality.fit(docs, labels.crossJoin(spark.range(30)).drop("id"), **settings)
    assert (again.bad, again.good) == (want.bad, want.good)
