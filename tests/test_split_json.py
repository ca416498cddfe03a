"""Large layer documents read in splits, against whole files and json.loads."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gridwise.sources.areas import read_area_layer
from gridwise.sources.split_json import list_texts


@pytest.fixture
def small_splits(spark):
    """Splits of a few dozen bytes, one a task."""
    names = {"spark.sql.files.maxPartitionBytes": "41", "spark.sql.files.openCostInBytes": "41"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def feature(rng, i):
    odd = rng.choice(['}', '{"', '\\', '\\"', '"}],"features":[{', "é}ü", "", "a\nb", "\\\\"])
    return {"type": "Feature", "id": i,
            "properties": {"Code": f"c{i}", "odd": odd, "deep": {"list": [{"x": [1, {}]}, "}"]}},
            "geometry": {"type": "Point", "coordinates": [i, rng.randint(0, 9)]}}


def written(tmp_path, docs, **dump):
    for i, doc in enumerate(docs):
        text = doc if isinstance(doc, str) else json.dumps(doc, **dump)
        (tmp_path / f"layer{i}.geojson").write_text(text, encoding="utf-8")
    return str(tmp_path)


@pytest.mark.parametrize("dump", [{}, {"indent": 1}, {"indent": 4, "ensure_ascii": False},
                                  {"separators": (",", ":")}])
def test_features_equal_the_document(spark, small_splits, tmp_path, dump):
    rng = random.Random(len(dump))
    docs = [{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "}"}},
             "features": [feature(rng, 100 * d + i) for i in range(size)],
             "links": [{"rel": "}]"}, {"rel": "x"}]} for d, size in enumerate([0, 1, 17, 3])]
    path = written(tmp_path, docs, **dump)
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
    got = sorted(json.loads(r.value)["id"] for r in list_texts(spark, path, "features").collect()
                 if json.loads(r.value).get("type") == "Feature")
    assert got == sorted(f["id"] for d in docs for f in d["features"])
    texts = {json.loads(r.value).get("id"): json.loads(r.value)
             for r in list_texts(spark, path, "features").collect()}
    for d in docs:
        for f in d["features"]:
            assert texts[f["id"]] == f


def test_layer_equals_whole_files(spark, small_splits, tmp_path):
    rng = random.Random(7)
    docs = [{"type": "FeatureCollection", "features": [feature(rng, i) for i in range(25)]},
            {"features": [feature(rng, 50)], "type": "FeatureCollection"}]
    path = written(tmp_path, docs, indent=2)
    key = lambda r: r.properties["code"]
    whole = sorted(read_area_layer(spark, path, whole_files=True).collect(), key=key)
    split = sorted(read_area_layer(spark, path, split=True).collect(), key=key)
    assert split == whole and len(split) == 26


def test_text_without_list_or_end(spark, small_splits, tmp_path):
    path = written(tmp_path, ['{"type": "FeatureCollection", "features": [{"type": "Feature", '
                              '"properties": {"a": 1}, "geometry": null}, {"type": "Feat'])
    got = read_area_layer(spark, path, split=True, mode="permissive").collect()
    assert [r.properties for r in got] == [{"a": "1"}]
    with pytest.raises(Exception, match="ends too early"):
        read_area_layer(spark, path, split=True).collect()


@pytest.mark.parametrize("text", ["", "\n", '{"type": "FeatureCollection", "features": []}\n', "{}"])
def test_documents_without_features(spark, tmp_path, text):
    assert read_area_layer(spark, written(tmp_path, [text]), split=True).collect() == []


def test_many_tasks_read_one_file(spark, tmp_path):
    """No task puts together more than its share of the file."""
    rng = random.Random(1)
    doc = {"type": "FeatureCollection", "features": [feature(rng, i) for i in range(3000)]}
    path = written(tmp_path, [doc], indent=1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "65536")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        texts = list_texts(spark, path, "features")
        per_task = texts.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in texts.groupBy().count().collect()) == 3000
        assert len(per_task) > 1 and max(r["count"] for r in per_task) < 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", "4194304")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
