"""Loading landed round documents without loss."""

import json

import pytest
from pyspark.sql import functions as F

from gridwise.operators import shape
from gridwise.operators.round_text import round_text_problems
from gridwise.plans.loaders import landed_rounds
from gridwise.sources.documents import read_json_text, write_json_text


def land(spark, docs):
    texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    return write_json_text(spark, texts, "rounds-test")


def inspection(geometry, results=None, **more):
    return {"closingUserDisplayName": "c", "location": {"geoJsonFeature": {"geometry": geometry}},
            "results": results or [{"creatingUserDisplayName": "u", "score": 1}], **more}


POINT = {"type": "Point", "coordinates": [4.9, 52.3]}
SQUARE = {"type": "Polygon", "coordinates": [[[4, 52], [5, 52], [5, 53], [4, 52]]]}


def test_geometries_of_mixed_types_stay_numbers(spark):
    path = land(spark, [{"id": 1, "inspections": [inspection(POINT), inspection(SQUARE)]},
                        {"id": 2, "inspections": [inspection(None)]}])
    rows = landed_rounds(spark, path).orderBy("idx").collect()
    assert [json.loads(r.geojson) for r in rows] == [POINT, SQUARE, None]
    assert [r.idx for r in rows] == [0, 1, 2]


def test_merge_follows_the_keys_that_are_there(spark):
    path = land(spark, [
        {"id": 1, "modifiedAt": "round", "inspections": [inspection(POINT, modifiedAt="insp")]},
        {"id": 2, "_tag": "kept", "inspections": [inspection(POINT, modifiedAt="insp")]},
        {"id": 3, "modifiedAt": None, "inspections": [inspection(POINT, modifiedAt="insp")]},
        {"id": 4, "score": 9, "inspections": [inspection(POINT, note="n")]},
        {"id": 5, "creatingUserDisplayName": "back", "inspections": [inspection(POINT)]}])
    rows = {r.id: r for r in landed_rounds(spark, path).collect()}
    assert [rows[i].modifiedAt for i in (1, 2, 3, 4)] == ["round", "insp", None, None]
    assert rows[2]["_tag"] == "kept" and rows[4].note == "n"
    assert rows[4].score == 9 and rows[1].score == 1
    assert "creatingUserDisplayName" not in rows[5].asDict()


def test_required_keys_are_checked_in_every_document(spark):
    good = {"id": 1, "inspections": [inspection(POINT)]}
    bad = [{"id": 2}, {"id": 3, "inspections": [{"location": {"geoJsonFeature": {"geometry": POINT}},
                                                 "results": []}]},
           {"id": 4, "inspections": [inspection(POINT, [{"score": 2}])]},
           {"id": 5, "inspections": [{"closingUserDisplayName": "c", "results": []}]}]
    for doc in bad:
        with pytest.raises(Exception, match="missing required key"):
            landed_rounds(spark, land(spark, [good, doc]), with_index=False).collect()
    path = land(spark, [good, *bad])
    assert [r.id for r in landed_rounds(spark, path, mode="permissive").collect()] == [1]
    texts = spark.read.text(path).withColumn("id", F.get_json_object("value", "$.id"))
    problems = round_text_problems(texts, read_json_text(spark, path).schema, ["id"])
    assert sorted((r["_doc"]["id"], r.problem) for r in problems.collect()) == [
        ("2", "inspections"), ("3", "closingUserDisplayName"), ("4", "creatingUserDisplayName"),
        ("5", "location.geoJsonFeature.geometry")]


def test_listing_drives_the_load(spark):
    path = land(spark, [{"uri": f"/r/{i}", "id": i, "inspections": [inspection(POINT)]}
                        for i in range(5)])
    listing = spark.createDataFrame([("/r/3", 0), ("/r/1", 1)], "uri string, position int")
    rows = landed_rounds(spark, path, listing=listing).orderBy("idx").collect()
    assert [r.id for r in rows] == [3, 1]
    lost = listing.union(spark.createDataFrame([("/r/99", 2)], "uri string, position int"))
    with pytest.raises(LookupError):
        landed_rounds(spark, path, listing=lost)


def test_colliding_paths_and_null_leaves(spark):
    path = land(spark, [{"a": {"b": 1}, "a.b": 2, "n": None, "z": 3}])
    df = read_json_text(spark, path, "a struct<b:long>, `a.b` long, n long, z long")
    wide = shape.flatten_wide(df)
    assert wide.columns == ["a.b", "n", "z"] and wide.first()[0] == 2
    long = shape.flatten_long(df.withColumn("id", F.lit(1)).select("id", F.struct("n", "z").alias("r")),
                              "id", "r")
    assert sorted((r.path, r.value) for r in long.collect()) == [("n", None), ("z", "3")]


def test_drop_key_passes_other_values_through(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("dates"), F.lit(2).alias("x")).alias("s"),
                               F.lit(5).alias("n"))
    s, n = (shape.drop_key(F.col(c), "dates", df.schema[c].dataType) for c in ("s", "n"))
    row = df.select(s.alias("s"), n.alias("n")).first()
    assert row.s.asDict() == {"x": 2} and row.n == 5
