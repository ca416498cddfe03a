"""Scalar text functions and document shaping operators."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridwise.functions.text import (concat_text, content_type, dated_name, file_ext, file_stem,
                                     key_text, mask_prefixed, str_left, str_right)
from gridwise.operators import shape
from gridwise.operators.joins import join_concat_key
from gridwise.operators.row_index import with_row_index


def test_key_text(spark):
    df = spark.createDataFrame([(3.0,), (3.5,), (None,), (-2.0,)], "v double")
    assert [r.k for r in df.select(key_text("v").alias("k")).collect()] == ["3", "3.5", None, "-2"]


def test_left_right_concat_nulls(spark):
    df = spark.createDataFrame([("abcdef", "x"), ("ab", None)], "s string, t string")
    rows = df.select(str_left("s", 4).alias("l"), str_right("s", 3).alias("r"),
                     concat_text("s", "t").alias("c")).collect()
    assert [(r.l, r.r, r.c) for r in rows] == [("abcd", "def", "abcdefx"), ("ab", "ab", None)]


def test_concat_key_collision_and_strict(spark):
    a = spark.createDataFrame([(1, 23), (12, 3), (None, 5)], "t long, s long")
    b = spark.createDataFrame([(1, 23, "x")], "tid long, oid long, name string")
    loose = join_concat_key(a, b, ["t", "s"], ["tid", "oid"]).count()
    strict = join_concat_key(a, b, ["t", "s"], ["tid", "oid"], strict_keys=True).count()
    assert (loose, strict) == (2, 1)


def test_mask_prefixed(spark):
    df = spark.createDataFrame([(["ogr2ogr", " PG:host=x", "\tPG:y", "x PG:"],)], "a array<string>")
    got = df.select(mask_prefixed("a").alias("m")).first().m
    assert got == ["ogr2ogr", "PG: <CONNECTION STRING REDACTED>",
                   "PG: <CONNECTION STRING REDACTED>", "x PG:"]


@pytest.mark.parametrize("path,stem,ext,ctype", [
    ("/data/inspections_2024-01-01.csv", "inspections_2024-01-01", "csv", "text/csv"),
    ("http://a.example.com/x/page.HTML?q=1#top", "page", "HTML", "text/html"),
    ("/data/archive.tar.zip", "archive.tar", "zip", "application/zip"),
    ("/data/.hidden", ".hidden", "", None),
    ("/data/noext", "noext", "", None),
])
def test_file_names(spark, path, stem, ext, ctype):
    df = spark.createDataFrame([(path,)], "p string")
    r = df.select(file_stem("p").alias("s"), file_ext("p").alias("e"),
                  content_type("p").alias("c")).first()
    assert (r.s, r.e, r.c) == (stem, ext, ctype)


def test_dated_name(spark):
    df = spark.createDataFrame([("inspections_total_areas",)], "s string")
    assert df.select(dated_name("s", "2024-03-05").alias("n")).first().n == \
        "inspections_total_areas_2024-03-05.csv"


def test_merge_parent_wins_keeps_null_parent(spark):
    df = spark.createDataFrame([((1, "child", "c-only"), (None, "parent"))],
                               "c struct<id:int, name:string, own:string>, "
                               "p struct<id:bigint, name:string>")
    ct: StructType = df.schema["c"].dataType
    pt: StructType = df.schema["p"].dataType
    r = df.select(shape.merge_parent_wins(F.col("c"), ct, F.col("p"), pt).alias("m")).first().m
    assert r.asDict() == {"id": None, "name": "parent", "own": "c-only"}


def test_merge_maps_last_wins(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": None, "c": "3"})],
                               "c map<string,string>, p map<string,string>")
    r = df.select(shape.merge_maps("c", "p").alias("m")).first().m
    assert r == {"a": "1", "b": None, "c": "3"}


ROUND = ("struct<id:bigint, name:string, inspections:array<struct<id:bigint, "
         "closingUserDisplayName:string, location:struct<geoJsonFeature:struct<type:string, "
         "geometry:struct<type:string, coordinates:array<double>>>>, "
         "results:array<struct<id:bigint, score:bigint, creatingUserDisplayName:string, "
         "photos:array<struct<id:bigint, uri:string>>>>>>>")


def _round_docs(spark):
    docs = [
        (7, "r7", [(70, "closer", (("Feature", ("Point", [4.5, 52.1])),),
                    [(1, 5, "u", [(11, "a"), (12, "b")]), (2, 6, "u", [])]),
                   (71, "closer", (("Feature", None),), [])]),
        (8, "r8", []),
    ]
    return spark.createDataFrame([(d,) for d in docs], f"d {ROUND}").select("d.*")


def test_explode_rounds_merge_and_flatten(spark):
    from gridwise.plans.loaders import inspection_rounds
    out = inspection_rounds(_round_docs(spark), doc_order=["id"]).orderBy("idx").collect()
    assert [r.idx for r in out] == [0, 1]
    first = out[0].asDict()
    assert first["id"] == 7 and first["name"] == "r7"          # round id wins
    assert first["score"] == 5 and first["photos.0.id"] == 11 and first["photos.1.uri"] == "b"
    assert first["location.geoJsonFeature.type"] == "Feature"
    assert "closingUserDisplayName" not in first and "creatingUserDisplayName" not in first
    assert first["geojson"] == '{"type":"Point","coordinates":[4.5,52.1]}'
    assert out[1].asDict()["photos.0.id"] is None


def test_parent_display_name_is_dropped_again(spark):
    t = ("struct<id:bigint, closingUserDisplayName:string, inspections:array<struct<"
         "id:bigint, closingUserDisplayName:string, location:struct<geoJsonFeature:"
         "struct<geometry:string>>, results:array<struct<id:bigint, "
         "creatingUserDisplayName:string>>>>>")
    docs = spark.createDataFrame([((1, "round closer", [(2, "insp closer", ((None,),),
                                                          [(3, "creator")])]),)],
                                 f"d {t}").select("d.*")
    rec_type = shape.explode_rounds(docs).schema["rec"].dataType
    assert "closingUserDisplayName" not in rec_type.fieldNames()
    kept = shape.explode_rounds(docs, redrop=False).select("rec.closingUserDisplayName")
    assert kept.first()[0] == "round closer"


def test_permissive_rounds_and_rejects(spark):
    t = ("struct<id:bigint, inspections:array<struct<id:bigint, closingUserDisplayName:string, "
         "location:struct<geoJsonFeature:struct<type:string, geometry:string>>, "
         "results:array<struct<id:bigint, creatingUserDisplayName:string>>>>>")
    rows = [((1, [(10, "c", (("Feature", None),), [(100, "u")]),
                  (11, "c", (("Feature", None),), None)]),),
            ((2, None),)]
    docs = spark.createDataFrame(rows, f"d {t}").select("d.*")
    kept = shape.explode_rounds(docs, mode="permissive").collect()
    assert len(kept) == 1 and kept[0].geojson == "null"
    probs = sorted((r.doc, r.inspection, r.problem) for r in shape.round_problems(docs).collect())
    assert probs == [(1, 1, "missing results"), (2, None, "missing inspections")]
    with pytest.raises(Exception):
        shape.explode_rounds(docs).collect()


def test_explode_rounds_failfast(spark):
    docs = spark.createDataFrame([(1, None)], "id bigint, inspections array<struct<id:bigint>>")
    with pytest.raises(KeyError):
        shape.explode_rounds(docs)


def test_flatten_long_and_drop_key(spark):
    df = spark.createDataFrame([(1, ("a", (5,)))], "id int, r struct<t:string, p:struct<k:int>>")
    got = sorted((r.path, r.value) for r in shape.flatten_long(df, "id", "r").collect())
    assert got == [("p.k", "5"), ("t", "a")]
    m = spark.createDataFrame([({"dates": "x", "k": "v"},)], "m map<string,string>")
    assert m.select(shape.drop_key("m").alias("m")).first().m == {"k": "v"}


def test_with_row_index_dense(spark):
    df = spark.range(0, 5000, 3).select((F.col("id") * 7 % 5000).alias("k"))
    rows = with_row_index(df, ["k"], partitions=7).collect()
    pairs = sorted((r.idx, r.k) for r in rows)
    assert [i for i, _ in pairs] == list(range(len(pairs)))
    assert [k for _, k in pairs] == sorted(k for _, k in pairs)
