"""Sources and sinks on literal inputs: CSV fidelity, table replace/CTAS,
GeoJSON layers, object listing/existence, zip expansion."""

import io
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

import json

import pytest
from pyspark.sql import functions as F

from gridwise.session import checkpoint_root
from gridwise.sinks.tables import replace_table
from gridwise.sources.areas import layer_rejects, read_area_layer
from gridwise.functions.geometry import make_box
from gridwise.sinks import export as X
from gridwise.sinks import tables as T
from gridwise.sinks.publish import publish_files, publish_manifest
from gridwise.sources import files as FS
from gridwise.sources.areas import layer_columns, read_area_layer
from gridwise.sources.documents import read_json_text, scan_listing, write_json_text


def _tmp():
    return tempfile.mkdtemp(prefix="gridwise-test-")


def test_csv_round_trip_keeps_text(spark):
    rows = [(1, 'say "hi"; ok'), (2, "  leading and trailing  "), (3, "two\nlines"),
            (4, None), (5, "a,b;c")]
    df = spark.createDataFrame(rows, "id long, t string")
    for sep in (";", ","):
        path = X.export_csv(df, _tmp(), "tbl", sep=sep, run_date="2024-02-03")
        assert path.endswith("tbl_2024-02-03.csv")
        back = X.read_csv_export(spark, path, sep=sep, schema="id long, t string")
        assert sorted(back.collect()) == sorted(df.collect())


def test_replace_table_and_ctas(spark):
    path = _tmp() + "/t"
    T.replace_table(spark.range(10), path)
    T.replace_table(spark.range(3), path)
    assert T.scan_table(spark, path).count() == 3
    t = T.create_table_as_select(spark, spark.range(5), "gw_ctas_test", _tmp() + "/c1")
    assert t.count() == 5
    t = T.create_table_as_select(spark, spark.range(2), "gw_ctas_test", _tmp() + "/c2")
    assert t.count() == 2


def test_geojson_layers_lines_and_collections(spark):
    df = spark.createDataFrame([("A", 4.80, 52.30), ("B", 4.90, 52.35)],
                               "CODE string, lon double, lat double")
    df = df.withColumn("geom", make_box("lon", "lat", F.col("lon") + 0.01,
                                        F.col("lat") + 0.01)).drop("lon", "lat")
    lines = X.export_geojson(df, _tmp() + "/l", "geom", ["CODE"])
    coll = X.export_geojson(df, _tmp() + "/c", "geom", ["CODE"], collection_size=1)
    for path in (lines, coll):
        layer = read_area_layer(spark, path, to_srid=28992)
        got = {r.code: r.wkb_geometry for r in layer_columns(layer, ["code"]).collect()}
        assert set(got) == {"A", "B"}
        assert got["A"].srid == 28992
        assert 110000 < got["A"].parts[0][0][0].x < 130000


def test_listing_documents(spark):
    text = spark.createDataFrame([('[{"uri":"/a"},{"uri":"/b"}]',), ('[{"uri":"/c"}]',)],
                                 "value string")
    path = write_json_text(spark, text, "listing-test")
    assert sorted(r.uri for r in scan_listing(spark, path).collect()) == ["/a", "/b", "/c"]
    assert read_json_text(spark, path).count() == 3


def test_objects_manifest_and_existence(spark):
    d = _tmp()
    for name, body in (("a.csv", b"x\n"), ("b.json", b"{}"), ("c.bin", b"\x00")):
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(body)
    man = {r.name: r.content_type for r in publish_manifest(spark, d).collect()}
    assert man == {"a.csv": "text/csv", "b.json": "application/json", "c.bin": "application/octet-stream"}
    with open(os.path.join(d, "a#1.csv"), "wb") as fh:
        fh.write(b"y\n")
    assert "a#1.csv" in [r.name for r in FS.list_files(spark, d).collect()]
    expected = spark.createDataFrame([("a#1.csv",), ("lost.csv",)], "name string")
    out = {r.name: (r.present, r.length) for r in
           publish_files(spark, d, os.path.join(_tmp(), "to"), expected).collect()}
    assert out == {"a#1.csv": (True, 2), "lost.csv": (False, None)}
    expected = spark.createDataFrame([("a.csv",), ("zzz.csv",)], "name string")
    got = {r.name: r.present for r in FS.check_objects(spark, d, expected).collect()}
    assert got == {"a.csv": True, "zzz.csv": False}


def test_zip_members_with_corrupt_archive(spark):
    d = _tmp()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("one.txt", "1")
        zf.writestr("sub/two.txt", "22")
    with open(os.path.join(d, "good.zip"), "wb") as fh:
        fh.write(buf.getvalue())
    damaged = io.BytesIO()
    with zipfile.ZipFile(damaged, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("fine.txt", "f" * 500)
        zf.writestr("torn.txt", "".join(map(str, range(500))))
    raw = bytearray(damaged.getvalue())
    at = raw.index(b"torn.txt") + 30
    raw[at:at + 40] = bytes(40)  # deflate data of one member
    with open(os.path.join(d, "half.zip"), "wb") as fh:
        fh.write(bytes(raw))
    with open(os.path.join(d, "bad.zip"), "wb") as fh:
        fh.write(b"not a zip at all")
    with open(os.path.join(d, "note.txt"), "wb") as fh:
        fh.write(b"ignored")
    rows = FS.zip_members(spark, d, filename_as_folder=True).collect()
    good = sorted((r.member, r.size) for r in rows if r.error is None)
    bad = sorted((r.archive.rpartition("/")[2], r.member) for r in rows if r.error is not None)
    assert good == [("fine.txt", 500), ("one.txt", 1), ("sub/two.txt", 2)]
    assert bad == [("bad.zip", None), ("half.zip", "torn.txt")]
    assert all(r.target.endswith("/" + r.member) for r in rows if r.error is None)


def test_area_layer_has_no_silent_drops(spark):
    feature = ('{"type":"Feature","properties":{"CODE":"a"},"geometry":'
               '{"type":"Point","coordinates":[1,2]}}')
    collection = '{"type":"FeatureCollection","features":[' + feature + "," + feature + "]}"
    lines = spark.createDataFrame([(feature,), ('{"type":"Feat',), ('{"type":"Other"}',),
                                   (collection,), ("",)], "value string")
    path = write_json_text(spark, lines, "layer-test")
    with pytest.raises(Exception, match="neither a Feature nor"):
        read_area_layer(spark, path).collect()
    assert read_area_layer(spark, path, mode="permissive").count() == 3
    assert layer_rejects(spark, path).count() == 2
    d = _tmp()
    with open(os.path.join(d, "pretty.geojson"), "w") as fh:
        fh.write(json.dumps(json.loads(collection), indent=2))
    with pytest.raises(Exception, match="whole_files"):
        read_area_layer(spark, d).collect()
    assert read_area_layer(spark, d, whole_files=True).count() == 2


def test_replace_table_keeps_the_old_one_when_a_run_fails(spark):
    path = os.path.join(_tmp(), "t")
    replace_table(spark.range(5), path)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        replace_table(broken, path)
    assert spark.read.parquet(path).count() == 5
    replace_table(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7
    # a table can be replaced by what was read from it
    replace_table(spark.read.parquet(path).where("id > 2"), path)
    assert spark.read.parquet(path).count() == 4


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, key, default=None):
            return "yarn" if key == "spark.master" else default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
