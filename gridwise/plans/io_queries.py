"""Registered queries that land data in the shared working folder and read
it back: document sources, tables, CSV/GeoJSON sinks, file sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwise.plans import inputs as I
from gridwise.plans.registry import query
from gridwise.sources import documents as D


def _t(spark, sf_dir):
    return I.Tables(spark, sf_dir)


@query
def records_to_table_q(spark, sf_dir):
    t = _t(spark, sf_dir)
    path = D.write_json_text(spark, I.events_json_text(t), "records")
    df = D.records_to_table(spark, path)
    return df.select("event_id", "event_type", "user_id", "value")


@query
def scan_listing_q(spark, sf_dir):
    e = _t(spark, sf_dir)("events")
    item = F.to_json(F.struct(F.concat(F.lit("/e/"), F.col("event_id").cast("string"))
                              .alias("uri")))
    # listing pages of at most 1000 objects, one JSON array per line
    pages = (e.select(F.floor(F.col("event_id") / 1000).alias("_page"), item.alias("_it"))
             .groupBy("_page")
             .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("_it")), F.lit("]"))
                  .alias("value")))
    path = D.write_json_text(spark, pages.select("value"), "listing")
    return D.scan_listing(spark, path)


@query
def scan_detail_by_uri_q(spark, sf_dir):
    t = _t(spark, sf_dir)
    # the customers that events name; other user ids have no document
    listing = (t("events").join(t("customer"), F.col("user_id") == F.col("c_custkey"), "left_semi")
               .select(F.concat(F.lit("/c/"), F.col("user_id").cast("string")).alias("uri"))
               .distinct())
    docs_text = t("customer").select(F.to_json(F.struct(
        F.concat(F.lit("/c/"), F.col("c_custkey").cast("string")).alias("uri"),
        "c_custkey", "c_name", "c_mktsegment")).alias("value"))
    path = D.write_json_text(spark, docs_text, "details")
    docs = D.read_json_text(spark, path)
    return D.scan_detail_by_uri(listing, docs).select(
        "uri", "c_custkey", "c_name", "c_mktsegment")


# ---------------------------------------------------------------------------
# tables
# ---------------------------------------------------------------------------

from gridwise.session import work_dir  # noqa: E402
from gridwise.sinks import export as X  # noqa: E402
from gridwise.sinks import tables as T  # noqa: E402

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@query
def scan_table(spark, sf_dir):
    o = _t(spark, sf_dir)("orders").select(*ORDER_COLS)
    path = T.replace_table(o, work_dir(spark, "orders"))
    return T.scan_table(spark, path).select(*ORDER_COLS)


@query
def sink_replace_table(spark, sf_dir):
    o = _t(spark, sf_dir)("orders").select(*ORDER_COLS)
    path = work_dir(spark, "orders_replace")
    # first run: a stale version of the table; second run replaces it whole
    T.replace_table(o.where(F.col("o_orderstatus") == "F")
                    .withColumn("o_totalprice", F.lit(0.0)), path)
    T.replace_table(o, path)
    return T.scan_table(spark, path).select(*ORDER_COLS)


@query
def sink_replace_version(spark, sf_dir):
    from gridwise.sinks.versions import remove_old, replace_version
    o = _t(spark, sf_dir)("orders").select(*ORDER_COLS)
    path = work_dir(spark, "orders_versions")
    replace_version(o.where(F.col("o_orderstatus") == "F"), path)
    replace_version(o.withColumn("o_totalprice", F.lit(0.0)), path)
    replace_version(o, path)
    remove_old(spark, path)
    return T.scan_table(spark, path).select(*ORDER_COLS)


@query
def sink_ctas(spark, sf_dir):
    o = _t(spark, sf_dir)("orders").select(*ORDER_COLS)
    return T.create_table_as_select(spark, o, "orders_ctas",
                                    work_dir(spark, "orders_ctas")).select(*ORDER_COLS)


# ---------------------------------------------------------------------------
# CSV / GeoJSON exports
# ---------------------------------------------------------------------------

DOC_SCHEMA = "doc_id long, text string, lang string, source string"


def _csv_roundtrip(spark, sf_dir, sep):
    d = _t(spark, sf_dir)("documents").select("doc_id", "text", "lang", "source")
    path = X.export_csv(d, work_dir(spark, "export"), "documents", sep=sep,
                        run_date="2024-01-01")
    return X.read_csv_export(spark, path, sep=sep, schema=DOC_SCHEMA)


@query
def export_csv_semicolon(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, ";")


@query
def export_csv_comma(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, ",")


_FEATURE_BACK = "type string, properties struct<code:string, naam:string>, geometry string"


@query
def export_geojson(spark, sf_dir):
    sq = I.cust_squares(_t(spark, sf_dir)).withColumn("code", F.col("id").cast("string"))
    path = X.export_geojson(sq, work_dir(spark, "squares_geojson"), "geom", ["code", "naam"])
    back = spark.read.text(path).select(F.from_json("value", _FEATURE_BACK).alias("f"))
    return back.select(F.col("f.properties.code").alias("code"),
                       F.col("f.properties.naam").alias("naam"),
                       F.col("f.geometry").alias("geometry"))


@query
def scan_area_layer(spark, sf_dir):
    from gridwise.functions.geometry import bbox
    from gridwise.sources.areas import layer_columns, read_area_layer
    # upper-case property key on purpose: the layer scan lower-cases keys
    sq = (I.cust_squares(_t(spark, sf_dir)).drop("code")
          .withColumn("CODE", F.col("id").cast("string")))
    path = X.export_geojson(sq, work_dir(spark, "squares_layer"), "geom", ["CODE", "naam"],
                            collection_size=64)
    layer = layer_columns(read_area_layer(spark, path), ["code", "naam"])
    b = bbox(F.col("wkb_geometry"))
    return layer.select("code", "naam", b["minx"].alias("minx"), b["miny"].alias("miny"),
                        b["maxx"].alias("maxx"), b["maxy"].alias("maxy"))


def _layer_document(features, stem: str):
    """One pretty-printed FeatureCollection document of the features (id, code, naam,
    geom) in a new folder; other members of the root stand around the list."""
    from gridwise.functions.geometry import to_geojson
    from gridwise.operators.row_index import with_row_index
    spark = features.sparkSession
    text = F.concat(
        F.when(F.col("n") == 1, F.lit("    ")).otherwise(F.lit("    ,")), F.lit('{\n      "type": "Feature",\n'),
        F.lit('      "properties": {"CODE": "'), F.col("code"), F.lit('", "note": "}] \\\\ \\"{ '),
        F.col("naam"), F.lit('",\n        "naam": "'), F.col("naam"), F.lit('"},\n      "geometry":\n'),
        to_geojson(F.col("geom")), F.lit("\n    }"))
    body = with_row_index(features, ["id"], "n").select(
        (F.col("n") + 1).alias("n"), "code", "naam", "geom").select("n", text.alias("value"))
    last = F.lit(1 << 62)
    head = spark.range(1).select(F.lit(0).cast("long").alias("n"), F.lit(
        '{\n  "type": "FeatureCollection",\n  "crs": {"type": "name", "properties": {"name": "x"}},\n'
        '  "features": [').alias("value"))
    tail = spark.range(1).select(last.alias("n"), F.lit(
        '  ],\n  "links": [{"rel": "]}"}, {"rel": "next"}]\n}').alias("value"))
    path = work_dir(spark, stem)
    # a test input: one file, so one task writes it
    (head.unionByName(body).unionByName(tail).coalesce(1).sortWithinPartitions("n")
     .select("value").write.text(path))
    return path


@query
def scan_area_layer_split(spark, sf_dir):
    """S4 over one pretty-printed document that many tasks read."""
    from gridwise.functions.geometry import bbox
    from gridwise.sources.areas import layer_columns, read_area_layer
    sq = I.cust_squares(_t(spark, sf_dir)).withColumn("code", F.col("id").cast("string"))
    path = _layer_document(sq.select("id", "code", "naam", "geom"), "squares_document")
    layer = layer_columns(read_area_layer(spark, path, split=True), ["code", "naam"])
    b = bbox(F.col("wkb_geometry"))
    return layer.select("code", "naam", b["minx"].alias("minx"), b["miny"].alias("miny"),
                        b["maxx"].alias("maxx"), b["maxy"].alias("maxy"))


def degree_layers(t):
    """Two layers in WGS 84 degrees: customer squares (neighbourhoods, grows
    with the data) and region bands (districts)."""
    from gridwise.functions.geometry import make_box
    buurt = I.cust_squares_degrees(t).select(F.col("id").cast("string").alias("code"), "naam",
                                             "geom")
    r = t("region")
    rk = F.col("r_regionkey")
    blat0 = (F.lit(5230) + rk * 10).cast("double") / F.lit(100.0)
    blat1 = (F.lit(5240) + rk * 10).cast("double") / F.lit(100.0)
    sd = r.select(rk.cast("string").alias("code"), F.col("r_name").alias("naam"),
                  make_box(F.lit(4.7), blat0, F.lit(5.05), blat1).alias("geom"))
    return {"buurt": buurt, "stadsdeel": sd}


@query
def area_layers(spark, sf_dir):
    from gridwise.functions.geometry import bbox
    from gridwise.sources.areas import layer_columns, load_layers
    paths = {name: X.export_geojson(df, work_dir(spark, f"layer_{name}"), "geom",
                                    ["code", "naam"])
             for name, df in degree_layers(_t(spark, sf_dir)).items()}
    loaded = load_layers(spark, paths)
    out = None
    for name, layer in loaded.items():
        b = bbox(F.col("wkb_geometry"))
        cols = layer_columns(layer, ["code", "naam"]).select(
            F.lit(name).alias("layer"), "code", "naam",
            F.col("wkb_geometry")["srid"].alias("srid"),
            F.round(b["minx"], 2).alias("minx"), F.round(b["miny"], 2).alias("miny"),
            F.round(b["maxx"], 2).alias("maxx"), F.round(b["maxy"], 2).alias("maxy"))
        out = cols if out is None else out.unionByName(cols)
    return out


# ---------------------------------------------------------------------------
# files, objects, archives, publish
# ---------------------------------------------------------------------------

from gridwise.sinks.publish import publish_files  # noqa: E402
from gridwise.sources import files as FS  # noqa: E402


def _customer_files(spark, sf_dir, records_per_file=500):
    """Customers landed as CSV part files (more files as the table grows)."""
    c = _t(spark, sf_dir)("customer").select("c_custkey", "c_name", "c_mktsegment")
    path = work_dir(spark, "objects")
    (c.repartition(4).write.mode("overwrite").option("header", "true")
     .option("maxRecordsPerFile", records_per_file).csv(path))
    return path


@query
def scan_objects(spark, sf_dir):
    path = _customer_files(spark, sf_dir)
    objs = FS.scan_objects(spark, path, glob="*.csv")
    # one row per data line of every object (the header line excluded)
    lines = objs.select("name", F.explode(F.split(
        F.regexp_replace(F.decode("content", "UTF-8"), r"\n$", ""), "\n")).alias("line"))
    return lines.where(~F.col("line").startswith("c_custkey")).select(
        F.split("line", ",").getItem(0).cast("bigint").alias("c_custkey"),
        F.split("line", ",").getItem(1).alias("c_name"))


@query
def list_files(spark, sf_dir):
    return FS.list_files(spark, _customer_zips(spark, sf_dir)).select("name")


def _expected_archives(spark, sf_dir):
    """The archives that the customers should give, and one that nobody wrote."""
    number = F.floor(F.floor(F.col("c_custkey") / ZIP_GROUP) / MEMBERS_PER_ZIP)
    names = (_t(spark, sf_dir)("customer").select(
        F.concat(F.lit("archive_"), number.cast("string"), F.lit(".zip")).alias("name")).distinct())
    return names.unionByName(spark.range(1).select(F.lit("archive_x#1.zip").alias("name")))


@query
def check_objects(spark, sf_dir):
    folder = _customer_zips(spark, sf_dir)
    return FS.check_objects(spark, folder, _expected_archives(spark, sf_dir)).select(
        "name", "present")


@query
def publish_manifest(spark, sf_dir):
    return publish_files(spark, _customer_zips(spark, sf_dir), work_dir(spark, "published"),
                         _expected_archives(spark, sf_dir)).select(
        "name", "content_type", "present")


ZIP_GROUP = 100      # customers per archive member
MEMBERS_PER_ZIP = 10


def _write_zips(folder):
    """applyInPandas body: one archive per group of members, and beside archive 0
    a damaged one.  Writes through pyarrow's file systems, so the folder may be
    local, HDFS or an object store."""
    import io
    import zipfile

    import pandas as pd
    from pyarrow import fs as pafs

    def write(pdf):
        arch = int(pdf["archive"].iloc[0])
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            for m, text in sorted(zip(pdf["member"], pdf["text"])):
                zf.writestr(f"customers_{int(m)}.csv", text)
        data = buf.getvalue()
        filesystem, root = pafs.FileSystem.from_uri(folder)
        filesystem.create_dir(root, recursive=True)
        with filesystem.open_output_stream(f"{root}/archive_{arch}.zip") as out:
            out.write(data)
        if arch == 0:
            with filesystem.open_output_stream(f"{root}/broken#1.zip") as out:
                out.write(data[: len(data) // 3])
        return pd.DataFrame({"archive": [arch], "bytes": [len(data)]})

    return write


def _customer_zips(spark, sf_dir):
    c = _t(spark, sf_dir)("customer")
    member = F.floor(F.col("c_custkey") / ZIP_GROUP)
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), F.col("c_name"))
    # members of at most ZIP_GROUP lines (custkey is unique), archives of at
    # most MEMBERS_PER_ZIP members: every group is bounded
    members = (c.groupBy(member.alias("member"))
               .agg(F.concat_ws("\n", F.array_sort(F.collect_list(line))).alias("text"))
               .withColumn("archive", F.floor(F.col("member") / MEMBERS_PER_ZIP)))
    folder = work_dir(spark, "zips")
    if folder.startswith("/"):
        folder = "file://" + folder
    (members.groupBy("archive").applyInPandas(_write_zips(folder), "archive long, bytes long")
     .write.format("noop").mode("overwrite").save())
    return folder


@query
def zip_members(spark, sf_dir):
    rows = FS.zip_members(spark, _customer_zips(spark, sf_dir))
    return rows.select(
        "member",
        F.when(F.col("content").isNotNull(),
               F.size(F.split(F.decode("content", "UTF-8"), "\n"))).alias("n_lines"),
        F.col("error").isNotNull().alias("failed"))


# ---------------------------------------------------------------------------
# incremental enrichment (Structured Streaming)
# ---------------------------------------------------------------------------

@query
def inspections_total_areas_stream(spark, sf_dir):
    from gridwise.plans import enrich
    from gridwise.plans.loaders import inspection_types
    from gridwise.streaming.incremental import enrichment_stream, start_enrichment
    t = _t(spark, sf_dir)
    area, obj = I.split_staging(I.insp_staging(t))
    root = work_dir(spark, "stream")
    # land the two staging tables as files, the way the loader would
    T.replace_table(area, f"{root}/staging_area")
    T.replace_table(obj, f"{root}/staging_object")
    types = inspection_types(I.type_docs_region(t), doc_order=["id", "_chunk"],
                             with_index=False)
    b6, w6, s6, g6 = I.rd_layers(t)
    hierarchy = enrich.area_hierarchy(b6, w6, s6)
    stream = enrichment_stream(spark, f"{root}/staging_area", f"{root}/staging_object",
                               area.schema, types, hierarchy, g6, max_files_per_trigger=2)
    q = start_enrichment(stream, f"{root}/out", f"{root}/checkpoint")
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return out.withColumn("lat", F.round("lat", 9)).withColumn("lon", F.round("lon", 9))
