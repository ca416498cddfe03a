"""The production job chain, file to file, on inputs landed from sf0.001."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gridwise.plans import inputs as I
from gridwise.plans import jobs
from gridwise.sinks.export import export_geojson
from gridwise.sinks.tables import scan_table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")


def test_job_chain(spark):
    root = tempfile.mkdtemp(prefix="gridwise-jobs-")
    t = I.Tables(spark, SF)
    # land the documents and layers the way the upstream services deliver them
    I.type_docs_region(t).select(F.to_json(F.struct("*")).alias("value")) \
        .write.text(f"{root}/types.json")
    I.round_docs(t).select(F.to_json(F.struct("*")).alias("value")) \
        .write.text(f"{root}/rounds.json")
    b6, w6, s6, g6 = I.rd_layers(t)
    w6 = w6.withColumn("wkb_geometry", F.lit(None).cast(b6.schema["wkb_geometry"].dataType))
    layers = {}
    for name, df, props in (("buurt", b6, ["code", "naam"]),
                            ("buurtcombinatie", w6, ["vollcode", "naam", "code"]),
                            ("stadsdeel", s6.withColumn("wkb_geometry", F.lit(None).cast(
                                b6.schema["wkb_geometry"].dataType)), ["code", "naam"]),
                            ("gebiedsgerichtwerken", g6, ["code", "naam"])):
        layers[name] = export_geojson(df, f"{root}/layers/{name}", "wkb_geometry", props)

    types = jobs.load_types(spark, f"{root}/types.json", f"{root}/staging/types")
    rounds = jobs.load_rounds(spark, f"{root}/rounds.json", f"{root}/staging/rounds")
    staged = scan_table(spark, rounds)
    assert staged.count() == t("lineitem").count()
    assert sorted(r.idx for r in staged.select("idx").collect()) == list(range(staged.count()))
    area = jobs.replace_table(staged.where(F.col("status") == "F"), f"{root}/staging/area")
    obj = jobs.replace_table(staged.where(F.col("status") != "F"), f"{root}/staging/object")
    tables = jobs.load_areas(spark, layers, f"{root}/areas", source_srid=28992)
    out = jobs.enrich_tables(spark, area, obj, types, tables, f"{root}/inspections_total_areas")
    result = scan_table(spark, out)
    rows = result.count()
    assert len(result.columns) == 28 and rows > 0
    csv = jobs.export(spark, out, f"{root}/export", run_date="2024-05-06")
    assert csv.endswith("inspections_total_areas_2024-05-06.csv")
    manifest = jobs.publish(spark, csv, f"{root}/published").collect()
    assert manifest and all(r.present for r in manifest)
    assert all(r.content_type == "text/csv" for r in manifest if r.name.endswith(".csv"))
    # a second run replaces the tables whole, and E4's table can be published too
    again = jobs.enrich_tables(spark, area, obj, types, tables, f"{root}/inspections_total_areas",
                               total_path=f"{root}/inspections_total")
    assert scan_table(spark, again).count() == rows
    assert scan_table(spark, f"{root}/inspections_total").count() >= 1
