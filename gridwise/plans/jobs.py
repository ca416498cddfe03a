"""User-facing jobs, file to file — the production chain of the original:

    load_types    landed type documents   -> staging table (E1)
    load_rounds   landed round documents  -> staging table (E2)
    load_areas    GeoJSON layers (4326)   -> layer tables in 28992 (E3)
    enrich        staging + types + layers -> inspections_total_areas (E4-E6)
    export        table -> dated CSV folder (K4, K6)
    publish       folder -> destination, every expected file verified (K8, K9, S7)

Every job reads and writes through Spark's sources and sinks, so paths can be
local, HDFS or object-store URIs; tables are replaced whole, as the original
replaces them on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.plans import enrich
from gridwise.plans.loaders import inspection_types, landed_rounds
from gridwise.sinks.export import export_csv
from gridwise.sinks.publish import publish_files
from gridwise.sinks.tables import replace_table, scan_table  # noqa: F401 (re-exported)
from gridwise.sources.areas import layer_columns, load_layers
from gridwise.sources.documents import read_json_text, scan_detail_by_uri

# The names of the four area layers of the upstream map
# service and the property columns used from each.
LAYER_COLUMNS = {
    "stadsdeel": ["code", "naam"],
    "buurt": ["code", "naam"],
    "buurtcombinatie": ["vollcode", "naam", "code"],
    "gebiedsgerichtwerken": ["code", "naam"],
}


def load_types(spark: SparkSession, docs_path: str, out_path: str, schema=None,
               listing: DataFrame | None = None) -> str:
    """Type documents (JSON, one per line) -> staging table with idx, in
    order of their id or, with a ``listing`` (uri, position), exactly the listed
    documents in its order."""
    docs = read_json_text(spark, docs_path, schema=schema)
    if listing is None:
        docs = docs.withColumn("_order", F.col("id"))
    else:
        docs = scan_detail_by_uri(listing, docs).withColumnRenamed("position", "_order")
    return replace_table(inspection_types(docs, doc_order=["_order"]), out_path)


def load_rounds(spark: SparkSession, docs_path: str, out_path: str,
                mode: str = "failfast", schema=None, listing: DataFrame | None = None) -> str:
    """Round documents (JSON, one per line) -> staging table with idx; see
    ``loaders.landed_rounds``."""
    return replace_table(landed_rounds(spark, docs_path, schema=schema, mode=mode,
                                       listing=listing), out_path)


def load_areas(spark: SparkSession, layer_paths: dict[str, str], out_root: str,
               source_srid: int = 4326) -> dict:
    """Each layer reprojected to 28992 once and stored as a table."""
    out = {}
    for name, layer in load_layers(spark, layer_paths, source_srid=source_srid).items():
        cols = LAYER_COLUMNS.get(name, ["code", "naam"])
        out[name] = replace_table(layer_columns(layer, cols), f"{out_root.rstrip('/')}/{name}")
    return out


def enrich_tables(spark: SparkSession, area_staging: str, object_staging: str, types: str,
                  layers: dict[str, str], out_path: str, total_path: str | None = None) -> str:
    """The enriched, area-coded inspections table; ``total_path`` also
    publishes ``inspections_total``, which the areas are then joined to."""
    total = enrich.inspections_total(scan_table(spark, area_staging),
                                     scan_table(spark, object_staging),
                                     scan_table(spark, types))
    if total_path:
        total = scan_table(spark, replace_table(total, total_path))
    hierarchy = enrich.area_hierarchy(scan_table(spark, layers["buurt"]),
                                      scan_table(spark, layers["buurtcombinatie"]),
                                      scan_table(spark, layers["stadsdeel"]))
    result = enrich.inspections_total_areas(total, hierarchy,
                                            scan_table(spark, layers["gebiedsgerichtwerken"]))
    return replace_table(result, out_path)


def export(spark: SparkSession, table_path: str, output_folder: str,
           table_name: str = "inspections_total_areas", sep: str = ";", run_date=None) -> str:
    """K4: ``<table>_<date>.csv`` folder of part files with a header."""
    return export_csv(scan_table(spark, table_path), output_folder, table_name, sep=sep,
                      run_date=run_date)


def publish(spark: SparkSession, folder: str, destination: str,
            expected: DataFrame | None = None) -> DataFrame:
    """Every file of a folder copied to ``destination``; the manifest
    (name, length, content_type, present) lists the ``expected`` names, by
    default the folder's."""
    return publish_files(spark, folder, destination, expected)
