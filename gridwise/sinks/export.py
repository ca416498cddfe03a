"""File exports: dated CSV (K4, K5, K6) and GeoJSON (K7).

CSV is written as parallel part files in a folder named like the original
single file (``<table>_<YYYY-MM-DD>.csv``); one file only on explicit request
(``single_file=True`` funnels the rows through one task — use for small
exports only).  Options reproduce a database ``COPY ... CSV HEADER``: fields
quoted when needed with doubled quotes, leading/trailing blanks kept, null as
an empty field.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwise.functions.geometry import to_geojson

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",
    "emptyValue": '""',
    "lineSep": "\n",
}


def dated_file_name(stem: str, run_date: _dt.date | str | None = None,
                    suffix: str = ".csv") -> str:
    """``<stem>_<YYYY-MM-DD><suffix>`` (K6); ``run_date`` defaults to today."""
    day = run_date or _dt.date.today()
    if isinstance(day, _dt.date):
        day = day.isoformat()
    return f"{stem}_{day}{suffix}"


def export_csv(df: DataFrame, output_folder: str, table_name: str, sep: str = ";",
               run_date=None, single_file: bool = False, limit: int | None = None) -> str:
    """K4 (``sep=';'``) / K5 (``sep=','``): returns the written path.
    ``limit`` writes only a preview of that many rows (L1)."""
    path = f"{output_folder.rstrip('/')}/{dated_file_name(table_name, run_date)}"
    out = df.limit(limit) if limit is not None else df
    out = out.coalesce(1) if single_file else out
    out.write.mode("overwrite").options(**CSV_OPTIONS).option("sep", sep).csv(path)
    return path


def read_csv_export(spark, path: str, sep: str = ";", schema=None) -> DataFrame:
    reader = (spark.read.options(**{k: v for k, v in CSV_OPTIONS.items() if k != "emptyValue"})
              .option("sep", sep).option("multiLine", "true").option("mode", "FAILFAST"))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def feature_text(geom: Column, properties: list[str]) -> Column:
    """One GeoJSON Feature as compact JSON text."""
    props = F.to_json(F.struct(*[F.col(p) for p in properties])) if properties else F.lit("{}")
    return F.concat(F.lit('{"type":"Feature","properties":'), props,
                    F.lit(',"geometry":'), F.coalesce(to_geojson(geom), F.lit("null")),
                    F.lit("}"))


def export_geojson(df: DataFrame, path: str, geom: str, properties: list[str],
                   collection_size: int | None = None) -> str:
    """K7: features as line-delimited GeoJSON (default), or as FeatureCollection
    documents of at most ``collection_size`` features, one per line."""
    feats = df.select(feature_text(F.col(geom), properties).alias("value"))
    if collection_size:
        chunk = F.floor(F.monotonically_increasing_id() / F.lit(collection_size))
        feats = (feats.withColumn("_c", chunk).groupBy("_c")
                 .agg(F.concat(F.lit('{"type":"FeatureCollection","features":['),
                               F.concat_ws(",", F.collect_list("value")), F.lit("]}"))
                      .alias("value"))
                 .select("value"))
    feats.write.mode("overwrite").text(path)
    return path
