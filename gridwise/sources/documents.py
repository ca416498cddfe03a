"""Document sources: listing scan (S1), detail scan by uri (S2), JSON records
to a table with an inferred schema (S3).

The original fetches documents one HTTP call at a time.  Here the documents
are landed files (a snapshot per run) read by Spark's JSON source: parsing
and schema inference are distributed over the files, and the N+1 lookup of
details by uri becomes one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridwise.session import work_dir


def write_json_text(spark: SparkSession, text: DataFrame, name: str) -> str:
    """Land a one-column frame of JSON text (one document per line) in the
    shared working folder; returns the folder."""
    path = work_dir(spark, name)
    text.write.mode("overwrite").text(path)
    return path


def read_json_text(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   multi_line: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """Read JSON documents.  Without ``schema`` the schema is inferred as the
    union of all keys (absent -> null).  A line holding a JSON array yields
    one row per element."""
    reader = spark.read.option("mode", mode).option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def scan_listing(spark: SparkSession, path: str, multi_line: bool = False,
                 strict: bool = True) -> DataFrame:
    """Listing documents (JSON arrays of objects with ``uri``) -> one row
    per uri, in listing order is not guaranteed (use the uri as key).  A
    listed object without ``uri`` raises when ``strict``."""
    df = read_json_text(spark, path, multi_line=multi_line)
    if "uri" not in df.columns:
        raise KeyError("listing objects have no 'uri' key")
    uri = F.col("uri")
    if strict:
        uri = F.when(uri.isNull(), F.raise_error(F.lit("listing object without 'uri'"))
                     ).otherwise(uri)
    return df.select(uri.alias("uri"))


def scan_detail_by_uri(listing: DataFrame, documents: DataFrame, strict: bool = True
                       ) -> DataFrame:
    """The document of every listed uri (one join instead of one request
    per uri).  ``strict`` asserts that every listed uri has a document."""
    if strict:
        missing = listing.join(documents.select("uri"), "uri", "left_anti").limit(1).count()
        if missing:
            raise LookupError("listed uri without a document")
    return listing.join(documents, "uri", "inner")


def records_to_table(spark: SparkSession, path: str, schema: StructType | None = None
                     ) -> DataFrame:
    """S3: JSON records -> table; columns are the union of keys seen."""
    return read_json_text(spark, path, schema=schema)
