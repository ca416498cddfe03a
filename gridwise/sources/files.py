"""File and object sources: object read (S6), existence check (S7), directory
listing (S8) and zip expansion (S9).

All of them go through Spark's ``binaryFile`` source, which lists and reads
files of any Hadoop file system (local, HDFS, S3, ABFS) in parallel tasks; the
content column is only read when selected.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.functions.text import path_name


def scan_objects(spark: SparkSession, path: str, glob: str | None = None,
                 recursive: bool = False) -> DataFrame:
    """(path, name, length, modificationTime, content) per file."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    return df.select("path", path_name(F.col("path")).alias("name"), "length",
                     "modificationTime", "content")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Regular files directly in ``path`` (content is never read)."""
    return scan_objects(spark, path, glob).drop("content")


def check_objects(spark: SparkSession, path: str, expected: DataFrame,
                  name_col: str = "name") -> DataFrame:
    """For every expected name, whether an object of that name exists
    under ``path`` (``present``) and its length."""
    found = list_files(spark, path).select(F.col("name").alias(name_col), "length")
    return (expected.join(found, name_col, "left")
            .withColumn("present", F.col("length").isNotNull()))


ZIP_SCHEMA = "archive string, member string, size long, content binary, error string"


ZIP_COLUMNS = ["archive", "member", "size", "content", "error"]
BATCH_BYTES = 16 * 1024 * 1024


def _members(path: str, content: bytes):
    """One tuple per member; a member that can't be read (damaged, encrypted,
    unknown method) gives its error and leaves the others alone."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
    except Exception as exc:  # noqa: BLE001  (any damage of the directory)
        yield path, None, None, None, f"bad zip: {exc}"
        return
    with archive:
        for info in archive.infolist():
            if info.is_dir():
                continue
            try:
                yield path, info.filename, info.file_size, archive.read(info), None
            except Exception as exc:  # noqa: BLE001
                yield path, info.filename, info.file_size, None, f"bad member: {exc}"


def _expand(batches):
    for pdf in batches:
        out, held = [], 0
        for path, content in zip(pdf["path"], pdf["content"]):
            for row in _members(path, content):
                out.append(row)
                held += len(row[3] or b"")
                if held >= BATCH_BYTES or len(out) >= 256:
                    yield pd.DataFrame(out, columns=ZIP_COLUMNS)
                    out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=ZIP_COLUMNS)


def zip_members(spark: SparkSession, path: str, filename_as_folder: bool = False
                ) -> DataFrame:
    """Every ``*.zip`` in ``path`` expanded to one row per member.  A
    corrupt archive gives one row with ``error`` set, a corrupt member its own;
    neither stops the others.  An archive is read in one task, its members leave
    it in batches of about ``BATCH_BYTES``.  ``target`` is where the original would extract the member: the
    archive's folder, or a sub-folder named after the archive."""
    zips = (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
            .option("recursiveFileLookup", "false").load(path).select("path", "content"))
    rows = zips.mapInPandas(_expand, ZIP_SCHEMA)
    folder = F.regexp_replace(F.col("archive"), r"/[^/]*$", "")
    stem = F.regexp_replace(path_name(F.col("archive")), r"\.zip$", "")
    target = (F.concat(folder, F.lit("/"), stem, F.lit("/"), F.col("member"))
              if filename_as_folder else F.concat(folder, F.lit("/"), F.col("member")))
    return rows.withColumn("target", F.when(F.col("member").isNotNull(), target))
