"""Publish step (K8, K9, E9): copy the files of a folder to a destination, with
their content types, then verify every expected name there."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.functions.text import content_type, path_name
from gridwise.sources.files import check_objects, list_files

CHUNK_BYTES = 8 * 1024 * 1024


def publish_manifest(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """(name, path, length, content_type) for every regular file in
    ``folder`` (part files of a CSV export included)."""
    files = list_files(spark, folder, glob)
    return files.select("name", "path", "length", content_type(F.col("name"), path_name).alias(
        "content_type"))


def _open(uri: str):
    """(file system, path) of a file or folder.  A name may hold any character,
    so local paths are taken as they are and others escaped."""
    scheme, found, rest = uri.partition("://")
    if not found:
        scheme, rest = "file", uri.removeprefix("file:")
    if scheme == "file":
        return pafs.LocalFileSystem(), rest
    return pafs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@')}")


def publish_files(spark: SparkSession, folder: str, destination: str,
                  expected: DataFrame | None = None, glob: str | None = None) -> DataFrame:
    """Copy the regular files of ``folder`` to ``destination`` and return, for
    every expected name (column ``name``; default: the folder's files), the
    length found there, its content type and whether it is present.

    Files are copied by the executors in chunks, each to a name of its own first
    and then moved, so a lost task leaves no half file under a published name.
    """
    source = list_files(spark, folder, glob).select("path", "name")

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, base = _open(destination)
        target.create_dir(base, recursive=True)
        for pdf in batches:
            for path, name in zip(pdf["path"], pdf["name"]):
                origin, at = _open(path)
                part = f"{base}/.{name}.part"
                with origin.open_input_file(at) as src, target.open_output_stream(
                        part, compression=None) as out:
                    while data := src.read(CHUNK_BYTES):
                        out.write(data)
                target.move(part, f"{base}/{name}")
            yield pdf[["name"]]

    # each file once, whatever reads the result: the copy is a job of its own
    (source.mapInPandas(copy, "name string").write.format("noop").mode("overwrite").save())
    names = source.select("name") if expected is None else expected.select("name")
    return check_objects(spark, destination, names).select(
        "name", "length", content_type(F.col("name"), path_name).alias("content_type"),
        "present")
