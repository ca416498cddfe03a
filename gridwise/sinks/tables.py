"""Table sinks: replace a table (K1), drop-and-create-as-select (K3), and the
matching scan (S5).  Paths live in the shared folder, so a lost executor's
tasks simply re-run: Spark's file commit protocol publishes each write once.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from gridwise.sinks.versions import commits, scan_version


def replace_table(df: DataFrame, path: str, fmt: str = "parquet",
                  partition_by: list[str] | None = None) -> str:
    """K1: write ``df`` beside ``path``, then put it in the old table's place.

    Readers see the old table until the new one is complete; a run that fails
    leaves it untouched.  On object stores the move is a copy, and ``path`` is
    briefly absent between the two moves; ``versions.replace_version`` replaces tables
    under readers without that."""
    fresh = f"{path.rstrip('/')}__new_{uuid.uuid4().hex[:8]}"
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(fresh)
    _swap(df.sparkSession, fresh, path)
    return path


def _swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Move ``fresh`` to ``path`` with the Hadoop file system of the paths."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    new, old = jvm.org.apache.hadoop.fs.Path(fresh), jvm.org.apache.hadoop.fs.Path(path)
    store = old.getFileSystem(conf)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}__old_{uuid.uuid4().hex[:8]}")
    had = store.exists(old)
    if had and not store.rename(old, aside):
        raise OSError(f"cannot move {path} aside")
    if not store.rename(new, old):
        if had:
            store.rename(aside, old)
        raise OSError(f"cannot move the new table to {path}")
    if had:
        store.delete(aside, True)


def scan_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """``SELECT * FROM t`` for a catalog table name, a path, or the path of a table
    with versions (``versions.replace_version``)."""
    if ("/" in source or ":" in source) and commits(spark, source):
        return scan_version(spark, source, fmt)
    if "/" in source or ":" in source:
        return spark.read.format(fmt).load(source)
    return spark.table(source)


_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}$")


def create_table_as_select(spark: SparkSession, df: DataFrame, table: str, location: str,
                           fmt: str = "parquet") -> DataFrame:
    """K3: ``DROP TABLE IF EXISTS t; SELECT ... INTO t`` — the rows are written
    to ``location`` (a fresh folder per run) first.  A table of the same columns and
    format then gets the new location, in one step of the catalog, so it is never
    absent; otherwise its entry is dropped and made anew.  Names may have a schema."""
    if not _NAME.match(table):
        raise ValueError(f"not a plain table name: {table!r}")
    df.write.format(fmt).save(location)
    if spark.catalog.tableExists(table) and _same_table(spark, table, location, fmt):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
        return spark.table(table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=location, source=fmt)
    return spark.table(table)


def _same_table(spark: SparkSession, table: str, location: str, fmt: str) -> bool:
    """Whether the catalog's table has the format and the columns written to ``location``."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    columns = [(f.name, f.dataType) for f in spark.read.format(fmt).load(location).schema.fields]
    return (about.get("Type") in ("EXTERNAL", "MANAGED")
            and str(about.get("Provider", "")).lower() == fmt and "'" not in location
            and columns == [(f.name, f.dataType) for f in spark.table(table).schema.fields])
