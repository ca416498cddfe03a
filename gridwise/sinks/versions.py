"""Tables that are replaced while others read them (K1, K3).

A table is a folder of immutable versions and of commits::

    <path>/v-<id>/...             rows of one version, written by Spark's commit protocol
    <path>/_commits/<number>.<id> an empty file: the version with this id is in force

Replacing a table writes a new version and then makes one file.  That one creation is
the commit; no file or folder is moved, and the table is never absent.  A reader takes
the version of the last commit (highest number, then id) at the time it is called, and
keeps reading it however often the table is replaced meanwhile.  A run that fails before
its commit leaves an unnamed version behind, which ``remove_old`` clears away.

Everything goes through the Hadoop file system of the path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"


def _store(spark: SparkSession, path: str):
    """The file system of a path, and a function that makes paths below it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    root = path.rstrip("/")
    store = make(root).getFileSystem(spark._jsc.hadoopConfiguration())
    return store, lambda name: make(f"{root}/{name}")


def commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version id) of all commits, oldest first."""
    store, at = _store(spark, path)
    if not store.exists(at(COMMITS)):
        return []
    names = [f.getPath().getName() for f in store.listStatus(at(COMMITS))]
    found = [n.split(".", 1) for n in names if not n.startswith((".", "_"))]
    return sorted((int(number), version) for number, version in found)


def replace_version(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a new version of the table at ``path`` and commit it.  Of runs that
    end at the same time the one that commits with the higher number, then id, is in
    force."""
    spark = df.sparkSession
    version = uuid.uuid4().hex
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path.rstrip('/')}/v-{version}")
    done = commits(spark, path)
    number = done[-1][0] + 1 if done else 0
    store, at = _store(spark, path)
    store.create(at(f"{COMMITS}/{number:012d}.{version}"), False).close()
    return path


def version_path(spark: SparkSession, path: str) -> str:
    """The folder of the version in force."""
    done = commits(spark, path)
    if not done:
        raise FileNotFoundError(f"no committed version of {path}")
    return f"{path.rstrip('/')}/v-{done[-1][1]}"


def scan_version(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The rows of the version in force now."""
    return spark.read.format(fmt).load(version_path(spark, path))


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions (one at least) and what failed runs left;
    the number of versions deleted.  Call it when no run is writing and no reader is
    left on older versions."""
    store, at = _store(spark, path)
    done = commits(spark, path)
    stay = {version for _, version in done[-max(1, keep):]}
    for number, version in done:
        if version not in stay:
            store.delete(at(f"{COMMITS}/{number:012d}.{version}"), False)
    gone = 0
    for found in store.listStatus(at("")) if store.exists(at("")) else []:
        name = found.getPath().getName()
        if name.startswith("v-") and name[2:] not in stay:
            store.delete(at(name), True)
            gone += 1
    return gone
