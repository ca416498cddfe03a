"""Helpers shared by the training-data operators: tables, hot-safe group
minimum, connected components.

Every helper keeps its state in DataFrames; where lineage has to be cut the
rows are written as Parquet below the shared folder that the cluster names in
``spark.checkpoint.dir`` and read again.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.session import work_dir

FOLD_COUNT = 5
EDGES_AT_ONCE = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(written: DataFrame) -> None:
    """Delete a table of ``materialize`` that nothing reads any more."""
    spark = written.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(written.written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_memory() -> None:
    """Give the memory that a task freed back to the system.

    Python workers stay for later tasks, and what their allocators keep counts against
    an executor's memory.  Where the C library has no such call, nothing happens."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text is divisible by five; rows without
    an id count as held out, so nothing is learned from them."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLD_COUNT
    return F.coalesce(fold == 0, F.lit(True))


def group_min_by_salt(df: DataFrame, keys: Sequence[str], salt: str,
                      value: str, out: str) -> DataFrame:
    """One row per (keys, salt) that carries the minimum of ``value`` over all
    rows of ``keys`` and their number ``<out>_rows``.

    Both aggregates combine before their shuffle, and a hot key comes back as
    one row per salt, so a join on (keys, salt) spreads its rows over as many
    tasks as there are salts.
    """
    parts = df.groupBy(*keys, salt).agg(F.min(value).alias("_min"),
                                        F.count(F.lit(1)).alias("_n"))
    whole = parts.groupBy(*keys).agg(F.min("_min").alias(out),
                                     F.sum("_n").alias(f"{out}_rows"),
                                     F.collect_list(salt).alias("_salts"))
    return whole.select(*keys, out, f"{out}_rows", F.explode("_salts").alias(salt))


def _attach_min(edges: DataFrame, salts: int) -> DataFrame:
    """edges (u, v) -> (u, v, m) with m the smallest of u and all its v."""
    # dealt once by (u, s), for the minimum and for the join alike (no end is null; said
    # here, as else the join alone would say it and deal its own); the join is no
    # broadcast one, as that takes the minima through the driver, each round anew
    keyed = (edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int"))
             .where("u is not null and s is not null").repartition("u", "s"))
    least = group_min_by_salt(keyed, ["u"], "s", "v", "mv").select(
        "u", "s", F.least("u", "mv").alias("m"))
    return keyed.join(least.hint("merge"), ["u", "s"]).select("u", "v", "m")


def _contracted(links: DataFrame, count: int) -> DataFrame:
    """The ``count`` links with those of each task replaced by stars that connect the
    same nodes: (node, smallest node that the task's links reach from it).

    A task gets about ``EDGES_AT_ONCE`` links, and gives its stars away and begins anew
    when it holds that many nodes."""
    most = EDGES_AT_ONCE

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(node: int) -> int:
            up = above.setdefault(node, node)
            while up != node:
                above[node] = up = above[up]
                node, up = up, above[up]
            return node

        def given() -> pa.RecordBatch:
            found = [(n, r) for n in list(above) if (r := root(n)) != n]
            above.clear()
            return pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int64()),
                                               pa.array([r for _, r in found], pa.int64())], ["u", "v"])

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                a, b = root(u), root(v)
                if a != b:
                    above[max(a, b)] = min(a, b)
                if len(above) >= most:
                    yield given()
        yield given()

    return links.coalesce(max(1, -(-count // most))).mapInArrow(stars, "u long, v long").distinct()


def components(edges: DataFrame, salts: int = 32, name: str = "components") -> DataFrame:
    """Connected components of the undirected edges (u, v) of longs.

    Returns (node, component) for every node of an edge; component is the
    smallest node reachable.  Alternates the large-star and small-star steps
    (Kiveris et al., 2014), each a minimum per node joined back on a salted
    key, until the edge set stays the same.  Each round is written to the
    shared folder, so lineage stays short.  Self loops keep their node as a
    component of its own; rows with a null end are ignored.
    """
    edges = edges.where("u is not null and v is not null").select(
        F.col("u").cast("long"), F.col("v").cast("long"))
    loops = edges.where("u = v").select("u", "v")
    links = edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                         F.least("u", "v").alias("v")).distinct()
    links = materialize(links, name)
    count = links.count()
    if count:  # links of one task are joined there, which spares rounds
        before, links = links, materialize(_contracted(links, count), name)
        discard(before)
    state = _signature(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_attach_min(both, salts).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = _attach_min(large, salts)
        before = links
        links = materialize(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), name)
        discard(before)
        after = _signature(links)
        if after == state:
            break
        state = after
    return (links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .unionByName(loops.select(F.col("u").alias("node"), F.col("v").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                    F.sum((F.xxhash64("v", "u") % 1000003))).first()
    return tuple(row)
