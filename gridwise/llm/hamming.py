"""Exact k nearest binary codes by multi-index hashing.

A 64-bit code is cut into segments of about log2(number of codes) - 4 bits, and
every segment is indexed by its value.  Two codes at distance d have a segment
that differs in at most d / segments bits.  So round r probes, for every query
still open, the values at distance r in each segment, verifies the codes found
there by their whole Hamming distance, and after it every code up to distance
``segments * (r + 1) - 1`` is known.  A query is closed when that covers its
k-th best distance; the others go on with the next radius, and the join keeps
only codes that are no farther than the k-th best so far.

Equal codes are one index entry with their number and their k smallest ids, so
a code that a third of all rows share is compared once per query.

Defined results: rows are ranked by distance, then id.  Rows without code are
neither found nor searched for; a null id never is a query and ranks after other
ids.  Repeated rows rank as rows of their own.  With fewer than k rows all are
returned.  Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwise.llm.common import materialize, table
from gridwise.llm.rp_forest import usable

BITS = 64
K = 10
QUERY_STEP = 100
PROBE_ROWS = 1 << 16


def sign_code(vector: Column) -> Column:
    """64 sign bits: bit i is set where the components i, i + 64, ... sum to
    more than zero."""
    x = vector.cast("array<double>")
    folded = F.when(F.size(x) <= BITS, x).otherwise(F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda i: F.aggregate(F.filter(x, lambda v, j: j % BITS == i), F.lit(0.0),
                              lambda a, v: a + v)))
    bits = F.transform(folded, lambda v, i: F.when(v > 0, F.call_function(
        "shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def segments(codes: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    width = min(30, max(8, round(math.log2(max(2, codes))) - 4))
    count = math.ceil(BITS / width)
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(edges)]


def segment_value(code: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(code, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _probes(cuts: list[tuple[int, int]], radius: int):
    """Rows (q, seg, value, most) at ``radius`` from each query's segment values."""

    def masks(width: int) -> Iterator[np.ndarray]:
        bits = itertools.combinations(range(width), radius)
        while chunk := list(itertools.islice(bits, PROBE_ROWS)):
            yield np.array([sum(1 << b for b in c) for c in chunk], np.int64)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, most in zip(batch.column("q").to_pylist(), batch.column("most").to_pylist()):
                for seg, (low, width) in enumerate(cuts):
                    if radius > width:
                        continue
                    value = ((q & ((1 << BITS) - 1)) >> low) & ((1 << width) - 1)
                    for mask in masks(width):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(mask), q, np.int64)),
                             pa.array(np.full(len(mask), seg, np.int32)),
                             pa.array(mask ^ value),
                             pa.array(np.full(len(mask), most, np.int32))],
                            ["q", "seg", "value", "most"])

    return probe


def nearest(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """rows (id, code) and queries (query_id, code) -> query_id, rank, id,
    distance of the k nearest rows of each query."""
    rows = rows.where("code is not null").select("id", "code")
    queries = materialize(queries.where("code is not null and query_id is not null")
                          .select("query_id", F.col("code").alias("q")), "hamming-queries")
    ids = Window.partitionBy("code").orderBy(F.col("id").asc_nulls_last())
    # the row limit per code applies before the shuffle already
    ranked = (rows.withColumn("r", F.row_number().over(ids)).where(F.col("r") <= k)
              .groupBy("code").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "id"))),
                                               lambda x: x["id"]).alias("ids")))
    entries = materialize(ranked.withColumn("held", F.size("ids")), "hamming-codes")
    count, total = entries.agg(F.count(F.lit(1)), F.sum("held")).first()
    wanted = min(k, total or 0)
    cuts = segments(count)
    index = materialize(entries.select("code", F.explode(F.array(*[
        F.struct(F.lit(s).alias("seg"), segment_value(F.col("code"), low, width).alias("value"))
        for s, (low, width) in enumerate(cuts)])).alias("s")).select("code", "s.seg", "s.value"),
        "hamming-index")

    # queries with one code share their search
    still = materialize(queries.select("q", F.lit(BITS).alias("most")).distinct(), "hamming-open")
    best = spark_empty(still, "q long, code long, distance int, held int, least long")
    closed = best
    for radius in range(max(w for _, w in cuts) + 1):
        if still.isEmpty() or not wanted:
            break
        probes = still.mapInArrow(_probes(cuts, radius), "q long, seg int, value long, most int")
        cells = index.withColumnsRenamed({"seg": "i_seg", "value": "i_value"}).hint("merge")
        differ = F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).cast("int")
        # many probes come of few queries, which the planner can't know: no side
        # of this join is to be broadcast
        seen = (probes.join(cells, (F.col("seg") == F.col("i_seg"))
                            & (F.col("value") == F.col("i_value")) & (differ <= F.col("most")))
                .select("q", "code").distinct().join(entries, "code")
                .select("q", "code", differ.alias("distance"), "held",
                        F.get("ids", F.lit(0)).alias("least")))
        top = Window.partitionBy("q").orderBy("distance", F.col("least").asc_nulls_last(), "code")
        best = materialize(
            best.unionByName(seen).distinct().withColumn("r", F.row_number().over(top))
            .where(F.col("r") <= k).drop("r"), "hamming-best")
        covered = len(cuts) * (radius + 1) - 1
        full = (best.where(F.col("distance") <= covered).groupBy("q")
                .agg(F.sum("held").alias("n")).where(F.col("n") >= wanted).select("q"))
        full = materialize(full, "hamming-full")
        closed = closed.unionByName(best.join(full, "q", "left_semi"))
        best = best.join(full, "q", "left_anti")
        limits = best.groupBy("q").agg(F.sum("held").alias("n"), F.max("distance").alias("d"))
        still = materialize(still.join(full, "q", "left_anti").select("q").join(limits, "q", "left")
                            .select("q", F.when(F.col("n") >= wanted, F.col("d")).otherwise(BITS)
                                    .alias("most")), "hamming-open")
    closed = closed.unionByName(best)
    last = Window.partitionBy("query_id").orderBy("distance", F.col("id").asc_nulls_last())
    listed = (closed.join(entries.select("code", "ids"), "code")
              .select("q", "distance", F.explode("ids").alias("id")))
    return (queries.join(listed, "q")
            .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "distance"))


def spark_empty(like: DataFrame, schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame([], schema)


def op2_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every hundredth vector, among all vectors."""
    vectors = table(spark, sf_dir, "embeddings").where(usable(F.col("embedding")))
    rows = materialize(vectors.select(F.col("vec_id").alias("id"),
                                      sign_code(F.col("embedding")).alias("code")),
                       "hamming-rows")
    queries = rows.where(F.col("id") % QUERY_STEP == 0).select(
        F.col("id").alias("query_id"), "code")
    return nearest(rows, queries).withColumnRenamed("id", "vec_id")


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_sum(list_transform(range(1, 65), lambda i:
    CASE WHEN embedding[i] > 0 THEN CAST(1 AS HUGEINT) << (i - 1) ELSE CAST(0 AS HUGEINT) END)) AS code
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         bit_count(xor(CAST(q.code AS HUGEINT), CAST(v.code AS HUGEINT))) AS distance
  FROM v q JOIN v ON q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
WHERE rank <= 10
"""
