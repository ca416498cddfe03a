"""Dense row index 0..n-1 in a given order, without a single-partition window
and with one evaluation of the input.

``row_number().over(Window.orderBy(k))`` moves every row into one task, and a
range partitioning of the rows themselves evaluates them once more to sample
them.  Here the rows are evaluated once:

1. they are stored as they come, each with a number of its own (``sinks.stored``);
2. the order keys, weights and numbers alone (light rows) are range-partitioned and
   stored too, so that the layout is fixed for the passes below, even if an executor
   is lost and tasks re-run;
3. sums of weights per partition — one row per partition reaches the driver — become
   starting offsets, a window within each partition gives the rest;
4. the rows get their start by a join on their number, broadcast where the starts are
   measured to be small.

A row of weight w takes w numbers: a document (or an inspection) that unfolds into
w rows is numbered before it is unfolded, and each row adds its position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gridwise.operators.joins import DEFAULT_BROADCAST_ROWS
from gridwise.sinks.stored import stored


def tiebreak(df: DataFrame):
    """A hash of the row, over the columns that have one (maps don't)."""
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields
                if "map<" not in f.dataType.simpleString()
                and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*hashable) if hashable else F.lit(0).cast("long")


_LOW_BITS = (1 << 33) - 1  # a row's place in its partition, in monotonically_increasing_id


def with_starts(df: DataFrame, order_cols: list[str], weight: Column | None, name: str = "_start",
                partitions: int | None = None) -> DataFrame:
    """``df`` with the sum of the weights of all rows before each in the order of
    ``order_cols``.  Rows with equal keys follow each other in some order.  A null
    weight counts as 0; without ``weight`` every row weighs 1.

    ``df`` is evaluated once, to be stored.
    """
    return starts_of(stored_rows(df, weight), order_cols, weight is not None, name, partitions)


def stored_rows(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """``df`` stored, with a number ``_row`` of each row and its weight."""
    each = F.lit(1) if weight is None else F.coalesce(weight, F.lit(0))
    return stored(df.withColumn("_weight", each.cast("long"))
                  .withColumn("_row", F.monotonically_increasing_id()), "rows")


def starts_of(laid: DataFrame, order_cols: list[str], weighted: bool = True, name: str = "_start",
              partitions: int | None = None) -> DataFrame:
    """``with_starts`` of ``stored_rows``."""
    spark: SparkSession = laid.sparkSession
    # the rows' numbers split a key that a third of the table shares over several ranges
    light = (laid.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(order_cols)],
                         "_row", "_weight"))
    keys = [*[F.col(f"_k{i}") for i in range(len(order_cols))], F.col("_row")]
    light = (light.repartitionByRange(*([partitions] if partitions else []), *keys)
             .sortWithinPartitions(*keys).withColumn("_pid", F.spark_partition_id())
             .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))))
    light = stored(light, "starts")
    sums = light.groupBy("_pid").agg(F.sum("_weight").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    offsets, total, rows = [], 0, 0
    for row in sums.orderBy("_pid").collect():
        offsets.append((int(row["_pid"]), total))
        total += int(row["_n"])
        rows += int(row["_rows"])
    bases = spark.createDataFrame(offsets, StructType([
        StructField("_pid", LongType(), False), StructField("_base", LongType(), False)]))
    before = Window.partitionBy("_pid").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.col("_at") if not weighted else F.coalesce(F.sum("_weight").over(before), F.lit(0))
    starts = (light.withColumn("_in", inside)
              .join(F.broadcast(bases), "_pid")   # one row per partition: bounded
              .select("_row", (F.col("_base") + F.col("_in")).alias(name)))
    # two numbers a row, counted above; a hash join leaves the rows themselves unsorted
    starts = F.broadcast(starts) if rows <= DEFAULT_BROADCAST_ROWS else starts.hint("shuffle_hash")
    return laid.join(starts, "_row").drop("_row", "_weight")


def with_row_index(df: DataFrame, order_cols: list[str], name: str = "idx",
                   partitions: int | None = None) -> DataFrame:
    """``df`` with the dense number 0..n-1 of each row in the order of ``order_cols``."""
    return with_starts(df, order_cols, None, name, partitions)
