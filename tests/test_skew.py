"""Hot keys: a group holding a third of all rows is spread over several
range partitions and nested into bounded lists, never one unbounded list."""

from pyspark.sql import functions as F

from gridwise.operators.joins import join_concat_key
from gridwise.operators.nesting import bounded_chunks, nest
from gridwise.operators.row_index import with_row_index


def _skewed(spark, n=30000):
    # a third of the rows share group 0 (and many share one order value)
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))


def test_hot_group_spread_and_bounded(spark):
    df = _skewed(spark)
    laid = bounded_chunks(df, ["g"], ["k"], max_size=64, partitions=8)
    parts = laid.where(F.col("g") == 0).select(F.spark_partition_id().alias("p")).distinct()
    assert parts.count() > 1            # the hot group is not in one task
    lists = nest(df, ["g"], ["k"], [F.col("v")], "items", max_size=64)
    sizes = lists.select(F.size("items").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 64
    assert sizes.agg(F.sum("n")).first()[0] == df.count()


def test_row_index_with_hot_ties(spark):
    df = _skewed(spark, 9000)
    out = with_row_index(df, ["k"], partitions=6)
    idx = sorted(r.idx for r in out.select("idx").collect())
    assert idx == list(range(9000))
    # order respected: idx increases with k
    pairs = out.select("idx", "k").orderBy("idx").collect()
    assert all(a.k <= b.k for a, b in zip(pairs, pairs[1:]))


def test_identical_rows_are_spread(spark):
    same = spark.range(40000).select(F.lit(1).alias("k"), F.lit("x").alias("v"),
                                     F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    out = with_row_index(same, ["k"], partitions=8)
    assert sorted(r.idx for r in out.select("idx").collect()) == list(range(40000))
    laid = bounded_chunks(same, ["k"], ["k"], max_size=64, partitions=8)
    largest = laid.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 20000


def test_null_keys_stay_out_of_the_concat_join(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 3, F.col("id")).alias("a"), F.lit(1).alias("b"))
    right = spark.createDataFrame([(0, 1, "x"), (None, 1, "y"), (2, 1, "z")], "c long, d int, e string")
    joined = join_concat_key(left, right, ["a", "b"], ["c", "d"])
    assert sorted(r.e for r in joined.collect()) == ["x", "z"]
    assert "isnotnull" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert join_concat_key(left, right, ["a", "b"], ["c", "d"], how="left").count() == 1000
