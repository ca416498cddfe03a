"""Nest flat rows into bounded lists (documents) without collecting a whole
group into one task.

``bounded_chunks`` lays rows out in a total order with range partitioning
(a hot group key is split across ranges because the order keys differ),
checkpoints that layout so ids are stable on re-execution, and numbers
consecutive runs of at most ``max_size`` rows.  ``nest`` then collects each
(group, chunk) into a sorted list: every list holds at most ``max_size``
elements, and concatenating a group's lists in chunk order gives the group
in order.  Where the rows of a group have a key of their own, ``nest`` cuts by
spans of that key instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwise.operators.row_index import tiebreak
from gridwise.session import checkpoint_root


def bounded_chunks(df: DataFrame, group_keys: list[str], order_keys: list[str],
                   max_size: int = 64, partitions: int | None = None,
                   name: str = "_chunk") -> DataFrame:
    spark = df.sparkSession
    checkpoint_root(spark)
    keys = [F.col(c) for c in group_keys + order_keys] + [F.col("_tie"), F.col("_draw")]
    laid = (df.withColumn("_tie", tiebreak(df)).withColumn("_draw", F.rand(17))
            .repartitionByRange(*([partitions] if partitions else []), *keys)
            .sortWithinPartitions(*keys).drop("_tie", "_draw")
            .withColumn(name, F.floor(F.monotonically_increasing_id() / F.lit(max_size)))
            .checkpoint(eager=True))
    return laid


def nest(df: DataFrame, group_keys: list[str], order_keys: list[str], fields: list[Column],
         list_name: str, max_size: int = 64, span: int | None = None) -> DataFrame:
    """Group rows into lists of at most ``max_size`` structs ``fields``,
    ordered by ``order_keys``.  Output: group keys, ``_chunk``, ``list_name``.

    With ``span``, the first order key is a whole number that no two rows of a
    group share: a list then holds the rows of one span of it, at most ``span``.
    That cut is arithmetic: it needs no total order and no checkpoint, and it is
    the same on every cluster.
    """
    carried = [F.struct(*fields).alias("_v")]
    rows = nest_rows(df, group_keys, order_keys, list_name, max_size, span, carried)
    return rows.withColumn(list_name, F.transform(list_name, lambda e: e["_v"]))


def nest_rows(df: DataFrame, group_keys: list[str], order_keys: list[str], list_name: str,
              max_size: int = 64, span: int | None = None, carried: list[Column] = (),
              together: str | None = None) -> DataFrame:
    """``nest`` whose lists hold the order keys under their own names and the ``carried``
    columns.  Wide fields that follow from these are better made after the last shuffle.

    With ``together``, one of the group keys, the rows are dealt out by that key alone: a
    join on it needs no second shuffle, and no lists are serialised before the first."""
    if span is None:
        chunked = bounded_chunks(df, group_keys, order_keys, max_size)
    else:
        chunked = df.withColumn("_chunk", F.floor(F.col(order_keys[0]) / F.lit(span)))
    ordered = F.struct(*order_keys, *carried)
    if together is not None:
        chunked = chunked.select(*group_keys, "_chunk", ordered.alias("_e")).repartition(together)
        ordered = F.col("_e")
    return chunked.groupBy(*group_keys, "_chunk").agg(
        F.array_sort(F.collect_list(ordered)).alias(list_name))
