"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

The size of a document is its number of words; a source's size is the sum.
The words of all sources are shared out by weight (1, 2, 3, repeating, over
the sources in code point order, null last); a source gets at most ``max_epochs``
times its size, and what is over goes to the others by weight, until nobody is
above its limit.  A source's target then is met by complete epochs (every
document taken as often as the target holds the whole source) and a fractional
one: each document draws an exponential key divided by its quality weight, and
documents are taken in key order until the rest of the target is reached.

Everything is DataFrame operations.  No source is sorted in one task: keys fall
into ``BINS`` bins of a source, bins are summed and prefix-summed, and only the
bin in which a target ends is ordered document by document.

Defined results: a null text has size 0, is never drawn into a fractional
epoch, and takes 0.  The key is a function of doc_id, source, size and of the
row's number among equal (doc_id, source, size), so reruns agree, and repeated
rows draw different keys.  Equal keys are ordered by doc_id.  The last document
drawn is the one with which the sum comes closest to the target.  Null sources
form one source.  Sizes and targets are exact up to 2**53 words.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwise.llm.common import materialize, table

WEIGHT_CYCLE = 3
MAX_EPOCHS = 3
BINS = 4096
REPEATS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(size: Column, chars: Column) -> Column:
    """Weight of a document in the fractional draw: 1 for texts whose mean word
    is 3 to 10 characters long (with its separator), 0.5 for others."""
    mean = chars / F.greatest(size, F.lit(1))
    return F.when((mean >= 3) & (mean <= 10), 1.0).otherwise(0.5)


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target``.

    Sources are few against documents: one row each, ordered in one window.
    Filling by weight up to a limit each: with sources ordered by limit per
    weight, the first k are at their limit for the smallest k at which the
    words left, divided by the weights left, are no more than the next
    source's limit per weight.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sources.withColumn("weight", (F.row_number().over(order) - 1) % WEIGHT_CYCLE + 1)
    limit = F.col("source_size") * max_epochs
    ranked = ranked.withColumn("limit", limit).withColumn("ratio", F.col("limit") / F.col("weight"))
    filled = Window.orderBy("ratio", F.col("source").isNull(), F.col("source"))
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    stepped = ranked.select("*", F.struct(
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .alias("left"), F.sum("weight").over(after).alias("weights")).alias("share"))
    # the common level is that of the first source which stays below its limit; a
    # source's part of it is one division, as it would be by hand
    stays = F.col("share.left") / F.col("share.weights") <= F.col("ratio")
    common = F.first(F.when(stays, F.col("share")), True).over(
        filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    stepped = stepped.withColumn("common", common)
    part = F.col("common.left") * F.col("weight") / F.col("common.weights")
    return stepped.select(
        "source", "source_size",
        F.least(F.col("limit").cast("double"),
                F.coalesce(part, F.col("limit").cast("double"))).alias("target"))


def draw_key(weight: Column) -> Column:
    """Exponential key divided by the weight, from 52 bits of an MD5 hash."""
    text = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                       F.coalesce(F.col("source"), F.lit("")), F.col("size").cast("string"),
                       F.col("copy").cast("string"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 1.0) / float(2 ** 52 + 1)) / weight


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, bins: int = BINS,
        carry: Sequence[str] = ()) -> DataFrame:
    """docs (doc_id, source, text) -> doc_id, source, size, source_size, target
    (of the source) and taken (words of the document that the mix takes).

    Columns named in ``carry`` come along; rows that differ in them only are told
    apart by them."""
    sized = docs.select("doc_id", "source", *carry, word_count(F.col("text")).alias("size"),
                        F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    # the texts are read once; what follows works on a few numbers per document
    sized = materialize(sized, "mix-sizes")
    copies = Window.partitionBy("doc_id", "source", "size").orderBy("chars", *carry)
    spread = sized.groupBy("doc_id", "source", "size", "chars", *carry).agg(F.count(F.lit(1)).alias("n"))
    # rows that repeat one another are numbered by exploding their count; a large count
    # in blocks, which are dealt out before they unfold
    spread = spread.withColumn("before", F.coalesce(F.sum("n").over(
        copies.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    few = spread.where(F.col("n") <= REPEATS)
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / REPEATS)))
    many = (spread.where(F.col("n") > REPEATS).select("*", blocks.alias("block"))
            .select("doc_id", "source", "size", "chars", *carry,
                    F.least(F.col("n") - F.col("block") * REPEATS, F.lit(REPEATS)).alias("n"),
                    (F.col("before") + F.col("block") * REPEATS).alias("before"))
            .repartition("doc_id", "source", "size", "before"))
    keyed = (few.unionByName(many)
             .select("doc_id", "source", "size", "chars", *carry, "before",
                     F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
             .withColumn("copy", F.col("before") + F.col("i") - 1)
             .withColumn("key", draw_key(quality_weight(F.col("size"), F.col("chars"))))
             .withColumn("bin", F.floor((1 - F.exp(-F.col("key"))) * bins).cast("int")))
    keyed = materialize(keyed.select("doc_id", "source", "size", *carry, "copy", "key", "bin"), "mix-keys")

    by_bin = keyed.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    sums = by_bin.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    goal = targets(sums, max_epochs).withColumn(
        "epochs", F.when(F.col("source_size") > 0,
                         F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        .cast("long")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    # one row per source and bin: at most ``bins`` rows of a source in a window
    up_to = Window.partitionBy("source").orderBy("bin").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    plan = (by_bin.withColumn("bin_end", F.sum("bin_size").over(up_to)).alias("b")
            .join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")))
            .select("b.source", "b.bin", "bin_size", "bin_end", "source_size", "target",
                    "epochs", "rest"))
    # salted, as a source may hold a third of all documents in few bins
    row = keyed.alias("k").join(
        plan.alias("p"), (F.col("k.bin") == F.col("p.bin"))
        & F.col("k.source").eqNullSafe(F.col("p.source"))).select(
        "k.doc_id", "k.source", "k.size", *[f"k.{c}" for c in carry], "k.key", "k.copy", "k.bin", "bin_size", "bin_end",
        "source_size", "target", "epochs", "rest")
    base = F.col("epochs") * F.col("size")
    inside = F.col("bin_end") <= F.col("rest")
    outside = F.col("bin_end") - F.col("bin_size") >= F.col("rest")
    sure = row.where(inside | outside).withColumn(
        "taken", base + F.when(inside, F.col("size")).otherwise(0))
    within = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "copy").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = F.col("bin_end") - F.col("bin_size") + F.sum("size").over(within)
    # taken as long as it brings the sum closer to the rest than leaving it does
    ended = row.where(~(inside | outside)).withColumn("end", end).withColumn(
        "taken", base + F.when(F.col("end") - F.col("size") / 2 <= F.col("rest"),
                               F.col("size")).otherwise(0))
    columns = ["doc_id", "source", *carry, "size", "source_size", "target",
               F.col("taken").cast("long").alias("taken")]
    return sure.select(*columns).unionByName(ended.select(*columns))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         coalesce(length(text), 0) AS chars
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap,
             1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS weight
      FROM s),
-- share by weight, hold those above their limit there, share the rest again
r AS (
  SELECT source, source_size, cap, weight, 0 AS round, false AS held,
         CAST(sum(source_size) OVER () AS DOUBLE) * weight / sum(weight) OVER () AS target
  FROM w
  UNION ALL
  SELECT source, source_size, cap, weight, round + 1, held OR target > cap,
         CASE WHEN held OR target > cap THEN CAST(cap AS DOUBLE)
              ELSE (sum(source_size) OVER () - sum(CASE WHEN held OR target > cap THEN cap ELSE 0 END) OVER ())
                   * weight / sum(CASE WHEN held OR target > cap THEN 0 ELSE weight END) OVER () END
  FROM r WHERE round < (SELECT count(*) FROM w)),
t AS (SELECT source, source_size, target,
             CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
      FROM r WHERE round = (SELECT count(*) FROM w)),
k AS (SELECT d.doc_id, d.source, size, source_size, target, epochs, c,
             -ln((CAST(('0x' || substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''),
                  coalesce(d.source, ''), CAST(size AS VARCHAR), CAST(c AS VARCHAR))), 1, 13)) AS BIGINT) + 1.0)
                 / 4503599627370497.0)
             / CASE WHEN chars / greatest(size, 1) BETWEEN 3 AND 10 THEN 1.0 ELSE 0.5 END AS key
      FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size ORDER BY chars) - 1 AS c FROM d) d
      JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, c
                                ROWS UNBOUNDED PRECEDING) AS upto FROM k)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + CASE WHEN upto - size / 2 <= target - epochs * source_size
                                  AND target > epochs * source_size THEN size ELSE 0 END AS BIGINT) AS taken
FROM e
"""
