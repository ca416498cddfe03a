"""The elements of one large JSON document, read by many tasks.

A pretty-printed or compact FeatureCollection has no line that is a feature, so a
plain text scan cannot cut it.  Here the file is read in pieces that end at ``}``
(the text source splits files at such borders at any place).  Whether a piece starts
inside a string depends on how many quotes stand before it, and how deep it lies on
the brackets before it: both are prefix sums.

1. Each piece gives the parity of its quotes and its change of depth, for a start
   outside and one inside a string.
2. A block (one file split) adds up its pieces for either start; one row per block
   goes through a window per file, which gives each block's true start.
3. Within its block each piece then knows its depth.  Where a piece ends at the depth
   of the list's elements, an element ends.

Elements within a block are put together there; the parts at the ends of blocks
meet by the number of blocks before them that hold a border.  No task sees more than
a block at a time, apart from an element that is larger than one.  (The joins with the
rows of blocks are merge joins, so that pieces stay dealt by block: a plan that
broadcasts the pieces would leave them dealt by file.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# depth of the elements' list: the root object is 1, a list in it 2
LIST_DEPTH = 2
_BLOCK = ["file", "block"]
# a string, or one that the piece does not end
_STRING = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|$)'


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _change(piece: Column) -> Column:
    """Opening less closing brackets of a piece outside of strings."""
    bare = F.regexp_replace(piece, _STRING, "")
    return _count(bare, "{[") - _count(bare, "}]")


def _pieces(spark: SparkSession, path: str, keep_text: bool) -> DataFrame:
    """One row per piece: its file, block and place, ``quotes`` (parity), and
    ``out``/``inside``: the change of depth up to and with the ``}`` after the piece,
    for a start outside and inside a string."""
    text = F.col("value")
    quotes = _count(F.regexp_replace(text, r"(?s)\\.", ""), '"') % 2
    # the brace after a piece counts if the piece ends outside of strings
    out = _change(text) - (1 - F.col("quotes"))
    inside = _change(F.concat(F.lit('"'), text)) - F.col("quotes")
    rows = (spark.read.option("lineSep", "}").text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("place"), "value",
                    quotes.alias("quotes")))
    return rows.select("file", "block", "place", "quotes", out.alias("out"), inside.alias("inside"),
                       *(["value"] if keep_text else []))


def _within_block(pieces: DataFrame) -> DataFrame:
    """Adds ``odd``: the parity of the quotes before a piece in its block."""
    before = Window.partitionBy(*_BLOCK).orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1)
    return pieces.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)


def _block_starts(pieces: DataFrame) -> DataFrame:
    """(file, block, in_string, depth, end_depth, end_string): the state before each
    block, and the state at the end of its file."""
    change = F.when(F.col("odd") == 0, F.col("out")).otherwise(F.col("inside"))
    turned = F.when(F.col("odd") == 0, F.col("inside")).otherwise(F.col("out"))
    blocks = (_within_block(pieces).groupBy(*_BLOCK)
              .agg((F.sum("quotes") % 2).alias("quotes"), F.sum(change).alias("from_out"),
                   F.sum(turned).alias("from_inside")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    blocks = blocks.withColumn(
        "in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    blocks = blocks.withColumn("change", F.when(F.col("in_string") == 0, F.col("from_out"))
                               .otherwise(F.col("from_inside")))
    return blocks.select(*_BLOCK, "in_string",
                         F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
                         F.sum("change").over(whole).alias("end_depth"),
                         (F.sum("quotes").over(whole) % 2).alias("end_string"))


def _with_depth(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Pieces with ``border``: 1 where an element ends with the piece's brace."""
    known = _within_block(pieces.join(starts.hint("merge"), _BLOCK))
    start = (F.col("odd") + F.col("in_string")) % 2
    change = F.when(start == 0, F.col("out")).otherwise(F.col("inside"))
    upto = Window.partitionBy(*_BLOCK).orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = (start + F.col("quotes")) % 2
    depth = F.col("depth") + F.sum("change").over(upto)
    return (known.withColumn("change", change).withColumn("end", end)
            .withColumn("border", ((depth == LIST_DEPTH) & (F.col("end") == 0)).cast("int")))


def list_elements(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    """(file, head, value): the text up to the end of each object that lies two levels
    deep in a file, from the end of the one before.  ``head`` marks texts that begin
    with other members of the root or with the start of a list.

    A file that ends within a string or within brackets raises in ``failfast`` mode;
    in ``permissive`` mode it gives the elements that are whole.
    """
    if mode not in ("failfast", "permissive"):
        raise ValueError("mode must be 'failfast' or 'permissive'")
    starts = _block_starts(_pieces(spark, path, False))
    cut_off = (F.col("end_string") == 1) | (F.col("end_depth") > 0)
    light = _with_depth(_pieces(spark, path, False), starts)
    borders = light.groupBy(*_BLOCK).agg(F.sum("border").alias("borders"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    borders = borders.withColumn("blocks_before", F.coalesce(
        F.sum(F.signum("borders")).over(earlier), F.lit(0.0)).cast("long"))
    before = Window.partitionBy(*_BLOCK).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = (_with_depth(_pieces(spark, path, True), starts).join(borders.hint("merge"), _BLOCK)
              .withColumn("nth", F.coalesce(F.sum("border").over(before), F.lit(0))))
    # parts before a block's first border and after its last one go on in other blocks
    first, last = F.col("nth") == 0, F.col("nth") == F.col("borders")
    shared = first | last
    whole = placed.select(
        "file", "value", "border", "block", "place", "end",
        F.when(shared, F.lit(-1)).otherwise(F.col("block")).alias("in_block"),
        F.when(first, F.col("blocks_before"))
        .when(last, F.col("blocks_before") + 1).otherwise(F.col("nth")).alias("number"),
        cut_off.alias("cut_off"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
        "block", "place", F.concat("value", F.lit("}")).alias("t")))), lambda p: p["t"]), "")
    joined = (whole.groupBy("file", "in_block", "number")
              .agg(text.alias("value"), F.max("border").alias("ends"),
                   F.max("cut_off").alias("cut_off")))
    if mode == "failfast":
        joined = joined.withColumn("value", F.when(F.col("cut_off"), F.raise_error(F.concat(
            F.lit("the JSON document ends too early: "), F.col("file"))).cast("string"))
            .otherwise(F.col("value")))
    head = ~F.col("value").rlike(r"^\s*,")
    return joined.where("ends = 1").select("file", head.alias("head"), "value")


def list_texts(spark: SparkSession, path: str, member: str, mode: str = "failfast") -> DataFrame:
    """(file, value): the JSON text of each object in the root's list ``member``.

    Objects of other lists of the root come along (but for their first ones); a reader
    tells them by their content."""
    found = list_elements(spark, path, mode)
    start = f'(?s)^.*?"{member}"\\s*:\\s*\\[\\s*'
    text = F.when(F.col("head"), F.when(F.col("value").rlike(start),
                                        F.regexp_replace("value", start, ""))
                  ).otherwise(F.regexp_replace("value", r"^[\s,]*", ""))
    return found.select("file", text.alias("value")).where(F.startswith("value", F.lit("{")))
