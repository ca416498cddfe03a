"""The loading jobs: inspection types (E1) and inspection rounds (E2) from
nested documents into flat staging tables with a row index ``idx``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridwise.operators import shape
from gridwise.operators.round_text import explode_round_texts
from gridwise.operators.row_index import starts_of, stored_rows, with_row_index
from gridwise.sinks.stored import stored
from gridwise.sources.documents import read_json_text


def inspection_types(docs: DataFrame, doc_order: list[str] | None = None,
                     with_index: bool = True, mode: str = "failfast") -> DataFrame:
    """One row per score option with its type id/name; ``idx`` numbers
    the rows in document order, then option order."""
    order = None if doc_order is None else F.struct(*[F.col(c) for c in doc_order])
    d = docs.withColumn("_order", order) if order is not None else docs
    flat = shape.explode_types(d, doc_order="_order" if order is not None else None, mode=mode)
    if not with_index:
        return flat.drop("_doc", "_pos")
    out = with_row_index(flat, ["_doc", "_pos"])
    return out.select("idx", *[c for c in flat.columns if c not in ("_doc", "_pos")])


def inspection_rounds(docs: DataFrame, doc_order: list[str] | None = None,
                      with_index: bool = True, mode: str = "failfast") -> DataFrame:
    """Round documents -> one flat row per result (explode inspections,
    explode results, drop the display names, cut the geometry out as JSON
    text, merge round > inspection > result, flatten to dotted columns) with
    ``idx`` in document order.

    The documents are evaluated once: their inspections are stored before the longest
    lists are measured, and numbered by the sizes of their lists of results before these
    unfold."""
    level = shape.inspection_level(docs, mode, doc_order)
    if not with_index:
        return _staged(shape.result_level(stored(level, "inspections"), mode), False)
    size = F.size(F.col("_m").getField(shape.INSPECTION_RESULTS))
    laid = stored_rows(level, F.greatest(size, F.lit(0)))
    flat_cols = shape.flatten_columns(shape.result_level(laid, mode), "rec")
    rows = shape.result_level(starts_of(laid, ["_doc", "_i"]), mode)
    return rows.select((F.col("_start") + F.col("_r")).alias("idx"),
                       *[e.alias(n) for n, e in flat_cols], "geojson")


def landed_rounds(spark: SparkSession, path: str, schema: StructType | None = None,
                  order: list[str] | None = None, with_index: bool = True,
                  mode: str = "failfast", listing: DataFrame | None = None) -> DataFrame:
    """E2 over landed JSON texts (one document per line).  Nothing of a document
    is lost: geometries stay text whatever their types, and a key only wins over
    a child's where the document has it.

    ``schema`` is that of the documents; without one it is inferred, which reads
    them once more.  ``order`` names paths of the documents that set the row
    order (default: ``id``).  With a ``listing`` (uri, position) exactly the listed
    documents are loaded, in its order; a listed uri without a document raises.
    """
    texts = spark.read.text(path).where(F.trim("value") != "")
    schema = schema or read_json_text(spark, path).schema
    if listing is not None:
        texts = texts.withColumn("uri", F.get_json_object("value", "$.uri"))
        if not listing.join(texts, "uri", "left_anti").isEmpty():
            raise LookupError("listed uri without a document")
        texts = listing.select("uri", "position").join(texts, "uri")
        names = ["position"]
    else:
        names = []
        for name in order or ["id"]:
            texts = texts.withColumn(f"_by_{len(names)}", _order_key(schema, name))
            names.append(f"_by_{len(names)}")
    return _staged(explode_round_texts(texts, schema, names, mode), with_index)


def _order_key(schema: StructType, path: str) -> F.Column:
    kind = shape.field_type(schema, path)
    return F.get_json_object("value", f"$.{path}").cast(kind)


def _staged(rows: DataFrame, with_index: bool) -> DataFrame:
    """Exploded rounds -> flat staging columns, numbered by ``idx`` on request."""
    flat_cols = shape.flatten_columns(rows, "rec")
    names = [n for n, _ in flat_cols] + ["geojson"]
    if not with_index:
        return rows.select(*[e.alias(n) for n, e in flat_cols], "geojson")
    flat = rows.select("_doc", "_i", "_r", *[e.alias(n) for n, e in flat_cols], "geojson")
    out = with_row_index(flat, ["_doc", "_i", "_r"])   # stored layout
    return out.select("idx", *[F.col(f"`{n}`") for n in names])
