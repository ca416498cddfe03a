"""Round documents as JSON text: lossless explode and merge by key presence.

A parsed struct can't tell an absent key from a null one, and inference turns
geometries of mixed types into strings.  Here each level is parsed from its own
text: the levels below it and the geometry stay text, and ``json_object_keys``
says which keys a document really holds.  So a parent's key wins whenever it is
present, null or not, and a key that only other documents have changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from gridwise.operators.shape import (GEOMETRY_PATH, INSPECTION_DROP, INSPECTION_RESULTS,
                                      RESULT_DROP, ROUND_INSPECTIONS)

_TEXTS = ArrayType(StringType())


def _element(schema: StructType, name: str) -> StructType:
    if name not in schema.fieldNames():
        return StructType([])
    kind = schema[name].dataType
    inner = kind.elementType if isinstance(kind, ArrayType) else None
    return inner if isinstance(inner, StructType) else StructType([])


def _without(schema: StructType, *names: str) -> StructType:
    return StructType([f for f in schema.fields if f.name not in names])


def _cut(schema: StructType, steps: list[str]) -> StructType:
    """The schema without the field at a path, and without structs left empty."""
    out = []
    for f in schema.fields:
        if f.name != steps[0]:
            out.append(f)
        elif len(steps) > 1 and isinstance(f.dataType, StructType):
            inner = _cut(f.dataType, steps[1:])
            if inner.fields:
                out.append(StructField(f.name, inner))
    return StructType(out)


def _as(value: Column, have: DataType, want: DataType) -> Column:
    if have == want:
        return value
    nested = isinstance(have, (StructType, ArrayType, MapType))
    return F.to_json(value) if nested else value.cast("string")


def _merged(child: Column, child_type: StructType, parent: Column, parent_type: StructType,
            parent_keys: Column) -> list[tuple[str, Column, DataType]]:
    """Fields of the merge: the parent's value where the parent has the key."""
    mine = {f.name: f.dataType for f in child_type.fields}
    theirs = {f.name: f.dataType for f in parent_type.fields}
    out = []
    for name in dict.fromkeys([*mine, *theirs]):
        if name not in theirs:
            out.append((name, child.getField(name), mine[name]))
        elif name not in mine:
            out.append((name, parent.getField(name), theirs[name]))
        else:
            # values of different types meet as text
            kind = mine[name] if mine[name] == theirs[name] else StringType()
            out.append((name, F.when(F.array_contains(parent_keys, name),
                                     _as(parent.getField(name), theirs[name], kind))
                        .otherwise(_as(child.getField(name), mine[name], kind)), kind))
    return out


def _keys(text: Column) -> Column:
    return F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))


def _inspection_problem(text: Column, keys: Column, inspection_drop: str, steps: list[str]) -> Column:
    holder = F.get_json_object(text, "$." + ".".join(steps[:-1]))
    return (F.when(~F.array_contains(keys, inspection_drop), F.lit(inspection_drop))
            .when(~F.array_contains(_keys(holder), steps[-1]), F.lit(".".join(steps))))


def explode_round_texts(texts: DataFrame, schema: StructType, order: list[str],
                        mode: str = "failfast", value: str = "value",
                        inspections: str = ROUND_INSPECTIONS, results: str = INSPECTION_RESULTS,
                        inspection_drop: str = INSPECTION_DROP, result_drop: str = RESULT_DROP,
                        geometry_path: str = GEOMETRY_PATH) -> DataFrame:
    """Round documents (column ``value``, one JSON text per row) -> one row per
    result: ``rec`` (merged record, round over inspection over result),
    ``geojson`` (the geometry's text, ``null`` where it is null), ``_doc`` (the
    order columns), ``_i``, ``_r`` and ``problem``.

    Required keys are checked in every document: in ``failfast`` mode a missing
    one raises, in ``permissive`` mode the row that lacks it is left out, and
    ``round_text_problems`` lists it.
    """
    rows = _exploded(texts, schema, order, value, inspections, results, inspection_drop,
                     result_drop, geometry_path)
    if mode == "permissive":
        return rows.where("problem is null").drop("problem")
    if mode != "failfast":
        raise ValueError("mode must be 'failfast' or 'permissive'")
    raised = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(
        F.lit("missing required key: "), F.col("problem"))).cast("string")).otherwise(
        F.col("geojson"))
    return rows.withColumn("geojson", raised).drop("problem")


def round_text_problems(texts: DataFrame, schema: StructType, order: list[str],
                        value: str = "value", **names) -> DataFrame:
    """(_doc, _i, _r, problem) of every document, inspection or result that lacks
    a required key; positions are null above the level of the problem."""
    defaults = {"inspections": ROUND_INSPECTIONS, "results": INSPECTION_RESULTS,
                "inspection_drop": INSPECTION_DROP, "result_drop": RESULT_DROP,
                "geometry_path": GEOMETRY_PATH}
    return (_exploded(texts, schema, order, value, **(defaults | names))
            .where("problem is not null").select("_doc", "_i", "_r", "problem"))


def _exploded(texts, schema, order, value, inspections, results, inspection_drop, result_drop,
              geometry_path) -> DataFrame:
    steps = geometry_path.split(".")
    insp_type = _element(schema, inspections)
    result_type = _element(insp_type, results)
    if not result_type.fields:  # lists of results may stand in the round
        result_type = _element(schema, results)
    round_own = _without(schema, inspections, results)
    insp_own = _cut(_without(insp_type, inspection_drop, results), steps)
    result_own = _without(result_type, result_drop)
    lists = StructType([StructField(inspections, _TEXTS), StructField(results, _TEXTS)])

    doc = texts.select(
        F.struct(*[F.col(c) for c in order]).alias("_doc"), F.col(value).alias("_text"),
        _keys(F.col(value)).alias("_rk"),
        F.from_json(F.col(value), StructType(round_own.fields + lists.fields)).alias("_round"))
    # documents and inspections without their list give one row with a problem
    doc = doc.withColumn("_p0", F.when(F.col("_round").getField(inspections).isNull(),
                                       F.lit(inspections)))
    insp = doc.select("*", F.posexplode_outer(F.col("_round").getField(inspections))
                      .alias("_i", "_it"))
    insp = insp.where("_p0 is not null or _it is not null").select(
        "_doc", "_rk", "_round", "_p0", "_i", "_it", _keys(F.col("_it")).alias("_ik"),
        F.from_json("_it", StructType(insp_own.fields + lists.fields[1:])).alias("_insp"),
        F.coalesce(F.get_json_object("_it", "$." + geometry_path), F.lit("null")).alias("geojson"))
    own_results = F.when(F.array_contains("_rk", results), F.col("_round").getField(results)
                         ).otherwise(F.col("_insp").getField(results))
    problem = F.coalesce(
        F.col("_p0"), _inspection_problem(F.col("_it"), F.col("_ik"), inspection_drop, steps),
        F.when(own_results.isNull(), F.lit(results)))
    merged = _merged(F.col("_insp"), insp_own, F.col("_round"), round_own, F.col("_rk"))
    merged = [m for m in merged if m[0] not in (inspection_drop, result_drop)]
    level = insp.select(
        "_doc", "_i", "geojson", problem.alias("_p1"), own_results.alias("_results"),
        F.array_union("_rk", "_ik").alias("_mk"),
        F.struct(*([v.alias(n) for n, v, _ in merged] or [F.lit(None).alias("_none")])).alias("_m"))
    merged_type = StructType([StructField(n, t) for n, _, t in merged])
    res = level.select("*", F.posexplode_outer(F.when(F.col("_p1").isNull(), F.col("_results")))
                       .alias("_r", "_rt")).where("_p1 is not null or _rt is not null")
    res = res.withColumn("_res", F.from_json("_rt", result_own))
    rec = _merged(F.col("_res"), result_own, F.col("_m"), merged_type, F.col("_mk"))
    missing = F.when(F.col("_p1").isNull() & ~F.array_contains(_keys(F.col("_rt")), result_drop),
                     F.lit(result_drop))
    return res.select("_doc", "_i", "_r",
                      F.struct(*[v.alias(n) for n, v, _ in rec]).alias("rec"), "geojson",
                      F.coalesce("_p1", missing).alias("problem"))
