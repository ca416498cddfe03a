"""Document shaping: explode nested records, merge parent into child,
drop fields, extract subtrees as JSON text, flatten to dotted columns.

Two representations are supported:

* struct form (schema known or inferred by ``spark.read.json``): every
  operation is a projection over nested fields and compiles to built-in
  expressions;
* map form (``map<string, string>`` of JSON values, open schema): used when
  documents are so heterogeneous that "key absent" and "key present but null"
  must be told apart (parent-wins merge keeps a present null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from gridwise.operators.flatten import flatten_json_long, flatten_long  # noqa: F401


# ---------------------------------------------------------------------------
# Field names of the inspection API documents.
#   type documents:   id, inspectionItemName, inspectionItemOptions
#   round documents:  inspections -> results; inspections carry
#                     closingUserDisplayName and location.geoJsonFeature.geometry,
#                     results carry creatingUserDisplayName
# ---------------------------------------------------------------------------
TYPE_OPTIONS = "inspectionItemOptions"
TYPE_NAME = "inspectionItemName"
ROUND_INSPECTIONS = "inspections"
INSPECTION_RESULTS = "results"
INSPECTION_DROP = "closingUserDisplayName"
RESULT_DROP = "creatingUserDisplayName"
GEOMETRY_PATH = "location.geoJsonFeature.geometry"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------------------
# explode with parent constants (types) and the 3-level round explode
# ---------------------------------------------------------------------------

def _require(col: Column, what: str, mode: str) -> Column:
    if mode == "failfast":
        return F.when(col.isNull(), F.raise_error(F.lit(f"missing required key: {what}"))
                      ).otherwise(col)
    if mode == "permissive":
        return col
    raise ValueError("mode must be 'failfast' or 'permissive'")


def explode_types(docs: DataFrame, options: str = TYPE_OPTIONS,
                  type_id: str = "id", type_name: str = TYPE_NAME,
                  mode: str = "failfast", doc_order: str | None = None) -> DataFrame:
    """One row per option of each inspection-type document, with the parent's
    id and name added as ``inspection_type_id``/``inspection_type_name``
    (an option's own keys of those names are overwritten).  Empty list -> no
    rows; a missing list raises in ``failfast`` mode.

    Returns the option fields flattened one level plus ``_doc``/``_pos``
    ordering columns (drop them or feed them to ``with_row_index``).
    """
    arr = _require(F.col(options), options, mode)
    keep = [F.col(doc_order).alias("_doc")] if doc_order else [F.monotonically_increasing_id().alias("_doc")]
    exploded = docs.select(*keep, F.col(type_id).alias("_tid"), F.col(type_name).alias("_tname"),
                           F.posexplode(arr).alias("_pos", "_opt"))
    opt_type = exploded.schema["_opt"].dataType
    names = [f.name for f in opt_type.fields if f.name not in (
        "inspection_type_id", "inspection_type_name")]
    return exploded.select("_doc", "_pos", *[F.col("_opt")[n].alias(n) for n in names],
                           F.col("_tid").alias("inspection_type_id"),
                           F.col("_tname").alias("inspection_type_name"))


def merge_parent_wins(child: Column, child_type: StructType, parent: Column,
                      parent_type: StructType, exclude: tuple[str, ...] = ()) -> Column:
    """``child.update(parent)`` on structs: every top-level key of the parent
    replaces the child's (whole value, no deep merge); keys only in the child
    keep their position, parent-only keys are appended in parent order.
    ``exclude`` names are dropped.

    A struct can't tell an absent key from a null one: a null in the parent
    leaves the child's value.  ``round_text`` merges documents by the keys that
    they hold, where a present null wins."""
    ptypes = {f.name: f.dataType for f in parent_type.fields}
    cols = []
    for f in child_type.fields:
        if f.name in exclude:
            continue
        value = child[f.name]
        if f.name in ptypes:
            same = ptypes[f.name] == f.dataType
            value = F.coalesce(parent[f.name], value) if same else parent[f.name]
        cols.append(value.alias(f.name))
    cnames = {f.name for f in child_type.fields}
    for f in parent_type.fields:
        if f.name not in cnames and f.name not in exclude:
            cols.append(parent[f.name].alias(f.name))
    return F.struct(*cols)


def merge_maps(*maps) -> Column:
    """Map form of the parent-wins merge: ``map_concat(child, ..., parent)``
    with later maps winning (needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN``).
    Absent keys stay absent; present nulls win."""
    return F.map_concat(*[_c(m) for m in maps])


def drop_fields(col, struct_type: StructType, names: tuple[str, ...],
                mode: str = "failfast") -> Column:
    """Remove top-level fields of a struct; a name absent from the schema
    raises in ``failfast`` mode (the original pops required keys)."""
    have = {f.name for f in struct_type.fields}
    missing = [n for n in names if n not in have]
    if missing and mode == "failfast":
        raise KeyError(f"required field(s) missing: {missing}")
    present = [n for n in names if n in have]
    return _c(col).dropFields(*present) if present else _c(col)


def drop_key(col, key: str = "dates", dtype: DataType | None = None) -> Column:
    """Drop one key, top level only, from a map or a struct; values of another
    ``dtype`` pass through.  Without ``dtype`` the column is taken for a map."""
    if isinstance(dtype, StructType):
        return _c(col).dropFields(key) if key in dtype.fieldNames() else _c(col)
    if dtype is not None and not isinstance(dtype, MapType):
        return _c(col)
    return F.map_filter(_c(col), lambda k, v: k != F.lit(key))


def extract_json(col, path: str, dtype: DataType) -> Column:
    """A nested field serialised to JSON text (``dtype`` is the field's type);
    a null value becomes the text ``null``, as the original serialises
    ``None``."""
    c = _c(col)
    for step in path.split("."):
        c = c[step]
    return _json_value(c, dtype)


def field_type(struct_type: StructType, path: str) -> DataType:
    t: DataType = struct_type
    for step in path.split("."):
        if not isinstance(t, StructType) or step not in t.fieldNames():
            raise KeyError(f"required field missing: {path}")
        t = t[step].dataType
    return t


def _json_value(c: Column, dtype: DataType) -> Column:
    """JSON text of a value of any type (struct/array via to_json)."""
    if isinstance(dtype, (StructType, ArrayType, MapType)):
        return F.coalesce(F.to_json(c), F.lit("null"))
    wrapped = F.to_json(F.array(c))
    return F.when(c.isNull(), F.lit("null")).otherwise(
        F.regexp_extract(wrapped, r"^\[(.*)\]$", 1))


def explode_rounds(docs: DataFrame, mode: str = "failfast",
                   doc_order: list[str] | str | None = None,
                   inspections: str = ROUND_INSPECTIONS, results: str = INSPECTION_RESULTS,
                   inspection_drop: str = INSPECTION_DROP,
                   result_drop: str = RESULT_DROP,
                   geometry_path: str = GEOMETRY_PATH,
                   redrop: bool = True) -> DataFrame:
    """Round document -> one row per result, with the round merged over each
    inspection and the inspection merged over each result (round wins over
    inspection wins over result).  Before merging, ``inspection_drop`` is
    removed from each inspection, ``result_drop`` from each result, and the
    geometry subtree is cut out of the inspection and kept as JSON text in
    column ``geojson``.

    Returns a struct column ``rec`` (the merged record, still nested) plus
    ``geojson`` and ordering columns ``_doc``, ``_i``, ``_r``.

    A parent that carries a dropped display name would bring it back through
    the merge (the original removes the child's copy before merging);
    ``redrop=True`` removes such names from the merged record as well.
    """
    level = inspection_level(docs, mode, doc_order, inspections, results, inspection_drop,
                             geometry_path)
    return result_level(level, mode, results, inspection_drop, result_drop, redrop)


def inspection_level(docs: DataFrame, mode: str = "failfast",
                     doc_order: list[str] | str | None = None,
                     inspections: str = ROUND_INSPECTIONS, results: str = INSPECTION_RESULTS,
                     inspection_drop: str = INSPECTION_DROP,
                     geometry_path: str = GEOMETRY_PATH) -> DataFrame:
    """The first half of ``explode_rounds``: one row per inspection with ``_doc``,
    ``_i``, ``geojson`` and ``_m``, the inspection merged with its round, whose list of
    results is still nested."""
    rtype: StructType = docs.schema
    if inspections not in rtype.fieldNames():
        raise KeyError(f"required field missing: {inspections}")
    # order columns named with an underscore are bookkeeping, not record keys
    listed = [doc_order] if isinstance(doc_order, str) else list(doc_order or [])
    own = {inspections, *(c for c in listed if c.startswith("_"))}
    round_fields = [f for f in rtype.fields if f.name not in own]
    round_type = StructType(round_fields)
    if doc_order is None:
        order = F.monotonically_increasing_id()
    elif isinstance(doc_order, str):
        order = F.col(doc_order)
    else:
        order = F.struct(*[F.col(c) for c in doc_order])
    lvl1 = docs.select(order.alias("_doc"),
                       F.struct(*[F.col(f.name) for f in round_fields]).alias("_round"),
                       F.posexplode(_require(F.col(inspections), inspections, mode))
                       .alias("_i", "_insp"))
    itype: StructType = lvl1.schema["_insp"].dataType
    insp = drop_fields(F.col("_insp"), itype, (inspection_drop,), mode)
    itype2 = StructType([f for f in itype.fields if f.name != inspection_drop])

    # cut the geometry out of location.geoJsonFeature
    steps = geometry_path.split(".")
    geo_src = F.col("_insp")
    for s in steps:
        geo_src = geo_src[s]
    geo_type = itype
    for s in steps:
        geo_type = geo_type[s].dataType if isinstance(geo_type, StructType) else None
        if geo_type is None:
            raise KeyError(f"required field missing: {geometry_path}")
    geojson = _json_value(geo_src, geo_type)
    # an object left empty by the cut flattens to nothing, so drop it whole
    insp = insp.dropFields(".".join(_empty_after_drop(itype2, steps)))
    itype3 = _drop_path(itype2, steps)

    merged_insp = merge_parent_wins(insp, itype3, F.col("_round"), round_type)
    mtype = _merged_type(itype3, round_type)
    if results not in mtype.fieldNames():
        raise KeyError(f"required field missing: {results}")
    return lvl1.select("_doc", "_i", geojson.alias("geojson"), merged_insp.alias("_m"))


def result_level(level: DataFrame, mode: str = "failfast", results: str = INSPECTION_RESULTS,
                 inspection_drop: str = INSPECTION_DROP, result_drop: str = RESULT_DROP,
                 redrop: bool = True) -> DataFrame:
    """The second half of ``explode_rounds``: rows of ``inspection_level`` -> one row per
    result.  Columns of ``level`` beside its own pass through."""
    own = ["_doc", "_i", "geojson"]
    more = [c for c in level.columns if c not in (*own, "_m")]
    lvl2, mtype = level, level.schema["_m"].dataType
    res_arr = _require(F.col("_m")[results], results, mode)
    inspection_wo_results = F.col("_m").dropFields(results)
    itype4 = StructType([f for f in mtype.fields if f.name != results])
    lvl3 = lvl2.select(*own, *more, inspection_wo_results.alias("_m"),
                       F.posexplode(res_arr).alias("_r", "_res"))
    rtype_: StructType = lvl3.schema["_res"].dataType
    res = drop_fields(F.col("_res"), rtype_, (result_drop,), mode)
    rtype2 = StructType([f for f in rtype_.fields if f.name != result_drop])
    rec = merge_parent_wins(res, rtype2, F.col("_m"), itype4)
    if redrop:
        merged = _merged_type(rtype2, itype4).fieldNames()
        again = [n for n in (inspection_drop, result_drop) if n in merged]
        if again:
            rec = rec.dropFields(*again)
    return lvl3.select("_doc", "_i", "_r", rec.alias("rec"), "geojson", *more)


def round_problems(docs: DataFrame, doc_key: str = "id", inspections: str = ROUND_INSPECTIONS,
                   results: str = INSPECTION_RESULTS) -> DataFrame:
    """The reject list of ``mode='permissive'``: every round without an
    ``inspections`` list and every inspection without a ``results`` list —
    the documents a fail-fast run stops on.  Columns: the document key, the
    inspection position (null for round-level problems) and the problem."""
    rounds = docs.where(F.col(inspections).isNull()).select(
        F.col(doc_key).alias("doc"), F.lit(None).cast("int").alias("inspection"),
        F.lit(f"missing {inspections}").alias("problem"))
    insp = (docs.where(F.col(inspections).isNotNull())
            .select(F.col(doc_key).alias("doc"), F.posexplode(inspections).alias("pos", "i"))
            .where(F.col("i")[results].isNull())
            .select("doc", F.col("pos").alias("inspection"),
                    F.lit(f"missing {results}").alias("problem")))
    return rounds.unionByName(insp)


def _empty_after_drop(t: StructType, steps: list[str]) -> list[str]:
    """The path to drop so that no struct is left without fields: the
    shallowest ancestor whose only content is the dropped subtree."""
    cut = len(steps)
    node: DataType = t
    chain = []
    for st_ in steps:
        chain.append(node)
        node = node[st_].dataType
    for depth in range(len(steps) - 1, 0, -1):
        if len(chain[depth].fields) == 1:
            cut = depth
        else:
            break
    return steps[:cut]


def _drop_path(t: StructType, steps: list[str]) -> StructType:
    steps = _empty_after_drop(t, steps)
    return _drop_exact(t, steps)


def _drop_exact(t: StructType, steps: list[str]) -> StructType:
    if len(steps) == 1:
        return StructType([f for f in t.fields if f.name != steps[0]])
    out = []
    for f in t.fields:
        if f.name == steps[0] and isinstance(f.dataType, StructType):
            out.append(StructField(f.name, _drop_exact(f.dataType, steps[1:]), f.nullable))
        else:
            out.append(f)
    return StructType(out)


def _merged_type(child: StructType, parent: StructType) -> StructType:
    pn = {f.name: f for f in parent.fields}
    out = [pn.get(f.name, f) for f in child.fields]
    cn = {f.name for f in child.fields}
    out += [f for f in parent.fields if f.name not in cn]
    return StructType(out)


# ---------------------------------------------------------------------------
# flatten to dotted paths
# ---------------------------------------------------------------------------

def flatten_columns(df: DataFrame, col: str | None = None,
                    sep: str = ".") -> list[tuple[str, Column]]:
    """Columns of the wide flattening of ``df`` (or of one struct column):
    every leaf of the nested structure becomes a column named by its dotted
    path; list elements are addressed by position (``photos.0.id``) up to the
    longest list present in the data.  Maps and leaves keep their type.  Of two
    leaves with one path (``{"a": {"b": 1}, "a.b": 2}``) the later one stays.

    The longest list per path is measured with one aggregate per nesting
    depth of lists (a handful of scalars reach the driver, no rows)."""
    if col is None:
        fields = [(f.name, F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    else:
        st = df.schema[col].dataType
        fields = [(f.name, F.col(col)[f.name], f.dataType) for f in st.fields]
    leaves: list[tuple[str, Column, int]] = []
    pending = [(n, e, t, i) for i, (n, e, t) in enumerate(fields)]
    while pending:
        arrays = []
        nxt = []
        for name, expr, dtype, top in pending:
            if isinstance(dtype, StructType):
                nxt += [(f"{name}{sep}{f.name}", expr.getField(f.name), f.dataType, top)
                        for f in dtype.fields]
            elif isinstance(dtype, ArrayType):
                arrays.append((name, expr, dtype, top))
            else:
                leaves.append((name, expr, top))
        if arrays:
            row = df.agg(*[F.max(F.size(e)).alias(f"m{i}") for i, (_, e, _, _) in
                           enumerate(arrays)]).first()
            for i, (name, expr, dtype, top) in enumerate(arrays):
                for k in range(max(row[f"m{i}"] or 0, 0)):
                    nxt.append((f"{name}{sep}{k}", F.get(expr, k), dtype.elementType, top))
        pending = nxt
    return list(_last_of_each(leaves).items())


def _last_of_each(leaves: list) -> dict[str, Column]:
    """(path, column, top field's number) -> column by path; of equal paths the
    one in the later field."""
    out: dict[str, Column] = {}
    rank: dict[str, int] = {}
    for path, e, field in leaves:
        if path not in out or field >= rank[path]:
            out[path], rank[path] = e, field
    return out


def flatten_wide(df: DataFrame, col: str | None = None, keep: list[str] | None = None,
                 sep: str = ".") -> DataFrame:
    cols = flatten_columns(df, col, sep)
    return df.select(*[F.col(k) for k in (keep or [])], *[e.alias(n) for n, e in cols])


def array_first(arr, field: str | None = None) -> Column:
    """First element of a list (``x.0`` / ``x.0.field``); absent -> null."""
    first = F.get(_c(arr), 0)
    return first[field] if field else first


def nested_field(col, path: str) -> Column:
    """Value at a dotted path inside nested structs."""
    c = _c(col)
    for s in path.split("."):
        c = c[s]
    return c
