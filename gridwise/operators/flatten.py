"""Flattening to rows (id, path, value), whatever the documents' shape.

The number of expressions follows the depth of the documents, never the length
of their lists: a list element's position is part of a row's path, not a column.

* ``flatten_long``: a column with a schema.  All (path, value) entries of a row
  come from one nested ``transform``; there is one ``explode`` and no shuffle.
* ``flatten_json_long``: JSON texts of open schema, unfolded as variants level by
  level; a level is one ``explode`` and leaves pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from gridwise.sinks.stored import stored

_ENTRY = "array<struct<path:string,value:string>>"


def _entries(value: Column, kind: DataType, path: Column, sep: str, key: str,
             lengths: dict[str, int] | None) -> Column:
    """array<struct<path, value>> of the leaves of ``value``, whose own path is
    ``path``.  An absent struct counts as a struct of null leaves.  With ``lengths``
    (by ``key``, the path without positions) shorter lists are filled with nulls."""
    if isinstance(kind, StructType):
        inner = [_entries(value.getField(f.name), f.dataType, F.concat(path, F.lit(sep + f.name)), sep,
                          f"{key}/{f.name}", lengths) for f in kind.fields]
        return F.concat(*inner) if inner else F.array().cast(_ENTRY)
    if isinstance(kind, ArrayType):
        def element(x: Column, i: Column) -> Column:
            return _entries(x, kind.elementType, F.concat(path, F.lit(sep), i.cast("string")), sep,
                            f"{key}/", lengths)

        if lengths is None:
            each = F.transform(value, element)
        elif not lengths[key]:
            return F.array().cast(_ENTRY)
        else:
            places = F.sequence(F.lit(0), F.lit(lengths[key] - 1))
            each = F.transform(places, lambda i: element(F.get(value, i), i))
        return F.coalesce(F.flatten(each), F.array().cast(_ENTRY))
    return F.array(F.struct(path.alias("path"), value.cast("string").alias("value")))


def _list_sizes(value: Column, kind: DataType, key: str) -> list[tuple[str, Column]]:
    """(key, size of the longest list) for every list in the type."""
    if isinstance(kind, StructType):
        return [found for f in kind.fields
                for found in _list_sizes(value.getField(f.name), f.dataType, f"{key}/{f.name}")]
    if not isinstance(kind, ArrayType):
        return []
    keys = [k for k, _ in _list_sizes(F.lit(None), kind.elementType, f"{key}/")]

    def longest(n: int) -> Column:
        return F.array_max(F.transform(
            value, lambda x: _list_sizes(x, kind.elementType, f"{key}/")[n][1]))

    return [(key, F.size(value)), *[(k, longest(n)) for n, k in enumerate(keys)]]


def _may_collide(kind: DataType, sep: str) -> bool:
    if isinstance(kind, StructType):
        return any(sep in f.name or _may_collide(f.dataType, sep) for f in kind.fields)
    return isinstance(kind, ArrayType) and _may_collide(kind.elementType, sep)


def _last_of_each_path(entries: Column) -> Column:
    placed = F.array_sort(F.transform(entries, lambda e, i: F.struct(
        e["path"].alias("path"), i.alias("at"), e["value"].alias("value"))))
    bound = F.array(F.struct(placed.alias("l")))
    kept = F.transform(bound, lambda b: F.filter(b["l"], lambda e, i: F.coalesce(
        F.get(b["l"], i + 1)["path"] != e["path"], F.lit(True))))
    return F.get(kept, 0)


def flatten_long(df: DataFrame, id_col: str, col: str | None = None, keep_nulls: bool = True,
                 sep: str = ".") -> DataFrame:
    """(id, path, value) of every leaf of ``df`` (or of one struct column): the path
    is dotted, list elements go by position, values are text.

    With ``keep_nulls`` every row has the same paths: null leaves stay, and lists are
    filled with nulls up to the longest one, which one aggregate measures (a number
    per list of the schema reaches the driver).  Without it a row has the paths of its
    own leaves that are not null, and nothing is measured.  Of leaves of one path in a
    row the last one stays.
    """
    if col is None:
        kind = df.schema
        fields = [(f.name, F.col(f"`{f.name}`"), f.dataType) for f in kind.fields]
    else:
        kind = df.schema[col].dataType
        fields = [(f.name, F.col(f"`{col}`")[f.name], f.dataType) for f in kind.fields]
    lengths = None
    if keep_nulls:
        sizes = [found for n, c, t in fields for found in _list_sizes(c, t, n)]
        row = df.agg(*[F.max(size).alias(f"m{i}") for i, (_, size) in enumerate(sizes)]).first() \
            if sizes else ()
        lengths = {key: max(0, row[i] or 0) for i, (key, _) in enumerate(sizes)}
    entries = F.concat(*[_entries(c, t, F.lit(n), sep, n, lengths) for n, c, t in fields])
    if _may_collide(kind, sep):
        entries = _last_of_each_path(entries)
    out = df.select(F.col(id_col), F.explode(entries).alias("_kv"))
    out = out.select(id_col, "_kv.path", "_kv.value")
    return out if keep_nulls else out.where(F.col("value").isNotNull())


# A string literal of JSON, matched without backtracking.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def json_depth(text: Column) -> Column:
    """How deep the lists and objects of a JSON text are nested (a scalar: 0)."""
    brackets = F.translate(F.regexp_replace(F.regexp_replace(text, _STRING, ""), r"[^\[\]{}]", ""),
                           "{}", "[]")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, bracket: Column) -> Column:
        now = acc["now"] + F.when(bracket == "[", 1).when(bracket == "]", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.aggregate(F.split(brackets, ""), zero, step, lambda acc: acc["most"])


_LEVEL = """
    case when _map is not null then
           transform(map_entries(_map), (e, i) -> named_struct('_k', e.key, '_at', i, '_v', e.value))
         when _list is not null then
           transform(_list, (e, i) -> named_struct('_k', cast(i as string), '_at', i, '_v', e))
         else array(named_struct('_k', cast(null as string), '_at', 0, '_v', _v)) end"""


def _one_level(rows: DataFrame, ids: list[str], sep: str) -> DataFrame:
    opened = rows.select("*", F.expr("try_cast(_v as map<string, variant>)").alias("_map"),
                         F.expr("try_cast(_v as array<variant>)").alias("_list"))
    each = opened.select(*ids, "path", "_doc", "_text", "_places",
                         F.col("_map").isNotNull().alias("_is_map"),
                         F.inline(F.expr(_LEVEL)))
    # only texts in which two leaves may have one path carry text and places
    quoted = F.concat(F.lit("$['"), F.col("_k"), F.lit("']"))
    place = F.when(F.col("_is_map"), F.array_position(F.json_object_keys("_text"), F.col("_k"))
                   .cast("int")).otherwise(F.col("_at"))
    inner = F.call_function("get_json_object", F.col("_text"), F.when(F.col("_is_map"), quoted).otherwise(
        F.concat(F.lit("$["), F.col("_k"), F.lit("]"))))
    goes_on = F.col("_text").isNotNull() & F.col("_k").isNotNull()
    return each.select(
        *ids, F.when(F.col("_k").isNull(), F.col("path")).otherwise(
            F.concat_ws(sep, "path", "_k")).alias("path"),
        "_doc", F.when(goes_on, inner).alias("_text"),
        F.when(F.col("_k").isNull() | F.col("_places").isNull(), F.col("_places")).otherwise(
            F.array_append("_places", F.coalesce(F.when(goes_on, place), F.col("_at")))).alias("_places"),
        "_v")


def flatten_json_long(docs: DataFrame, ids: list[str], text: str, sep: str = ".",
                      depth: int | None = None, mode: str = "failfast",
                      keep_nulls: bool = True) -> DataFrame:
    """(ids, path, value) of every leaf of the JSON texts in column ``text``.

    Lists and objects may differ from text to text and hold values of mixed types.
    Values are text (strings bare, null as null); a scalar document has path
    ''.  Empty lists and objects have no leaf, a null text has none either.  Of leaves
    of one path (``{"a": {"b": 1}, "a.b": 2}``) the later one in the text stays.  A text
    that is no JSON raises (``failfast``) or has no leaf (``permissive``).

    ``depth`` levels are unfolded; without it the deepest text's, which one aggregate
    over the stored texts measures.  Values below ``depth`` stay JSON text.  The plan has one
    explode a level, whatever the lengths of lists; only texts with a key that holds
    ``sep`` are shuffled, to compare their leaves' paths.
    """
    if mode not in ("failfast", "permissive"):
        raise ValueError("mode must be 'failfast' or 'permissive'")
    source = F.col(text)
    dotted = _has_key_with(source, sep)
    if depth is None:
        # the texts are read for the measure and for either kind of them
        docs = stored(docs.select(*ids, source.alias("_source"), json_depth(source).alias("_depth"),
                                  dotted.alias("_dotted")), "texts")
        depth = docs.agg(F.max("_depth")).first()[0] or 0
        source, dotted = F.col("_source"), F.col("_dotted")
    parsed = F.parse_json(source) if mode == "failfast" else F.try_parse_json(source)
    rows = docs.where(source.isNotNull()).select(
        *ids, F.lit(None).cast("string").alias("path"),
        F.when(dotted, F.monotonically_increasing_id()).alias("_doc"),
        F.when(dotted, source).alias("_text"),
        F.when(dotted, F.array().cast("array<int>")).alias("_places"), parsed.alias("_v"))
    rows = rows.where("_v is not null")
    for _ in range(depth):
        rows = _one_level(rows, ids, sep)
    leaves = rows.select(*ids, F.coalesce("path", F.lit("")).alias("path"), "_doc", "_places",
                         F.expr("cast(_v as string)").alias("value"))
    last = F.max_by(F.struct("value"), F.col("_places"))["value"].alias("value")
    out = (leaves.where("_doc is null").select(*ids, "path", "value").unionByName(
        leaves.where("_doc is not null").groupBy("_doc", *ids, "path").agg(last)
        .select(*ids, "path", "value")))
    return out if keep_nulls else out.where(F.col("value").isNotNull())


def _has_key_with(text: Column, sep: str) -> Column:
    """True if some key of the JSON text may hold ``sep``: a string followed by a
    colon does."""
    keys = F.regexp_extract_all(text, F.lit(f"({_STRING})\\s*:"), F.lit(1))
    return F.exists(keys, lambda k: F.contains(k, F.lit(sep)) | F.contains(k, F.lit("\\u")))
