"""Scalar text functions (LEFT/RIGHT, ||, text keys, masking, names).

Every function takes and returns a Column and compiles to built-in
expressions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# ---------------------------------------------------------------------------
# Fixed values that must equal the original tool's output.
#   Credential mask: a list element whose stripped text starts with "PG:" is
#   replaced by exactly "PG: <CONNECTION STRING REDACTED>".
# ---------------------------------------------------------------------------
MASK_PREFIX = "PG:"
MASK_TEXT = "PG: <CONNECTION STRING REDACTED>"

# Content types by lower-cased file extension: the registry that Python's
# standard library ships (no files of this host are read), and GeoJSON's own.
_REGISTRY = mimetypes.MimeTypes(filenames=())
CONTENT_TYPES = {ext.lstrip("."): kind for strict in (False, True)
                 for ext, kind in _REGISTRY.types_map[strict].items()}
CONTENT_TYPES |= {"csv": "text/csv", "geojson": "application/geo+json"}
# endings that compress a file of the type before them
ENCODINGS = tuple(ext.lstrip(".") for ext in _REGISTRY.encodings_map)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def str_left(col, n: int) -> Column:
    """SQL ``LEFT(s, n)`` for n >= 0 (null in, null out)."""
    return F.left(_c(col), F.lit(n))


def str_right(col, n: int) -> Column:
    """SQL ``RIGHT(s, n)`` for n >= 0."""
    return F.right(_c(col), F.lit(n))


def concat_text(*cols) -> Column:
    """SQL ``a || b``: null-propagating concatenation."""
    return F.concat(*[_c(c) for c in cols])


def key_text(col, dtype=None) -> Column:
    """Text form of a key value as a relational database prints it.

    Integral floating values print without a fractional part (``3.0`` ->
    ``"3"``); all other values use the ordinary string cast.  ``dtype`` is the
    column's Spark type when known; without it the integral check is applied
    to every value (a no-op for integers and strings).
    """
    c = _c(col)
    if dtype is not None and not isinstance(dtype, (DoubleType, FloatType)):
        return c.cast("string")
    as_double = c.cast("double")
    plain = F.abs(as_double) < F.lit(1.0e15)
    integral = (as_double == F.floor(as_double)) & plain & ~F.isnan(as_double)
    # from 1e15 on databases print the shortest digits with an exponent: 1.5e+15
    scientific = F.regexp_replace(F.regexp_replace(
        as_double.cast("string"), r"\.0E", "E"), "E", "e+")
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(integral, as_double.cast("bigint").cast("string"))
            .when(~plain & (F.abs(as_double) < float("inf")), scientific)
            .otherwise(c.cast("string")))


def mask_prefixed(arr, prefix: str = MASK_PREFIX, mask: str = MASK_TEXT) -> Column:
    """Replace each array element whose whitespace-stripped text starts with
    ``prefix`` by ``mask``; other elements pass through unchanged."""
    pattern = "(?U)^\\s*" + _regex_quote(prefix)
    return F.transform(_c(arr), lambda x: F.when(x.rlike(pattern), F.lit(mask)).otherwise(x))


def _regex_quote(text: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in text)


def path_last_step(col) -> Column:
    """Last path step of a path or URL (query string and fragment removed)."""
    no_query = F.regexp_replace(_c(col), r"[?#].*$", "")
    return F.regexp_extract(no_query, r"([^/]*)$", 1)


def path_name(col) -> Column:
    """Last step of a file's path, as it is (``a#1.csv`` is a file name)."""
    return F.regexp_extract(_c(col), r"([^/]*)$", 1)


def file_ext(col) -> Column:
    """Extension after the last dot of the last path step; '' when none."""
    return F.regexp_extract(path_last_step(col), r"(?<=.)\.([^.]*)$", 1)


def file_stem(col) -> Column:
    """Base name without its extension (``os.path.splitext(basename)[0]``)."""
    base = path_last_step(col)
    return F.when(file_ext(col) == "", base).otherwise(
        F.regexp_replace(base, r"(?<=.)\.[^.]*$", ""))


def content_type(col, last_step=path_last_step) -> Column:
    """Content type guessed from the extension of a URL's last step (of a file:
    ``last_step=path_name``); an ending that only says how the file is compressed
    (``x.csv.gz``) is passed over; null if unknown."""
    table = F.create_map(*[F.lit(x) for kv in CONTENT_TYPES.items() for x in kv])
    endings = "|".join(map(_regex_quote, ENCODINGS))
    inner = F.regexp_replace(F.lower(last_step(_c(col))), rf"(?<=.)\.(?:{endings})$", "")
    return F.try_element_at(table, F.regexp_extract(inner, r"(?<=.)\.([^.]*)$", 1))


def dated_name(stem, run_date=None, suffix: str = ".csv") -> Column:
    """``<stem>_<YYYY-MM-DD><suffix>``; ``run_date`` defaults to today."""
    day = F.current_date() if run_date is None else (
        F.to_date(F.lit(run_date)) if isinstance(run_date, str) else _c(run_date))
    return F.concat(_c(stem), F.lit("_"), F.date_format(day, "yyyy-MM-dd"), F.lit(suffix))
