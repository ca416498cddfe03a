"""Relational operators of the enrichment SQL: positional/by-name union, the
concatenated-text-key join, and the prefix/suffix code joins.

Every join is an equi-join on an expression, so Catalyst extracts the key and
plans a hash or sort-merge join.  A side is broadcast only after its size has
been measured (``broadcast_if_small``); otherwise adaptive execution decides at
run time with real shuffle statistics and splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwise.functions.text import key_text

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def union_all(a: DataFrame, b: DataFrame, by_position: bool = False) -> DataFrame:
    """``UNION ALL``.  By name with missing columns filled with null (default;
    two independently inferred staging tables may differ in column order),
    or by position for strict parity."""
    if by_position:
        return a.union(b)
    return a.unionByName(b, allowMissingColumns=True)


def measured_size(df: DataFrame, row_bytes: Column | None = None) -> tuple[int, int]:
    """(rows, bytes) of a frame, measured with one aggregate.  ``row_bytes``
    estimates a row's size; by default the sum of the string lengths plus 16
    bytes per column."""
    if row_bytes is None:
        parts = [F.coalesce(F.length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) + 16
                 for f in df.schema.fields]
        row_bytes = sum(parts[1:], parts[0]) if parts else F.lit(16)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("b")).first()
    return int(row["n"] or 0), int(row["b"] or 0)


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the measured size is under both limits."""
    n, b = measured_size(df)
    return F.broadcast(df) if n <= max_rows and b <= max_bytes else df


def in_parallel(*thunks):
    """Run independent small driver-side measurements (each one Spark job)
    concurrently; Spark schedules jobs from several threads side by side."""
    from concurrent.futures import ThreadPoolExecutor
    if len(thunks) <= 1:
        return [t() for t in thunks]
    with ThreadPoolExecutor(max_workers=len(thunks)) as pool:
        return [f.result() for f in [pool.submit(t) for t in thunks]]


def concat_key(*cols, dtypes=None) -> Column:
    """``a::text || b::text`` with database text forms (integral doubles print
    without ``.0``); null in any part -> null key (never matches)."""
    dtypes = dtypes or [None] * len(cols)
    return F.concat(*[key_text(_c(c), t) for c, t in zip(cols, dtypes)])


def join_concat_key(left: DataFrame, right: DataFrame, left_parts: list[str],
                    right_parts: list[str], how: str = "inner", strict_keys: bool = False,
                    small_side: str | None = "right") -> DataFrame:
    """Join on ``text(l1)||text(l2) = text(r1)||text(r2)``.

    Parity default: the concatenated text key, including its false matches
    (``1||23`` = ``12||3``).  ``strict_keys=True`` joins on the typed parts
    pairwise instead.  ``small_side`` is measured and broadcast if small.
    """
    lt = {f.name: f.dataType for f in left.schema.fields}
    rt = {f.name: f.dataType for f in right.schema.fields}
    # null keys never match: without them an inner join has no task of nulls
    for c in left_parts if how == "inner" else ():
        left = left.where(left[c].isNotNull())
    for c in right_parts if how in ("inner", "left") else ():
        right = right.where(right[c].isNotNull())
    if small_side == "right":
        right = broadcast_if_small(right)
    elif small_side == "left":
        left = broadcast_if_small(left)
    if strict_keys:
        cond = None
        for lc, rc in zip(left_parts, right_parts):
            e = key_text(left[lc], lt[lc]) == key_text(right[rc], rt[rc])
            cond = e if cond is None else cond & e
    else:
        cond = (concat_key(*[left[c] for c in left_parts], dtypes=[lt[c] for c in left_parts])
                == concat_key(*[right[c] for c in right_parts],
                              dtypes=[rt[c] for c in right_parts]))
    return left.join(right, cond, how)


def join_prefix(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column,
                how: str = "left", broadcast_right: bool = True) -> DataFrame:
    """Equi-join on derived code keys such as ``RIGHT(w.vollcode,2) =
    LEFT(b.code,2)``; several matches multiply rows, unmatched rows survive a
    left join with nulls."""
    r = broadcast_if_small(right) if broadcast_right else right
    return left.join(r, left_key == right_key, how)
