"""Frames that a job reads more than once, kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType, DateType, DecimalType,
                               MapType, NumericType, StringType, StructType, TimestampNTZType,
                               TimestampType)

from gridwise.session import checkpoint_root, work_dir

_ATOMS = (BinaryType, BooleanType, DateType, DecimalType, NumericType, StringType, TimestampType,
          TimestampNTZType)


def _has_columns(kind: DataType) -> bool:
    """Whether Parquet keeps a type as it is: no struct is empty or has two names that
    differ in case alone."""
    if isinstance(kind, StructType):
        names = {f.name.lower() for f in kind.fields}
        return 0 < len(names) == len(kind.fields) and all(_has_columns(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _has_columns(kind.elementType)
    if isinstance(kind, MapType):
        return _has_columns(kind.keyType) and _has_columns(kind.valueType)
    return type(kind) in _ATOMS or isinstance(kind, NumericType)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` evaluated once and read back: as Parquet, a fraction of a checkpoint's
    bytes and read by column, or, where Parquet lacks a type of it, from a checkpoint."""
    if not _has_columns(df.schema):
        checkpoint_root(df.sparkSession)
        return df.checkpoint(eager=True)
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
