"""Data types without the promise that nested values are present."""

from __future__ import annotations

from pyspark.sql import types as T


def nullable(dtype: T.DataType) -> T.DataType:
    """The type with nullable elements and fields: what any file gives back, and what any such value can be cast to."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(nullable(dtype.elementType), True)
    if isinstance(dtype, T.MapType):
        return T.MapType(nullable(dtype.keyType), nullable(dtype.valueType), True)
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in dtype.fields])
    return dtype
