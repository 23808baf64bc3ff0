"""Data types by name, and casts that raise or give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.errors import EngineError

#: Names of types and the Spark types that hold them. Unsigned ones take the next wider type.
TYPES: dict[str, T.DataType] = {
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "int16": T.ShortType(),
    "int8": T.ByteType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float64": T.DoubleType(),
    "float32": T.FloatType(),
    "bool": T.BooleanType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
}
UNSIGNED = {"uint8": 2**8, "uint16": 2**16, "uint32": 2**32, "uint64": 2**64}


def spark_type(dtype: str | T.DataType) -> T.DataType:
    if isinstance(dtype, T.DataType):
        return dtype
    if dtype == "time":
        return T.TimeType(6)
    if dtype not in TYPES:
        raise EngineError("INVALID", f"unknown type {dtype!r}")
    return TYPES[dtype]


def cast(value: Column, dtype: str | T.DataType, strict: bool = True) -> Column:
    """value as dtype; what doesn't fit raises (strict) or becomes null. Unsigned types check their range."""
    kind = spark_type(dtype)
    out = value.cast(kind) if strict else value.try_cast(kind)
    if dtype in UNSIGNED:
        good = (out >= 0) & (out < F.lit(UNSIGNED[dtype]).cast("decimal(21,0)"))
        bad = F.raise_error(F.lit(f"value out of range of {dtype}")).cast(kind) if strict else F.lit(None).cast(kind)
        out = F.when(out.isNull() | good, out).otherwise(bad)
    return out


def is_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def is_integer(kind: T.DataType) -> bool:
    return isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
