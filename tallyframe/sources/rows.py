"""Frames from rows, columns and Arrow data in the driver: small data, as a program holds it."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tallyframe.errors import EngineError, ValidationError
from tallyframe.functions import dtypes
from tallyframe.operators.frame import Frame

INFER_ROWS = 100


def _kind(value: Any) -> T.DataType:
    import datetime
    import decimal

    if value is None:
        return T.NullType()
    if isinstance(value, bool):
        return T.BooleanType()
    for kinds, out in (((int,), T.LongType()), ((float,), T.DoubleType()), ((str,), T.StringType()), ((bytes, bytearray), T.BinaryType()), ((datetime.datetime,), T.TimestampNTZType()), ((datetime.date,), T.DateType()), ((datetime.time,), T.StringType()), ((decimal.Decimal,), T.DecimalType(38, 10))):
        if isinstance(value, kinds):
            return out
    if isinstance(value, Mapping):
        return T.StructType([T.StructField(str(k), _kind(v)) for k, v in value.items()])
    if isinstance(value, (list, tuple)):
        kind: T.DataType = T.NullType()
        for v in value:
            kind = wider(kind, _kind(v))
        return T.ArrayType(kind)
    raise EngineError("INVALID", f"no type for {type(value).__name__}")


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: numbers widen, all else meets in strings."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        names = list(dict.fromkeys([*a.names, *b.names]))
        pick = lambda s, n: s[n].dataType if n in s.names else T.NullType()
        return T.StructType([T.StructField(n, wider(pick(a, n), pick(b, n))) for n in names])
    return T.StringType()


def convert(value: Any, kind: T.DataType, strict: bool, row: int, name: str) -> Any:
    """value as kind; what doesn't fit raises, or is null if not strict. Floats in integer columns are cut."""
    if value is None or isinstance(kind, T.NullType):
        return None
    try:
        if isinstance(kind, T.BooleanType):
            if isinstance(value, (bool, int)):
                return bool(value)
            raise TypeError
        if dtypes.is_integer(kind):
            if isinstance(value, (bool, int, float)):
                bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}[type(kind)]
                if not -(2 ** (bits - 1)) <= int(value) < 2 ** (bits - 1):
                    raise TypeError
                return int(value)
            raise TypeError
        if dtypes.is_float(kind):
            if isinstance(value, (bool, int, float)):
                return float(value)
            raise TypeError
        if isinstance(kind, T.StringType):
            if isinstance(value, (str, int, float, bool)) or not strict or hasattr(value, "isoformat"):
                return value if isinstance(value, str) else value.isoformat() if hasattr(value, "isoformat") else str(value)
            raise TypeError
        if isinstance(kind, T.ArrayType):
            return [convert(v, kind.elementType, strict, row, name) for v in value]
        if isinstance(kind, T.StructType):
            return tuple(convert(value.get(f.name), f.dataType, strict, row, f"{name}.{f.name}") for f in kind)
        return value
    except (TypeError, ValueError, AttributeError):
        if strict:
            raise ValidationError(f"{value!r} is no {kind.simpleString()}", row, name) from None
        return None


def _schema(schema: Any) -> list[tuple[str, Any]]:
    if isinstance(schema, T.StructType):
        return [(f.name, f.dataType) for f in schema]
    if isinstance(schema, pa.Schema):
        from pyspark.sql.pandas.types import from_arrow_schema

        return [(f.name, f.dataType) for f in from_arrow_schema(schema)]
    return [*schema.items()] if isinstance(schema, Mapping) else [(n, k) for n, k in schema]


def from_rows(spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: Any = None, columns: Sequence[str] | None = None, overrides: Mapping[str, Any] | None = None, strict: bool = True, infer_rows: int = INFER_ROWS) -> Frame:
    """A frame from dicts.

    Types come from the first infer_rows rows (0: all), or from a schema (a mapping, pairs or a
    StructType: its columns, with missing ones null and others dropped). columns names the columns
    and leaves types to be found. overrides changes types of columns that are there. Columns come
    in the order in which rows name them.
    """
    if schema is not None and columns is not None:
        raise EngineError("INVALID", "only one of schema and columns")
    if infer_rows < 0:
        raise EngineError("INVALID", "infer_rows is negative")
    if columns is not None and (len({*columns}) < len(columns) or "" in columns):
        raise EngineError("INVALID", "column names are empty or repeated")
    if not rows and schema is None and columns is None:
        raise EngineError("INVALID", "no data, cannot infer schema")
    if schema is not None:
        kinds = {n: dtypes.spark_type(k) for n, k in _schema(schema)}
    else:
        names = columns if columns is not None else list(dict.fromkeys(k for r in rows for k in r))
        kinds = {}
        for n in names:
            kind: T.DataType = T.NullType()
            for r in rows[: infer_rows or None]:
                kind = wider(kind, _kind(r.get(n)))
            kinds[n] = kind
    for n, k in (overrides or {}).items():
        if n in kinds:
            kinds[n] = dtypes.spark_type(k)
    data = [tuple(convert(r.get(n), k, strict, i, n) for n, k in kinds.items()) for i, r in enumerate(rows)]
    return Frame(spark.createDataFrame(data, T.StructType([T.StructField(n, k) for n, k in kinds.items()])))


def from_columns(spark: SparkSession, data: Mapping[str, Sequence[Any]], schema: Any = None, overrides: Mapping[str, Any] | None = None) -> Frame:
    """A frame from columns of one length."""
    lengths = {len(v) for v in data.values()}
    if len(lengths) > 1:
        raise EngineError("INVALID", "columns differ in length")
    n = lengths.pop() if lengths else 0
    return from_rows(spark, [{k: v[i] for k, v in data.items()} for i in range(n)], schema, None if schema is not None or n else [*data], overrides, infer_rows=0)


def from_structs(spark: SparkSession, items: Sequence[Any], **options: Any) -> Frame:
    """A frame from dataclass objects; a field's metadata may give its column as name, or "-" to leave it out."""
    rows = []
    for x in items:
        named = [(f.metadata.get("name", f.name), getattr(x, f.name)) for f in dataclasses.fields(x)]
        rows.append({k: dataclasses.asdict(v) if dataclasses.is_dataclass(v) else v for k, v in named if k != "-"})
    return from_rows(spark, rows, **options)


def from_arrow(spark: SparkSession, data: pa.Table | pa.RecordBatch) -> Frame:
    return Frame(spark.createDataFrame(pa.Table.from_batches([data]) if isinstance(data, pa.RecordBatch) else data))


def frame(spark: SparkSession, data: Any, **options: Any) -> Frame:
    """A frame from whichever of these data is: dicts, columns, dataclass objects, Arrow data."""
    if isinstance(data, (pa.Table, pa.RecordBatch)):
        return from_arrow(spark, data)
    if isinstance(data, Mapping):
        return from_columns(spark, data, **options)
    if data and dataclasses.is_dataclass(data[0]):
        return from_structs(spark, data, **options)
    return from_rows(spark, data, **options)


def arrow_batch(rows: Sequence[Mapping[str, Any]], schema: pa.Schema) -> pa.RecordBatch:
    """Rows as an Arrow batch of a schema; a value of another type raises with its place."""
    for i, r in enumerate(rows):
        for f in schema:
            try:
                pa.array([r.get(f.name)], f.type)
            except (pa.ArrowInvalid, pa.ArrowTypeError) as e:
                raise ValidationError(str(e), i, f.name) from None
    return pa.RecordBatch.from_pylist([dict(r) for r in rows], schema=schema)
