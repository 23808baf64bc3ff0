"""Sinks that write from the executors, and exports of results to the program, which are guarded by size."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable
from typing import Any

import pyarrow as pa
from pyspark.sql import functions as F

from tallyframe.errors import EngineError
from tallyframe.operators.frame import Frame

_limit_bytes: int | None = None


def set_memory_limit(bytes_: int | None) -> None:
    """Exports whose estimated size is above this raise; None lifts the limit."""
    global _limit_bytes
    if bytes_ is not None and bytes_ < 0:
        raise EngineError("INVALID", "a limit can't be negative")
    _limit_bytes = bytes_ or None


def memory_limit() -> int | None:
    return _limit_bytes


def _guarded(frame: Frame):
    if _limit_bytes is not None:
        size = int(str(frame.df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size > _limit_bytes:
            raise EngineError("OOM", f"the result may take {size} bytes; the limit is {_limit_bytes}")
    return frame.df.orderBy(*frame._keys()) if frame.order else frame.df


# Files


def write_parquet(frame: Frame, path: str, mode: str = "errorifexists") -> None:
    frame.df.write.mode(mode).parquet(path)


def write_ndjson(frame: Frame, path: str, compression: str | None = None, mode: str = "errorifexists") -> None:
    """JSON lines, nulls written out, in a folder of part files; compression is gzip or None."""
    if compression not in (None, "gzip"):
        raise EngineError("INVALID", f"unknown compression {compression!r}")
    frame.df.write.mode(mode).options(ignoreNullFields=False, **({"compression": compression} if compression else {})).json(path)


# To the program


def _json_rows(frame: Frame) -> Iterable[str]:
    rows = _guarded(frame)
    return (r[0] for r in rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator())


def to_json(frame: Frame) -> str:
    """One JSON array."""
    return "[" + ",".join(_json_rows(frame)) + "]"


def to_ndjson(frame: Frame) -> str:
    return "".join(r + "\n" for r in _json_rows(frame))


def to_maps(frame: Frame) -> list[dict[str, Any]]:
    return [r.asDict(True) for r in _guarded(frame).collect()]


def to_arrow(frame: Frame) -> pa.Table:
    return _guarded(frame).toArrow()


def to_list(frame: Frame, column: str | None = None) -> list[Any]:
    """One column's values; its name may be left out if there is only one."""
    if column is None:
        if len(frame.columns) != 1:
            raise EngineError("INVALID", "name one of the columns")
        column = frame.columns[0]
    frame._known([column])
    return [r[0] for r in _guarded(frame).select(column).collect()]


def to_array(frame: Frame, kind: pa.DataType, column: str | None = None) -> pa.Array:
    """One column as an Arrow array of exactly this type."""
    names = frame.columns if column is None else [column]
    if len(names) != 1:
        raise EngineError("INVALID", "name one of the columns")
    frame._known(names)
    got = _guarded(frame).select(names[0]).toArrow().column(0).combine_chunks()
    if got.type != kind:
        raise EngineError("INVALID", f"{names[0]} is {got.type}, not {kind}")
    return got


def to_structs(frame: Frame, kind: type) -> list[Any]:
    """Rows as objects of a dataclass; its fields take columns by their names, or by name in their metadata."""
    fields = {f.name: f.metadata.get("name", f.name) for f in dataclasses.fields(kind)}
    frame._known([c for c in fields.values() if c != "-"])
    return [kind(**{n: r[c] for n, c in fields.items() if c != "-"}) for r in to_maps(frame)]


def show(frame: Frame, rows: int = 20) -> None:
    (frame.df.orderBy(*frame._keys()) if frame.order else frame.df).show(rows, truncate=False)


