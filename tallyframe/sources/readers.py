"""Scans of files, and sheets of workbooks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Mapping, Sequence
from functools import cached_property
from typing import Any
from xml.etree import ElementTree

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.errors import EngineError
from tallyframe.functions import dtypes
from tallyframe.operators.frame import Frame
from tallyframe.sources.rows import from_rows


class LazyFrame(Frame):
    """A frame whose files are opened when it is first used, so that a missing one is an error then."""

    def __init__(self, load: Callable[[], DataFrame]):
        self._load = load

    @cached_property
    def df(self) -> DataFrame:  # type: ignore[override]
        return self._load()

    @property
    def order(self):
        return []


def scan_parquet(spark: SparkSession, path: str) -> LazyFrame:
    return LazyFrame(lambda: spark.read.parquet(path))


def scan_csv(spark: SparkSession, path: str, has_header: bool = True, separator: str = ",", skip_rows: int = 0, infer_rows: int | None = None, null_value: str | None = None, try_parse_dates: bool = False, quote: str = '"', comment_prefix: str | None = None, schema: Mapping[str, Any] | None = None, encoding: str = "utf8", ignore_errors: bool = False) -> LazyFrame:
    """A table from delimited text.

    schema overwrites the types of the columns it names. infer_rows limits the rows that types are
    found from (all, if None). skip_rows and long comment prefixes drop whole lines of each file.
    With ignore_errors a bad value is null and its row stays, else reading it is an error. Malformed
    bytes become U+FFFD with encoding utf8-lossy and are an error with utf8.
    """
    if len(separator) != 1:
        raise EngineError("INVALID", "the separator is one character")

    def load() -> DataFrame:
        options = {"header": has_header, "sep": separator, "quote": quote or "", "mode": "PERMISSIVE", "multiLine": False}
        if null_value is not None:
            options["nullValue"] = null_value
        lines = None
        long_comment = comment_prefix if comment_prefix and len(comment_prefix) > 1 else None
        if comment_prefix and not long_comment:
            options["comment"] = comment_prefix
        if skip_rows or long_comment:
            # Lines of a file's first block follow one another in i, so one number for each file tells which are skipped.
            # The driver lists all files anyway, so a row for each may be sent to all; it also leaves the lines in order, heads first.
            lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
            if skip_rows:
                starts = lines.filter("b = 0").groupBy("f").agg(F.min("i").alias("s"))
                lines = lines.join(F.broadcast(starts), "f").filter((F.col("b") > 0) | (F.col("i") - F.col("s") >= skip_rows))
            if long_comment:
                lines = lines.filter(~F.col("value").startswith(long_comment))
        if encoding == "utf8" and not spark.read.text(path).filter(~F.is_valid_utf8("value")).isEmpty():
            raise EngineError("INVALID", f"{path} is not valid UTF-8")

        def parsed(reader: DataFrameReader, rows: DataFrame | None) -> DataFrame:
            """What a reader makes of the files, or of lines."""
            if rows is None:
                return reader.csv(path)
            strings = getattr(rows.select("value")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
            return DataFrame(reader._jreader.csv(strings), spark)

        sample = lines if infer_rows is None else (spark.read.text(path) if lines is None else lines).limit(infer_rows + int(has_header))
        found = parsed(spark.read.options(inferSchema=True, preferDate=True, **options), sample).schema
        kinds = []
        for f in found:
            kind = T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else T.LongType() if isinstance(f.dataType, T.IntegerType) else f.dataType
            if not try_parse_dates and isinstance(kind, (T.DateType, T.TimestampNTZType)):
                kind = T.StringType()
            kinds.append(T.StructField(f.name, dtypes.spark_type(schema[f.name]) if schema and f.name in schema else kind))
        options["mode"] = "PERMISSIVE" if ignore_errors else "FAILFAST"
        return parsed(spark.read.options(**options).schema(T.StructType(kinds)), lines)

    return LazyFrame(load)


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    out = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        out = out * 26 + ord(c) - 64
    return out - 1


def _sheets(spark: SparkSession, path: str) -> tuple[dict[str, list[list[str | None]]], list[str]]:
    """Cells of all sheets, as text, by name; read through Spark, so any store it knows will do."""
    raw = spark.read.format("binaryFile").load(path).select("content").first()
    if raw is None:
        raise EngineError("NOT_FOUND", f"no file {path}")
    with zipfile.ZipFile(io.BytesIO(bytes(raw[0]))) as z:
        parse = lambda name: ElementTree.fromstring(z.read(name))
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in parse("xl/sharedStrings.xml").findall("m:si", _NS)]
        targets = {r.get("Id"): r.get("Target") for r in parse("xl/_rels/workbook.xml.rels")}
        out = {}
        for sheet in parse("xl/workbook.xml").find("m:sheets", _NS):
            target = targets[sheet.get(_REL)].lstrip("/")
            rows = []
            for row in parse(target if target.startswith("xl/") else f"xl/{target}").iter(f"{{{_NS['m']}}}row"):
                cells: list[str | None] = []
                for c in row.findall("m:c", _NS):
                    at = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    value = c.find("m:v", _NS)
                    if c.get("t") == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                    elif c.get("t") == "s":
                        text = shared[int(value.text)]
                    elif c.get("t") == "b":
                        text = "true" if value.text == "1" else "false"
                    else:
                        text = value.text if value is not None else None
                    cells[at] = text
                rows.append(cells)
            out[sheet.get("name")] = rows
    return out, [*out]


def _is_bool(s: str) -> bool:
    return s in ("0", "1", "t", "f", "T", "F", "true", "false", "TRUE", "FALSE", "True", "False")


def _is_int(s: str) -> bool:
    return bool(re.fullmatch(r"[+-]?(0|[1-9]\d*)", s)) and -(2**63) <= int(s) < 2**63


def _is_float(s: str) -> bool:
    return bool(re.fullmatch(r"[+-]?(\d+\.\d*|\.\d+|\d+)([eE][+-]?\d+)?", s)) and bool(re.search(r"[.eE]", s)) and not re.match(r"[+-]?0\d", s)


def _typed(values: list[str | None]) -> tuple[str, list[Any]]:
    """A column's type over all its cells: bool, then int, then float, else string; blanks are null."""
    cells = [v if v is not None and v.strip() else None for v in values]
    some = [v.strip() for v in cells if v is not None]
    whole = lambda f: bool(some) and all(map(f, some))
    if whole(_is_bool):
        return "bool", [None if v is None else v.strip() in ("1", "t", "T", "true", "TRUE", "True") for v in cells]
    if whole(_is_int):
        return "int64", [None if v is None else int(v) for v in cells]
    if whole(lambda s: _is_int(s) or _is_float(s)):
        return "float64", [None if v is None else float(v) for v in cells]
    return "string", cells


def _sheet_frame(spark: SparkSession, name: str, rows: list[list[str | None]], raise_if_empty: bool) -> Frame:
    if not rows:
        if raise_if_empty:
            raise EngineError("INVALID", f"sheet {name!r} is empty")
        return Frame(spark.createDataFrame([], T.StructType([])))
    header = [(h or "").strip() or f"column_{i + 1}" for i, h in enumerate(rows[0])]
    if len({*header}) < len(header):
        raise EngineError("INVALID", f"sheet {name!r} repeats a column name")
    kinds, columns = [], []
    for i, h in enumerate(header):
        kind, values = _typed([r[i] if i < len(r) else None for r in rows[1:]])
        kinds.append((h, kind))
        columns.append(values)
    data = [dict(zip(header, r, strict=True)) for r in zip(*columns, strict=True)]
    return from_rows(spark, data, schema=kinds)


def read_excel(spark: SparkSession, path: str, sheet_id: int = 1, sheet_name: str | None = None, raise_if_empty: bool = True) -> Frame:
    """One sheet, by its place from 1 or its name. Workbooks are small: the driver reads them."""
    cells, names = _sheets(spark, path)
    if sheet_name is None and not 1 <= sheet_id <= len(names):
        raise EngineError("NOT_FOUND", f"no sheet {sheet_id}")
    name = sheet_name or names[sheet_id - 1]
    if name not in cells:
        raise EngineError("NOT_FOUND", f"no sheet {name!r}")
    return _sheet_frame(spark, name, cells[name], raise_if_empty)


def read_excel_sheets(spark: SparkSession, path: str, sheet_names: Sequence[str] | None = None, sheet_ids: Sequence[int] | None = None, raise_if_empty: bool = True) -> dict[str, Frame]:
    """Some sheets, or all, by name."""
    if sheet_names and sheet_ids:
        raise EngineError("INVALID", "sheet_names excludes sheet_ids")
    cells, names = _sheets(spark, path)
    if any(not 1 <= i <= len(names) for i in sheet_ids or ()):
        raise EngineError("NOT_FOUND", "no such sheet")
    wanted = dict.fromkeys([*(sheet_names or [])] or [names[i - 1] for i in sheet_ids or []] or names)
    if missing := [n for n in wanted if n not in cells]:
        raise EngineError("NOT_FOUND", f"no sheet {missing[0]!r}")
    return {n: _sheet_frame(spark, n, cells[n], raise_if_empty) for n in wanted}
