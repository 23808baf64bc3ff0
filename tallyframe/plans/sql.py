"""SQL over named frames."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyframe.errors import EngineError
from tallyframe.operators.frame import Frame
from tallyframe.sources.readers import LazyFrame


class SQLContext:
    """Names of frames, kept apart from those of other contexts and of the session: each statement runs over views of its own session."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, Frame] | None = None):
        self.spark, self._tables = spark, {}
        self.register_many(tables or {})

    def register(self, name: str, frame: Frame) -> SQLContext:
        if not re.fullmatch(r"\w+", name):
            raise EngineError("INVALID", f"{name!r} is no table name")
        self._tables[name] = frame
        return self

    def register_many(self, tables: Mapping[str, Frame]) -> SQLContext:
        for name, frame in tables.items():
            self.register(name, frame)
        return self

    def unregister(self, *names: str) -> SQLContext:
        for name in names:
            self._tables.pop(name, None)
        return self

    def tables(self) -> list[str]:
        return sorted(self._tables)

    def _run(self, query: str) -> DataFrame:
        if re.fullmatch(r"(?is)\s*show\s+tables\s*;?\s*", query):
            return self.spark.createDataFrame([(n,) for n in self.tables()], "name string")
        mine = f"_{uuid.uuid4().hex[:12]}_"
        for name, frame in self._tables.items():
            if re.search(rf"(?i)\b{name}\b", query):
                frame.df.createOrReplaceTempView(mine + name)
        try:
            # Names of the context shadow the session's: a WITH clause in front names each view used.
            used = [n for n in self._tables if re.search(rf"(?i)\b{n}\b", query)]
            heads = ", ".join(f"`{n}` AS (SELECT * FROM `{mine}{n}`)" for n in used)
            body = query.strip().rstrip(";")
            if heads:
                inner = re.match(r"(?is)with\s+(recursive\s+)?", body)
                body = f"WITH {heads}, {body[inner.end():]}" if inner else f"WITH {heads} {body}"
            return self.spark.sql(body)
        except Exception as e:
            raise EngineError("SQL", f"{' '.join(query.split())[:96]}: {str(e)[:500]}") from e
        finally:
            for name in self._tables:
                self.spark.catalog.dropTempView(mine + name)

    def execute(self, query: str) -> Frame:
        """The result; frames that aren't named are not opened."""
        if not query.strip():
            raise EngineError("INVALID", "an empty query")
        if not self._tables:
            raise EngineError("INVALID", "no tables are registered")
        return Frame(self._run(query))

    def execute_lazy(self, query: str) -> LazyFrame:
        """The same, run when the frame is used: until then even a missing file is no error."""
        if not query.strip():
            raise EngineError("INVALID", "an empty query")
        return LazyFrame(lambda: self._run(query))


def sql(spark: SparkSession, query: str, **tables: Frame) -> Frame:
    return SQLContext(spark, tables).execute(query)
