"""A frame's verbs over files as they arrive, written as JSON lines: the row-wise ones, which need no order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyframe.operators.frame import Frame


def follow_parquet(spark: SparkSession, source: str, schema, verbs: Callable[[Frame], Frame], out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Each new Parquet file under source goes through verbs into out, once, also after a restart."""
    rows = verbs(Frame(spark.readStream.schema(schema).parquet(source))).df
    writer = rows.writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint).option("ignoreNullFields", "false")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
