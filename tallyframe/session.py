"""Sessions: the settings the library relies on, and its own code on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.timeType.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what can be set on a running session; nothing that a cluster's owner sizes is touched."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(name: str = "tallyframe", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, an own temporary one if driver and tasks share a machine, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tallyframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_tallyframe_shipped", False):
        return spark
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tallyframe-"), "tallyframe.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("tallyframe", os.path.relpath(full, here)))
    context.addPyFile(path)
    context._tallyframe_shipped = True
    return spark
