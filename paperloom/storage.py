"""Tables and files that a run writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}


def run_folder(spark: SparkSession) -> str:
    """A folder of this application in spark.checkpoint.dir, gone when its JVM ends.

    Only where that is unset and everything runs in one process, as in tests, a temporary folder takes its place.
    """
    context = spark.sparkContext
    if context.applicationId not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not root and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = root.rstrip("/") if root else f"file://{tempfile.mkdtemp(prefix='paperloom-')}"
        where = context._jvm.org.apache.hadoop.fs.Path(f"{root}/paperloom-run-{context.applicationId}")
        system = where.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(where)
        system.deleteOnExit(where)
        _folders[context.applicationId] = str(where.toString())
    return _folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """df written as a table and read back: what follows, and tasks that run again, don't do its work anew."""
    path = f"{folder}/{label}" if folder else new_folder(df.sparkSession, label)
    df.write.mode("overwrite" if folder else "errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
