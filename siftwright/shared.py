"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a temporary folder if all of Spark runs in this process, as in tests, and else an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='siftwright-')}"
        sc.setCheckpointDir(named)
    return named if re.match(r"\w+:", named) else f"file://{os.path.abspath(named)}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{shared_root(spark).rstrip('/')}/siftwright/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    atexit.register(_deleted, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop)
    return path


def _deleted(fs, path) -> None:
    try:
        fs.delete(path, True)
    except Exception:  # the session may be over
        pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read again, so that what was counted once stays as it was."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
