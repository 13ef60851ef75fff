"""What the operators share: shipping this package to executors, shared tables and shared files."""

from __future__ import annotations

import atexit
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siftwright.shared import shared_root
from siftwright.shipping import ship

#: Words everywhere in this subpackage: runs of anything but these six ASCII white space characters.
ASCII_SPACE = " \t\n\x0b\x0c\r"


_mine: list[tuple[SparkSession, str]] = []


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{shared_root(spark).rstrip('/')}/siftwright/{name}-{uuid.uuid4().hex}"
    _mine.append((spark, path))
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _delete_mine() -> None:
    for spark, path in _mine:
        try:
            delete_path(spark, path)
        except Exception:  # the session may be over; the folder then belongs to whoever clears the shared folder
            return


class Table:
    """A table written to the shared folder and read again: lineage ends here, so a lost executor costs nothing before it."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, new_shared_path(df.sparkSession, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    return Table(df, name).df


try:  # gives memory that was freed back to the system; the C library may have no such call
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):
    _trim = None
_held: dict[object, object] = {}


def held(kind: object, make: Callable[[], object]):
    """What a Python worker keeps from batch to batch. Workers outlive the stage that they were started for, so only one kind is kept at a time."""
    if kind not in _held:
        _held.clear()
        gc.collect()
        _held[kind] = make()
    return _held[kind]


def forget() -> None:
    """At a task's end: a worker that waits for the next one, perhaps of another operator, keeps vocabularies and weights but no table of words."""
    for x in _held.values():
        x.forget()
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``f`` on each Arrow batch; empty batches are left out."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                if batch.num_rows:
                    yield f(batch)
        finally:
            forget()

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts, nulls as empty texts."""
    return [t or "" for t in batch.column(column).to_pylist()]
