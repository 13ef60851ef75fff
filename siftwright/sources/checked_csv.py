"""The scan: a Spark data source of delimited files, one task for each file.

Quoted line feeds and compressed files can't be split, so a file is one task; a table of many files is many tasks. Records stream through in Arrow
batches of ``chunk_size`` rows, so a task holds one batch whatever the file's size. Blank lines, empty fields and record
widths arrive as they are, which Spark's own CSV reader doesn't do.
"""

from __future__ import annotations

import io
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from siftwright import errors
from siftwright.contract import DatasetContract
from siftwright.errors import CodedError, InspectionError
from siftwright.shipping import ship
from siftwright.sources import inspect as look

SCHEMA = "source_file string, row_number long, fields array<string>, raw_line string"


def _noted(lines: io.TextIOBase, last: list[str]) -> Iterator[str]:
    """The lines, each noted in ``last`` for whoever asks which line a record ended on."""
    for line in lines:
        last[0] = line
        yield line


def read_records(plan: look.Plan, contract: DatasetContract, ceiling: int = look.MAX_DECOMPRESSED_BYTES) -> Iterator[tuple[int, list[str], str]]:
    """Row number (from 1, over the records that count), fields and last source line of each data record."""
    with io.TextIOWrapper(look.open_bytes(plan.path, ceiling), encoding=plan.codec, newline="", errors="strict") as stream:
        last = [""]
        number = 0
        for at, fields in enumerate(look.records(_noted(stream, last), contract)):
            if at < plan.first_row or at in plan.dropped and (len(fields) != len(plan.header) or tuple(fields) == plan.header):
                continue
            number += 1
            yield number, fields, last[0]


@dataclass
class _File(InputPartition):
    path: str
    plan: look.Plan | None = None  # None: made where the file is read


class _Reader(DataSourceReader):
    def __init__(self, files: list[_File], contract: DatasetContract, ceiling: int):
        self.files, self.contract, self.ceiling = files, contract, ceiling

    def partitions(self) -> list[InputPartition]:
        return [*self.files] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, _File):
            return
        name = os.path.basename(partition.path)
        plan = partition.plan or look.inspect(partition.path, self.contract, self.ceiling)
        schema = pa.schema([("source_file", pa.string()), ("row_number", pa.int64()), ("fields", pa.list_(pa.string())), ("raw_line", pa.string())])
        rows: list[tuple[int, list[str], str]] = []

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), *(pa.array([r[k] for r in rows], schema.field(k + 1).type) for k in range(3))], schema=schema)
            rows.clear()
            return made

        for row in read_records(plan, self.contract, self.ceiling):
            rows.append(row)
            if len(rows) == self.contract.chunk_size:
                yield batch()
        if rows:
            yield batch()


class _FilteringReader(_Reader):
    """For sessions that let Python sources take filters."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """A filter on ``source_file`` leaves files unread; the others go back to Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("source_file",):
                self.files = [p for p in self.files if os.path.basename(p.path) == f.value]
            else:
                yield f


class CheckedCsv(DataSource):
    """``spark.read.format("checked_csv")`` after ``register``; ``scan`` is the usual way in. Options: ``inspected``, as ``packed`` makes it, and ``filters``."""

    @classmethod
    def name(cls) -> str:
        return "checked_csv"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        files, contract, ceiling = unpacked(self.options["inspected"])
        kind = _FilteringReader if self.options.get("filters") == "true" else _Reader
        return kind(files, contract, ceiling)


def packed(files: list[_File], contract: DatasetContract, ceiling: int) -> str:
    import base64
    import pickle

    return base64.b64encode(pickle.dumps((files, contract, ceiling))).decode()


def unpacked(text: str) -> tuple[list[_File], DatasetContract, int]:
    import base64
    import pickle

    return pickle.loads(base64.b64decode(text))


def _one_header(spark: SparkSession, paths: list[str], contract: DatasetContract, ceiling: int) -> tuple[str, ...]:
    """The header of many files, each inspected in a task; one row comes back, whatever their number."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: list[tuple[str | None, str | None]] = []
            for path in batch.column(0).to_pylist():
                try:
                    seen.append((json.dumps(look.inspect(path, contract, ceiling).header), None))
                except CodedError:
                    seen.append((None, path))
            yield pa.RecordBatch.from_arrays([pa.array([s[k] for s in seen], pa.string()) for k in range(2)], ["header", "refused"])

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 1000))
    found = files.mapInArrow(f, "header string, refused string").agg(F.min("refused"), F.count_distinct("header"), F.min("header")).first()
    if found[0] is not None:
        look.inspect(found[0], contract, ceiling)  # says why
        raise InspectionError(f"{found[0]} changed while it was inspected")
    if found[1] > 1:
        raise InspectionError(f"files with {found[1]} different headers; scan them one by one", errors.EXTRA_UNEXPECTED_COLUMN)
    return tuple(json.loads(found[2]))


def scan(spark: SparkSession, paths: list[str], contract: DatasetContract, ceiling: int = look.MAX_DECOMPRESSED_BYTES) -> tuple[DataFrame, list[str]]:
    """The records of files with one header, and that header. All files are inspected first, so a refused one raises before anything is read. Of many files each is
    inspected in a task, and once more by the task that reads it, so the driver holds their paths only."""
    ship(spark)
    if len(paths) > 1:
        header, files = _one_header(spark, paths, contract, ceiling), [_File(p) for p in paths]
    else:
        files = [_File(p, look.inspect(p, contract, ceiling)) for p in paths]
        header = files[0].plan.header if files else tuple(contract.names)
    spark.dataSource.register(CheckedCsv)
    df = spark.read.format("checked_csv").option("inspected", packed(files, contract, ceiling)).option("filters", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).load()
    return df, list(header)
