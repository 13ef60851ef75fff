"""Ingestion of one file, all or nothing: inspect, scan, classify, check, write, record.

A load's rows lie in folders named by the try that wrote them. They count once the ledger's entry of the content names that try. There is one entry for a
dataset and checksum: a file that is put in place whole, last, and only where none is. So a crash before leaves nothing that a reader sees, the same content is
never loaded twice, whatever its name, and of two loaders at work on it at once one wins and the other drops what it wrote. Claims only save work: they are
renewed while a load runs and may be taken over when that stops.

Entries are put in place by a hard link on a local file system and by a rename elsewhere, which must refuse to replace a file (HDFS does).
"""

from __future__ import annotations

import hashlib
import json
import os
import threading
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siftwright.contract import DatasetContract
from siftwright.errors import CodedError, ConstraintError, ContractError, Status, StructureError
from siftwright.operators import classify, constraints
from siftwright.sources import checked_csv
from siftwright.sources import inspect as look

LEDGER_SCHEMA = "id long, dataset string, file_name string, checksum string, processed_at timestamp, total_rows long, valid_rows long, invalid_rows long, status string"
_LOAD, _DAY = "load", "ingested_date"


@dataclass(frozen=True)
class Result:
    status: Status
    dataset: str
    file_name: str
    checksum: str | None = None
    total_rows: int = 0
    valid_rows: int = 0
    invalid_rows: int = 0
    duration_seconds: float = 0.0

    def summary(self) -> str:
        return f"{self.dataset} {self.file_name}: {self.status} total={self.total_rows} valid={self.valid_rows} invalid={self.invalid_rows} in {self.duration_seconds:.3f}s"


def summary_of(results: dict[str, object]) -> str:
    """A cascade's steps, one to a line."""
    return "\n".join(f"{name}: {r.summary() if isinstance(r, Result) else r}" for name, r in results.items())


@dataclass(frozen=True)
class Rules:
    """What the target tables demand: a key, parents (column to (dataset's contract, its column)), and widths in bytes."""

    key: tuple[str, ...] = ()
    parents: dict[str, tuple[DatasetContract, str]] = field(default_factory=dict)
    widths: dict[str, int] = field(default_factory=dict)


def sha256_of(path: str) -> str:
    found = hashlib.sha256()
    with look.open_raw(path) as f:
        while block := f.read(1 << 20):
            found.update(block)
    return found.hexdigest()


class Store:
    """Tables below one root, which may be any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _put(self, path: str, text: str) -> bool:
        """Puts a file in place, whole, unless there is one."""
        staged, target = self._path(f"{self.root}/_staged/{uuid.uuid4().hex}"), self._path(path)
        self._fs.mkdirs(staged.getParent())
        self._fs.mkdirs(target.getParent())
        out = self._fs.create(staged, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                try:
                    os.link(staged.toUri().getPath(), target.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            return not self._fs.exists(target) and bool(self._fs.rename(staged, target))
        finally:
            self._fs.delete(staged, False)

    def _entries(self) -> DataFrame:
        """The ledger with the try that each entry names."""
        path, schema = f"{self.root}/ledger", f"{LEDGER_SCHEMA}, {_LOAD} string"
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).json(path) if self._exists(path) else self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        return self._entries().drop(_LOAD)

    def recorded(self, dataset: str, checksum: str):
        path = self._path(f"{self.root}/ledger/{dataset}/{checksum}.json")
        return self.spark.read.schema(LEDGER_SCHEMA).json(path.toString()).first() if self._fs.exists(path) else None

    def table(self, contract: DatasetContract, valid: bool = True) -> DataFrame:
        """The committed rows, with ``ingested_at`` and ``ingested_date`` but without the load's name."""
        schema, name = (contract.valid_schema, contract.targets.valid_table) if valid else (contract.invalid_schema, contract.targets.invalid_table)
        full = schema.add("ingested_at", "timestamp").add(_LOAD, "string").add(_DAY, "date")
        path = f"{self.root}/{name}"
        rows = self.spark.read.schema(full).parquet(path) if self._exists(path) else self.spark.createDataFrame([], full)
        done = self._entries().filter(F.col("dataset") == contract.dataset).select(_LOAD)
        return rows.join(done, _LOAD, "left_semi").drop(_LOAD)

    def write(self, df: DataFrame, table: str, load: str, at: datetime) -> int:
        """Writes a load's rows and returns their number."""
        seen = Observation()
        out = df.withColumns({"ingested_at": F.lit(at), _DAY: F.lit(at.astimezone(timezone.utc).date())}).observe(seen, F.count(F.lit(1)).alias("n"))
        out.write.mode("overwrite").partitionBy(_DAY).parquet(f"{self.root}/{table}/{_LOAD}={load}")
        return seen.get["n"]

    def drop(self, table: str, load: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{table}/{_LOAD}={load}"), True)

    def truncate(self, contract: DatasetContract) -> None:
        """Empties a dataset's tables. Its part of the ledger goes first, in one rename, and with it all its rows are out of sight; its files may be loaded again."""
        own = self._path(f"{self.root}/ledger/{contract.dataset}")
        if self._fs.exists(own):
            gone = self._path(f"{self.root}/_staged/{uuid.uuid4().hex}")
            self._fs.mkdirs(gone.getParent())
            if not self._fs.rename(own, gone):
                raise OSError(f"cannot empty the ledger of {contract.dataset}")
            self._fs.delete(gone, True)
        for table in (contract.targets.valid_table, contract.targets.invalid_table):
            self._fs.delete(self._path(f"{self.root}/{table}"), True)

    def claim(self, dataset: str, checksum: str, stale_seconds: float | None = None) -> bool:
        """Whether this caller is the one that loads this content now. A claim that nobody has renewed for ``stale_seconds`` is taken over."""
        path = f"{self.root}/locks/{dataset}-{checksum}"
        for there in (self._fs.globStatus(self._path(path)) or []) if stale_seconds is not None else []:  # none or one, even if it goes meanwhile
            if time.time() - there.getModificationTime() / 1000 > stale_seconds:
                self.release(dataset, checksum)
        return self._put(path, "")

    @contextmanager
    def renewing(self, dataset: str, checksum: str, seconds: float):
        """Renews a claim every so often while the body runs."""
        path, over = self._path(f"{self.root}/locks/{dataset}-{checksum}"), threading.Event()

        def renew() -> None:
            while not over.wait(seconds):
                try:
                    self._fs.setTimes(path, int(time.time() * 1000), -1)
                except Exception:  # taken over: the ledger decides which of the two counts
                    return

        thread = threading.Thread(target=renew, daemon=True)
        thread.start()
        try:
            yield
        finally:
            over.set()
            thread.join()

    def release(self, dataset: str, checksum: str) -> None:
        self._fs.delete(self._path(f"{self.root}/locks/{dataset}-{checksum}"), False)

    def record(self, r: Result, at: datetime, load: str) -> bool:
        """Commits a load. False if the content is recorded already, which changes nothing. Ids are never given twice; one may stay unused."""
        last = self.ledger().agg(F.max("id")).first()[0] or 0
        while not self._put(f"{self.root}/ids/{last + 1:012d}", ""):
            last += 1
        row = {"id": last + 1, "dataset": r.dataset, "file_name": r.file_name, "checksum": r.checksum, "processed_at": at.astimezone(timezone.utc).isoformat(), "total_rows": r.total_rows, "valid_rows": r.valid_rows, "invalid_rows": r.invalid_rows, "status": str(r.status), _LOAD: load}
        return self._put(f"{self.root}/ledger/{r.dataset}/{r.checksum}.json", json.dumps(row) + "\n")


def check(valid: DataFrame, invalid: DataFrame, contract: DatasetContract, store: Store, rules: Rules) -> None:
    """Raises ConstraintError for the first rule that rows break."""

    def none(df: DataFrame, what: str) -> None:
        if row := df.first():
            raise ConstraintError(f"{contract.dataset}: {what}: {row.asDict()}")

    if rules.key:
        none(constraints.duplicate_keys(valid, *rules.key), "a key stands twice")
        none(constraints.already_there(valid, store.table(contract), *rules.key), "a key is already there")
    for column, (parent, parent_column) in rules.parents.items():
        none(constraints.orphans(valid, column, store.table(parent), parent_column), f"{column} has no parent")
    if rules.widths:
        texts = {n: w for n, w in rules.widths.items() if n in invalid.columns and dict(valid.dtypes).get(n, "string") == "string"}
        none(constraints.too_wide(valid, {n: w for n, w in texts.items() if n in valid.columns}), "a text is too long")
        none(constraints.too_wide(invalid, texts), "a text of an invalid row is too long")


def _drop(store: Store, contract: DatasetContract, load: str) -> None:
    for table in (contract.targets.valid_table, contract.targets.invalid_table):
        store.drop(table, load)


def _load(spark: SparkSession, path: str, contract: DatasetContract, store: Store, rules: Rules, result: Result, load: str, at: datetime) -> Result:
    """Writes and checks a file's rows; on any fault nothing stays."""
    records, header = checked_csv.scan(spark, [path], contract)
    marked = classify.classify(records, contract, header).persist()
    try:
        valid, invalid = classify.valid_rows(marked, contract, header), classify.invalid_rows(marked, contract, header)
        n = {"valid_rows": store.write(valid, contract.targets.valid_table, load, at), "invalid_rows": store.write(invalid, contract.targets.invalid_table, load, at)}
        found = replace(result, **n, total_rows=sum(n.values()), status=Status.SUCCESS_WITH_INVALID_ROWS if n["invalid_rows"] else Status.SUCCESS)
        try:
            check(valid, invalid, contract, store, rules)
        except ConstraintError as e:
            raise BrokenRule(str(e), found) from e
        return found
    except BaseException:
        _drop(store, contract, load)
        raise
    finally:
        marked.unpersist()


class BrokenRule(ConstraintError):
    """A rule that a file's rows break, with their numbers."""

    def __init__(self, message: str, counted: Result):
        super().__init__(message)
        self.counted = counted


def process(spark: SparkSession, path: str, contract: DatasetContract, store: Store, rules: Rules = Rules(), now: datetime | None = None, wait_seconds: float = 60.0) -> Result:
    """Loads one file. Never raises: the result's status says how it ended."""
    began = time.monotonic()
    result = Result(Status.PROCESSING_ERROR, contract.dataset, os.path.basename(path))
    done = lambda r, **k: replace(r, **k, duration_seconds=time.monotonic() - began)
    try:
        contract.checked()
    except ContractError:
        return done(result, status=Status.CONFIGURATION_ERROR)
    if not look.exists(path):
        return done(result, status=Status.FILE_NOT_FOUND)
    claimed, load = False, uuid.uuid4().hex
    known = lambda row: done(result, status=Status(row.status), total_rows=row.total_rows, valid_rows=row.valid_rows, invalid_rows=row.invalid_rows)
    try:
        result = replace(result, checksum=sha256_of(path))
        while not claimed:
            if row := store.recorded(contract.dataset, result.checksum):
                return known(row)
            claimed = store.claim(contract.dataset, result.checksum, wait_seconds)
            if not claimed:
                time.sleep(0.2)
        at = now or datetime.now(timezone.utc)
        at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)  # a time without a zone is UTC, wherever the driver is
        with store.renewing(contract.dataset, result.checksum, max(0.05, wait_seconds / 4)):
            result = _load(spark, path, contract, store, rules, result, load, at)
        if store.record(result, at, load):
            return done(result)
        _drop(store, contract, load)  # another loader was first
        return known(store.recorded(contract.dataset, result.checksum))
    except StructureError:
        return done(result, status=Status.INVALID_FILE, total_rows=0, valid_rows=0, invalid_rows=0)
    except BrokenRule as e:
        return done(e.counted, status=Status.DATABASE_ERROR)
    except (CodedError, PySparkException, OSError, ValueError):
        return done(result, status=Status.PROCESSING_ERROR)
    finally:
        if claimed:
            store.release(contract.dataset, result.checksum)
