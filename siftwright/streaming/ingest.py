"""Continuous ingestion: files that arrive are loaded once each, steps run in order, and reports wait until their data is there."""

from __future__ import annotations

import fnmatch
import glob
import os
import time
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftwright.contract import DatasetContract
from siftwright.errors import Status
from siftwright.operators.engine import Result, Rules, Store, process

_FILES = "path string, modificationTime timestamp, length long, content binary"


def latest_file(folder: str, pattern: str) -> str | None:
    """The last of the matching files by name."""
    return max(glob.glob(os.path.join(glob.escape(folder), pattern)), default=None)


def path_of(uri: str) -> str:
    """What Spark calls a file, as the loader opens it: local files by their path, all others by their whole URI."""
    return unquote(urlparse(uri).path) if uri.startswith("file:") else uri


def load_again(load: Callable[[], Result], retries: int = 3, sleep: Callable[[float], None] = time.sleep) -> Result:
    """Loads; what ends in PROCESSING_ERROR, which may pass, is tried again after 1, 2, 4 ... seconds, and raises in the end, so that its batch isn't counted as done."""
    for k in range(retries + 1):
        result = load()
        if result.status != Status.PROCESSING_ERROR:
            return result
        if k < retries:
            sleep(2.0**k)
    raise RuntimeError(f"{result.dataset} {result.file_name} could not be loaded")


def stream(spark: SparkSession, folder: str, contract: DatasetContract, store: Store, checkpoint: str, rules: Rules = Rules(), seconds: int | None = None, told: Callable[[Result], None] = lambda r: None, retries: int = 3, sleep: Callable[[float], None] = time.sleep) -> StreamingQuery:
    """Loads files of the contract's pattern as they arrive, in order of their names within a batch. Without ``seconds``: those there now. A batch that is delivered
    again changes nothing, as the ledger knows each content. A file that can't be loaded now fails its batch, which is then delivered again."""
    arrived = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", contract.file_pattern).load(folder).select("path")

    def load(batch: DataFrame, _: int) -> None:
        for row in batch.orderBy("path").collect():  # names of new files
            told(load_again(lambda path=path_of(row.path): process(spark, path, contract, store, rules), retries, sleep))

    writer = arrived.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def matching(names: list[str], pattern: str) -> list[str]:
    return sorted(n for n in names if fnmatch.fnmatchcase(n, pattern))


def ready_today(ledger: DataFrame, datasets: list[str]) -> bool:
    """Whether every dataset has a load today."""
    begin = F.current_date().cast("timestamp")  # a range of the column itself, which a scan can prune by
    today = ledger.filter(F.col("dataset").isin(datasets) & (F.col("processed_at") >= begin) & (F.col("processed_at") < F.date_add(F.current_date(), 1).cast("timestamp")))
    return today.agg(F.count_distinct("dataset")).first()[0] == len(set(datasets))


def wait_until(ready: Callable[[], bool], poke: float = 30.0, retries: int = 10, timeout: float = 180.0, transient: tuple[type[BaseException], ...] = (OSError,), sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> None:
    """Asks again and again. Transient errors in a row wait 1, 2, 4 ... seconds, at most ``poke``; more than ``retries`` of them are raised, and so is TimeoutError in the end."""
    begun, failed = clock(), 0
    while True:
        try:
            if ready():
                return
            failed, pause = 0, poke
        except transient:
            failed += 1
            if failed > retries:
                raise
            pause = min(2.0 ** (failed - 1), poke)
        if clock() - begun + pause > timeout:
            raise TimeoutError(f"not ready after {timeout:g} seconds")
        sleep(pause)


def cascade(steps: list[tuple[str, Callable[[], Result | object]]], report: str | None = None, timeout: float | None = None, clock: Callable[[], float] = time.monotonic) -> dict[str, object]:
    """Runs steps in order; what ran is returned by name. A load that failed ends the cascade, but for one that ended in CONFIGURATION_ERROR: then what is between
    is skipped and the step named ``report`` still runs. No step begins ``timeout`` seconds after the first did; that raises TimeoutError."""
    out: dict[str, object] = {}
    begun, skip = clock(), False
    for name, step in steps:
        if skip and name != report:
            continue
        if timeout is not None and clock() - begun > timeout:
            raise TimeoutError(f"{name} did not begin within {timeout:g} seconds")
        out[name] = step()
        if isinstance(out[name], Result) and out[name].status not in (Status.SUCCESS, Status.SUCCESS_WITH_INVALID_ROWS):
            if out[name].status != Status.CONFIGURATION_ERROR or report is None:
                break
            skip = True
    return out


def every(seconds: float, run: Callable[[float], object], runs: int | None = None, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time) -> list[object]:
    """Runs at each multiple of ``seconds`` since the epoch, one run at a time. What became due while a run went on is left out, not made up for. ``run`` gets the time it
    was due, the same if that run is tried again, and what it raises ends that run only. ``runs``: how many; None: for ever, with no list kept."""
    out: list[object] = []
    done = 0
    due = clock() // seconds * seconds + seconds
    while runs is None or done < runs:
        sleep(max(0.0, due - clock()))
        try:
            ended: object = run(due)
        except Exception as e:  # the next run is independent
            ended = e
        if runs is not None:
            out.append(ended)
        done += 1
        due = max(due + seconds, clock() // seconds * seconds + seconds) if clock() >= due + seconds else due + seconds
    return out


def bucket_counts(events: DataFrame, ts: str, minutes: int = 5, late: str = "10 minutes") -> DataFrame:
    """Rows by clock bucket, over a batch or a stream; a stream drops what comes later than ``late``."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, late) if events.isStreaming else rows
    return rows.groupBy(F.window(ts, f"{minutes} minutes").alias("w")).agg(F.count("*").alias("n_rows")).select(F.col("w.start").alias("bucket"), "n_rows")
