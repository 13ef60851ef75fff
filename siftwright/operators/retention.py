"""Retention: old input files go by the day in their names."""

from __future__ import annotations

import glob
import os
import re
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_in(name, dataset: str):
    """The day in ``<dataset>_<YYYYMMDD>.csv`` or ``.csv.gz``, or null."""
    text = F.regexp_extract(name, f"^{re.escape(dataset)}_([0-9]{{8}})[.]csv([.]gz)?$", 1)
    return F.try_to_timestamp(F.when(text != "", text), F.lit("yyyyMMdd")).cast("date")


def candidates(files: DataFrame, name: str, dataset: str, cutoff: date) -> DataFrame:
    """Files of the dataset from before the cutoff."""
    return files.withColumn("file_day", day_in(F.col(name), dataset)).filter(F.col("file_day") < F.lit(cutoff))


def sweep(folder: str, dataset: str, cutoff: date) -> tuple[list[str], list[tuple[str, str]]]:
    """Deletes such files. Returns those deleted, and those left with the reason. Never raises."""
    deleted, left = [], []
    for path in sorted(glob.glob(os.path.join(glob.escape(folder), f"{dataset}_*"))):
        name = os.path.basename(path)
        m = re.fullmatch(rf"{re.escape(dataset)}_(\d{{4}})(\d{{2}})(\d{{2}})\.csv(?:\.gz)?", name)
        try:
            if not m:
                left.append((name, "no day in its name"))
            elif date(*map(int, m.groups())) < cutoff:
                os.remove(path)
                deleted.append(name)
        except (OSError, ValueError) as e:
            left.append((name, str(e)))
    return deleted, left
