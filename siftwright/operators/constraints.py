"""Keys, references and widths, as set operations over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that more than one row has, with their number."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def already_there(df: DataFrame, table: DataFrame, *key: str) -> DataFrame:
    """Rows whose key the table has."""
    return df.join(table.select(*key), list(key), "left_semi")


def orphans(df: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose parent is unknown; a null parent is unknown too."""
    return df.join(parents.select(F.col(parent_column).alias(column)), column, "left_anti")


def too_wide(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Rows with a text of more bytes than its column holds."""
    over: Column = F.lit(False)
    for name, n in widths.items():
        over = over | F.coalesce(F.octet_length(name) > n, F.lit(False))
    return df.filter(over)


def pending(files: DataFrame, ledger: DataFrame, *key: str) -> DataFrame:
    """Files whose key the ledger doesn't have: those still to be loaded."""
    return files.join(ledger.select(*key), list(key), "left_anti")
