"""Whether tables have the columns that contracts ask for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Difference:
    table: str
    column: str | None
    problem: str


def differences(table: str, found: T.StructType, wanted: T.StructType) -> list[Difference]:
    """Columns that are missing, and columns of another type. Further columns do no harm."""
    there = {f.name: f.dataType for f in found}
    out = [Difference(table, f.name, "missing") for f in wanted if f.name not in there]
    return out + [Difference(table, f.name, f"is {there[f.name].simpleString()}, not {f.dataType.simpleString()}") for f in wanted if f.name in there and there[f.name] != f.dataType]


def catalogue(spark: SparkSession, wanted: dict[str, T.StructType], database: str | None = None) -> list[Difference]:
    """The same over the tables of Spark's catalogue."""
    there = {t.name: t for t in spark.catalog.listTables(database)}
    out: list[Difference] = []
    for name, schema in wanted.items():
        if name not in there:
            out.append(Difference(name, None, "missing"))
        else:
            out += differences(name, spark.table(f"{database}.{name}" if database else name).schema, schema)
    return out


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]
