"""Advisory schema inference: one aggregate over all columns of text, then a short decision on the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwright.contract import ColumnContract
from siftwright.functions import typed

# Words of a boolean column, and those that tell one from numbers.
BOOLEAN_WORDS = ("true", "false", "yes", "no", "0", "1")
TELLING_WORDS = ("true", "false", "yes", "no")


@dataclass(frozen=True)
class Inferred:
    type: str
    flag: str | None = None
    format: str | None = None


def measures(c: Column, formats: tuple[str, ...] = ()) -> list[Column]:
    """Counts over a column's values, nulls aside."""
    low = F.lower(c)
    digits = c.rlike(r"^-?[0-9]+$")
    counts = [
        F.count(c).alias("n"),
        F.count_if(low.isin(*BOOLEAN_WORDS)).alias("boolean"),
        F.count_if(low.isin(*TELLING_WORDS)).alias("telling"),
        F.count_if(c.rlike(r"^-?[0-9]+(?:\.[0-9]+)?[eE][+-]?[0-9]+$")).alias("scientific"),
        F.count_if(digits).alias("digits"),
        F.count_if(c.rlike(r"^-?0[0-9]+$")).alias("leading_zero"),
        F.count_if(typed.is_number(c)).alias("number"),
    ]
    return counts + [F.count_if(typed.parsed_time(c, f).isNotNull()).alias(f"format_{k}") for k, f in enumerate(formats)]


def decide(m: dict[str, int], formats: tuple[str, ...] = ()) -> Inferred:
    n = m["n"]
    if not n:
        return Inferred("string", "empty-sample")
    if m["boolean"] == n and m["telling"]:
        return Inferred("boolean")
    for k, f in enumerate(formats):
        if m[f"format_{k}"] == n:
            return Inferred("timestamp" if typed.time_format(f).has_time else "date", None, f)
    if m["scientific"]:
        return Inferred("string", "scientific-notation")
    if m["digits"] == n:
        return Inferred("string", "leading-zero") if m["leading_zero"] else Inferred("integer")
    if m["number"] == n:
        return Inferred("decimal")
    return Inferred("string", "mixed-parseable" if m["number"] else None)


def infer(df: DataFrame, columns: list[str], formats: tuple[str, ...] = ()) -> dict[str, Inferred]:
    """The type of each text column. Values that are null, as missing fields of short rows are, say nothing."""
    row = df.agg(*(F.struct(*measures(F.col(c), formats)).alias(c) for c in columns)).first()
    return {c: decide(row[c].asDict(), formats) for c in columns}


def draft(found: dict[str, Inferred], precision: int = 38, scale: int = 10) -> list[ColumnContract]:
    """Columns of a contract to start from: all nullable and required."""
    return [ColumnContract(n, i.type, True, True, i.format, precision if i.type == "decimal" else None, scale if i.type == "decimal" else None) for n, i in found.items()]


def as_table(df: DataFrame, columns: list[str], formats: tuple[str, ...] = ()) -> DataFrame:
    """``column_name, inferred, flag`` by the same rules, as a query."""
    agg = df.agg(*(F.struct(*measures(F.col(c), formats)).alias(c) for c in columns))
    rows = agg.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("m")) for c in columns))).alias("r")).select("r.column_name", "r.m.*")
    n = F.col("n")
    timed = F.lit(None).cast("string")
    for k, f in reversed([*enumerate(formats)]):
        timed = F.when(F.col(f"format_{k}") == n, "timestamp" if typed.time_format(f).has_time else "date").otherwise(timed)
    plain = (n > 0) & ~((F.col("boolean") == n) & (F.col("telling") > 0)) & timed.isNull()
    inferred = (
        F.when(n == 0, "string")
        .when((F.col("boolean") == n) & (F.col("telling") > 0), "boolean")
        .when(timed.isNotNull(), timed)
        .when(F.col("scientific") > 0, "string")
        .when(F.col("digits") == n, F.when(F.col("leading_zero") > 0, "string").otherwise("integer"))
        .when(F.col("number") == n, "decimal")
        .otherwise("string")
    )
    flag = (
        F.when(n == 0, "empty-sample")
        .when(plain & (F.col("scientific") > 0), "scientific-notation")
        .when(plain & (F.col("digits") == n) & (F.col("leading_zero") > 0), "leading-zero")
        .when(plain & (F.col("digits") < n) & (F.col("number") > 0) & (F.col("number") < n), "mixed-parseable")
    )
    return rows.select("column_name", inferred.alias("inferred"), flag.alias("flag"))
