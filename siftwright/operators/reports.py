"""Report operators: joins, grouped totals, latest records, buckets and top rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """An amount in whole cents, half away from zero."""
    return F.round(amount * 100, 0).cast("long")


def mean_cents(total: Column, n: Column) -> Column:
    """The mean of whole cents rounded half away from zero, by integers alone; null without rows."""
    return F.when(n > 0, F.signum(total).cast("long") * F.call_function("div", F.abs(total) * 2 + n, n * 2))


def by_region_and_month(facts: DataFrame, region: str, day: str, amount_cents: str) -> DataFrame:
    """Rows, total and mean by region and month. Null months form a group; null amounts count as rows only."""
    grouped = facts.groupBy(F.col(region).alias("region"), F.trunc(day, "MM").alias("order_month")).agg(F.count("*").alias("n_orders"), F.sum(amount_cents).alias("total_cents"), F.count(amount_cents).alias("n_amounts"))
    return grouped.select("region", "order_month", "n_orders", "total_cents", mean_cents(F.col("total_cents"), F.col("n_amounts")).alias("mean_cents"))


def in_report_order(report: DataFrame) -> DataFrame:
    """Regions, then months, those without a month last."""
    return report.orderBy(F.asc_nulls_last("region"), F.asc_nulls_last("order_month"))


def latest_all_ties(df: DataFrame, group: str, by: str) -> DataFrame:
    """The rows with the greatest ``by`` of each group, all of them if several have it."""
    return df.join(df.groupBy(group).agg(F.max(by).alias(by)), [group, by])


def latest_one(df: DataFrame, *by: str) -> DataFrame:
    """The one latest row, later columns deciding between equal ones."""
    return df.orderBy(*(F.desc_nulls_last(c) for c in by)).limit(1)


def bucket(ts: Column, minutes: int = 5) -> Column:
    """The begin of the clock's bucket that holds an instant."""
    return F.window(ts, f"{minutes} minutes").start


def first_of_group(df: DataFrame, n: int, group: str, *by: str) -> DataFrame:
    """The first rows of each group, numbered ``rn``."""
    w = Window.partitionBy(group).orderBy(*by)
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def labelled_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row for each table: its label and its number of rows."""
    out = None
    for label, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(label).alias("label"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def modal_value(df: DataFrame, value: Column, order: str) -> DataFrame:
    """The most frequent value; of equally frequent ones the first by ``order``."""
    counted = df.select(value.alias("value"), F.col(order).alias("_o")).groupBy("value").agg(F.count("*").alias("n_rows"), F.min("_o").alias("_first"))
    return counted.orderBy(F.desc("n_rows"), "_first").limit(1).select("value", "n_rows")
