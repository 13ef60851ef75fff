"""Synthetic rows: a pure function of seed and row number, so every run and every retry makes the same ones."""

from __future__ import annotations

import hashlib
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwright.contract import ColumnContract, DatasetContract
from siftwright.shared import stored

#: How a row is broken: too few fields, an empty required field, a field of a wrong type, too many fields.
BREAKS = ("short", "empty", "type", "long")
EULER = 0.5772156649015329  # the Euler-Mascheroni constant


def structured_id(prefix: str, seed: int, number: Column) -> Column:
    """``PREFIX-<8 hex digits of the seed's SHA-256>-<at least six digits>``."""
    return F.concat(F.lit(f"{prefix}-{hashlib.sha256(str(seed).encode()).hexdigest()[:8]}-"), F.format_string("%06d", number))


def seed_of(ts: Column) -> Column:
    """The minute of an instant as a number: the same logical time gives the same seed."""
    return F.date_format(ts, "yyyyMMddHHmm").cast("long")


def seed_at(ts: datetime) -> int:
    return int(ts.strftime("%Y%m%d%H%M"))


def drawn(digits: int, seed: int, *parts: Column) -> Column:
    """A whole number below ``16 ** digits`` that seed and parts determine: the first digits of an MD5, which other engines can compute as well."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *(p.cast("string") for p in parts))), 1, digits), 16, 10).cast("long")


def share(seed: int, *parts: Column) -> Column:
    """A number from 0 to 1 that seed and parts determine."""
    return drawn(10, seed, *parts) / float(1 << 40)


def text_of(column: ColumnContract, seed: int, number: Column, prefix: str) -> Column:
    """A valid field, exact for decimals: whole numbers of the last digit, never floats."""
    at = lambda n: drawn(15, seed, F.lit(column.name), number) % n
    if column.type == "decimal":
        units = at(10 ** min(column.precision, 17))  # what 15 hexadecimal digits can tell apart
        whole = F.call_function("div", units, F.lit(10**column.scale))
        return F.concat(whole.cast("string"), F.lit("."), F.lpad((units - whole * 10**column.scale).cast("string"), column.scale, "0"))
    if column.type == "integer":
        return at(1_000_000).cast("string")
    if column.type == "boolean":
        return F.when(at(2) == 0, "true").otherwise("false")
    if column.type in ("date", "timestamp"):
        ts = F.timestamp_seconds(F.lit(1_577_836_800) + at(6 * 365 * 86_400))
        return F.date_format(ts, _java(column.format))
    return structured_id(prefix, seed, number) if column.name.endswith("_id") else F.concat(F.lit(f"{column.name}-"), at(1000).cast("string"))


def _java(fmt: str) -> str:
    names = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%z": "xx"}
    out, i = "", 0
    while i < len(fmt):
        two = fmt[i : i + 2]
        out, i = (out + names[two], i + 2) if two in names else (out + f"'{fmt[i]}'", i + 1)
    return out


def rows(spark: SparkSession, contract: DatasetContract, n: int, seed: int, invalid_share: float = 0.0, pools: dict[str, DataFrame] | None = None) -> DataFrame:
    """``number, fields, broken``: rows in contract order; ``broken`` is null for valid ones. ``pools`` gives columns their values, drawn by ``zipf``."""
    df = spark.range(1, n + 1).withColumnRenamed("id", "number")
    texts = {c.name: text_of(c, seed, F.col("number"), contract.dataset[:3].upper()) for c in contract.columns}
    for name, pool in (pools or {}).items():
        df = zipf(df, pool, "number", seed, name)
        texts[name] = F.col(name)
    broken = F.when(share(seed, F.lit("broken"), F.col("number")) < invalid_share, F.element_at(F.array(*map(F.lit, BREAKS)), (drawn(15, seed, F.lit("how"), F.col("number")) % len(BREAKS) + 1).cast("int")))
    df = df.select("number", F.array(*texts.values()).alias("fields"), broken.alias("broken"))
    needed = next((k for k, c in enumerate(contract.columns) if not c.nullable), 0)
    typed_at = next((k for k, c in enumerate(contract.columns) if c.type != "string"), needed)
    put = lambda k, v: F.transform("fields", lambda x, i: F.when(i == k, F.lit(v)).otherwise(x))
    fields = (
        F.when(F.col("broken") == "short", F.slice("fields", 1, max(1, len(contract.columns) - 1)))
        .when(F.col("broken") == "empty", put(needed, ""))
        .when(F.col("broken") == "type", put(typed_at, "not-a-value"))
        .when(F.col("broken") == "long", F.concat("fields", F.array(F.lit("surplus"))))
        .otherwise(F.col("fields"))
    )
    return df.withColumn("fields", fields)


def correlated(spark: SparkSession, parent: DatasetContract, child: DatasetContract, key: str, parents: int, children: int, seed: int, invalid_share: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Rows of two datasets, where the children's ``key`` is drawn from the valid parents' by ``zipf``."""
    made = rows(spark, parent, parents, seed, invalid_share)
    pool = made.filter("broken is null").select(F.get("fields", F.lit(parent.names.index(key))).alias(key))
    return made, rows(spark, child, children, seed, invalid_share, {key: pool})


def harmonic(r: Column) -> Column:
    """``1 + 1/2 + ... + 1/r``, 0 for 0, to the precision of a double: the asymptotic series sixteen places on, less the terms between."""
    x = (r + 16).cast("double")
    series = F.log(x) + EULER + 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6) + 1 / (240 * x**8)
    return series - reduce(lambda a, k: a + 1 / (r + k), range(2, 17), 1 / (r + 1))


def ranked(pool: DataFrame, name: str) -> DataFrame:
    """``rank, name``: the pool's one column, numbered from 1 in its order. Ranges are sorted in tasks of their own and stored, then each adds what lies before it."""
    (value,) = pool.columns
    inner = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the place in the task's own range
    ranges = stored(pool.select(F.col(value).alias(name)).repartitionByRange(name).sortWithinPartitions(name).select(name, F.spark_partition_id().alias("range"), inner.alias("at")), "ranks")
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))  # one row for each range
    offsets = ranges.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(before, F.lit(0)).alias("before"))
    return ranges.join(offsets, "range").select((F.col("before") + F.col("at") + 1).alias("rank"), name)


def zipf(df: DataFrame, pool: DataFrame, key: str, seed: int, name: str) -> DataFrame:
    """``df`` with ``name``, drawn with replacement from the pool's one column: the value of rank r with weight 1/r, ranks in the values' order.

    Each row's share of the weights' sum tells its rank: the least whose harmonic number is above it, at most one off a closed form. Rows and values then meet by rank."""
    n = pool.count()
    if not n:
        raise ValueError("an empty pool has nothing to draw")
    total = harmonic(F.lit(n))
    target, guess = F.col("target"), F.col("guess")
    rank = F.when(harmonic(guess) > target, guess).when(harmonic(guess + 1) > target, guess + 1).otherwise(guess + 2)
    rows = df.withColumn("target", share(seed, F.lit(name), F.col(key)) * total).withColumn("guess", F.floor(F.exp(target - EULER) - 0.5))
    rows = rows.withColumn("rank", F.greatest(F.lit(1), F.least(F.lit(n), rank)).cast("long"))
    return rows.join(ranked(pool, name), "rank").select(*df.columns, name)


def csv_lines(df: DataFrame, contract: DatasetContract) -> DataFrame:
    """``number, value``: each row as a line, fields quoted where they need it."""
    d = contract.csv
    special = "[" + "".join("\\" + c for c in (d.delimiter, d.quotechar)) + "\r\n]"
    quoted = F.transform("fields", lambda x: F.when(x.rlike(special), F.concat(F.lit(d.quotechar), F.replace(x, F.lit(d.quotechar), F.lit(d.quotechar * 2)), F.lit(d.quotechar))).otherwise(x))
    return df.select("number", F.array_join(quoted, d.delimiter).alias("value"))
