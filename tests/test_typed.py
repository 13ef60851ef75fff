import random
from datetime import datetime
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from siftwright.contract import ColumnContract
from siftwright.functions import typed


def verdicts(spark, column, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [r.e for r in df.select("i", typed.error_of(F.col("v"), column).alias("e")).orderBy("i").collect()]


def shuffled(alphabet, n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 9))) for _ in range(n)]


def python_integer(t):
    try:
        int(t)
    except ValueError:
        return "TYPE_MISMATCH"


def python_decimal(t, precision, scale):
    try:
        sign, digits, exponent = Decimal(t).as_tuple()
    except InvalidOperation:
        return "TYPE_MISMATCH"
    if not isinstance(exponent, int):
        return "TYPE_MISMATCH"
    s = max(0, -exponent)
    p = len(digits) + exponent if exponent >= 0 else max(len(digits), -exponent)
    return "DECIMAL_PRECISION_EXCEEDED" if s > scale or p > precision else None


def python_time(t, fmt, code):
    try:
        datetime.strptime(t, fmt)
    except ValueError:
        return code


def test_integer(spark):
    texts = shuffled("0123456789+-_ \tx.", 1500, 1) + ["", "0", "+0", "1_2_3", "__1"]
    assert verdicts(spark, ColumnContract("v", "integer"), texts) == [python_integer(t) for t in texts]


def test_decimal(spark):
    texts = shuffled("0123456789.eE+-_ ", 2500, 2) + ["1e99999999999", "1e-99999999999", "0.00", "000123.40", "sNaN", "-Infinity", "1E+2", "."]
    texts = [t for t in texts if "_" not in t]
    assert verdicts(spark, ColumnContract("v", "decimal", precision=6, scale=2), texts) == [python_decimal(t, 6, 2) for t in texts]


@pytest.mark.parametrize("fmt", ["%Y-%m-%d", "%d/%m/%Y", "%Y%m%d"])
def test_date(spark, fmt):
    r = random.Random(3)
    wide = fmt == "%Y%m%d"
    texts = []
    for _ in range(1500):
        y, m, d = r.choice([0, 1, 1999, 2024, 2026, 9999]), r.randrange(0, 14), r.randrange(0, 33)
        t = fmt.replace("%Y", f"{y:04d}").replace("%m", r.choice([f"{m:02d}", f"{m:02d}" if wide else str(m)])).replace("%d", r.choice([f"{d:02d}", f"{d:02d}" if wide else str(d)]))
        texts.append(t)
    texts += ["", "x", " 2026-01-05", "2026-01-05 ", "2026-1", "2026-01-05T"]
    got = verdicts(spark, ColumnContract("v", "date", format=fmt), texts)
    want = [python_time(t, fmt, "INVALID_DATE_FORMAT") for t in texts]
    year_zero = [t for t, g, w in zip(texts, got, want) if g != w]
    assert all("0000" in t for t in year_zero)


def test_timestamp(spark):
    fmt = "%Y-%m-%dT%H:%M:%S%z"
    texts = ["2026-01-05T10:20:30+0000", "2026-01-05T10:20:30+00:00", "2026-01-05T10:20:30Z", "2026-1-5T1:2:3-0330", "2026-01-05T10:20:30", "2026-01-05T25:00:00Z", "2026-01-05 10:20:30Z", "2026-13-05T10:20:30Z", "2026-02-30T10:20:30Z", "x"]
    assert verdicts(spark, ColumnContract("v", "timestamp", format=fmt), texts) == [python_time(t, fmt, "INVALID_TIMESTAMP_FORMAT") for t in texts]


def test_conversion_and_wide_decimals(spark):
    c = ColumnContract("v", "decimal", precision=6, scale=2)
    df = spark.createDataFrame([("123456",), ("12345.6",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(typed.converted(F.col("v"), c)).collect()] == [Decimal("123456.00"), Decimal("12345.60"), None, None]


def test_unknown_directive():
    with pytest.raises(ValueError):
        typed.time_format("%Y %q")
