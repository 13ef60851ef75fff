"""Row classification: every record gets an error code or none, in one projection over the scan.

Order of precedence: a wrong number of fields, then the first declared column that is empty and may not be, then the first one of a wrong type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwright.contract import SUFFIX, ColumnContract, DatasetContract
from siftwright.errors import NULL_VIOLATION, WRONG_COLUMN_COUNT
from siftwright.functions import typed


def _field(contract: DatasetContract, header: list[str], name: str, filled: bool) -> Column:
    """The raw text of a column. An optional column that the header lacks is empty, or null in rows of a wrong width."""
    if name in header:
        return F.get("fields", F.lit(header.index(name)))
    return F.lit("" if filled else None).cast("string")


def classify(records: DataFrame, contract: DatasetContract, header: list[str]) -> DataFrame:
    """``records`` (``source_file, row_number, fields, raw_line``) with ``error_code`` and ``error_message``, null for valid rows."""
    n = len(header)
    text = {c.name: _field(contract, header, c.name, True) for c in contract.columns}
    nulls = [F.when(text[c.name] == "", F.lit(c.name)) for c in contract.columns if not c.nullable]
    first_null = F.coalesce(*nulls) if nulls else F.lit(None).cast("string")
    error = lambda code, message: F.struct(F.lit(code).cast("string").alias("code") if isinstance(code, str) else code.alias("code"), message.alias("message"))

    def type_error(c: ColumnContract) -> Column:
        code = F.when(text[c.name] != "", typed.error_of(text[c.name], c))
        return typed.let(code, lambda e: F.when(e.isNotNull(), error(e, F.concat(F.lit(f"'{c.name}' failed type check: "), e))))

    wrong = [type_error(c) for c in contract.columns if c.type != "string"]
    null_error = typed.let(first_null, lambda name: F.when(name.isNotNull(), error(NULL_VIOLATION, F.concat(F.lit("'"), name, F.lit("' is required but empty")))))
    width = F.size("fields")
    width_error = error(WRONG_COLUMN_COUNT, F.concat(F.lit(f"expected {n} fields, got "), width.cast("string")))
    marked = records.withColumn("_error", F.when(width != n, width_error).otherwise(F.coalesce(null_error, *wrong)))
    return marked.withColumns({"error_code": F.col("_error.code"), "error_message": F.col("_error.message")}).drop("_error")


def valid_rows(classified: DataFrame, contract: DatasetContract, header: list[str], *extra: str) -> DataFrame:
    """The valid rows, typed, in the order of the contract."""
    columns = [typed.converted(_field(contract, header, c.name, True), c).alias(c.name) for c in contract.columns]
    return classified.filter(F.col("error_code").isNull()).select(*columns, *extra)


def invalid_rows(classified: DataFrame, contract: DatasetContract, header: list[str], *extra: str) -> DataFrame:
    """The invalid rows as they were read: missing trailing fields are null, empty ones stay empty."""
    wide = F.col("error_code") == WRONG_COLUMN_COUNT
    columns = [F.when(wide, _field(contract, header, n, False)).otherwise(_field(contract, header, n, True)).alias(n) for n in contract.names]
    return classified.filter(F.col("error_code").isNotNull()).select(*columns, *SUFFIX, *extra)


def error_counts(classified: DataFrame) -> DataFrame:
    """Invalid rows by error code."""
    return classified.filter(F.col("error_code").isNotNull()).groupBy("error_code").agg(F.count("*").alias("n_rows"))
