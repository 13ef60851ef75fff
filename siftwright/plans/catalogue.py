"""Queries over the test tables, one for each operator, and the same in SQL.

Each query runs the operator's own code; its SQL says independently what must come out.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwright.contract import ColumnContract, DatasetContract, Dialect
from siftwright.functions import typed
from siftwright.operators import classify, constraints, generate, infer, reports, retention
from siftwright.sources import checked_csv, filename
from siftwright.shared import new_path
from siftwright.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Reports

_FACTS_SQL = "SELECT n_name AS region, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


def _report_sql(facts: str) -> str:
    return f"""
        SELECT region, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, count(*) AS n_orders, CAST(sum(cents) AS BIGINT) AS total_cents,
               CAST((2 * sum(cents) + count(cents)) // (2 * count(cents)) AS BIGINT) AS mean_cents
        FROM ({facts}) GROUP BY 1, 2"""


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", reports.cents(F.col("o_totalprice")).alias("cents"))
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))


@_query(_report_sql(_FACTS_SQL) + " ORDER BY region NULLS LAST, order_month NULLS LAST LIMIT 10")
def report_region_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten rows of the report, in its order."""
    return reports.in_report_order(reports.by_region_and_month(_facts(spark, sf_dir), "region", "o_orderdate", "cents")).limit(10)


@_query(_report_sql(_FACTS_SQL))
def report_region_month_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.by_region_and_month(_facts(spark, sf_dir), "region", "o_orderdate", "cents")


@_query(_report_sql(f"SELECT region, CASE WHEN cents % 7 <> 0 THEN o_orderdate END AS o_orderdate, CASE WHEN cents % 5 <> 0 THEN cents END AS cents FROM ({_FACTS_SQL})"))
def report_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months and amounts that are missing: a month of its own, and rows that count without an amount."""
    facts = _facts(spark, sf_dir).withColumns({"o_orderdate": F.when(F.col("cents") % 7 != 0, F.col("o_orderdate")), "cents": F.when(F.col("cents") % 5 != 0, F.col("cents"))})
    return reports.in_report_order(reports.by_region_and_month(facts, "region", "o_orderdate", "cents"))


@_query("SELECT event_type, event_id, ts FROM events e WHERE ts = (SELECT max(ts) FROM events x WHERE x.event_type = e.event_type)")
def latest_per_group_correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = reports.latest_all_ties(_table(spark, sf_dir, "events").select("event_type", "event_id", "ts"), "event_type", "ts").select("event_type", "event_id", "ts")
    return latest.orderBy("event_type", "event_id")


@_query("SELECT event_id, event_type, ts FROM events WHERE event_type = 'click' ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = _table(spark, sf_dir, "events").filter("event_type = 'click'").select("event_id", "event_type", "ts")
    return reports.latest_one(clicks, "ts", "event_id")


@_query("SELECT count(DISTINCT event_type) AS n_types FROM events WHERE event_type IN ('click', 'view', 'error') AND CAST(ts AS DATE) = DATE '2024-01-02'")
def readiness_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    kind = events.schema["ts"].dataType  # a half-open range of the column itself reaches the scan
    day = events.filter(F.col("event_type").isin("click", "view", "error") & (F.col("ts") >= F.lit("2024-01-02").cast(kind)) & (F.col("ts") < F.lit("2024-01-03").cast(kind)))
    return day.agg(F.count_distinct("event_type").alias("n_types"))


@_query("SELECT bucket, event_id, rn FROM (SELECT time_bucket(INTERVAL 5 minutes, ts) AS bucket, event_id, row_number() OVER (PARTITION BY time_bucket(INTERVAL 5 minutes, ts) ORDER BY event_id) AS rn FROM events) WHERE rn <= 3")
def top3_per_5min_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").select(reports.bucket(F.col("ts")).alias("bucket"), "event_id")
    return reports.first_of_group(rows, 3, "bucket", "event_id").withColumn("rn", F.col("rn").cast("long")).orderBy("bucket", "rn")


@_query("SELECT strftime(time_bucket(INTERVAL 5 minutes, ts), '%Y-%m-%d %H:%M') AS label, minute(time_bucket(INTERVAL 5 minutes, ts)) AS at_minute, count(*) AS n_rows FROM events GROUP BY 1, 2")
def bucket_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = ingest.bucket_counts(_table(spark, sf_dir, "events"), "ts")
    return counted.select(F.date_format("bucket", "yyyy-MM-dd HH:mm").alias("label"), F.minute("bucket").cast("long").alias("at_minute"), "n_rows")


_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@_query(" UNION ALL ".join(f"SELECT '{t}' AS label, count(*) AS n_rows FROM {t}" for t in _COUNTED))
def table_counts_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.labelled_counts({t: _table(spark, sf_dir, t) for t in _COUNTED})


# Constraints


@_query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 10 <> 0)")
def fk_orphans_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = _table(spark, sf_dir, "customer").filter("c_custkey % 10 <> 0")
    return constraints.orphans(_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", parents, "c_custkey").select("o_orderkey", "o_custkey")


@_query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.duplicate_keys(_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@_query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def pk_already_there(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return constraints.already_there(_table(spark, sf_dir, "orders").select("o_orderkey"), items, "o_orderkey")


@_query("SELECT p_partkey, p_name FROM part WHERE strlen(p_name) > 9")
def width_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.too_wide(_table(spark, sf_dir, "part").select("p_partkey", "p_name"), {"p_name": 9})


@_query("SELECT doc_id, sha256(coalesce(text, '')) AS checksum FROM documents WHERE sha256(coalesce(text, '')) NOT IN (SELECT sha256(coalesce(text, '')) FROM documents WHERE doc_id % 3 = 0)")
def idempotency_pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: those whose content the ledger, every third of them, hasn't seen."""
    files = _table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("checksum"))
    return constraints.pending(files, files.filter("doc_id % 3 = 0"), "checksum").select("doc_id", "checksum")


@_query("SELECT c_custkey, sha256(concat_ws('|', c_custkey, c_name, c_mktsegment)) AS checksum FROM customer")
def row_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select("c_custkey", F.sha2(F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment"), 256).alias("checksum"))


# Validation: orders as text records, some of them broken in ways that their key gives

ORDERS = DatasetContract(
    "orders",
    "orders_*.csv*",
    (
        ColumnContract("order_id", nullable=False),
        ColumnContract("customer_id", nullable=False),
        ColumnContract("order_date", "date", format="%Y-%m-%d"),
        ColumnContract("amount", "decimal", precision=9, scale=2),
    ),
)


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    cents = reports.cents(F.col("o_totalprice"))
    amount = (
        F.when(k % 19 == 4, "12.345").when(k % 23 == 6, "abc").when(k % 29 == 7, " 1_000.5 ").when(k % 31 == 8, "1e3").when(k % 47 == 12, "1234567890").when(k % 53 == 13, "")
        .otherwise(F.concat(F.call_function("div", cents, F.lit(100)).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")))
    )
    day = F.when(k % 7 == 1, "").when(k % 13 == 2, "31/02/2026").when(k % 17 == 5, F.date_format("o_orderdate", "yyyy-M-d")).when(k % 59 == 14, "2026-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    fields = F.array(k.cast("string"), F.when(k % 11 == 3, "").otherwise(F.col("o_custkey").cast("string")), day, amount)
    fields = F.when(k % 37 == 9, F.slice(fields, 1, 3)).when(k % 41 == 10, F.concat(fields, F.array(F.lit("surplus")))).when(k % 43 == 11, F.array().cast("array<string>")).otherwise(fields)
    made = F.struct(F.lit("orders_20260101.csv").alias("source_file"), k.alias("row_number"), fields.alias("fields"))
    rows = _table(spark, sf_dir, "orders").select(F.inline(F.array(made)))  # as from a scan: filters above don't repeat what makes the fields
    return rows.withColumn("raw_line", F.concat(F.array_join("fields", ","), F.lit("\n")))


_RECORDS_SQL = """
    raw AS (
        SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS f1, CASE WHEN o_orderkey % 11 = 3 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS f2,
               CASE WHEN o_orderkey % 7 = 1 THEN '' WHEN o_orderkey % 13 = 2 THEN '31/02/2026' WHEN o_orderkey % 17 = 5 THEN strftime(o_orderdate, '%Y-%-m-%-d')
                    WHEN o_orderkey % 59 = 14 THEN '2026-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS f3,
               CASE WHEN o_orderkey % 19 = 4 THEN '12.345' WHEN o_orderkey % 23 = 6 THEN 'abc' WHEN o_orderkey % 29 = 7 THEN ' 1_000.5 ' WHEN o_orderkey % 31 = 8 THEN '1e3'
                    WHEN o_orderkey % 47 = 12 THEN '1234567890' WHEN o_orderkey % 53 = 13 THEN ''
                    ELSE (CAST(round(o_totalprice * 100) AS BIGINT) // 100) || '.' || lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') END AS f4,
               CASE WHEN o_orderkey % 37 = 9 THEN 3 WHEN o_orderkey % 41 = 10 THEN 5 WHEN o_orderkey % 43 = 11 THEN 0 ELSE 4 END AS width
        FROM orders),
    marked AS (
        SELECT *,
               CASE WHEN width <> 4 THEN 'WRONG_COLUMN_COUNT' WHEN f2 = '' THEN 'NULL_VIOLATION'
                    WHEN f3 IN ('31/02/2026', '2026-02-30') THEN 'INVALID_DATE_FORMAT'
                    WHEN f4 = 'abc' THEN 'TYPE_MISMATCH'
                    WHEN f4 IN ('12.345', '1234567890') THEN 'DECIMAL_PRECISION_EXCEEDED' END AS error_code
        FROM raw),
    messages AS (
        SELECT *,
               CASE error_code WHEN 'WRONG_COLUMN_COUNT' THEN 'expected 4 fields, got ' || width WHEN 'NULL_VIOLATION' THEN '''customer_id'' is required but empty'
                    WHEN 'INVALID_DATE_FORMAT' THEN '''order_date'' failed type check: INVALID_DATE_FORMAT'
                    WHEN 'TYPE_MISMATCH' THEN '''amount'' failed type check: TYPE_MISMATCH'
                    WHEN 'DECIMAL_PRECISION_EXCEEDED' THEN '''amount'' failed type check: DECIMAL_PRECISION_EXCEEDED' END AS error_message
        FROM marked)"""
_VALID_SQL = """
    SELECT f1 AS order_id, f2 AS customer_id, CAST(try_strptime(nullif(f3, ''), '%Y-%m-%d') AS DATE) AS order_date,
           CAST(round(100 * CAST(nullif(replace(trim(f4), '_', ''), '') AS DOUBLE)) AS BIGINT) AS amount_cents
    FROM messages WHERE error_code IS NULL"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(order_records(spark, sf_dir), ORDERS, ORDERS.names)


@_query(f"WITH {_RECORDS_SQL} SELECT k AS row_number, error_code, error_message, CASE WHEN width >= 1 THEN f1 END AS order_id, CASE WHEN width >= 4 THEN f4 END AS amount FROM messages WHERE error_code = 'WRONG_COLUMN_COUNT'")
def validate_structural(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a wrong width: missing trailing fields are null, surplus ones are dropped."""
    bad = classify.invalid_rows(_classified(spark, sf_dir), ORDERS, ORDERS.names)
    return bad.filter("error_code = 'WRONG_COLUMN_COUNT'").select("row_number", "error_code", "error_message", "order_id", "amount")


@_query(f"WITH {_RECORDS_SQL} SELECT k AS row_number, error_code, error_message FROM messages")
def validate_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's verdict: width before emptiness before type."""
    return _classified(spark, sf_dir).select("row_number", "error_code", "error_message")


@_query(f"WITH {_RECORDS_SQL} {_VALID_SQL}")
def split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify.valid_rows(_classified(spark, sf_dir), ORDERS, ORDERS.names)
    return rows.select("order_id", "customer_id", "order_date", (F.col("amount") * 100).cast("long").alias("amount_cents"))


@_query(f"WITH {_RECORDS_SQL} SELECT CASE WHEN width >= 1 THEN f1 END AS order_id, CASE WHEN width >= 2 THEN f2 END AS customer_id, CASE WHEN width >= 3 THEN f3 END AS order_date, CASE WHEN width >= 4 THEN f4 END AS amount, error_code, error_message, 'orders_20260101.csv' AS source_file, k AS row_number, CASE width WHEN 0 THEN '' WHEN 3 THEN f1 || ',' || f2 || ',' || f3 WHEN 4 THEN f1 || ',' || f2 || ',' || f3 || ',' || f4 ELSE f1 || ',' || f2 || ',' || f3 || ',' || f4 || ',surplus' END || chr(10) AS raw_line FROM messages WHERE error_code IS NOT NULL")
def split_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.invalid_rows(_classified(spark, sf_dir), ORDERS, ORDERS.names)


@_query(f"WITH {_RECORDS_SQL} SELECT error_code, count(*) AS n_rows FROM messages WHERE error_code IS NOT NULL GROUP BY 1")
def error_code_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.error_counts(_classified(spark, sf_dir))


@_query(f"WITH {_RECORDS_SQL} SELECT count(*) AS total_rows, count(*) FILTER (error_code IS NULL) AS valid_rows, count(error_code) AS invalid_rows, CASE WHEN count(error_code) = 0 THEN 'SUCCESS' ELSE 'SUCCESS_WITH_INVALID_ROWS' END AS status FROM messages")
def load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _classified(spark, sf_dir).agg(F.count("*").alias("total_rows"), F.count_if(F.col("error_code").isNull()).alias("valid_rows"), F.count("error_code").alias("invalid_rows"))
    return n.withColumn("status", F.when(F.col("invalid_rows") == 0, "SUCCESS").otherwise("SUCCESS_WITH_INVALID_ROWS"))


# Texts with the code and the value (as text) that each type gives them.
_CASES: dict[str, tuple[ColumnContract, list[tuple[str, str | None, str | None]]]] = {
    "integer": (
        ColumnContract("v", "integer"),
        [("42", None, "42"), (" +7\t", None, "7"), ("1_000", None, "1000"), ("-0012", None, "-12"), ("1__0", "TYPE_MISMATCH", None), ("_1", "TYPE_MISMATCH", None), ("1.0", "TYPE_MISMATCH", None), ("abc", "TYPE_MISMATCH", None), ("12345678901234567890123", None, "12345678901234567890123"), ("- 1", "TYPE_MISMATCH", None)],
    ),
    "decimal": (
        ColumnContract("v", "decimal", precision=6, scale=2),
        [("100.99", None, "100.99"), ("100.999", "DECIMAL_PRECISION_EXCEEDED", None), ("123456", None, "123456.00"), ("1234567", "DECIMAL_PRECISION_EXCEEDED", None), ("1e3", None, "1000.00"), ("1e99999999999", "DECIMAL_PRECISION_EXCEEDED", None), (".5", None, "0.50"), ("NaN", "TYPE_MISMATCH", None), ("Infinity", "TYPE_MISMATCH", None), ("1,5", "TYPE_MISMATCH", None), (" 7. ", None, "7.00"), ("-0.10", None, "-0.10")],
    ),
    "date": (
        ColumnContract("v", "date", format="%Y-%m-%d"),
        [("2026-01-05", None, "2026-01-05"), ("2026-1-5", None, "2026-01-05"), (" 2026-01-05", "INVALID_DATE_FORMAT", None), ("2026-02-29", "INVALID_DATE_FORMAT", None), ("2024-02-29", None, "2024-02-29"), ("31/02/2026", "INVALID_DATE_FORMAT", None), ("2026-01-05x", "INVALID_DATE_FORMAT", None), ("0000-01-01", "INVALID_DATE_FORMAT", None), ("26-01-05", "INVALID_DATE_FORMAT", None)],
    ),
    "timestamp": (
        ColumnContract("v", "timestamp", format="%Y-%m-%dT%H:%M:%S%z"),
        [("2026-01-05T10:20:30+0000", None, "2026-01-05 10:20:30"), ("2026-01-05T10:20:30Z", None, "2026-01-05 10:20:30"), ("2026-01-05T10:20:30+02:00", None, "2026-01-05 08:20:30"), ("2026-1-5T1:2:3-0130", None, "2026-01-05 02:32:03"), ("2026-01-05T10:20:30", "INVALID_TIMESTAMP_FORMAT", None), ("2026-01-05 10:20:30Z", "INVALID_TIMESTAMP_FORMAT", None), ("2026-01-05T24:00:00Z", "INVALID_TIMESTAMP_FORMAT", None), ("x", "INVALID_TIMESTAMP_FORMAT", None)],
    ),
    "boolean": (
        ColumnContract("v", "boolean"),
        [("true", None, "true"), (" FALSE ", None, "false"), ("1", None, "true"), ("0", None, "false"), ("yes", "TYPE_MISMATCH", None), ("t", "TYPE_MISMATCH", None), ("2", "TYPE_MISMATCH", None)],
    ),
}


def _literal(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


def _validate(kind: str) -> None:
    column, cases = _CASES[kind]
    n = len(cases)
    pick = lambda k: " ".join(f"WHEN c_custkey % {n} = {i} THEN {_literal(c[k])}" for i, c in enumerate(cases))

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = F.element_at(F.array(*(F.lit(c[0]) for c in cases)), (F.col("c_custkey") % n + 1).cast("int"))
        rows = _table(spark, sf_dir, "customer").select("c_custkey", texts.alias("v"))
        error = typed.error_of(F.col("v"), column)
        value = typed.converted(F.col("v"), column)
        value = F.date_format(value, "yyyy-MM-dd HH:mm:ss") if kind == "timestamp" else value.cast("string")
        return rows.select("c_custkey", "v", error.alias("error_code"), F.when(error.isNull(), value).alias("value"))

    query.__name__ = f"validate_{kind}"
    _query(f"SELECT c_custkey, CASE {pick(0)} END AS v, CASE {pick(1)} END AS error_code, CASE {pick(2)} END AS value FROM customer")(query)


for _kind in _CASES:
    _validate(_kind)


# Schema inference, file names, generation


@_query("SELECT * FROM (VALUES ('c_custkey', 'integer', NULL), ('c_name', 'string', NULL), ('balance', 'decimal', NULL), ('padded', 'string', 'leading-zero'), ('science', 'string', 'scientific-notation'), ('mixed', 'string', 'mixed-parseable'), ('answer', 'boolean', NULL), ('day', 'date', NULL), ('nothing', 'string', 'empty-sample')) AS t(column_name, inferred, flag)")
def infer_schema_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    columns = {
        "c_custkey": k.cast("string"),
        "c_name": F.col("c_name"),
        "balance": F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
        "padded": F.format_string("%08d", k),
        "science": F.when(k % 50 == 0, "1e5").otherwise(k.cast("string")),
        "mixed": F.when(k % 2 == 0, "12.5").otherwise("n/a"),
        "answer": F.when(k % 2 == 0, "yes").otherwise("0"),
        "day": F.date_format(F.date_add(F.lit(date(2024, 1, 1)), (k % 300).cast("int")), "yyyy-MM-dd"),
        "nothing": F.lit(None).cast("string"),
    }
    rows = _table(spark, sf_dir, "customer").select(*(c.alias(n) for n, c in columns.items()))
    return infer.as_table(rows, list(columns), ("%Y-%m-%d",))


_MASK = "{dataset}_{country}_{day:%Y%m%d}[_{part:03d}].csv"
_NAMES_SQL = "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'orders.csv' WHEN o_orderkey % 2 = 0 THEN 'orders_BR_' || strftime(o_orderdate, '%Y%m%d') || '.csv' ELSE 'orders_BR_' || strftime(o_orderdate, '%Y%m%d') || '_' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || '.csv' END AS file_name, o_orderdate FROM orders"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyyMMdd")
    name = F.when(k % 9 == 0, "orders.csv").when(k % 2 == 0, F.concat(F.lit("orders_BR_"), day, F.lit(".csv"))).otherwise(F.concat(F.lit("orders_BR_"), day, F.lit("_"), F.format_string("%03d", k % 1000), F.lit(".csv")))
    return _table(spark, sf_dir, "orders").select("o_orderkey", name.alias("file_name"))


@_query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN 'orders' END AS dataset, CASE WHEN o_orderkey % 9 <> 0 THEN 'BR' END AS country, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, CASE WHEN o_orderkey % 9 <> 0 AND o_orderkey % 2 <> 0 THEN o_orderkey % 1000 END AS part FROM ({_NAMES_SQL})")
def filename_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    facets = filename.compile_mask(_MASK).columns(F.col("file_name"))
    return _names(spark, sf_dir).select("o_orderkey", *(c.alias(n) for n, c in facets.items()))


@_query(f"SELECT max(file_name) AS file_name FROM ({_NAMES_SQL}) WHERE file_name LIKE 'orders\\_%' ESCAPE '\\'")
def latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).filter(F.col("file_name").startswith("orders_")).agg(F.max("file_name").alias("file_name"))


@_query("SELECT o_orderkey, 'orders_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS file_name, CAST(o_orderdate AS DATE) AS file_day FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'")
def retention_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv")).alias("file_name"))
    return retention.candidates(files, "file_name", "orders", date(1996, 1, 1))


@_query("SELECT len(string_split(coalesce(text, ''), ' ')) AS value, count(*) AS n_rows FROM documents GROUP BY 1 ORDER BY n_rows DESC, min(doc_id) LIMIT 1")
def modal_field_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = F.size(F.split(F.coalesce("text", F.lit("")), " ")).cast("long")
    return reports.modal_value(_table(spark, sf_dir, "documents"), width, "doc_id")


@_query("SELECT c_custkey, 'CUS-' || substr(sha256('42'), 1, 8) || '-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS structured_id FROM customer")
def structured_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select("c_custkey", generate.structured_id("CUS", 42, F.col("c_custkey")).alias("structured_id"))


@_query("SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M') AS BIGINT) AS seed FROM events")
def seed_from_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", generate.seed_of(F.col("ts")).alias("seed"))


@_query("""
    WITH ranked AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS r FROM customer),
    bounds AS (SELECT c_name, sum(1.0::DOUBLE / r) OVER (ORDER BY r) AS hi FROM ranked),
    draws AS (SELECT o_orderkey, ('0x' || substr(md5('7|drawn|' || o_orderkey), 1, 10))::BIGINT / 1099511627776.0::DOUBLE * (SELECT max(hi) FROM bounds) AS target FROM orders)
    SELECT o_orderkey, c_name AS drawn FROM draws ASOF JOIN bounds ON target < hi""")
def zipf_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer for each order, drawn by rank; tests hold the frequencies against 1/rank."""
    pool = _table(spark, sf_dir, "customer").select("c_name")
    return generate.zipf(_table(spark, sf_dir, "orders").select("o_orderkey"), pool, "o_orderkey", 7, "drawn")


def _drawn_sql(part: str, digits: int = 15) -> str:
    return f"('0x' || substr(md5('42|{part}|' || n), 1, {digits}))::BIGINT"


@_query(f"""
    WITH numbers AS (SELECT row_number() OVER () AS n FROM orders),
    made AS (
        SELECT n, 'ORD-' || substr(sha256('42'), 1, 8) || '-' || lpad(CAST(n AS VARCHAR), 6, '0') AS id,
               strftime(make_timestamp((1577836800 + {_drawn_sql("order_date")} % 189216000) * 1000000), '%Y-%m-%d') AS day,
               {_drawn_sql("amount")} % 1000000000 AS units,
               CASE WHEN {_drawn_sql("broken", 10)} / 1099511627776.0::DOUBLE < 0.1 THEN (['short', 'empty', 'type', 'long'])[{_drawn_sql("how")} % 4 + 1] END AS broken
        FROM numbers),
    texts AS (SELECT *, (units // 100) || '.' || lpad(CAST(units % 100 AS VARCHAR), 2, '0') AS amount FROM made)
    SELECT n AS row_number, broken,
           CASE WHEN broken IN ('short', 'long') THEN 'WRONG_COLUMN_COUNT' WHEN broken = 'empty' THEN 'NULL_VIOLATION' WHEN broken = 'type' THEN 'INVALID_DATE_FORMAT' END AS error_code,
           CASE WHEN broken = 'short' THEN id || ',' || id || ',' || day WHEN broken = 'empty' THEN ',' || id || ',' || day || ',' || amount
                WHEN broken = 'type' THEN id || ',' || id || ',not-a-value,' || amount WHEN broken = 'long' THEN id || ',' || id || ',' || day || ',' || amount || ',surplus'
                ELSE id || ',' || id || ',' || day || ',' || amount END AS line
    FROM texts""")
def generated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic orders, a tenth of them broken, as the generator writes and the classifier sees them."""
    n = _table(spark, sf_dir, "orders").count()
    made = generate.rows(spark, ORDERS, n, 42, 0.1)
    lines = generate.csv_lines(made, ORDERS).withColumnRenamed("number", "row_number")
    records = made.select(F.lit("made.csv").alias("source_file"), F.col("number").alias("row_number"), "fields", F.lit("").alias("raw_line"), "broken")
    return classify.classify(records, ORDERS, ORDERS.names).select("row_number", "broken", "error_code").join(lines, "row_number").withColumnRenamed("value", "line")


# The scan: files written by Spark's own sink, read through the checked source


def _bare(spark: SparkSession, folder: str) -> list[str]:
    """The files below a folder that Spark wrote, renamed so that no ending tells what they are; the folder of a partition gives its name."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    paths = []
    found = fs.listFiles(path(folder), True)
    while found.hasNext():
        status = found.next()
        file = status.getPath()
        if file.getName().startswith("part-") and status.getLen():
            parent = file.getParent().getName()
            name = parent.split("=")[1] if "=" in parent else file.getName().split(".")[0]
            fs.rename(file, path(f"{folder}/{name}"))
            paths.append(f"{folder}/{name}")
    return sorted(paths)


def _written(spark: SparkSession, rows: DataFrame, compression: str) -> list[str]:
    """CSV files of the rows in the folder that all machines share, without an ending that would tell their compression."""
    out = new_path(spark, "csv")
    rows.write.option("header", True).option("compression", compression).option("emptyValue", "").option("escape", '"').csv(out)
    return _bare(spark, out)


def _order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = reports.cents(F.col("o_totalprice"))
    amount = F.concat(F.call_function("div", cents, F.lit(100)).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    note = F.concat(F.lit('x, "'), F.col("o_orderpriority"), F.lit('"\nnext line'))
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"), note.alias("customer_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"), amount.alias("amount"))


_SCAN_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'x, "' || o_orderpriority || '"' || chr(10) || 'next line' AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
                      CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents FROM orders"""


def _scanned(spark: SparkSession, sf_dir: str, compression: str) -> DataFrame:
    records, header = checked_csv.scan(spark, _written(spark, _order_texts(spark, sf_dir), compression), ORDERS)
    rows = classify.valid_rows(classify.classify(records, ORDERS, header), ORDERS, header)
    return rows.select("order_id", "customer_id", "order_date", (F.col("amount") * 100).cast("long").alias("amount_cents"))


@_query(_SCAN_SQL)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scanned(spark, sf_dir, "none")


@_query(_SCAN_SQL)
def csv_gzip_magic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip files whose names don't say so."""
    return _scanned(spark, sf_dir, "gzip")


_YEARS_SQL = """
    WITH rows AS (
        SELECT year(o_orderdate) AS y, o_orderkey, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS place, strftime(o_orderdate, '%Y-%m-%d') AS day,
               (CAST(round(o_totalprice * 100) AS BIGINT) // 100) || '.' || lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS amount, o_custkey, o_orderkey % 5 = 0 AS cut
        FROM orders)
    SELECT 'orders_' || y AS source_file, place AS row_number, CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN cut THEN 'c' || chr(10) || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
           CASE WHEN cut THEN o_custkey || '",' || day || ',' || amount ELSE o_orderkey || ',' || o_custkey || ',' || day || ',' || amount END || chr(10) AS raw_line
    FROM rows"""


@_query(_YEARS_SQL)
def scan_preamble_repeated_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file a year, each with a title above the header, the header once more below the first row, and fields that hold a line feed: numbers of rows and their last lines."""
    k, year = F.col("o_orderkey"), F.year("o_orderdate")
    cents = reports.cents(F.col("o_totalprice"))
    amount = F.concat(F.call_function("div", cents, F.lit(100)).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    customer = F.when(k % 5 == 0, F.concat(F.lit('"c\n'), F.col("o_custkey"), F.lit('"'))).otherwise(F.col("o_custkey").cast("string"))
    header = ",".join(ORDERS.names)
    data = _table(spark, sf_dir, "orders").select(F.concat(F.lit("orders_"), year).alias("file"), k.cast("long").alias("at"), F.concat_ws(",", k, customer, F.date_format("o_orderdate", "yyyy-MM-dd"), amount).alias("value"))
    first = data.groupBy("file").agg(F.min("at").alias("least"))
    around = first.select("file", F.inline(F.array(*(F.struct(at.cast("double").alias("at"), F.lit(v).alias("value")) for at, v in ((F.lit(-2), "Orders of a year"), (F.lit(-1), header), (F.col("least") + 0.5, header))))))
    out = new_path(spark, "csv")
    data.withColumn("at", F.col("at").cast("double")).unionByName(around).repartition("file").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").text(out)
    records, _ = checked_csv.scan(spark, _bare(spark, out), ORDERS)
    return records.select("source_file", "row_number", F.get("fields", F.lit(0)).alias("order_id"), F.get("fields", F.lit(1)).alias("customer_id"), "raw_line")


_NATIONS = DatasetContract("nations", "nations*", (ColumnContract("n_nationkey", "integer", nullable=False), ColumnContract("n_name"), ColumnContract("n_regionkey", "integer")), csv=Dialect(delimiter=";", has_footer=True))


@_query("SELECT row_number() OVER (ORDER BY n_nationkey) AS row_number, CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def scan_mark_and_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that begins with a byte order mark, is cut by semicolons and ends in two lines that are no data."""
    rows = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("at"), F.concat_ws(";", "n_nationkey", "n_name", "n_regionkey").alias("value"))
    last = rows.agg(F.count("*").alias("n")).select(F.inline(F.array(F.struct(F.lit((1 << 62)).alias("at"), F.lit("checked by nobody").alias("value")), F.struct(F.lit((1 << 62) + 1).alias("at"), F.concat(F.lit("rows;"), "n").alias("value")))))
    head = spark.createDataFrame([(-1, "\ufeff" + ";".join(_NATIONS.names))], "at long, value string")
    out = new_path(spark, "csv")
    rows.unionByName(last).unionByName(head).repartition(1).sortWithinPartitions("at").select("value").write.text(out)  # one file, as its footer says
    records, header = checked_csv.scan(spark, _bare(spark, out), _NATIONS)
    good = classify.valid_rows(classify.classify(records, _NATIONS, header), _NATIONS, header, "row_number")
    return good.select("row_number", F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("long").alias("n_regionkey"))
