"""The operators applied to the synthetic tables with their production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwright.llm import bpe, decontaminate, html_main_text, language_id, quality_model, quality_rules, simhash, token_files, url_filter, warc
from siftwright.llm.vocabularies import pieces, word_bpe


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules that results name, and globs that decide where none of those fits.
URL_RULES = [url_filter.Rule.host_path(rule, verdict) for rule, verdict in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))] + [
    url_filter.Rule(glob, glob, "block", shown=False) for glob in ("*casino**", "*-pills.**", "*/wp-admin/**", "*.zip", "*/*.exe")
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.group(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), word_bpe())


#: Ends each document of the token files.
END_ID = 1


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = token_files.write(_table(spark, sf_dir, "documents"), word_bpe(), END_ID)
    return token_files.read(spark, shards).withColumnRenamed("key", "doc_id")


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main_text.extract(_table(spark, sf_dir, "pages"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(_table(spark, sf_dir, "pages"))
    found = warc.read(spark, archives)
    return found.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def _remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(_remainder(3) != 1), pieces())
    return language_id.detect(docs, model).select("doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    weights = quality_model.fit(docs, _table(spark, sf_dir, "labels").filter(_remainder(4) != 2))
    scored = quality_model.score(docs, weights)
    return scored.select("doc_id", (_remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_simhash": op2_simhash,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_token_files": op4_token_files,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_main_text": op6_html_main_text,
    "op7_warc": op7_warc,
    "op8_language_id": op8_language_id,
    "op9_quality_model": op9_quality_model,
    "op10_decontaminate": op10_decontaminate,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": """
        WITH cut AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        named AS (
            SELECT *,
                   CASE WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                        WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                        WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM cut)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
                    WHEN rule IS NOT NULL THEN 'allow'
                    WHEN contains(host, 'casino') OR contains(host, '-pills.') OR contains(path, '/wp-admin/')
                         OR (path = '' AND ends_with(host, '.zip')) OR (path <> '' AND regexp_matches(path, '(?s)^/[^/]*[.]exe$')) THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM named
    """,
}
