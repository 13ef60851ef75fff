"""Records wherever they start in a range."""

import io
import random

import pytest

from siftwright.llm import warc


def member(key, body, level=0):
    return warc.member(warc.Record(key, "response", None, len(body), warc.digest32(body), None, body), "2000-01-01T00:00:00Z", level=level)


@pytest.mark.parametrize("after", [1 << 20, (1 << 20) - 1, (1 << 20) + 1, 2 << 20, 3 << 20, (2 << 20) - 2])
def test_a_record_at_a_block_after_a_large_one(after):
    large = member("large", random.Random(3).randbytes((3 << 20) + 5000).replace(warc.MAGIC[:2], b"ab"))
    raw = large + member("small", b"text")
    begin = len(large) - after
    f = io.BytesIO(raw)
    assert [r.key for r in warc.records_in(f, 0, begin)] == ["large"]
    assert [r.key for r in warc.records_in(f, begin, len(raw))] == ["small"]


def test_the_query_itself(spark, tmp_path):
    import base64
    import hashlib

    from siftwright.llm import queries

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    more = spark.createDataFrame([(900_001, None, None), (900_002, "u", ""), (900_003, "u", "é" * 70_000)], "page_id long, url string, html string")
    pages.unionByName(pages.limit(15).selectExpr("page_id + 500000 AS page_id", "url", "html")).unionByName(more).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    payloads = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{tmp_path}/pages.parquet").collect()}
    last: dict[bytes, int] = {}
    for page_id, payload in payloads.items():
        last[payload] = max(page_id, last.get(payload, page_id))
    want = {(i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if last[p] == i else "revisit", None if last[p] == i else last[p]) for i, p in payloads.items()}
    got = queries.op7_warc(spark, str(tmp_path))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert {tuple(r) for r in got.collect()} == want and sum(w[3] == "revisit" for w in want) >= 16
