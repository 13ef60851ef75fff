"""WARC: archives of gzip members, one for each record, and a reader that splits them anywhere.

Writing: each task writes one archive. Payload digests are SHA-1 in base 32. Among records of equal payload the one with the largest key is a
``response``; the others are ``revisit`` records that refer to it and carry the HTTP header alone. Only digests that occur twice or more travel: a
narrow aggregate finds them, and they are joined to the records where those lie if they are few.

Reading: archives are cut into byte ranges. The task of a range scans it for gzip magic, takes a candidate for a record if it
decompresses to a WARC header, and owns the records that start inside the range, reading on past its end for the last one. Between records no scan is needed: the next member
starts where the last ended.

A payload that itself holds an uncompressed stretch of another archive could yield a candidate inside a record; text payloads can't.

Defined results: a null payload is the empty one; a null key gives a record whose key reads back as null, and never becomes what others refer to unless all keys are
null; rows that share the largest key and the payload are all responses; a null URL gives a record without target URI; an empty table gives no
archive and no record; only the named columns are read; a record's payload is held whole in memory, an archive never.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwright.llm.common import materialize, new_shared_path, ship
from siftwright.llm.files import opened, own_name, writing

MAGIC = b"\x1f\x8b\x08"
_URN = "urn:record-key:"
_READ = 1 << 20
_SAFE = "".join(map(chr, range(0x21, 0x7F)))


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class Record:
    key: str | None
    kind: str
    uri: str | None
    payload_bytes: int
    digest: str
    refers_to: str | None
    payload: bytes | None


def member(r: Record, date: str, level: int = 6) -> bytes:
    """The record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r.payload_bytes}\r\n\r\n".encode()
    block = http + (r.payload or b"") if r.kind == "response" else http
    lines = ["WARC/1.1", f"WARC-Type: {r.kind}", f"WARC-Record-ID: <{_URN}{quote(r.key or '', safe='')}>", f"WARC-Date: {date}"]
    if r.uri is not None:
        lines.append(f"WARC-Target-URI: {quote(r.uri, safe=_SAFE)}")
    lines.append(f"WARC-Payload-Digest: sha1:{r.digest}")
    if r.kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_URN}{quote(r.refers_to or '', safe='')}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(level, wbits=31)
    return pack.compress("\r\n".join(lines).encode()) + pack.compress(block + b"\r\n\r\n") + pack.flush()


def parsed(raw: bytes) -> Record:
    from urllib.parse import unquote

    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[: int(fields["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    size = int(m[1]) if (m := re.search(rb"(?im)^content-length:\s*(\d+)", http)) else len(body)
    key = lambda x: unquote(x.removeprefix(f"<{_URN}").removesuffix(">")) or None
    response = kind == "response"
    return Record(key(fields["warc-record-id"]), kind, fields.get("warc-target-uri"), len(body) if response else size, digest32(body) if response else fields.get("warc-payload-digest", "").removeprefix("sha1:"), key(fields["warc-refers-to"]) if "warc-refers-to" in fields else None, body if response else None)


def member_at(f, at: int) -> tuple[bytes, int] | None:
    """What the gzip member at this place holds, if it is a WARC record, and where it ends. None if it isn't one or is cut off."""
    unpack = zlib.decompressobj(31)
    out = b""
    size, place = 1 << 14, at
    parts = []
    try:
        while not unpack.eof:
            f.seek(place)
            raw = f.read(size)
            if not raw:
                return None
            place += len(raw)
            parts.append(unpack.decompress(raw))
            if len(parts) == 1 or len(out) < 5:
                out += parts[-1]
                if len(out) >= 5 and not out.startswith(b"WARC/"):
                    return None
            size = _READ
    except zlib.error:
        return None
    whole = b"".join(parts)
    return (whole, place - len(unpack.unused_data)) if whole.startswith(b"WARC/") else None


def records_in(f, begin: int, end: int) -> Iterator[Record]:
    """The records that start in the range of an open archive."""
    at = begin
    while at < end:
        found = member_at(f, at)
        if found:
            yield parsed(found[0])
            at = found[1]
            continue
        # no record here: look for the next candidate
        at += 1
        while at < end:
            f.seek(at)
            near = f.read(min(_READ, end - at) + len(MAGIC) - 1)
            if len(near) < len(MAGIC):
                return
            spot = near.find(MAGIC)
            if spot >= 0 and at + spot < end:
                at += spot
                break
            at += max(1, len(near) - len(MAGIC) + 1)


def write(df: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives below ``folder`` (a new one in the shared folder if None). Returns their table: ``path, size, records``. Payloads of
    ``min_bytes`` or more are deduplicated."""
    spark = df.sparkSession
    ship(spark)
    folder = folder or new_shared_path(spark, "warc")
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("digest", F.when(F.octet_length("payload") >= min_bytes, F.sha1("payload")))
    twice = rows.filter("digest is not null").groupBy("digest").agg(F.max("id").alias("last"), F.count("*").alias("n")).filter("n > 1").select("digest", "last")
    marked = rows.join(materialize(twice, "warc-twice"), "digest", "left").select(F.col("id").cast("string").alias("key"), "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("last")), F.col("last").cast("string")).alias("refers_to"))

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = own_name(folder, f"part-{TaskContext.get().partitionId():05d}", ".warc.gz")
        n = size = 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        with writing(path) as out:
            for batch in _chain(first, batches):
                for key, url, body, refers_to in zip(*(batch.column(k) for k in range(4))):
                    body = body.as_py()
                    refers_to = refers_to.as_py()
                    raw = member(Record(key.as_py(), "revisit" if refers_to is not None else "response", url.as_py(), len(body), digest32(body), refers_to, body), date)
                    out.write(raw)
                    size += len(raw)
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], ["path", "size", "records"])

    return materialize(marked.mapInArrow(f, "path string, size long, records long"), "warc-archives")


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def read(spark: SparkSession, archives: DataFrame, split_bytes: int = 4 << 20, payloads: bool = False) -> DataFrame:
    """The response and revisit records of archives (``path, size``): ``key, url, record_type, payload_bytes, payload_digest, refers_to`` and, if
    asked for, ``payload``. The digest of a response is that of the payload read, that of a revisit the one it names."""
    ship(spark)
    begins = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)).cast("long"), F.lit(split_bytes).cast("long"))
    splits = archives.select("path", F.explode(begins).alias("begin"))
    splits = splits.repartition(min(10_000, max(1, splits.count())), "path", "begin")  # a number, as these small rows stand for large reads
    schema = "key string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string" + (", payload binary" if payloads else "")

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[Record]) -> pa.RecordBatch:
            cols = [pa.array([getattr(r, n) for r in rows], t) for n, t in (("key", pa.string()), ("uri", pa.string()), ("kind", pa.string()), ("payload_bytes", pa.int64()), ("digest", pa.string()), ("refers_to", pa.string()))]
            if payloads:
                cols.append(pa.array([r.payload for r in rows], pa.binary()))
            return pa.RecordBatch.from_arrays(cols, ["key", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"][: len(cols)])

        for batch in batches:
            for path, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(path) as file:
                    rows: list[Record] = []
                    held = 0
                    for r in records_in(file, begin, begin + split_bytes):
                        if r.kind in ("response", "revisit"):
                            rows.append(r)
                            if payloads:
                                held += r.payload_bytes
                            else:
                                r.payload = None
                        if len(rows) >= 5000 or held > 16 << 20:
                            yield out(rows)
                            rows, held = [], 0
                    if rows:
                        yield out(rows)

    return splits.mapInArrow(f, schema)
