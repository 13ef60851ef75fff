"""Token-ID output: raw id files with a minimal perfect hash index.

Documents are dealt by ranges of their key, the more of them the larger the table, and sorted, and each task writes one shard: an ``.ids`` file that is nothing but little-endian ids (two
bytes wide where the vocabulary allows, else four), each document ended by the end id, and an ``.idx`` file. The index has a minimal perfect hash from
the shard's distinct keys to slots, and by slot a 16-bit fingerprint of the key and the run of documents that carry it, which are neighbours, and by document the
place of its first id. A lookup hashes the key, checks the fingerprint and reads the slice: constant time, whatever the number of keys.
The hash has levels of bits: a key rests in the first level where no other key falls on its bit, and its slot is the rank of that bit.

A shard counts once the table of shards, which Spark commits, names it. Shards follow each other in key order, so the sum of the
shards before gives each its place in the whole sequence.

Defined results: a null text is the empty one and yields the end id alone; rows that share a key are neighbours in order of their texts and share a slot; rows
with a null key come first and are read by position only, as the index does not hold them; a key that isn't there is told by its fingerprint but for one
in 65,536; an empty table gives no shard; only the named columns are read; texts are encoded whole, and a shard's ids are streamed.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwright.llm.bpe import encoder
from siftwright.llm.common import forget, materialize, new_shared_path, ship
from siftwright.llm.files import opened, own_name, read_all, writing

_MIX = np.uint64(0xFF51AFD7ED558CCD)
_SEED = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a level for each key that comes to it.
GAMMA = 2
LEVELS = 32
#: Of a table as the optimizer estimates it, which for files is their size, for one shard.
SHARD_BYTES = 512 << 20


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys ^ (_SEED * np.uint64(2 * seed + 1))
        x = (x ^ (x >> np.uint64(33))) * _MIX
        x = (x ^ (x >> np.uint64(29))) * _SEED
    return x ^ (x >> np.uint64(32))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 99) & np.uint64(0xFFFF)).astype(np.uint16)


@dataclass
class PerfectHash:
    """Distinct 64-bit keys to 0 .. n - 1."""

    sizes: np.ndarray  # bits by level
    words: np.ndarray  # the levels' bits, one after the other
    rank: np.ndarray  # bits set before each word
    rest: np.ndarray  # keys that no level took, sorted

    @staticmethod
    def build(keys: np.ndarray) -> "PerfectHash":
        left, sizes, levels = keys.astype(np.uint64), [], []
        while len(left) and len(sizes) < LEVELS:
            m = -(-len(left) * GAMMA // 64) * 64
            spot = (mixed(left, len(sizes)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(spot, minlength=m) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(m)
            left = left[~alone[spot]]
        words = np.concatenate([np.empty(0, np.uint64), *levels])
        return PerfectHash(np.array(sizes, np.int64), words, np.concatenate([[0], np.bitwise_count(words).cumsum(dtype=np.int64)]), np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of a key that was not there some slot or -1."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        base = 0
        for level, m in enumerate(self.sizes.tolist()):
            spot = (mixed(keys[todo], level) % np.uint64(m)).astype(np.int64) + base
            word, bit = self.words[spot >> 6], (spot & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = (self.rank[spot >> 6] + below)[hit]
            todo = todo[~hit]
            base += m
        if len(todo) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            there = self.rest[at] == keys[todo]
            out[todo[there]] = self.rank[-1] + at[there]
        return out


class Shard:
    """One shard's index, and its ids by key."""

    def __init__(self, path: str):
        with np.load(io.BytesIO(read_all(path + ".idx"))) as z:
            self.hash = PerfectHash(z["sizes"], z["words"], z["rank"], z["rest"])
            self.prints, self.first, self.count, self.starts, self.keys, self.n_null = z["prints"], z["first"], z["count"], z["starts"], z["keys"], int(z["n_null"])
            self.width = int(z["width"])
        self.path = path

    def rows(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key the first of its documents in this shard and their number, 0 where the key isn't there."""
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        keys = np.asarray(keys).astype(np.int64).view(np.uint64)
        slot = self.hash.slots(keys)
        there = (slot >= 0) & (self.prints[slot] == fingerprint(keys))
        return np.where(there, self.first[slot], 0), np.where(there, self.count[slot], 0)

    def ids(self, file, row: int) -> np.ndarray:
        begin, end = int(self.starts[row]), int(self.starts[row + 1])
        file.seek(begin * self.width)
        return np.frombuffer(file.read((end - begin) * self.width), f"<u{self.width}")

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of all documents with this key."""
        first, count = self.rows(np.array([key]))
        with opened(self.path + ".ids") as f:
            return [self.ids(f, r) for r in range(int(first[0]), int(first[0] + count[0]))]


def shard_count(rows: DataFrame) -> int | None:
    """Shards of ``SHARD_BYTES`` each by the optimizer's estimate of the table's size, so that a shard stays as large whatever the table; None if Spark's number of shuffle
    partitions is enough, which it may then coalesce. An estimate of over an exabyte is Spark's way to say that it doesn't know."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    n = -(-size // SHARD_BYTES)
    return n if size < 1 << 60 and n > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def write(df: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards below ``folder`` (a new one in the shared folder if None). Returns their table: ``shard, path, n_docs, n_tokens, low, high``, where ``shard``
    numbers them in key order and ``low`` and ``high`` are the least and greatest key."""
    spark = df.sparkSession
    ship(spark)
    folder = folder or new_shared_path(spark, "tokens")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    n = shard_count(rows)
    rows = (rows.repartitionByRange(n, "id") if n else rows.repartitionByRange("id")).sortWithinPartitions("id", "text")

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary, False)
        width = 2 if max(e.size, end_id + 1) <= 1 << 16 else 4
        number = TaskContext.get().partitionId()
        path = own_name(folder, f"shard-{number:06d}", "")
        keys, lengths, n_null = [], [], 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        end = np.array([end_id], f"<u{width}").tobytes()

        def each() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        with writing(path + ".ids") as out:
            for batch in each():
                n_null += batch.column(0).null_count
                keys.append(batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
                for ids in e.encode(batch.column(1).to_pylist()):
                    out.write(ids.astype(f"<u{width}").tobytes() + end)
                    lengths.append(len(ids) + 1)
        forget()
        key = np.concatenate(keys)
        distinct, at, count = np.unique(key, return_index=True, return_counts=True)
        names = distinct.view(np.uint64)
        hash_ = PerfectHash.build(names)
        slot = hash_.slots(names)
        by_slot = lambda x, t: np.bincount(slot, weights=x, minlength=len(slot)).astype(t) if len(slot) else np.empty(0, t)
        starts = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))])
        raw = io.BytesIO()
        np.savez(raw, sizes=hash_.sizes, words=hash_.words, rank=hash_.rank, rest=hash_.rest, prints=by_slot(fingerprint(names), np.uint16), first=by_slot(at + n_null, np.int64), count=by_slot(count, np.int64), starts=starts, keys=key, n_null=n_null, width=width)
        with writing(path + ".idx") as out:
            out.write(raw.getvalue())
        span = (int(key[0]), int(key[-1])) if len(key) else (None, None)
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([path]), pa.array([len(lengths)], pa.int64()), pa.array([int(starts[-1])], pa.int64()), pa.array(span[:1], pa.int64()), pa.array(span[1:], pa.int64())], ["shard", "path", "n_docs", "n_tokens", "low", "high"])

    return materialize(rows.mapInArrow(f, "shard long, path string, n_docs long, n_tokens long, low long, high long"), "token-shards")


def placed(shards: DataFrame) -> DataFrame:
    """The shards with ``base``: the ids of all shards before. One row for each shard passes the driver."""
    rows, base = [], 0
    for r in shards.orderBy("shard").collect():
        rows.append((r.shard, r.path, r.n_docs, r.n_tokens, r.low, r.high, base))
        base += r.n_tokens
    return shards.sparkSession.createDataFrame(rows, "shard long, path string, n_docs long, n_tokens long, low long, high long, base long")


def read(spark: SparkSession, shards: DataFrame, ids: bool = False) -> DataFrame:
    """Every document of the files, found by its key: ``key, start, n_tokens, ids_crc32`` and, if asked for, ``ids``. ``start`` counts the ids of all documents before, the
    end id counts, and the CRC is that of all its ids as little-endian unsigned 32-bit integers."""
    ship(spark)
    names = ["key", "start", "n_tokens", "ids_crc32", "ids"][: 4 + ids]

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(path)
                first, count = shard.rows(shard.keys)
                if not count.all():
                    raise ValueError(f"the index of {path} misses keys of its own")
                again = np.concatenate([np.zeros(min(1, len(shard.keys)), np.int64), np.where(shard.keys[1:] == shard.keys[:-1], 1, 0)])  # further documents of a key
                run = np.arange(len(again)) - np.maximum.accumulate(np.where(again == 0, np.arange(len(again)), 0))
                rows = np.concatenate([np.arange(shard.n_null), first + run])
                keys = pa.array([None] * shard.n_null + shard.keys.tolist(), pa.int64())
                with opened(shard.path + ".ids") as file:
                    for k in range(0, len(rows), 2000):
                        part = rows[k : k + 2000]
                        found = [shard.ids(file, int(r)).astype("<u4") for r in part]
                        cols = [keys[k : k + 2000], pa.array(base + shard.starts[part]), pa.array([len(x) for x in found], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64())]
                        if ids:
                            cols.append(pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(cols, names)

    schema = "key long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    n = min(10_000, max(1, shards.count()))
    return placed(shards).select("path", "base").repartition(n, "path").mapInArrow(f, schema)
