"""SimHash near-duplicates: 64-bit fingerprints, linked at a few differing bits, grouped into connected components.

Fingerprints of equal value become one node first, so groups of copies cost one node. Nodes are dealt to buckets in which every pair within the radius meets
(``layout``). A bucket is compared exactly, in tiles: its rows are sorted by population count, tiles are compared by exclusive-or and bit counts, and
tile pairs whose population counts differ by more than the radius are skipped, as they cannot link. Buckets have about ``BUCKET`` rows; one of more than ``TILE``
is dealt out: its rows are cut into tiles by population count and a salt, and each task gets one pair of tiles.

A task does not return all links but a forest of them that connects the same nodes, so a dense group of n nodes gives about n links.
Components then come from alternating large-star and small-star rounds, each cut off by a table in the shared folder. What a round joins are tables as they
are, so Spark can split the join of a node that most links touch.

``near_duplicates`` uses fingerprints for candidates only; what links two texts is the exact Jaccard overlap of their shingles. Candidates are all pairs
within a wide radius (``reach``) and all pairs of one group at a narrow one (``core``). A group is compared as a whole, and of pairs of different groups only
the texts that meet are sent, so a dense group of n texts gives about n rows, not n * n; large units are dealt out as tile pairs here too.

Defined results: null and empty texts have no shingle, fingerprint 0, and are linked like any other; a text of fewer words than a shingle
is one shingle; repeated rows and rows of equal id keep one result row each and share a component; a null id takes part, and a component's id is the
least id that is not null; an empty table gives an empty table; only the named columns are read. Of each group ``keep_one`` and ``keep_near`` keep one row: the
one with the least id, null last, and of rows that share it one with the least hash of its text; rows of another group that share the id are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwright.llm.common import Table, map_batches, materialize, ship, texts_of

#: Rows of a bucket, or fewer; more rows in all make more buckets.
BUCKET = 1024
#: Rows of a tile.
ROWS = 256
#: Rows of a bucket that one task compares at most; larger buckets are dealt out as tile pairs.
TILE = 32_768
#: Large buckets are found on the nodes whose hash is divisible by this; one that is missed is compared in one task.
_ONE_OF = 32
#: Low bits of a unit that hold its bucket's key.
_KEY_BITS = 27
#: Rows that are compared together, in whole units.
_TOGETHER = 60_000
#: Links that one task contracts at a time.
_CONTRACT = 1_000_000
#: Texts and their bytes that are compared in one unit at most; larger units are dealt out as tile pairs.
UNIT_TEXTS, UNIT_BYTES = 1024, 8 << 20
_BITS = np.array([[b >> k & 1 for k in range(8)] for b in range(256)], np.int64)


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """A bit is 1 where over half of the shingles' hashes have it, repeats included. Unsigned."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and the six ASCII spaces only
    if not w:
        return 0
    hash_ = xxhash.xxh64_intdigest
    if len(w) <= words:
        shingles = iter([b" ".join(w)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(w[k:] for k in range(words))))
        total = len(w) - words + 1
    hashes = np.fromiter((hash_(s, seed) for s in shingles), np.uint64, total).view(np.uint8).reshape(-1, 8)
    if total < 600:
        ones = np.unpackbits(hashes, axis=1, bitorder="little").sum(axis=0)
    else:
        ones = np.concatenate([np.bincount(hashes[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """``id, fp``: the fingerprint's bits as a signed long."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, words, seed) for t in texts_of(batch, "text")], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")), f, f"id {kind}, fp long")


def layout(n: int, radius: int) -> tuple[int, int, int]:
    """Stretches, the bits of each that make a bucket's key, and whether a row also goes to the keys one bit away (0 or 1). Two fingerprints within the radius
    differ by ``radius // stretches`` bits or fewer in some stretch: by none, so that they share its key, or by two at most, so that the two
    keys have a neighbour in common. The more rows, the more bits, which keeps a bucket near ``BUCKET`` rows; pairs that meet are the same at every size."""
    parts = radius + 1 if radius <= 3 else 4
    if radius // parts > 2:
        raise ValueError("a radius over 11 isn't supported")
    ball, bits = int(radius > 3), 0
    while bits < min(24, 64 // parts) and n * (1 + ball * bits) > BUCKET << bits:
        bits += 1
    return (parts if bits else 1), bits, ball


def _dealt(nodes: DataFrame, radius: int) -> tuple[DataFrame, tuple[int, int, int]]:
    """``unit`` and the columns of ``nodes`` (a table; distinct ``fp`` among them), sorted by unit and population count: a row for each bucket, and for each
    tile pair of a large one. The low ``_KEY_BITS`` bits of a unit are the bucket's key, which holds the stretch's number and its bits."""
    n = nodes.count()
    parts, bits, ball = how = layout(n, radius)
    own = nodes.columns
    value = lambda s: F.shiftrightunsigned("fp", 64 // parts * s).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    keys = F.array(*(value(s).bitwiseXOR(F.lit(flip).cast("long")) * parts + s for s in range(parts) for flip in (0, *(1 << k for k in range(bits * ball)))))
    rows = nodes.repartition(min(20_000, 1 + n // 50_000)).select(F.explode(keys).alias("key"), *own)  # a number, as a node makes many rows
    cool = rows.select(F.col("key").alias("unit"), *own)
    if n > TILE:  # else no bucket has more
        some = nodes.filter(F.pmod(F.xxhash64("fp"), F.lit(_ONE_OF)) == 0).select(F.explode(keys).alias("key"))
        hot = Table(some.groupBy("key").count().filter(F.col("count") * _ONE_OF > TILE).select("key"), "simhash-hot").df
        if not hot.isEmpty():  # tiles of a hot bucket: by population count, then by salt so that a tile has TILE / 2 rows or so
            zero = F.lit(0).cast("long")
            pop = F.bit_count("fp").cast("long")
            warm = rows.join(hot, "key", "left_semi").withColumn("pop", pop)
            salts = F.ceil(F.col("count") * 2 / TILE).cast("long")
            sizes = Table(warm.groupBy("key", "pop").count().select("key", "pop", salts.alias("salts")), "simhash-tiles").df
            tile = lambda p, s: F.col(p) * F.lit(1 << 40) + F.col(s)
            tiles = sizes.select("key", F.col("pop").alias("p2"), F.explode(F.sequence(zero, F.col("salts") - 1)).alias("s2"))
            others = Table(tiles.groupBy("key").agg(F.collect_list(tile("p2", "s2")).alias("others")), "simhash-tiles").df
            salted = warm.join(sizes, ["key", "pop"]).withColumn("s", F.pmod(F.xxhash64("fp"), F.col("salts"))).withColumn("own", tile("pop", "s"))
            near = F.filter("others", lambda o: F.abs(F.shiftright(o, 40) - F.col("pop")) <= radius)
            dealt = salted.join(others, "key").select("key", "own", *own, F.explode(near).alias("other"))
            pair = F.shiftleft(F.xxhash64(F.least("own", "other"), F.greatest("own", "other")).bitwiseOR(F.lit(1)), _KEY_BITS)
            cool = rows.join(hot, "key", "left_anti").select(F.col("key").alias("unit"), *own).unionByName(dealt.select(pair.bitwiseOR(F.col("key")).alias("unit"), *own))
    return cool.repartition("unit").sortWithinPartitions("unit", F.bit_count("fp")), how


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns, of longs, of whole units."""
    held: list[list[np.ndarray]] = []
    n = 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        n += batch.num_rows
        if n < _TOGETHER:
            continue
        cols = [np.concatenate(c) for c in zip(*held)]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))  # units are sorted
        if cut:
            yield [c[:cut] for c in cols]
        held, n = [[c[cut:] for c in cols]], n - cut
    if n:
        yield [np.concatenate(c) for c in zip(*held)]


@dataclass
class Tally:
    """Tile pairs that were compared, and those that were skipped as their population counts differ by more than the radius."""

    compared: int = 0
    skipped: int = 0


def tile_hits(unit: np.ndarray, fps: np.ndarray, radius: int, tally: Tally) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x, y), x < y, of the pairs of each unit within the radius, tile pair by tile pair. Rows are sorted by unit, then by population count. A unit of more
    than ``ROWS`` rows has tiles of its own; smaller ones share a tile."""
    edges = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1], [True]])).tolist()
    pops = np.bitwise_count(fps)

    def hits(lo: int, hi: int, lo2: int, hi2: int) -> tuple[np.ndarray, np.ndarray]:
        tally.compared += 1
        x, y = np.nonzero(np.bitwise_count(fps[lo:hi, None] ^ fps[None, lo2:hi2]) <= radius)
        x, y = x + lo, y + lo2
        keep = (x < y) & (unit[x] == unit[y])
        return x[keep], y[keep]

    begin = 0  # of the tile that small units share
    for lo, hi in zip(edges, [*edges[1:], edges[-1]]):
        if hi - begin > ROWS or lo == hi:
            if lo > begin:
                yield hits(begin, lo, begin, lo)
            begin = lo
        if hi - lo > ROWS:
            tiles = [(k, min(hi, k + ROWS)) for k in range(lo, hi, ROWS)]
            for k, (a, b) in enumerate(tiles):
                for m, (c, d) in enumerate(tiles[k:], k):
                    if int(pops[c]) - int(pops[b - 1]) > radius:
                        tally.skipped += len(tiles) - m
                        break
                    yield hits(a, b, c, d)
            begin = hi


class Forest:
    """Union-find over arrays. Roots are the least places."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.parent[x]
        while True:
            up = self.parent[r]
            if (up == r).all():
                self.parent[x] = r
                return r
            r = up

    def add(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the links joined two trees."""
        used = []
        at = np.arange(len(x))
        while len(at):
            a, b = self.roots(x[at]), self.roots(y[at])
            apart = a != b
            at, low, high = at[apart], np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            high, first = np.unique(high, return_index=True)
            self.parent[high] = low[first]
            used.append(at[first])
        return np.concatenate([np.empty(0, np.int64), *used])


def forest(unit: np.ndarray, fps: np.ndarray, radius: int, tally: Tally | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links within the radius that connect what all such links of a unit connect. Rows are sorted as for ``tile_hits``."""
    trees = Forest(len(fps))
    a, b = [np.empty(0, fps.dtype)], [np.empty(0, fps.dtype)]
    for x, y in tile_hits(unit, fps, radius, tally or Tally()):
        if len(x):
            used = trees.add(x, y)
            a.append(fps[x[used]])
            b.append(fps[y[used]])
    a, b = np.concatenate(a), np.concatenate(b)
    return a[a != b], b[a != b]


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    a, b = a.view(np.int64), b.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])


def links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """``a, b`` (a > b as signed longs): links that connect the distinct ``fp`` of ``nodes``, a table, as all links within the radius would."""
    ship(nodes.sparkSession)

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, fps in _by_unit(batches):
            yield _edges(*forest(unit, fps.view(np.uint64), radius))

    return _dealt(nodes.select("fp"), radius)[0].mapInArrow(f, "a long, b long").distinct()


def _first_meeting(fps: np.ndarray, other: np.ndarray, key: np.ndarray, how: tuple[int, int, int]) -> np.ndarray:
    """Whether this bucket is the first in which the pair meets: that of the first stretch in which they meet at all, and of the least common key there."""
    parts, bits, ball = how
    shifts = np.arange(parts, dtype=np.uint64) * np.uint64(64 // parts)
    mask = np.uint64((1 << bits) - 1)
    v, w = (fps[:, None] >> shifts) & mask, (other[:, None] >> shifts) & mask
    s = (np.bitwise_count(v ^ w) <= 2 * ball).argmax(axis=1)
    at = np.arange(len(fps))
    v, w = v[at, s], w[at, s]
    low = (v ^ w) & (~(v ^ w) + np.uint64(1))
    common = np.minimum(v ^ low, w ^ low) if ball else v
    return key.astype(np.uint64) == common * np.uint64(parts) + s.astype(np.uint64)


def pairs_across(nodes: DataFrame, radius: int) -> DataFrame:
    """``u, v, fp`` (u < v): for two groups that have a pair within the radius, the fingerprints of all such pairs. ``nodes``, a table, has distinct ``fp`` and
    ``core``, a group's name, or 0 for a fingerprint that is a group by itself."""
    ship(nodes.sparkSession)
    dealt, how = _dealt(nodes.select("fp", "core"), radius)

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, signed, core in _by_unit(batches):
            fps, key = signed.view(np.uint64), unit & ((1 << _KEY_BITS) - 1)
            name = np.where(core == 0, signed, core)
            for x, y in tile_hits(unit, fps, radius, Tally()):
                keep = ((core[x] != core[y]) | (core[x] == 0)) & (fps[x] != fps[y])
                x, y = x[keep], y[keep]
                if not len(x):
                    continue
                first = _first_meeting(fps[x], fps[y], key[x], how)
                x, y = x[first], y[first]
                u, v = np.minimum(name[x], name[y]), np.maximum(name[x], name[y])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in ((u, u), (v, v), (signed[x], signed[y]))], ["u", "v", "fp"])

    return dealt.mapInArrow(f, "u long, v long, fp long").distinct()


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct shingles' hashes, sorted. A text of fewer words, or none, is one shingle."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(w) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w))], np.uint64)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(w[k:] for k in range(words))))), np.uint64, len(w) - words + 1))


def overlap_forest(sets: list[np.ndarray], least: float) -> tuple[list[int], list[int]]:
    """Links that connect what all pairs whose Jaccard overlap is ``least`` or more connect."""
    sizes = np.array([len(s) for s in sets])
    words, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], sizes.cumsum()])
    mark = np.zeros(len(words), np.int32)
    left = np.ones(len(sets), bool)
    a: list[int] = []
    b: list[int] = []
    for seed in range(len(sets)):
        if not left[seed]:
            continue
        left[seed] = False
        queue = [seed]
        while queue and left.any():
            x = queue.pop()
            own = flat[starts[x] : starts[x + 1]]
            mark[own] = 1
            both = np.add.reduceat(mark[flat], starts[:-1])
            mark[own] = 0
            found = np.flatnonzero(left & (both >= least * (sizes + sizes[x] - both) - 1e-9))
            left[found] = False
            queue.extend(found.tolist())
            a.extend([x] * len(found))
            b.extend(found.tolist())
    return a, b


def overlaps(units: DataFrame, words: int, least: float) -> DataFrame:
    """``a, b`` (a > b): links of nodes that connect what all pairs of one unit at ``least`` or more connect. ``units``: ``u, v, lo, hi, node, text``."""
    ship(units.sparkSession)

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, nodes, sets = None, [], []

        def out() -> pa.RecordBatch:
            a, b = overlap_forest(sets, least) if len(sets) > 1 else ([], [])
            return _edges(np.array(nodes, np.int64)[np.array(a, np.int64)], np.array(nodes, np.int64)[np.array(b, np.int64)])

        for batch in batches:
            *names, members, texts = (batch.column(k) for k in range(6))
            for row, (name, node) in enumerate(zip(zip(*(c.to_pylist() for c in names)), members.to_pylist())):
                if name != unit:
                    if nodes:
                        yield out()
                    unit, nodes, sets = name, [], []
                nodes.append(node)
                sets.append(shingle_set(texts[row].as_py(), words))
        if nodes:
            yield out()

    dealt = units.select("u", "v", "lo", "hi", "node", "text").repartition("u", "v", "lo", "hi").sortWithinPartitions("u", "v", "lo", "hi")
    return dealt.mapInArrow(f, "a long, b long").distinct()


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that has a link, and the least node that these links lead to, but for those that are least themselves."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    trees = Forest(len(names))
    trees.add(at[: len(a)], at[len(a) :])
    roots = trees.roots(np.arange(len(names)))
    moved = roots != np.arange(len(names))
    return names[moved], names[roots[moved]]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that has a link: the least node of its component. Each task contracts its own links; then large-star and small-star alternate
    until nothing changes."""
    ship(edges.sparkSession)

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def out() -> pa.RecordBatch:
            a, b = contract(*(np.concatenate(c) for c in zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            n += batch.num_rows
            if n >= _CONTRACT:
                yield out()
                n = 0
        if held:
            yield out()

    table = Table(edges.mapInArrow(f, "a long, b long"), "simhash-links")
    before = None
    while True:
        e = table.df  # a > b
        both = e.union(e.select("b", "a").toDF("a", "b"))
        least = Table(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "simhash-least")
        large = Table(both.join(least.df, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct(), "simhash-large")
        least.drop()
        least = Table(large.df.groupBy("a").agg(F.min("b").alias("m")), "simhash-least")
        small = large.df.join(least.df, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.df.toDF("a", "b")).distinct()
        after = Table(small, "simhash-links")
        for t in (table, large, least):
            t.drop()
        table = after
        now = table.df.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or not now[0]:
            return table.df.union(table.df.select("b", "b").distinct().toDF("a", "b")).toDF("node", "root")
        before = now


def _told(df: DataFrame, id_col: str, text_col: str, words: int, seed: int) -> DataFrame:
    """``id, node, size, fp`` of each row; ``node`` is the text's hash and ``size`` its bytes."""
    text = F.coalesce(df[text_col], F.lit(""))
    told = df.select(F.struct(df[id_col].alias("id"), F.xxhash64(text).alias("node"), F.octet_length(text).cast("long").alias("size")).alias("row"), text.alias("text"))
    return materialize(fingerprints(told, "row", "text", words, seed).select("id.*", "fp"), "simhash-fingerprints")


def _led(found: DataFrame, member: DataFrame, name: str) -> DataFrame:
    """``found`` (``id, node`` and the column ``name``) with ``component_id`` and ``leads``. ``member`` has the root of every ``name`` that has a link."""
    order = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    own = materialize(found.groupBy(name).agg(F.min(order).alias("first")), "simhash-own")
    linked = materialize(own.join(member.withColumnRenamed("node", "__sw_node"), F.col(name) == F.col("__sw_node")).select(name, "first", "root"), "simhash-linked")
    first = materialize(linked.groupBy("root").agg(F.min("first").alias("lead")), "simhash-first")
    lead = linked.join(first, "root").select(F.col(name).alias("_name"), "lead")
    classes = materialize(own.join(lead, F.col(name) == F.col("_name"), "left").select(F.col(name).alias("_name"), F.coalesce("lead", "first").alias("lead")), "simhash-classes")
    leads = F.col("lead.id").eqNullSafe(F.col("id")) & (F.col("lead.node") == F.col("node"))
    return found.join(classes, F.col(name) == F.col("_name")).select(*found.columns, F.col("lead.id").alias("component_id"), leads.alias("leads"))


def _grouped(df: DataFrame, id_col: str, text_col: str, radius: int, words: int, seed: int) -> DataFrame:
    found = _told(df, id_col, text_col, words, seed).drop("size")
    nodes = materialize(found.select("fp").distinct(), "simhash-nodes")
    return _led(found, components(links(nodes, radius)), "fp")


def group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, words: int = 3, seed: int = 42) -> DataFrame:
    """``id_col, fp, component_id``: the least id of all rows reachable over links, the row itself included."""
    return _grouped(df, id_col, text_col, radius, words, seed).select(F.col("id").alias(id_col), "fp", "component_id")


def _near(df: DataFrame, id_col: str, text_col: str, words: int, core: int, reach: int, shingle: int, least: float, seed: int = 42) -> DataFrame:
    found = _told(df, id_col, text_col, words, seed)
    nodes = materialize(found.groupBy("node").agg(F.min("size").alias("size"), F.min("fp").alias("fp")), "near-nodes")
    fps = materialize(nodes.select("fp").distinct(), "near-distinct")
    cores = materialize(components(links(fps, core)), "near-cores").toDF("_fp", "root")
    cored = materialize(fps.join(cores, F.col("fp") == F.col("_fp"), "left").select("fp", F.coalesce("root", F.lit(0).cast("long")).alias("core")), "near-cored")
    across = pairs_across(cored, reach)
    grouped = materialize(nodes.join(cores, F.col("fp") == F.col("_fp"), "left").select(F.coalesce("root", "fp").alias("u"), "node", "size"), "near-grouped")
    several = materialize(grouped.groupBy("u").count().filter("count > 1").select("u"), "near-several")
    within = grouped.join(several, "u", "left_semi").select("u", F.col("u").alias("v"), "node", "size")
    members = materialize(within.unionByName(across.join(nodes, "fp").select("u", "v", "node", "size")), "near-members")

    # tiles of large units
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    size = members.groupBy("u", "v").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    salts = F.greatest(F.ceil(F.col("n") * 2 / UNIT_TEXTS), F.ceil(F.col("bytes") * 2 / UNIT_BYTES)).cast("long")
    large = materialize(size.filter((F.col("n") > UNIT_TEXTS) | (F.col("bytes") > UNIT_BYTES)).select("u", "v", salts.alias("salts")), "near-large")
    salted = members.join(large, ["u", "v"], "left").withColumn("salts", F.coalesce("salts", one)).withColumn("own", F.pmod(F.xxhash64("node"), F.col("salts")))
    tiled = salted.select("u", "v", "node", "own", F.explode(F.sequence(zero, F.col("salts") - 1)).alias("other"))
    units = tiled.select("u", "v", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node")
    wanted = materialize(members.select("node").distinct(), "near-wanted")
    text = F.coalesce(df[text_col], F.lit(""))
    texts = df.select(F.xxhash64(text).alias("node"), text.alias("text")).join(wanted, "node", "left_semi").dropDuplicates(["node"])
    member = components(overlaps(units.join(materialize(texts, "near-texts"), "node"), shingle, least))
    return _led(found.select("id", "node"), member, "node")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, core: int = 7, reach: int = 11, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """``id_col, component_id``: the least id of all rows reachable over links, which are pairs whose sets of ``shingle``-word shingles have a Jaccard overlap of
    ``least`` or more. Candidates are pairs of fingerprints (of ``words``-word shingles) within ``reach`` bits, and those of a group at ``core`` bits."""
    return _near(df, id_col, text_col, words, core, reach, shingle, least).select(F.col("id").alias(id_col), "component_id")


def keep_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, core: int = 7, reach: int = 11, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """As ``keep_one``, of the groups of ``near_duplicates``."""
    return _first_rows(df, _near(df, id_col, text_col, words, core, reach, shingle, least), id_col, text_col)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, words: int = 3, seed: int = 42) -> DataFrame:
    """One row of each group of ``group``, with all its columns: that with the least id."""
    return _first_rows(df, _grouped(df, id_col, text_col, radius, words, seed), id_col, text_col)


def _first_rows(df: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` that lead their group. Where ids don't repeat, the ids of those that go decide; else the id and the text's hash."""
    found = materialize(found.select("id", "node", "leads"), "simhash-leads")
    by_id = found.groupBy(F.col("id").alias("__sw_id")).agg(F.count("*").alias("_n"), F.count_if("leads").alias("_leads"))
    told = materialize(by_id.filter("_leads <> 1 or _n <> 1"), "simhash-told")  # those that go are fewer than those that stay
    here = df[id_col]
    kept = df.join(told.filter("_leads = 0 and __sw_id is not null").select("__sw_id"), here == F.col("__sw_id"), "left_anti")
    mixed = materialize(told.filter("_leads > 0 or __sw_id is null").select("__sw_id"), "simhash-mixed")
    if mixed.isEmpty():
        return kept
    stay = materialize(found.filter("leads").select(F.col("id").alias("__sw_id"), F.col("node").alias("__sw_node")).distinct(), "simhash-stay")
    plain = kept.join(mixed, here.eqNullSafe(F.col("__sw_id")), "left_anti")
    some = kept.join(mixed, here.eqNullSafe(F.col("__sw_id")), "left_semi")
    node = F.xxhash64(F.coalesce(df[text_col], F.lit("")))
    once = some.join(stay, here.eqNullSafe(F.col("__sw_id")) & (node == F.col("__sw_node"))).dropDuplicates(["__sw_id", "__sw_node"])
    return plain.unionByName(once.drop("__sw_id", "__sw_node"))
