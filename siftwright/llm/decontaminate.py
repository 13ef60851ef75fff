"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower case. Two passes over the corpus. The first counts the benchmark's words in all texts; from these counts each
n-gram of the benchmark has a number of times it is expected to stand in a thousand words by chance. N-grams over ``Rules.chance`` are common and seed
nothing, however few benchmark items hold them, while one that many texts copy stays a seed. The second pass joins a text that holds a rare n-gram to the
items that hold it, takes a window of the text's words around each cluster of hits, long enough for the whole item on either side, and aligns it with the item by
Smith-Waterman over words; the score is the share of the best possible one, that of an unedited copy. Insertions, deletions and replaced words lower it a
little, so paraphrased and edited copies score high. A window that holds too few of the item's words to reach the least score isn't aligned, so
an n-gram that very many items share costs little; nothing but results leaves a task.

The seeds, in flat arrays, go to every task, those of ``Rules.broadcast_words`` words of the benchmark or so at a time; a larger benchmark is sent block by
block, each with passes of its own over the corpus.

Defined results: a null text has no words and no hit; an item with fewer words than an n-gram seeds as a whole; an item without words seeds nothing; an
empty table on either side gives an empty result; items of equal text all hit; repeated rows of a text count once here, and of the hits of
rows with one id the best counts; null ids are kept; only the named columns are read; texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from siftwright.llm.common import materialize, ship, texts_of

_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Words that shares are taken of at least: a few copies in a small corpus make no word common.
_LEAST_WORDS = 100_000
#: Alignments that a task keeps, as many texts copy the same passage.
_KNOWN = 5_000


@dataclass(frozen=True)
class Rules:
    ngram: int = 5
    chance: float = 1e-6  # expected in a thousand words; a rare n-gram has less
    min_score: float = 0.45  # of the score of an unedited copy; one with 30 % of its words replaced scores 0.55 or so, half a copy 0.5 or just below
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    broadcast_words: int = 500_000  # some 30 bytes each in flat arrays, and 100 for each different word


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def gram_keys(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit key for each run of n numbers; hits are confirmed by alignment, so chance collisions do no harm."""
    key = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for k in range(n):
        key = (key ^ ids[k : k + len(key)]) * _MIX
        key ^= key >> np.uint64(31)
    return key


def smith_waterman(item: np.ndarray, window: np.ndarray, rules: Rules) -> tuple[int, int, int]:
    """Best local score, and where in ``window`` its alignment ends and how many window words it can span at most. A row for each item word; along a row the
    best gap comes from a running maximum."""
    slope = -rules.gap * np.arange(len(window) + 1)
    row = np.zeros(len(window) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        new = np.maximum(row + rules.gap, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(window == word, rules.match, rules.mismatch))
        row = np.maximum.accumulate(new + slope) - slope
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end, len(item)


@dataclass
class Grams:
    """The different n-grams of one length: sorted keys, their words, and for each the (item, place) pairs that hold it, one after the other."""

    keys: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    item: np.ndarray
    place: np.ndarray


class Seeds:
    """The n-grams of the benchmark, with the items and places that hold them. Items of equal words are one."""

    def __init__(self, items: list[tuple[object, str | None]], rules: Rules):
        self.vocab: dict[str, int] = {}
        number: dict[tuple[int, ...], int] = {}
        self.names: list[list[object]] = []
        for name, text in items:
            ids = tuple(self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text))
            if ids:
                if ids not in number:
                    number[ids] = len(number)
                    self.names.append([])
                self.names[number[ids]].append(name)
        self.item_ids = [np.array(ids, np.int32) for ids in number]
        self.sizes = np.array([len(x) for x in self.item_ids], np.int64)
        self.grams: dict[int, Grams] = {}
        for n in sorted({min(rules.ngram, size) for size in self.sizes.tolist()}):
            own = [k for k, size in enumerate(self.sizes.tolist()) if min(rules.ngram, size) == n]
            words = np.concatenate([np.lib.stride_tricks.sliding_window_view(self.item_ids[k], n) for k in own])
            per = [int(self.sizes[k]) - n + 1 for k in own]
            item, place = np.repeat(own, per).astype(np.int32), np.concatenate([np.arange(m, dtype=np.int32) for m in per])
            keys = np.concatenate([gram_keys(self.item_ids[k].astype(np.uint64), n) for k in own])
            order = np.argsort(keys, kind="stable")
            distinct, first = np.unique(keys[order], return_index=True)
            self.grams[n] = Grams(distinct, words[order[first]], np.append(first, len(keys)), item[order], place[order])

    def keep_rare(self, counts: np.ndarray, rules: Rules) -> None:
        """Leaves the n-grams that are expected less than ``rules.chance`` times in a thousand words, from the counts of their words (place 0: of all other
        words); and every item that is shorter than an n-gram, as it has no other seed."""
        shares = np.maximum(1, counts) / max(_LEAST_WORDS, int(counts.sum()))
        for n, g in self.grams.items():
            if n < rules.ngram:
                continue
            rare = np.flatnonzero(1000.0 * shares[g.words].prod(axis=1) < rules.chance)
            held = np.diff(g.starts)[rare]
            at = np.repeat(g.starts[rare] - np.concatenate([[0], held.cumsum()[:-1]]), held) + np.arange(int(held.sum())) if len(rare) else np.empty(0, np.int64)
            self.grams[n] = Grams(g.keys[rare], g.words[:0], np.concatenate([[0], held.cumsum()]).astype(np.int64), g.item[at], g.place[at])

    def numbers(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words))

    def windows(self, ids: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Item, begin, end and number of different seeds of each cluster of hits in a text."""
        known = ids > 0
        found: list[np.ndarray] = []
        for n, g in self.grams.items():
            if len(ids) < n or not len(g.keys):
                continue
            whole = known[: len(ids) - n + 1].copy()
            for k in range(1, n):
                whole &= known[k : len(ids) - n + 1 + k]
            spots = np.flatnonzero(whole)
            if not len(spots):
                continue
            keys = gram_keys(ids.astype(np.uint64), n)[spots]
            at = np.minimum(np.searchsorted(g.keys, keys), len(g.keys) - 1)
            good = g.keys[at] == keys
            at, spots = at[good], spots[good]
            held = g.starts[at + 1] - g.starts[at]
            if not held.sum():
                continue
            flat = np.repeat(g.starts[at] - np.concatenate([[0], held.cumsum()[:-1]]), held) + np.arange(int(held.sum()))
            found.append(np.stack([g.item[flat].astype(np.int64), np.repeat(spots, held) - g.place[flat], np.repeat(at, held)]))
        if not found:
            return
        item, start, key = np.concatenate(found, axis=1)
        order = np.lexsort((start, item))
        item, start, key = item[order], start[order], key[order]
        size = self.sizes[item]
        lo, hi = np.maximum(0, start - size // 2), start + size + size // 2 + 1
        edges = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (lo[1:] > hi[:-1]), [True]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield int(item[a]), int(lo[a]), int(hi[b - 1]), len(np.unique(key[a:b]))


def _counted(texts: DataFrame, sent, n_words: int) -> np.ndarray:
    """How often each word of the benchmark stands in all texts; at 0, all other words. A task's counts are summed before they leave it."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: Seeds = sent.value
        counts = np.zeros(n_words + 1, np.int64)
        for batch in batches:
            for text in texts_of(batch, "text"):
                counts += np.bincount(seeds.numbers(text), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["word", "n"])

    out = np.zeros(n_words + 1, np.int64)
    for r in texts.select("text").mapInArrow(f, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():  # the block's words
        out[r.word] = r.n
    return out


def _aligned(texts: DataFrame, sent, rules: Rules, kind: str, item_type) -> DataFrame:
    """Every window whose alignment scores enough."""
    item_arrow, item_kind = to_arrow_type(item_type), item_type.simpleString()

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Seeds = sent.value
        known: dict[tuple[int, bytes], float] = {}
        for batch in batches:
            rows = []
            for at, text in enumerate(texts_of(batch, "text")):
                ids = s.numbers(text)
                for item, begin, end, n_seeds in s.windows(ids):
                    window, own = ids[begin:end].astype(np.int32), s.item_ids[item]
                    if np.isin(own, window).sum() < rules.min_score * len(own) - 1e-9:  # each word that matches adds its share at most
                        continue
                    name = (item, window.tobytes())
                    if name not in known:
                        if len(known) >= _KNOWN:
                            known.clear()
                        known[name] = smith_waterman(own, window, rules)[0] / (rules.match * len(own))
                    if known[name] >= rules.min_score:
                        rows += [(at, x, known[name], begin, n_seeds) for x in s.names[item]]
            if rows:
                cols = [pa.array([r[k] for r in rows], t) for k, t in ((1, item_arrow), (2, pa.float64()), (3, pa.int32()), (4, pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), *cols], ["id", "item", "score", "begin", "n_seeds"])

    return texts.mapInArrow(f, f"id {kind}, item {item_kind}, score double, begin int, n_seeds int")


def _pairs(docs: DataFrame, own: Column, text_col: str, benchmark: DataFrame, rules: Rules, item_col: str, item_text_col: str) -> DataFrame:
    """``id, item, score, begin, n_seeds``: the best window of each pair of ``own`` and an item. Ids are of any kind."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(own.alias("id"), F.col(text_col).alias("text"))
    kind, item_type = texts.schema["id"].dataType.simpleString(), benchmark.schema[item_col].dataType
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    size = items.agg(F.sum(F.size(F.split("text", r"[^\p{L}\p{N}]+")))).first()[0] or 0
    blocks = 1 + size // rules.broadcast_words
    out = None
    for block in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        seeds = Seeds([(r.item, r.text) for r in part.orderBy("item", "text").collect()], rules)
        sent = spark.sparkContext.broadcast(seeds)
        seeds.keep_rare(_counted(texts, sent, len(seeds.vocab)), rules)
        aligned = _aligned(texts, spark.sparkContext.broadcast(seeds), rules, kind, item_type)
        out = aligned if out is None else out.unionByName(aligned)
    best = out.groupBy("id", "item").agg(F.max(F.struct("score", (-F.col("begin")).alias("b"), "n_seeds")).alias("best"))
    return best.select("id", "item", F.col("best.score").alias("score"), (-F.col("best.b")).alias("begin"), F.col("best.n_seeds").alias("n_seeds"))


def find(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``id_col, item_col, score, begin_word, n_seeds`` of every pair whose alignment scores ``rules.min_score`` or more: the best window of each pair."""
    return _pairs(docs, docs[id_col], text_col, benchmark, rules, item_col, item_text_col).toDF(id_col, item_col, "score", "begin_word", "n_seeds")


def clean(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows that pair with no item, with all their columns. A row goes by its id and the hash of its text, so one that shares the id of a leaked row stays."""
    node = F.xxhash64(docs[text_col])
    own = F.struct(docs[id_col].alias("__sw_id"), node.alias("__sw_node"))
    leaked = materialize(_pairs(docs, own, text_col, benchmark, rules, item_col, item_text_col).select("id.*").distinct(), "decontaminate-leaked")  # of known size: broadcast if it is small
    return docs.join(leaked, docs[id_col].eqNullSafe(F.col("__sw_id")) & (node == F.col("__sw_node")), "left_anti").select(*docs.columns)
