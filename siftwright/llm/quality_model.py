"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Features: words, pairs of words, word shapes and pairs of shapes, hashed into ``2 ** bits`` places. A shape keeps what kind of characters a word
is made of, each run once (``The`` Aa, ``THE!!`` A!!, ``the%%%`` a%%%, ``|`` |), and a word equal to the one before has a shape of its own. A text is the sparse
vector of its features' counts, scaled to length 1 in each of the two families, and its score the logistic function of the dot product with the weights.

Training: per-coordinate FTRL-proximal updates, text by text in an order that a hash of the id gives, over a bounded sample:
``Fit.texts`` labelled texts, those with the least hash of id. It runs in one task, through which the texts stream once for each round, so it holds the state of
the updates and one Arrow batch, which Spark bounds in rows and bytes. It returns the weights that are not zero.

Defined results: a null text scores as the empty one, which scores by the bias alone; with no labelled text all scores are 0.5; null
labels are left out; an id that carries several labels or rows is learned from as often as it pairs; rows are scored one by one, so repeated rows repeat
and an empty table stays empty; only the named columns are read; texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwright.llm.common import held, map_batches, ship, texts_of

#: Words whose hashes a worker keeps before it starts again.
TABLE_ENTRIES = 400_000
_SHAPES = (re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"[^\W\d_A]+"), re.compile(r"\d+"))


@dataclass(frozen=True)
class Fit:
    """``texts`` bounds the sample; the others are FTRL's."""

    texts: int = 12_000
    rounds: int = 2
    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02


def shape(word: str) -> str:
    for pattern, sign in zip(_SHAPES, "Aa0"):
        word = pattern.sub(sign, word)
    return word


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray, bits: int) -> np.ndarray:
    return (x * _MIX) >> np.uint64(64 - bits)


class Hasher:
    """Words to places and values."""

    def __init__(self, bits: int):
        self.bits = bits
        self.table: dict[str, int] = {}  # the word's hash above its shape's
        self.same = np.uint64(zlib.crc32(b"="))

    def learn(self, words: set[str]) -> None:
        if len(self.table) + len(words) > TABLE_ENTRIES:
            self.table.clear()
        hash_, table = zlib.crc32, self.table
        for w in words:
            table[w] = hash_(w.encode("utf-8", "surrogatepass")) << 32 | hash_(shape(w).encode("utf-8", "surrogatepass"))

    def forget(self) -> None:
        self.table = {}

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and values; place 0 is the bias."""
        words = (text or "").split()
        if not words:
            return np.zeros(1, np.int64), np.ones(1)
        new = {w for w in words if w not in self.table}
        if new:
            if len(self.table) + len(new) > TABLE_ENTRIES:
                self.table.clear()
                new = set(words)
            self.learn(new)
        h = np.fromiter(map(self.table.__getitem__, words), np.uint64, len(words))
        own, kind = h >> np.uint64(32), h & np.uint64(0xFFFFFFFF)
        kind[1:][own[1:] == own[:-1]] = self.same
        places, values = [np.zeros(1, np.int64)], [np.ones(1)]
        for salt, x in ((1, own), (3, kind)):
            pair = x[:-1] * np.uint64(31) + x[1:]
            all_ = np.concatenate([_mixed((x << np.uint64(3)) + np.uint64(salt), self.bits), _mixed((pair << np.uint64(3)) + np.uint64(salt + 1), self.bits)])
            found, n = np.unique(all_, return_counts=True)
            places.append(found.astype(np.int64))
            values.append(n / np.sqrt((n * n).sum()))
        return np.concatenate(places), np.concatenate(values)


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-min(35.0, max(-35.0, x)))))


class Ftrl:
    """The state of FTRL-proximal updates."""

    def __init__(self, how: Fit):
        self.how, self.z, self.n, self.hasher = how, np.zeros(1 << how.bits), np.zeros(1 << how.bits), Hasher(how.bits)

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        how = self.how
        return np.where(np.abs(z) <= how.l1, 0, -(z - np.sign(z) * how.l1) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2))

    def update(self, text: str | None, label: int) -> None:
        i, x = self.hasher.vector(text)
        ni = self.n[i]
        w = self._weights(self.z[i], ni)
        g = (logistic(float(w @ x)) - label) * x
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / self.how.alpha
        # a place may stand twice, once for each family
        np.add.at(self.z, i, g - sigma * w)
        np.add.at(self.n, i, g * g)

    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.n)


def train(rows: list[tuple[str | None, int]], how: Fit) -> np.ndarray:
    """The weights after ``how.rounds`` times the rows, in their order."""
    state = Ftrl(how)
    for _ in range(how.rounds):
        for text, label in rows:
            state.update(text, label)
    return state.weights()


def fit(docs: DataFrame, labels: DataFrame, how: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> np.ndarray:
    """Weights, from a bounded sample of the rows of ``docs`` that ``labels`` marks 0 or 1."""
    ship(docs.sparkSession)
    hashed = F.xxhash64(F.col(id_col).cast("string"))
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"), hashed.alias("h")).filter("label in (0, 1) and id is not null")
    sample = marked.orderBy("h", "id").limit(how.texts)  # bounded by how.texts, so it may be broadcast
    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id").select("h", "id", "label", "text")

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Ftrl(how)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                state.update(text.as_py(), label.as_py())
        w = state.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at], pa.float64())], ["place", "weight"])

    rounds = F.explode(F.sequence(F.lit(1), F.lit(how.rounds))).alias("round")
    stream = pairs.select("*", rounds).repartition(1).sortWithinPartitions("round", "h", "id", "label", "text").select("text", "label")
    out = np.zeros(1 << how.bits)
    got = stream.mapInArrow(one, "place long, weight double").toPandas()
    out[got["place"].to_numpy(np.int64)] = got["weight"].to_numpy(float)
    return out


def hasher_of(bits: int) -> Hasher:
    """The worker's own."""
    return held(("quality", bits), lambda: Hasher(bits))


def score(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score``."""
    sent = df.sparkSession.sparkContext.broadcast(weights)  # 2 ** bits numbers
    bits = int(np.log2(len(weights)))

    def scores(texts: list[str]) -> Iterator[float]:
        hasher, w = hasher_of(bits), sent.value
        for text in texts:
            i, x = hasher.vector(text)
            yield logistic(float(w[i] @ x))

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([*scores(texts_of(batch, "text"))], pa.float64())], ["id", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")), f, f"id {kind}, score double").withColumnRenamed("id", id_col)
