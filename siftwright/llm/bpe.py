"""BPE encoding and decoding with a contiguous rank array.

A word is a list of parts and, beside it, a list with the rank of each adjacent pair. The lowest rank is found by a scan, its
boundary is deleted, and the ranks of the two pairs that touch the merged part are looked up again. Words are short, so a scan
over a contiguous array beats a heap; the arrays of equally long words are rows of one matrix and are scanned together. Words
repeat, so each Python worker keeps a bounded table of those it has seen.

Texts are normalised, split and mapped to byte symbols as the vocabulary file says, so ids equal those of the tokenizers library.

Defined results: a null text encodes as the empty text, to no ids; null ids decode to the empty text; rows are mapped one by one, so
repeated rows and ties repeat their result and an empty table stays empty; only the named columns are read, so others may have any
name. Texts of any length are encoded whole, a white-space-free stretch at a time.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from siftwright.llm.common import held, map_batches, texts_of

#: Entries that a worker's table of encoded stretches holds before it starts again; twice as many where it holds no texts.
TABLE_ENTRIES = 250_000
#: Characters of text that are split before the new stretches among them are encoded together.
TOGETHER_CHARS = 4_000_000
#: Words of more parts than this are merged by a heap over a linked list, as scans take quadratic time.
SHORT_WORD = 256
_NO_RANK = np.int32(2**31 - 1)
#: White space to Python's split() but not to the vocabulary's pattern.
_ODD_SPACE = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> dict[int, str]:
    """Printable Latin-1 bytes stand for themselves; the others take the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class PairRanks:
    """Ranks of pairs of ids, looked up for whole arrays: open addressing over numpy arrays."""

    def __init__(self, pairs: np.ndarray, bits: int = 18):
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + 64, -1, np.int64)
        self.rank = np.full((1 << bits) + 64, _NO_RANK, np.int32)
        left = np.arange(len(pairs))
        slot = self._home(pairs)
        while len(left):
            free = self.keys[slot] == -1
            _, first = np.unique(np.where(free, slot, -1 - left), return_index=True)
            first = first[free[first]]
            self.keys[slot[first]] = pairs[left[first]]
            self.rank[slot[first]] = left[first]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], slot[rest] + 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        slot = self._home(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.rank[slot], _NO_RANK)
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            slot[open_] += 1
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.rank[slot[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out


class RankArrayEncoder:
    """Encodes with a vocabulary file of word-end BPE. Words of equal length are merged side by side, a row of ranks each."""

    def __init__(self, path: str, as_text: bool = True):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["pretokenizers"][1]["type"] != "ByteLevel":
            raise ValueError(f"not a byte-symbol BPE vocabulary: {path}")
        self.as_text = as_text
        vocab: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        self.size = max(self.tokens) + 1
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        self.pattern_or_space = regex.compile(f"{split}|\\s")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = PairRanks(np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64))
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.rank_of = {(vocab[a], vocab[b]): n for n, (a, b) in enumerate(merges)}
        symbols = byte_symbols()
        self.inner = np.array([vocab[symbols[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[symbols[b] + end] for b in range(256)], np.int32)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        #: Runs of ASCII letters are one match of the pattern.
        self.letters_whole = bool(regex.search(r"\[?\\p\{L\}\]?\+", split))
        #: By stretch without white space: ids as little-endian 32-bit integers, or these, the ids as decimal text and the decoded text.
        self.table: dict[str, bytes | tuple[bytes, str, str]] = {}

    def merge_rows(self, parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The contiguous rank arrays of equally long words at work. Yields rows' numbers and their final ids. Each step deletes one boundary of
        every row that has a rank left, so the rows that go on stay equally long."""
        rows = np.arange(len(parts))
        ranks = self.pairs.of(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(len(parts), -1)
        while parts.shape[1] > 1 and len(rows):
            low = ranks.argmin(axis=1)  # the leftmost of equal ranks
            at = np.arange(len(rows))
            rank = ranks[at, low]
            ended = rank == _NO_RANK
            if ended.any():
                yield rows[ended], parts[ended]
                rows, parts, ranks, low, rank = (x[~ended] for x in (rows, parts, ranks, low, rank))
                at = at[: len(rows)]
            wide = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, wide + (wide > low[:, None]), axis=1)
            parts[at, low] = self.merged[rank]
            wide = wide[:-1]
            ranks = np.take_along_axis(ranks, wide + (wide >= low[:, None]), axis=1)
            left = np.flatnonzero(low > 0)
            ranks[left, low[left] - 1] = self.pairs.of(parts[left, low[left] - 1], parts[left, low[left]])
            right = np.flatnonzero(low < parts.shape[1] - 1)
            ranks[right, low[right]] = self.pairs.of(parts[right, low[right]], parts[right, low[right] + 1])
        if len(rows):
            yield rows, parts

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same merges of one word by a heap over a linked list."""
        get, n = self.rank_of.get, len(ids)
        before, after, alive = [*range(-1, n - 1)], [*range(1, n), -1], [True] * n
        heap = [(r, i, p) for i, p in enumerate(zip(ids, ids[1:])) if (r := get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i] = int(self.merged[rank])
            alive[j], after[i] = False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if (r := get(p := (ids[i], ids[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i, p))
            if before[i] >= 0 and (r := get(p := (ids[before[i]], ids[i]))) is not None:
                heapq.heappush(heap, (r, before[i], p))
        return [i for i, a in zip(ids, alive) if a]

    def words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct words, each one match of the vocabulary's pattern, as little-endian 32-bit integers."""
        out: dict[str, bytes] = {}
        by_length: dict[int, tuple[list[str], list[bytes]]] = {}
        for w in words:
            b = w.encode("utf-8", "surrogatepass")
            if len(b) > SHORT_WORD:
                out[w] = np.array(self.merge_long([*self.inner[np.frombuffer(b[:-1], np.uint8)].tolist(), int(self.last[b[-1]])]), "<u4").tobytes()
            else:
                names, rows = by_length.setdefault(len(b), ([], []))
                names.append(w)
                rows.append(b)
        for length, (names, rows) in by_length.items():
            step = max(1, 200_000 // length)
            for k in range(0, len(rows), step):
                raw = np.frombuffer(b"".join(rows[k : k + step]), np.uint8).reshape(-1, length)
                parts = self.inner[raw]
                parts[:, -1] = self.last[raw[:, -1]]
                for at, ids in self.merge_rows(parts):
                    found, wide = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
                    for n, i in enumerate(at.tolist()):
                        out[names[k + i]] = found[n * wide : n * wide + wide]
        return out

    @staticmethod
    def normalize(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # letter by letter: no final sigma
                text = text.replace("Σ", "σ")
        return text.lower()

    def learn(self, stretches: set[str]) -> None:
        """Puts normalised stretches without white space in the table."""
        if not stretches:
            return
        whole = {w for w in stretches if w.isascii() and w.isalpha()} if self.letters_whole else set()
        names = [*stretches.difference(whole)]
        pieces: list[list[str]] = [[]]
        for p in self.pattern_or_space.findall(" ".join(names)) if names else ():
            if p == " ":
                pieces.append([])
            else:
                pieces[-1].append(p)
        ids = self.words(whole.union(*pieces))
        found = {w: ids[w] for w in whole}
        if names:
            found.update((name, ids[ps[0]] if len(ps) == 1 else b"".join([ids[p] for p in ps])) for name, ps in zip(names, pieces, strict=True))
        self.table.update(zip(found, map(self._told, found.values())) if self.as_text else found)

    def _told(self, raw: bytes) -> tuple[bytes, str, str]:
        ids = np.frombuffer(raw, "<u4").tolist()
        tokens = self.tokens
        return raw, " ".join(map(str, ids)), " ".join([tokens[i] for i in ids])

    def _split(self, text: str) -> list[str]:
        text = self.normalize(text)
        return [w for w in regex.split(r"\s+", text) if w] if _ODD_SPACE.search(text) else text.split()

    def parts(self, texts: list[str]) -> Iterator[Iterator]:
        """Of each text the table's entries, in order."""
        at = 0
        while at < len(texts):
            stretches: list[list[str]] = []
            chars, begin = 0, at
            while at < len(texts) and (at == begin or chars < TOGETHER_CHARS):
                text = texts[at]
                chars += len(text)
                at += 1
                if self.special_pattern and "<|" in text:
                    split = self.special_pattern.split(text)
                    stretches.append([w for s in split for w in ([s] if s in self.special else self._split(s))])
                else:
                    stretches.append(self._split(text))
            new: set[str] = set().union(*stretches)
            if len(self.table) + len(new) > TABLE_ENTRIES * (1 if self.as_text else 2):
                self.table.clear()
            new.difference_update(self.table)
            collecting = gc.isenabled()
            gc.disable()  # many new tuples, none in a cycle
            self.learn(new.difference(self.special))
            if collecting:
                gc.enable()
            for s in new & self.special.keys():
                raw = np.array([self.special[s]], "<u4").tobytes()
                self.table[s] = (raw, str(self.special[s]), s) if self.as_text else raw
            entry = self.table.__getitem__
            for s in stretches:
                yield map(entry, s)

    def forget(self) -> None:
        self.table = {}

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, unsigned 32-bit."""
        for parts in self.parts([t or "" for t in texts]):
            yield np.frombuffer(b"".join([p[0] for p in parts] if self.as_text else parts), "<u4")

    def decode(self, ids: Iterable[int] | None, skip_special_tokens: bool = False) -> str:
        """As the library decodes where the file names no decoder: tokens joined by spaces, unknown ids left out."""
        skip = set(self.special.values()) if skip_special_tokens else ()
        return " ".join([self.tokens[i] for i in (ids if ids is not None else ()) if i in self.tokens and i not in skip])


def encoder(path: str, as_text: bool = True) -> RankArrayEncoder:
    """The worker's own."""
    return held(("bpe", path, as_text), lambda: RankArrayEncoder(path, as_text))


def encode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the text's ``ids`` (array of int)."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = encoder(vocabulary, False)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([i.astype(np.int32) for i in e.encode(texts_of(batch, "text"))], pa.list_(pa.int32()))], ["id", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")), f, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids", skip_special_tokens: bool = False) -> DataFrame:
    """``id_col`` and the decoded ``text``."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = encoder(vocabulary)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([e.decode(i, skip_special_tokens) for i in batch.column(1).to_pylist()], pa.string())], ["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(df[id_col].alias("id"), df[ids_col].alias("ids")), f, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_tokens`` and the SHA-256 of the ids as decimal text and of the decoded text: encode and decode in one pass, no ids kept."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = encoder(vocabulary)
        n, ids, back = [], [], []
        for found in e.parts(texts_of(batch, "text")):
            parts = [*found]
            n.append(sum([len(p[0]) for p in parts]) // 4)
            ids.append(hashlib.sha256(" ".join([p[1] for p in parts]).encode()).hexdigest())
            back.append(hashlib.sha256(" ".join([p[2] for p in parts]).encode("utf-8", "surrogatepass")).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")), f, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
