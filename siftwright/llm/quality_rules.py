"""Quality rules: plain counts, and the divergence of a text's histograms from language references.

Two histograms describe a text: its characters by class, and its words by common word (one bin for all other words). For each language
there is a reference of both, the mean of the normalised histograms of the texts that pass the plain rules and are long enough; every such text counts
once, whatever its length. A text is held against the reference that it is nearest to, by the Jensen-Shannon distance (base 2, from
0 to 1). A histogram of too few characters or words says little, so below a minimum length it isn't held against anything.

Two passes: the first sums histograms by language (one small row for each language and batch), the second judges each text where it lies.
Neither shuffles texts.

Defined results: a null text counts as the empty one, which has no word and so fails the plain rules; a null language learns
no reference; where no text teaches a reference (an empty table, or all too short) the divergence rules are silent; rows are judged
one by one, so repeated rows repeat; only the named columns are read (``keep`` returns all columns of what it keeps); texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwright.llm.common import ASCII_SPACE, map_batches, ship, texts_of

# The most usual short words of four languages, lower case.
COMMON_WORDS = (
    "the of and to in a is that for it as was with be by on not he this are or his from at which but have an had they you were "  # English
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach "  # German
    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec mais comme ou "  # French
    "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si"  # Spanish
)
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "stop", "quote", "symbol", "other", "beyond ASCII")


def _class_of_byte() -> np.ndarray:
    """By byte of UTF-8 its class; bytes that continue a character have none (-1)."""
    out = np.full(256, 7)
    for chars, k in (("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (ASCII_SPACE, 3), (".,;:!?", 4), ("'\"()-", 5), (SYMBOLS + "@^_~=+\\/{}[]`", 6)):
        out[list(chars.encode())] = k
    out[0xC0:] = 8
    out[0x80:0xC0] = -1
    return out


_CLASS = _class_of_byte()
_TO_CLASS = (_CLASS[:, None] == np.arange(len(CLASSES))[None, :]).astype(np.int64)
_SPACES = list(ASCII_SPACE.encode())
_SYMBOL_BYTES = list(SYMBOLS.encode())
_COMMON = {w.encode(): n for n, w in enumerate(dict.fromkeys(COMMON_WORDS.split()))}
_BINS = len(CLASSES) + len(_COMMON) + 1


@dataclass(frozen=True)
class Rules:
    """The plain rules and the divergence rules. Distances are Jensen-Shannon distances."""

    min_words: int = 10
    max_repeat_percent: int = 20
    repeat_window: int = 5
    min_chars_for_classes: int = 100
    min_words_for_common: int = 60
    max_class_distance: float = 0.33
    #: A text that is this far in both histograms goes too.
    both_class_distance: float = 0.12
    both_common_distance: float = 0.27


def repeat_words(words: list[bytes], window: int) -> int:
    """Words inside windows that occur twice or more, the first included. Windows are compared by 64-bit hashes of their words' numbers."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), np.uint64, len(words))
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key = (key ^ ids[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    spots = np.flatnonzero(np.isin(key, twice))
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, spots, 1)
    np.add.at(covered, spots + window, -1)
    return int((covered.cumsum() > 0).sum())


@dataclass
class Facts:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    histogram: np.ndarray  # counts by class, then by common word, then of other words

    def base_failed(self, rules: Rules) -> bool:
        return self.n_words < rules.min_words or 100 * self.n_repeat_words > rules.max_repeat_percent * self.n_words


def facts(text: str | None, rules: Rules = Rules()) -> Facts:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    classes = by_byte @ _TO_CLASS
    seen: set[str] = set()
    n_lines = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                n_lines += 1
            elif line.strip(ASCII_SPACE):
                seen.add(line)
    plain = raw.lower().translate(None, b".,;:").split()
    common = np.bincount(np.fromiter(map(_COMMON.get, plain, repeat(len(_COMMON))), np.int64, len(plain)), minlength=len(_COMMON) + 1)
    return Facts(len(words), int(classes.sum() - by_byte[_SPACES].sum()), int(by_byte[_SYMBOL_BYTES].sum()), n_lines, repeat_words(words, rules.repeat_window), np.concatenate([classes, common]))


def _shares(histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = histogram[: len(CLASSES)], histogram[len(CLASSES) :]
    return a / max(1, a.sum()), b / max(1, b.sum())


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of a distribution from each row of ``q``, base 2."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda x: np.where(x > 0, x * np.log2(x / m), 0).sum(axis=1)
        return np.sqrt(np.clip((part(np.broadcast_to(p, q.shape)) + part(q)) / 2, 0, 1))


@dataclass(frozen=True)
class References:
    classes: np.ndarray  # a row for each language
    common: np.ndarray
    languages: tuple[str, ...]

    def distances(self, f: Facts, rules: Rules) -> tuple[float | None, float | None]:
        """To the nearest reference; None where the text is too short or nothing was learned."""
        if not self.languages:
            return None, None
        a, b = _shares(f.histogram)
        return (
            float(distance(a, self.classes).min()) if f.histogram[: len(CLASSES)].sum() >= rules.min_chars_for_classes else None,
            float(distance(b, self.common).min()) if f.n_words >= rules.min_words_for_common else None,
        )


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> References:
    """The references of all languages, from all texts that pass the plain rules and are long enough for both histograms."""
    ship(df.sparkSession)

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums: dict[str, np.ndarray] = {}
        for text, lang in zip(texts_of(batch, "text"), batch.column("lang").to_pylist()):
            if lang is None:
                continue
            x = facts(text, rules)
            if x.base_failed(rules) or len(text) < rules.min_chars_for_classes or x.n_words < rules.min_words_for_common:
                continue
            sums[lang] = sums.get(lang, 0) + np.concatenate([*_shares(x.histogram), [1.0]])
        rows = [(lang, k, float(v)) for lang, s in sums.items() for k, v in enumerate(s) if v]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.float64())], ["lang", "bin", "share"])

    sums = map_batches(df.select(df[text_col].alias("text"), df[lang_col].alias("lang")), f, "lang string, bin int, share double").groupBy("lang", "bin").agg(F.sum("share").alias("share"))
    by: dict[str, np.ndarray] = {}
    for lang, k, share in sums.orderBy("lang", "bin").collect():  # a few hundred numbers for each language
        by.setdefault(lang, np.zeros(_BINS + 1))[k] = share
    rows = np.array([x[:-1] / x[-1] for x in by.values()]).reshape(-1, _BINS)
    return References(rows[:, : len(CLASSES)], rows[:, len(CLASSES) :], tuple(by))


def verdict(f: Facts, references: References, rules: Rules) -> tuple[bool, bool, float | None, float | None]:
    """base_failed, kept, and the two distances."""
    failed = f.base_failed(rules)
    a, b = references.distances(f, rules)
    strange = a is not None and (a > rules.max_class_distance or b is not None and a > rules.both_class_distance and b > rules.both_common_distance)
    return failed, not failed and not strange, a, b


_SCHEMA = "id {}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, class_distance double, common_distance double"


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules(), references: References | None = None) -> DataFrame:
    """The counts, verdicts and distances of each text."""
    refs = references or learn(df, text_col, lang_col, rules)

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [facts(t, rules) for t in texts_of(batch, "text")]
        judged = [verdict(x, refs, rules) for x in found]
        cols = [pa.array([getattr(x, n) for x in found], pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        cols += [pa.array([j[k] for j in judged], pa.bool_() if k < 2 else pa.float64()) for k in range(4)]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols], ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "common_distance"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")), f, _SCHEMA.format(kind)).withColumnRenamed("id", id_col)


def keep(df: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules(), references: References | None = None) -> DataFrame:
    """The rows whose text the rules keep, with all their columns."""
    refs = references or learn(df, text_col, lang_col, rules)
    at = df.columns.index(text_col)

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([verdict(facts(t, rules), refs, rules)[1] for t in batch.column(at).to_pylist()], pa.bool_()))

    return map_batches(df, f, df.schema)
