"""Language ID: unigrams over pieces, with the segmentation summed out.

The pieces are a fixed public vocabulary. Each language has a probability for each piece; a word's probability is the sum over all its
segmentations into pieces of the product of their probabilities, which a forward pass finds in one sweep. A text is its runs of letters,
lower case, each begun by the vocabulary's word mark; its languages' posteriors follow from the sums of its words' log probabilities.

Both passes are kept in range by rescaling (sums of many words) or by logarithms (single long runs), so a run of letters counts whole whatever its length.

Fitting: expectation maximisation from equal probabilities, where expected counts of pieces come from a forward and a backward pass
over each distinct word. It is fitted on a bounded sample, ``Fit.texts_per_language`` different whole texts of each language, those with the
least hash of id and text. Their words are counted where they lie and summed by word; one task for each language gets the words and counts.

Defined results: a null text, and one without a letter, is ``und`` with score 0; so is every text where nothing was learned. Ties go to the language
that sorts first. Rows are judged one by one, so repeated rows repeat and an empty table stays empty; only the named columns are read
(``keep`` returns all columns of what it keeps); texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwright.llm.common import held, map_batches, materialize, ship

UNDETERMINED = "und"
_MARK = "▁"
_RUNS = re.compile(r"[^\W\d_]+")
#: Steps of the forward pass from one rescaling to the next.
_RESCALE = 12
#: Characters of a word above which its expected counts are found in logarithms.
_IN_LOGS = 40
#: Words whose log probabilities a worker keeps before it starts again; a word of many letters counts as several.
TABLE_ENTRIES = 400_000
#: Words of text that are split before the new ones among them are looked at together.
TOGETHER_WORDS = 400_000


@dataclass(frozen=True)
class Fit:
    """How much is learned from. ``stranger`` is the share that a language keeps for characters that no piece covers."""

    texts_per_language: int = 400
    rounds: int = 2
    longest_piece: int = 15  # of letters, as long as the longest of the vocabulary
    stranger: float = 1e-6
    smoothing: float = 0.05


@cache
def vocabulary(path: str, longest: int) -> frozenset[str]:
    """Lower-case pieces of letters, with or without the word mark."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    all_ = (pieces.id_to_piece(i) for i in range(pieces.get_piece_size()) if not pieces.is_control(i) and not pieces.is_byte(i) and not pieces.is_unknown(i))
    return frozenset(p for p in all_ if len(p) <= longest + (p[0] == _MARK) and p == p.lower() and _RUNS.fullmatch(p.removeprefix(_MARK) or "a"))


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower case."""
    return _RUNS.findall((text or "").lower())


def _spans(word: str, prob: dict[str, float], longest: int, stranger: float) -> list[tuple[int, int, float]]:
    """Begin, end and probability of every piece in the word, in order; a character that is no piece is a stranger."""
    n = len(word)
    out = []
    for i in range(n):
        for j in range(i + 1, min(n, i + longest + 1) + 1):
            p = prob.get(word[i:j])
            if p is not None:
                out.append((i, j, p))
            elif j == i + 1:
                out.append((i, j, stranger))
    return out


def expected_counts(word: str, prob: dict[str, float], longest: int, stranger: float) -> tuple[float, dict[str, float]]:
    """The word's log probability and, over all its segmentations, how often each piece is expected. ``word`` has its mark."""
    n = len(word)
    spans = _spans(word, prob, longest, stranger)
    counts: dict[str, float] = {}
    if n > _IN_LOGS:
        low = -np.inf
        front, back = [0.0] + [low] * n, [low] * n + [0.0]
        steps = [(i, j, math.log(p)) for i, j, p in spans]
        for i, j, p in steps:
            front[j] = _log_add(front[j], front[i] + p)
        for i, j, p in reversed(steps):
            back[i] = _log_add(back[i], p + back[j])
        for i, j, p in steps:
            counts[word[i:j]] = counts.get(word[i:j], 0.0) + math.exp(front[i] + p + back[j] - front[n])
        return front[n], counts
    forward, backward = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    for i, j, p in spans:
        forward[j] += forward[i] * p
    for i, j, p in reversed(spans):
        x = p * backward[j]
        backward[i] += x
        piece = word[i:j]
        counts[piece] = counts.get(piece, 0.0) + forward[i] * x / forward[n]
    return math.log(forward[n]), counts


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a))


def fit_pieces(words: Counter[str], pieces: frozenset[str], how: Fit) -> dict[str, float]:
    """Piece probabilities of one language from its words' counts."""
    prob = dict.fromkeys(pieces, 1 / max(1, len(pieces)))
    for _ in range(how.rounds):
        total: dict[str, float] = {}
        for word, n in words.items():
            for piece, x in expected_counts(_MARK + word, prob, how.longest_piece, how.stranger)[1].items():
                total[piece] = total.get(piece, 0.0) + n * x
        mass = sum(x for p, x in total.items() if p in pieces) + how.smoothing * len(pieces)
        prob = {p: (total.get(p, 0.0) + how.smoothing) / mass for p in pieces}
    return prob


class Model:
    """Piece probabilities of several languages."""

    def __init__(self, languages: list[str], prob: dict[str, tuple[float, ...]], how: Fit):
        self.languages, self.prob, self.how = languages, prob, how
        self.number = {p: n for n, p in enumerate(prob)}
        unknown = (how.stranger,) * len(languages)
        self.weights = np.array([*prob.values(), unknown, (0.0,) * len(languages)]).reshape(len(prob) + 2, len(languages))
        self.table: dict[str, int] = {}
        self.weight = 0
        self.rows = np.zeros((1024, len(languages)), np.float32)

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """A row for each word, the longest first: forward sums over all segmentations, for all words and languages at once. Only the last
        ``longest`` places of a pass are held."""
        longest, rows = self.how.longest_piece + 1, len(words)
        lengths = np.array([len(w) + 1 for w in words])
        words = [_MARK + w for w in words]
        get, strange, none = self.number.get, len(self.number), len(self.number) + 1
        window = np.zeros((longest + 1, rows, len(self.languages)))  # place i is in i % (longest + 1)
        window[0] = 1
        scale = np.zeros((rows, len(self.languages)))
        out = np.zeros((rows, len(self.languages)))
        going = rows
        for i in range(int(lengths[0])):
            left = int(np.searchsorted(-lengths, -i, side="left"))  # words that go on beyond place i
            if left < going:
                out[left:going] = np.log(window[i % (longest + 1), left:going]) + scale[left:going]
                going = left
            if i and i % _RESCALE == 0:
                most = window[:, :going].max(axis=0)
                window[:, :going] /= most
                scale[:going] += np.log(most)
            here = window[i % (longest + 1), :going].copy()
            window[i % (longest + 1), :going] = 0  # now place i + longest + 1
            reach = going
            for j in range(i + 1, min(int(lengths[0]), i + longest) + 1):
                while reach and lengths[reach - 1] < j:  # words that end before j
                    reach -= 1
                if not reach:
                    break
                missing = strange if j == i + 1 else none
                at = np.fromiter((get(w[i:j], missing) for w in words[:reach]), np.int64, reach)
                window[j % (longest + 1), :reach] += here[:reach] * self.weights[at]
        out[:going] = np.log(window[lengths[0] % (longest + 1), :going]) + scale[:going]
        return out

    def learn(self, words: set[str]) -> None:
        """Puts new words in the table."""
        ordered = sorted(words, key=len, reverse=True)
        if self.weight + sum(1 + len(w) // 64 for w in ordered) > TABLE_ENTRIES:
            self.forget()
        for k in range(0, len(ordered), 10_000):
            part = ordered[k : k + 10_000]
            at = len(self.table)
            if at + len(part) > len(self.rows):
                grown = np.zeros((2 * (at + len(part)), len(self.languages)), np.float32)
                grown[:at] = self.rows[:at]
                self.rows = grown
            self.rows[at : at + len(part)] = self.log_probabilities(part)
            self.table.update(zip(part, range(at, at + len(part))))
            self.weight += sum(1 + len(w) // 64 for w in part)

    def forget(self) -> None:
        self.table, self.weight = {}, 0
        self.rows = np.zeros((1024, len(self.languages)), np.float32)

    def scores(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        """The language and its posterior for each text, the languages equally likely beforehand."""
        at = 0
        while at < len(texts):
            together: list[list[str]] = []
            n = 0
            while at < len(texts) and n < TOGETHER_WORDS:
                together.append(words_of(texts[at]))
                n += len(together[-1])
                at += 1
            if self.languages:
                all_ = set().union(*together)
                new = all_.difference(self.table)
                if self.weight + sum(1 + len(w) // 64 for w in new) > TABLE_ENTRIES:
                    self.forget()
                    new = all_
                self.learn(new)
            get = self.table.__getitem__
            for words in together:
                if not words or not self.languages:
                    yield UNDETERMINED, 0.0
                    continue
                sums = self.rows[np.fromiter(map(get, words), np.int64, len(words))].sum(axis=0, dtype=np.float64)
                best = int(sums.argmax())
                yield self.languages[best], float(1 / np.exp(sums - sums[best]).sum())


def _sample(labelled: DataFrame, how: Fit, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``lang, text`` of the sample. A language's texts are ordered by hash; a cut-off hash, from the languages' counts, leaves so few that one task may order them."""
    own = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    rows = labelled.select(F.col(lang_col).alias("lang"), own.alias("h"), F.col(text_col).alias("text")).filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    counts = materialize(rows.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    share = 1.0
    while True:  # once, unless repeated texts are so many that the share holds too few different ones
        part = F.least(F.lit(1.0), F.lit(share * 4 * how.texts_per_language) / F.col("n"))
        near = rows.join(counts, "lang").filter(F.col("h") / 2.0**64 + 0.5 <= part).select("lang", "h").distinct()
        first = Window.partitionBy("lang").orderBy("h")
        chosen = materialize(near.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= how.texts_per_language).select("lang", "h"), "language-sample")
        short = chosen.groupBy("lang").count().join(counts, "lang", "right").filter((F.coalesce("count", F.lit(0)) < how.texts_per_language) & (F.col("n") > share * 4 * how.texts_per_language))
        if short.isEmpty():
            break
        share *= 16
    return rows.join(chosen, ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")


def fit(labelled: DataFrame, pieces_path: str, how: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the languages that ``labelled`` names, from a bounded sample of its rows. Null languages, texts and ids are left out; repeated rows count once."""
    ship(labelled.sparkSession)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter[tuple[str, str]] = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found.update((lang, w) for w in words_of(text.as_py()))
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array([*found.values()], pa.int64())], ["lang", "word", "n"])

    words = map_batches(_sample(labelled, how, id_col, text_col, lang_col), count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        prob = fit_pieces(Counter(dict(zip(pdf["word"], pdf["n"]))), vocabulary(pieces_path, how.longest_piece), how)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "piece": list(prob), "p": list(prob.values())})

    fitted = words.groupBy("lang").applyInPandas(one, "lang string, piece string, p double").toPandas()  # the vocabulary for each language
    if fitted.empty:
        return Model([], {}, how)
    table = fitted.pivot(index="piece", columns="lang", values="p").sort_index(axis=1)
    return Model([*table.columns], dict(zip(table.index, map(tuple, table.to_numpy().tolist()))), how)


def _scorer(df: DataFrame, model: Model):
    """What a task calls for its model: shipped once to each executor, rebuilt once in each Python worker."""
    sent = df.sparkSession.sparkContext.broadcast((model.languages, model.prob, model.how))  # the fixed vocabulary for each language
    number = sent._jbroadcast.id()
    return lambda: _rebuilt(number, sent)


def _rebuilt(number: int, sent) -> Model:
    return held(("language", number), lambda: Model(*sent.value))


def detect(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score``."""
    scorer = _scorer(df, model)

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [*scorer().scores(batch.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["id", "lang_pred", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")), f, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep(df: DataFrame, model: Model, languages: Iterable[str] | None = None, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is among ``languages`` (all learned ones if None) at ``min_score`` or more."""
    scorer, wanted, at = _scorer(df, model), set(model.languages if languages is None else languages), df.columns.index(text_col)

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([x in wanted and s >= min_score for x, s in scorer().scores(batch.column(at).to_pylist())], pa.bool_()))

    return map_batches(df, f, df.schema)
