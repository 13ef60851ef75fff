"""Runs of letters of any length, and the sample that is learned from."""

import math
from collections import Counter
from fractions import Fraction

import pytest

from siftwright.llm import language_id

PROB = {"\u2581": (0.1, 0.2), "\u2581b": (0.02, 0.01), "a": (0.1, 0.3), "ab": (0.2, 0.1), "b": (0.15, 0.1), "ba": (0.05, 0.2)}
WORDS = ["bbb", "bbb" + "q" * 60, "q" * 500, "ab" * 250, "a", "abq" * 30, "\u4e00" * 54]


def exact(word, k, how):
    """The recursion over all segmentations in fractions, as a logarithm."""
    word = "\u2581" + word
    total = [Fraction(1)] + [Fraction(0)] * len(word)
    for i in range(len(word)):
        for j in range(i + 1, min(len(word), i + how.longest_piece + 1) + 1):
            p = PROB[word[i:j]][k] if word[i:j] in PROB else how.stranger if j == i + 1 else 0
            total[j] += total[i] * Fraction(p)
    return math.log(total[-1].numerator) - math.log(total[-1].denominator)


def test_runs_of_any_length_have_their_sums():
    how = language_id.Fit(longest_piece=3)
    words = sorted(WORDS, key=len, reverse=True)
    got = language_id.Model(["x", "y"], PROB, how).log_probabilities(words)
    for n, w in enumerate(words):
        for k in range(2):
            assert got[n, k] == pytest.approx(exact(w, k, how), rel=1e-9)
            total, counts = language_id.expected_counts("\u2581" + w, {p: v[k] for p, v in PROB.items()}, how.longest_piece, how.stranger)
            assert total == pytest.approx(exact(w, k, how), rel=1e-9)
            assert sum(len(p) * x for p, x in counts.items()) == pytest.approx(len(w) + 1)


def test_letters_that_no_piece_covers_do_not_drown_a_word():
    model = language_id.Model(["x", "y"], PROB, language_id.Fit(longest_piece=3))
    (short, p), (long, q) = model.scores(["bbb", "bbb" + "q" * 60])
    assert short == long and p == pytest.approx(q, rel=1e-3)
    assert model.log_probabilities(["\u4e00" * 5000]).shape == (1, 2)


def test_fitting_on_long_runs():
    how = language_id.Fit()
    pieces = frozenset(["\u2581", "\u2581a", "a", "b"])
    for run in ("\u4e00" * 640, "\u4e00" * 54, "\u4e00" * 50):
        got = language_id.fit_pieces(Counter({"ab": 3, run: 1}), pieces, how)
        assert set(got) == pieces and all(0 < x < 1 for x in got.values())


def test_the_sample_is_bounded_by_texts(spark):
    how = language_id.Fit(texts_per_language=20)
    rows = [(i, f"text {i} of many", "en") for i in range(3000)] + [(5, "always the same", "de")] * 2000 + [(i, f"wort {i}", "de") for i in range(30)] + [(1, "une phrase", "fr"), (None, "x", "fr")]
    got = language_id._sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), how, "doc_id", "text", "lang").groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"en": 20, "de": 20, "fr": 1}


def test_no_piece_of_the_vocabulary_is_left_out():
    from siftwright.llm.vocabularies import pieces

    learned = language_id.vocabulary(pieces(), language_id.Fit().longest_piece)
    assert learned == language_id.vocabulary(pieces(), 1000) and "▁information" in learned
