"""The quality classifier against a plain one: scalar FTRL-proximal over features that are hashed one by one."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from siftwright.llm import quality_model

R = random.Random(4)


def kind(c):
    if "A" <= c <= "Z" or "À" <= c <= "Ö" or "Ø" <= c <= "Þ":
        return "A"
    return "0" if c.isdigit() and c.isdecimal() else "a" if c.isalpha() else c


def plain_shape(word):
    out = ""
    for c in word:
        k = kind(c)
        if k not in "Aa0" or not out.endswith(k):
            out += k
    return out


def plain_features(text, bits):
    words = text.split()
    own = [zlib.crc32(w.encode()) for w in words]
    kinds = [zlib.crc32(plain_shape(w).encode()) for w in words]
    kinds = [zlib.crc32(b"=") if k and own[k] == own[k - 1] else x for k, x in enumerate(kinds)]
    wide = 1 << 64
    place = lambda x: (x * 0x9E3779B97F4A7C15 % wide) >> (64 - bits)
    out = [(0, 1.0)]
    for salt, xs in ((1, own), (3, kinds)):
        if not xs:
            continue
        n = Counter(place(x * 8 % wide + salt) for x in xs)
        n.update(place((a * 31 + b) * 8 % wide + salt + 1) for a, b in zip(xs, xs[1:]))
        length = math.sqrt(sum(c * c for c in n.values()))
        out += [(p, c / length) for p, c in n.items()]
    return out


def plain_train(rows, how):
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= how.l1:
            return 0.0
        return -(z[i] - math.copysign(how.l1, z[i])) / ((how.beta + math.sqrt(n[i])) / how.alpha + how.l2)

    for _ in range(how.rounds):
        for text, label in rows:
            x = plain_features(text, how.bits)
            w = [weight(i) for i, _ in x]
            p = 1 / (1 + math.exp(-sum(a * v for a, (_, v) in zip(w, x))))
            steps = []
            for a, (i, v) in zip(w, x):
                g = (p - label) * v
                steps.append((i, g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / how.alpha * a, g * g))
            for i, dz, dn in steps:
                z[i] += dz
                n[i] += dn
    return {i: weight(i) for i in z if weight(i)}


def text(good):
    words = ["the", "The", "cat", "SAT", "on", "12", "mat!!", "é1", "Ünder"] if good else ["buy", "BUY", "now", "now", "$$$", "9%", "|"]
    return " ".join(R.choices(words, k=R.randrange(0, 30)))


def test_training_is_plain_ftrl():
    how = quality_model.Fit(bits=18)
    rows = [(text(k % 2), k % 2) for k in range(120)] + [("", 1), ("one", 0), ("now now now", 0)]
    got, want = quality_model.train(rows, how), plain_train(rows, how)
    assert set(np.flatnonzero(got)) == set(want)
    for i, w in want.items():
        assert got[i] == pytest.approx(w, rel=1e-6, abs=1e-9)


def test_scores_and_odd_rows(spark):
    how = quality_model.Fit(texts=50)
    docs = spark.createDataFrame([(k, text(k % 2), "x") for k in range(40)] + [(3, "again " * 5, "x"), (None, "no id", "x"), (90, "long " * 200_000, "x"), (91, None, "x"), (91, None, "x")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(3, 1), (None, 1), (90, None)], "doc_id long, quality int")
    weights = quality_model.fit(docs, labels, how)
    rows = docs.collect()
    got = sorted((str(r.doc_id), round(r.score, 9)) for r in quality_model.score(docs, weights).collect())
    plain = lambda t: 1 / (1 + math.exp(-sum(weights[i] * v for i, v in plain_features(t or "", how.bits))))
    assert got == sorted((str(r.doc_id), round(plain(r.text), 9)) for r in rows)
    assert quality_model.score(docs.limit(0), weights).collect() == []
    assert not quality_model.fit(docs.limit(0), labels, how).any()


def test_fit_streams_the_rows_in_the_order_of_the_hash(spark):
    how = quality_model.Fit(texts=25, rounds=3)
    docs = spark.createDataFrame([(k, text(k % 2)) for k in range(40)] + [(3, "again and again")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    hashes = {r[0]: r[1] for r in labels.selectExpr("doc_id", "xxhash64(cast(doc_id as string))").collect()}
    taken = sorted(hashes, key=hashes.get)[:25]
    rows = sorted((hashes[r.doc_id], r.doc_id, r.doc_id % 2, r.text) for r in docs.collect() if r.doc_id in taken)
    assert np.array_equal(quality_model.fit(docs, labels, how), quality_model.train([(r[3], r[2]) for r in rows], how))
