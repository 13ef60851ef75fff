"""Edited and partial copies of benchmark items, and items shorter than an n-gram."""

import random

from siftwright.llm import decontaminate

R = random.Random(12)


def word():
    return "".join(R.choices("abcdefghijklmnop", k=6))


def noise(n):
    return [word() for _ in range(n)]


def test_heavily_edited_and_half_copied_items(spark):
    items = [noise(n) for n in (15, 31, 40, 60)]
    texts = []
    for item in items:
        for share in (0.25, 0.3):
            at = {*range(len(item) - round(share * len(item)), len(item), 2), *range(1, round(share * len(item)), 2)}
            texts.append([f"new{k}" if k in at else w for k, w in enumerate(item)])
            assert len(at) >= round(share * len(item)) - 2
        spread = R.sample(range(6, len(item)), round(0.3 * len(item)))  # the first words stay as a seed
        texts.append([f"new{k}" if k in spread else w for k, w in enumerate(item)])
        texts.append(item[: len(item) // 2])
        texts.append(item[len(item) // 2 :])
    per = len(texts) // len(items)
    df = spark.createDataFrame([(k, " ".join(noise(300) + t + noise(300))) for k, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(df, bench).collect()} == {(k, k // per) for k in range(len(texts))}
    assert decontaminate.clean(df, bench).count() == 0


def test_short_items_in_a_corpus_of_any_size(spark):
    items = ["zebra", "two zebras", "the of and", "one two three four"]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    for n in (20, 3000):
        fill = [R.choice(["the", "of", "and", "one", word()]) for _ in range(n)]
        texts = [" ".join(fill + ["x", item, "y"] + fill) for item in items]
        df = spark.createDataFrame([*enumerate(texts), (9, "nothing here")], "doc_id long, text string")
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.find(df, bench).collect()}
        assert all(got[k, k] == 1 for k in range(len(items))) and 9 not in {d for d, _ in got}


def test_a_template_that_many_items_share(spark):
    template = noise(12)
    items = [template + noise(40) for _ in range(1000)]
    bench = spark.createDataFrame([*enumerate(" ".join(t) for t in items)], "item_id long, text string")
    texts = [noise(200) + template + noise(200), noise(100) + items[17] + noise(100), noise(50)]
    df = spark.createDataFrame([*enumerate(" ".join(t) for t in texts)], "doc_id long, text string")
    seeds = decontaminate.Seeds([(k, " ".join(t)) for k, t in enumerate(items)], decontaminate.Rules())
    assert len({item for item, *_ in seeds.windows(seeds.numbers(" ".join(texts[0])))}) == 1000
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(df, bench).collect()} == {(1, 17)}


def test_a_clean_row_that_shares_an_id_stays(spark):
    item = noise(30)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item)), (3, None)], "item_id long, text string")
    clean, dirty = " ".join(noise(50)), " ".join(noise(50) + item)
    df = spark.createDataFrame([(7, clean, "x"), (7, dirty, "x"), (None, dirty, "x"), (None, clean, "x"), (8, clean, "x"), (9, dirty + " x" * 200_000, "x")], "doc_id long, text string, id string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(df, bench).collect()} == {(d, i) for d in (7, None, 9) for i in (1, 2)}
    got = decontaminate.clean(df, bench)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted([("7", clean), ("None", clean), ("8", clean)])
