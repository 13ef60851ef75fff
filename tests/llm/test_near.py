"""The near-dedup stage: exact overlap decides, not the fingerprints."""

import corpus_pipeline as p
import numpy as np
import pytest

from siftwright.llm import simhash

SF = "/root/testdata/sf0.01"


def shingles(text, n=5):
    w = [x.lower() for x in (text or "").encode("utf-8", "surrogatepass").split()]
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}


def plain_first(rows, least=0.8):
    """The least id of each group, by all pairs."""
    sets = [shingles(r.text) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i]) * least <= len(sets[j]) <= len(sets[i]) / least:
                both = len(sets[i] & sets[j])
                if both >= least * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return [r.doc_id for i, r in enumerate(rows) if root(i) == i]


def test_near_stage_is_exact_overlap(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    got = sorted(r.doc_id for r in p.drop_near_duplicates(spark, docs, SF).collect())
    assert got == plain_first(rows)


def test_near_pairs_at_the_bound(spark):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 400, 304)]  # 300 shingles

    def edited(at):
        return " ".join("other" if k in at else w for k, w in enumerate(base))

    texts = [" ".join(base), edited({50, 100, 150, 200, 250, 280}), edited({20, 50, 80, 110, 140, 170, 200, 230, 260, 290})]  # 30 and 50 shingles gone: 0.82 and 0.71
    df = spark.createDataFrame([*enumerate(texts), (7, None), (8, ""), (9, texts[0])], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, core=0, reach=11).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 7: 7, 8: 7, 9: 0}
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_dense_groups_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = [f"w{x}" for x in rng.integers(0, 400, 120)]
    rows = []
    for k in range(90):
        at = set(rng.choice(120, 1 + k % 5, replace=False).tolist())
        rows.append((k, " ".join(f"x{k}" if i in at else w for i, w in enumerate(base))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(r.doc_id for r in simhash.keep_near(df).collect())
    monkeypatch.setattr(simhash, "UNIT_TEXTS", 8)
    monkeypatch.setattr(simhash, "TILE", 16)
    monkeypatch.setattr(simhash, "BUCKET", 8)
    monkeypatch.setattr(simhash, "ROWS", 4)
    monkeypatch.setattr(simhash, "_ONE_OF", 1)
    assert sorted(r.doc_id for r in simhash.keep_near(df).collect()) == whole
    sets = [shingles(t) for _, t in rows]
    for gone in set(range(90)) - set(whole):  # each has a partner by exact overlap
        assert max(len(sets[gone] & s) / len(sets[gone] | s) for k, s in enumerate(sets) if k != gone) >= 0.8
    assert len(whole) < 90


@pytest.mark.parametrize("radius, bucket, tile", [(10, 1024, 4096), (11, 8, 4096), (11, 32, 16), (6, 4, 4096)])
def test_pairs_across_are_all_pairs(spark, monkeypatch, radius, bucket, tile):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "_ONE_OF", 1)
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (6, 40), dtype=np.uint64), axis=0) for _ in range(5)]))
    core = np.where(np.arange(len(fps)) % 3 == 0, 5, 0)
    nodes = spark.createDataFrame([(int(x), int(c)) for x, c in zip(fps.view(np.int64), core)], "fp long, core long")
    name = np.where(core == 0, fps.view(np.int64), core)
    want = set()
    for i in range(len(fps)):
        for j in range(i):
            if int(fps[i] ^ fps[j]).bit_count() <= radius and (core[i] != core[j] or core[i] == 0):
                u, v = sorted((int(name[i]), int(name[j])))
                want |= {(u, v, int(x)) for x in fps[[i, j]].view(np.int64)}
    assert want and {tuple(r) for r in simhash.pairs_across(nodes, radius).collect()} == want


def test_rows_that_share_an_id_are_told_apart(spark):
    rng = np.random.default_rng(8)
    a, b, c = (" ".join(f"w{x}" for x in rng.integers(0, 5000, 60)) for _ in range(3))
    near = a.rsplit(" ", 1)[0] + " other"
    rows = [(7, a), (7, b), (8, c), (8, c), (9, near), (7, a), (None, b), (None, "quite alone here and nowhere else")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, id string, node int")
    for keep in (simhash.keep_near, simhash.keep_one):
        got = [(r.doc_id, r.text) for r in keep(df).collect()]
        want = [(7, a), (7, b), (8, c), (None, "quite alone here and nowhere else")] + ([(9, near)] if (9, near) in got and keep is simhash.keep_one else [])
        assert sorted(got, key=str) == sorted(want, key=str)
        assert keep(df).columns == df.columns
