"""Each operator against a plain version of itself, and its defined results for odd rows."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siftwright.llm import bpe, decontaminate, html_main_text, language_id, quality_model, quality_rules, simhash, token_files, url_filter, warc
from siftwright.llm import queries as q
from siftwright.llm.vocabularies import pieces, word_bpe

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "x", "the " * 30_000, "a<|endoftext|>b", "é" * 5000, "one two three", "one two three", "İ Σ ΑΣ ﬁ\x1cx", "\n\n", "🙂" * 40]


def docs(spark, texts, ids=None):
    rows = [(i, t, "en", "clash") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id string")  # "id" clashes with an inner name


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe())


# URL filters


def plain_judge(url, rules, default="allow"):
    host, path = url_filter.host_and_path(url)
    text = f".{host}{path}" if host or path else ""
    fits = []
    for r in rules:
        pattern = "".join({"**": r"[\s\S]*", "*": "[^/]*", "?": "[^/]"}.get(t) or re.escape(t) for t in re.findall(r"\*\*|\*|\?|[^*?]+", r.glob))
        if re.fullmatch(pattern, text):
            fits.append(r)
    best = min(fits, key=lambda r: (not r.shown, -len(r.name), -len(r.name.partition("/")[0]), r.verdict != "block"), default=None)
    return host, path, best.name if best and best.shown else None, best.verdict if best else default


def test_url_filter(spark):
    r = random.Random(1)
    parts = ["example", "net", "org", "com", ".", "/", "en", "fr", "de", "?", "#", "casino", "-pills.", "x.exe", "://", "HTTP", ":80", "é"]
    urls = [None, "", "http://", "http://net", "http://NET/", "https://a.example.net/en/x?y#z", "http://notexample.net/en/", "//x", "http://" + "a/" * 5000]
    urls += ["http://" + "".join(r.choice(parts) for _ in range(r.randrange(1, 9))) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = q.URL_RULES + [url_filter.Rule("*a?c**", "*a?c**", "block", False), *(url_filter.Rule(f"r{i}", f"*{i}x*/**y", "block", False) for i in range(40))]
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in url_filter.judge(df, rules).collect()}
    assert got == {i: plain_judge(u, rules) for i, u in enumerate(urls)}
    assert url_filter.Automaton(rules).words > 2
    assert url_filter.judge(df.limit(0), rules).collect() == []


# SimHash


def plain_fingerprint(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[k : k + words]) for k in range(len(w) - words + 1)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum((2 * n > len(shingles)) << b for b, n in enumerate(ones)) if shingles else 0


def plain_components(values, radius):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= radius:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(values))]


def test_fingerprints():
    for t in ODD + ["The the THE a b c " * 900]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)
        assert simhash.fingerprint(t, 5) == plain_fingerprint(t, 5)


def test_simhash_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    roots = plain_components(prints, 2)
    want = {r.doc_id: (f"{p:016x}", rows[k].doc_id) for r, p, k in zip(rows, prints, roots)}
    assert by_id(q.op2_simhash(spark, SF), "fingerprint", "component_id") == want


@pytest.mark.parametrize("radius, tile, bucket", [(2, 4096, 1024), (2, 16, 8), (7, 4096, 16), (11, 4096, 1024), (11, 32, 64), (3, 8, 4), (0, 8, 4)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, radius, tile, bucket):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "ROWS", 8)
    monkeypatch.setattr(simhash, "_ONE_OF", 1)
    r = random.Random(radius)
    values = set()
    for _ in range(40):
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 2, 30])):
            for _ in range(r.randrange(0, radius + 3)):
                x ^= 1 << r.randrange(64)
            values.add(x)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = {x.node: x.root for x in simhash.components(simhash.links(nodes, radius)).collect()}
    groups, want = collections.defaultdict(set), collections.defaultdict(set)
    for s, root in zip(signed, plain_components(values, radius)):
        groups[found.get(s, s)].add(s)
        want[root].add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_forest_is_sparse_and_connects():
    base = np.uint64(12345678901234567)
    fps = np.array([base ^ np.uint64(1 << a) ^ np.uint64(1 << b) for a in range(30) for b in range(a)], np.uint64)
    fps = fps[np.argsort(np.bitwise_count(fps), kind="stable")]
    a, b = simhash.forest(np.zeros(len(fps), np.int64), fps, 4)
    assert len(a) == len(fps) - 1
    assert all(bin(int(x) ^ int(y)).count("1") <= 4 for x, y in zip(a, b))


def test_tile_pairs_are_skipped_by_population_count(spark):
    """On a real table: the tiles that the query compares are skipped where no pair can link, and no pair is lost."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").limit(4000).collect()
    fps = np.unique(np.array([simhash.fingerprint(r.text) for r in rows], np.uint64))
    fps = fps[np.argsort(np.bitwise_count(fps), kind="stable")]
    tally = simhash.Tally()
    got = {(x, y) for xs, ys in simhash.tile_hits(np.zeros(len(fps), np.int64), fps, 2, tally) for x, y in zip(xs.tolist(), ys.tolist())}
    x, y = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2)
    assert got == {(a, b) for a, b in zip(x.tolist(), y.tolist()) if a < b}
    n = -(-len(fps) // simhash.ROWS)
    assert tally.compared + tally.skipped == n * (n + 1) // 2 and tally.skipped > n


def test_simhash_odd_rows(spark):
    df = docs(spark, ODD + ["one two three"], [*range(len(ODD)), 7]).unionByName(docs(spark, ["lonely words here"], [None]))
    out = simhash.group(df).collect()
    assert len(out) == df.count()
    assert {r.component_id for r in out if r.doc_id in (0, 1, 2, 10)} == {0}
    assert {r.component_id for r in out if r.doc_id in (7, 8)} == {7}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(7) == 1 and 8 not in ids and None in ids and 0 in ids and 1 not in ids
    assert simhash.group(df.limit(0)).collect() == [] and simhash.keep_one(df.limit(0)).collect() == []


# BPE


def test_bpe_equals_the_library(library):
    texts = [t or "" for t in ODD] + ["Don't we'll I'VE 12'S", "Z" * 3000, "<|startoftext|>A<|endoftext|><|endof", "中文字符 हिन्दी ①½ Å"]
    e = bpe.RankArrayEncoder(word_bpe())
    for t, ids, want in zip(texts, e.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == want.ids, t[:40]
        assert e.decode(want.ids) == library.decode(want.ids, skip_special_tokens=False)
        assert e.decode(want.ids, True) == library.decode(want.ids, skip_special_tokens=True)


def test_bpe_table_may_overflow(library, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 50)
    monkeypatch.setattr(bpe, "TOGETHER_CHARS", 300)
    e = bpe.RankArrayEncoder(word_bpe())
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("abcdeth", k=r.randrange(1, 9))) for _ in range(40)) for _ in range(60)]
    assert [x.tolist() for x in e.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_long_words_merge_alike(library):
    e = bpe.RankArrayEncoder(word_bpe())
    r = random.Random(6)
    for n in (255, 256, 257, 900):
        w = "".join(r.choices("theaninger", k=n))
        assert next(e.encode([w])).tolist() == library.encode(w, add_special_tokens=False).ids


def test_bpe_query(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert by_id(q.op3_bpe_round_trip(spark, SF), "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_bpe_odd_rows(spark, library):
    df = docs(spark, ODD)
    ids = by_id(bpe.encode(df, word_bpe()), "ids")
    assert {k: list(v[0]) for k, v in ids.items()} == {k: library.encode(t or "", add_special_tokens=False).ids for k, t in enumerate(ODD)}
    back = bpe.decode(bpe.encode(df, word_bpe()), word_bpe())
    assert by_id(back, "text")[7] == ("one</w> two</w> three</w>",)
    assert bpe.round_trip(df.limit(0), word_bpe()).collect() == []


# Token files


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64))
    h = token_files.PerfectHash.build(keys)
    assert np.array_equal(np.sort(h.slots(keys)), np.arange(len(keys)))
    assert len(token_files.PerfectHash.build(keys[:0]).slots(keys[:0])) == 0


def test_token_files_query(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want, start = {}, 0
    for r in rows:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        want[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert by_id(q.op4_token_files(spark, SF), "start", "n_tokens", "ids_crc32") == want


def test_token_files_have_more_shards_for_a_larger_table(spark, monkeypatch, tmp_path):
    docs(spark, [f"text {k}" for k in range(300)]).write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    few = token_files.read(spark, token_files.write(df, word_bpe(), 1)).collect()
    assert token_files.shard_count(df.select("doc_id", "text")) is None
    monkeypatch.setattr(token_files, "SHARD_BYTES", 512)
    shards = token_files.write(df, word_bpe(), 1)
    assert shards.count() > 4 and sorted(token_files.read(spark, shards).collect()) == sorted(few)


def test_token_files_keyed_access_and_odd_rows(spark, library):
    df = docs(spark, ODD + ["again", "a twin"], [*range(0, 10 * len(ODD), 10), None, 20])
    shards = token_files.write(df, word_bpe(), 1)
    rows = token_files.read(spark, shards, ids=True).collect()
    assert len(rows) == df.count() and sum(r.n_tokens for r in rows) == shards.agg({"n_tokens": "sum"}).first()[0]
    spans = sorted((r.start, r.start + r.n_tokens) for r in rows)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert [r.key for r in sorted(rows, key=lambda r: r.start)][0] is None
    for s in shards.collect():
        shard = token_files.Shard(s.path)
        for k, t in zip(range(0, 10 * len(ODD), 10), ODD):
            got = shard.get(k)
            if s.low <= k <= s.high:
                assert [*library.encode(t or "", add_special_tokens=False).ids, 1] in [x.tolist() for x in got]
                assert len(got) == (2 if k == 20 else 1)
        assert sum(len(shard.get(k)) for k in range(1, 4000, 10)) <= 2  # one in 65,536 foreign keys is taken for another
    assert token_files.read(spark, token_files.write(df.limit(0), word_bpe(), 1)).collect() == []


# Quality rules


def plain_repeats(words, n=5):
    grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
    twice = {g for g, c in collections.Counter(grams).items() if c > 1}
    return len({k + i for k, g in enumerate(grams) if g in twice for i in range(n)})


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, plain_repeats(words)


def test_quality_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = by_id(q.op5_quality_rules(spark, SF), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for r in rows:
        n = plain_counts(r.text)
        failed = n[0] < 10 or 100 * n[4] > 20 * n[0]
        assert got[r.doc_id][:6] == (*n, failed)
        assert not (failed and got[r.doc_id][6])


def test_quality_separates_labelled_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = q.op5_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("quality", "kept").collect()
    share = lambda quality: sum(r.kept for r in rows if r.quality == quality) / sum(r.quality == quality for r in rows)
    assert share(1) > 0.95 and share(0) < 0.1


def test_distance():
    p, rows = np.array([0.5, 0.5, 0]), np.array([[0.5, 0.5, 0], [0, 0, 1.0], [0.25, 0.25, 0.5]])
    d = quality_rules.distance(p, rows)
    assert d[0] == 0 and d[1] == 1 and 0 < d[2] < 1


def test_quality_odd_rows(spark):
    df = docs(spark, ODD)
    got = by_id(quality_rules.judge(df), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == {k: plain_counts(t) for k, t in enumerate(ODD)}
    assert quality_rules.keep(df).columns == df.columns
    assert quality_rules.judge(df.limit(0)).collect() == [] and quality_rules.keep(df.limit(0)).collect() == []


# HTML


def plain_cut(evidence, edges):
    """The least cost of all labellings."""
    n = len(evidence)
    best = None
    for mask in range(1 << n):
        cost = sum(max(0, e) if not mask >> k & 1 else max(0, -e) for k, e in enumerate(evidence)) + sum(w for a, b, w in edges if (mask >> a ^ mask >> b) & 1)
        best = cost if best is None else min(best, cost)
    return best


def test_minimum_cut():
    r = random.Random(2)
    for _ in range(200):
        n = r.randrange(1, 9)
        evidence = [r.randrange(-9, 10) for _ in range(n)]
        edges = [(a, b, r.randrange(0, 9)) for a in range(n) for b in range(a) if r.random() < 0.5]
        side = html_main_text.source_side(evidence, edges)
        cost = sum(max(0, e) if not s else max(0, -e) for e, s in zip(evidence, side)) + sum(w for a, b, w in edges if side[a] != side[b])
        assert cost == plain_cut(evidence, edges)


PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1><p>The best site in the world for everything you want to know.</p></header>
<ul id="menu"><li><a href=x>Home</a><li><a href=y>About us and more</a></ul><div class="cookie-notice"><p>We use cookies to give you the best experience, so please accept them all.</p></div>
<article><h1>Title &amp; more</h1><p>First   paragraph of the article with<br>a good number of words in it.<p>Short.<script>var x = "</p>";</script>
<blockquote>Quoted words</blockquote><div class="advert">Buy our product now and get fifty percent off everything in store today</div>
<form><label>Name</label><p>Sign up for our newsletter and get the best of our content</p></form><p>Last &eacute; &lt;b&gt;.</p>
<section id="comments"><p>I liked this article a lot and want to say so in many words.</p></section></article>
<aside><p>Related story about other things you may like to read next</p></aside><footer><p>Copyright of everyone who worked on this</p></footer></body></html>"""


def test_main_text():
    assert html_main_text.main_text(PAGE) == "Title & more\nFirst paragraph of the article with a good number of words in it.\nShort.\nQuoted words\nLast é <b>."
    for cut in range(0, len(PAGE), 7):
        html_main_text.main_text(PAGE[:cut])


def test_attributes():
    whole, words, hidden = html_main_text._names(' data-id="menu" aria-label="hidden menu" class="story"')
    assert whole == {"story"} and not words and not hidden
    whole, words, hidden = html_main_text._names(" CLASS=sideBar hidden")
    assert "sidebar" in whole and hidden
    whole, words, hidden = html_main_text._names(' class="site-nav related-work"')
    assert {"nav", "work", "site-nav"} <= whole and "related" in words - whole
    assert html_main_text._names("style='color:red; display : none'") == (set(), set(), True)


REST = "<p>The rest of the page, which has a good many words of its own.</p>"
AFTER = "The rest of the page, which has a good many words of its own."


@pytest.mark.parametrize(
    "inside, want",
    [
        ('<svg class="i"/>', None),
        ("<svg><path d=x><text>Label</text></svg>", None),
        ("<svg><path d=x>", None),
        ('<datalist><option value="a"><option value="b"></datalist>', None),
        ("<select><option>One<option>Two</select>", None),
        ("<select><option>One", None),
        ("<video><p>Your browser shows no videos at all.</p></video>", None),
        ("<button>Share</button>", None),
        ("<p>Press <button>Start</button> to begin the measurement of all values.</p>", "Press Start to begin the measurement of all values."),
        ("<p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is a number that we need below.</p>", "The sum a+b is a number that we need below."),
        ('<object data="x"><p>The picture shows a river with two bridges over it.</p></object>', "The picture shows a river with two bridges over it."),
        ('<p class="social-history">He never smoked and lives with two sisters in a small town.</p>', "He never smoked and lives with two sisters in a small town."),
        ('<section class="related-work"><p>Others have measured this before us, with other tools.</p></section>', "Others have measured this before us, with other tools."),
        ('<section class="discussion"><p>Our results agree with those of others who looked at it.</p></section>', "Our results agree with those of others who looked at it."),
        ('<div class="comment-body"><p>I liked this article a lot and want to say so here.</p></div>', None),
        ('<div class="related"><a href=a>Another story</a> <a href=b>One more story to read</a></div>', None),
    ],
)
def test_what_stays_of_an_article(inside, want):
    first = "<p>First paragraph of the article with a good number of words in it.</p>"
    page = f"<html><body><nav><a href=x>Home</a></nav><article><h1>Title of it</h1>{first}{inside}{REST}</article><footer>Copyright of all</footer></body></html>"
    assert html_main_text.main_text(page).split("\n")[2:] == ([want] if want else []) + [AFTER]


def test_pages_without_an_article():
    body = "".join(f"<p>Paragraph {k} tells some more of the story with a fair number of plain words, and then it ends.</p>" for k in range(4))
    for open_, close in (("<div class=post-content>", "</div>"), ("<div>", "</div>"), ("<main>", "</main>"), ("<td>", "</td>")):
        page = f"<body><div class=site-nav><a href=a>Home</a> <a href=b>News of today</a></div>{open_}<h2>Heading of the story</h2>{body}{close}<div id=sidebar><p>Other things that we sell here to everyone who reads this.</p></div><div class=page-footer>Copyright of us</div></body>"
        got = html_main_text.main_text(page).split("\n")
        assert got[-4:] == [f"Paragraph {k} tells some more of the story with a fair number of plain words, and then it ends." for k in range(4)] and len(got) <= 5, (open_, got)


def test_html_query(spark):
    import html

    for r in q.op6_html_main_text(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").drop("url"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>|<[^>]*$", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in want if p) and r.n_chars == len(r.text)


def test_html_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, "a"), (2, "u", "", "a"), (2, "u", "", "a"), (3, "u", "<p>" * 3000 + "deep", "a"), (None, "u", "<b", "a"), (5, "u", "<a " + "'" * 5001 + ">", "a")], "page_id long, url string, html string, id string")
    assert html_main_text.extract(df).count() == 6 and html_main_text.extract(df.limit(0)).collect() == []


# WARC


def test_warc_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    twins = pages.limit(20).selectExpr("page_id + 100000 AS page_id", "url", "html")
    more = spark.createDataFrame([(-1, None, None, 1), (-2, "http://x y/é\r\n", "", 1), (None, "u", "", 1), (200001, "u", "é" * 90_000, 1)], "page_id long, url string, html string, key int")
    df = pages.unionByName(twins).unionByName(more.drop("key")).withColumn("digest", F.lit("clash"))
    rows = df.collect()
    payload = lambda r: (r.html or "").encode()
    last = {}
    for r in rows:
        if r.page_id is not None:
            last[payload(r)] = max(last.get(payload(r), -(10**9)), r.page_id)
    want = sorted((str(r.page_id) if r.page_id is not None else "", len(payload(r)), base64.b32encode(hashlib.sha1(payload(r)).digest()).decode(), "response" if last[payload(r)] == r.page_id else "revisit", str(last[payload(r)]) if last[payload(r)] != r.page_id else "") for r in rows)
    archives = warc.write(df)
    for split in (4 << 20, 999):
        got = warc.read(spark, archives, split_bytes=split, payloads=True).collect()
        assert sorted((r.key or "", r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or "") for r in got) == want
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == {payload(r) for r in rows}
    small = warc.read(spark, warc.write(df, min_bytes=10**9)).filter("record_type = 'revisit'")
    assert small.count() == 0
    assert warc.read(spark, warc.write(df.limit(0))).collect() == []


def test_warc_members_are_plain_gzip():
    import gzip

    raw = warc.member(warc.Record("1", "response", "http://a/", 2, warc.digest32(b"hi"), None, b"hi"), "2000-01-01T00:00:00Z")
    text = gzip.decompress(raw + raw)
    assert text.count(b"WARC/1.1") == 2 and text.endswith(b"hi\r\n\r\n")


def test_magic_inside_a_record_is_no_record():
    import io

    body = b"\x1f\x8b\x08" * 5000 + bytes(range(256)) * 50
    raw = b"".join(warc.member(warc.Record(str(k), "response", None, len(body), warc.digest32(body), None, body), "2000-01-01T00:00:00Z", level=0) for k in range(4))
    for n in (1000, 5000, len(raw)):
        assert [r.key for begin in range(0, len(raw), n) for r in warc.records_in(io.BytesIO(raw), begin, min(begin + n, len(raw)))] == ["0", "1", "2", "3"]


# Language ID


def plain_probability(word, prob, stranger, longest):
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, min(len(word), longest) + 1):
        p = prob.get(word[:k], stranger if k == 1 else 0.0)
        total += p * plain_probability(word[k:], prob, stranger, longest) if p else 0.0
    return total


def test_forward_sums_all_segmentations():
    how = language_id.Fit(longest_piece=3)
    prob = {"▁": (0.1, 0.2), "▁a": (0.2, 0.05), "a": (0.1, 0.3), "ab": (0.2, 0.1), "b": (0.15, 0.1), "ba": (0.05, 0.2), "aba": (0.2, 0.05)}
    m = language_id.Model(["x", "y"], prob, how)
    for w in ("a", "abab", "bca", "aabba"):
        got = m.log_probabilities([w])[0]
        for k in range(2):
            want = plain_probability("▁" + w, {p: v[k] for p, v in prob.items()}, how.stranger, how.longest_piece + 1)
            assert got[k] == pytest.approx(np.log(want))
            total, counts = language_id.expected_counts("▁" + w, {p: v[k] for p, v in prob.items()}, how.longest_piece, how.stranger)
            assert total == pytest.approx(np.log(want))
            assert sum(len(p) * n for p, n in counts.items()) == pytest.approx(len(w) + 1)  # the pieces cover the word


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = q.op8_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").collect()
    assert len(got) > 250 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)


def test_language_odd_rows(spark):
    train = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, "x", None), (4, None, "en")], "doc_id long, text string, lang string")
    m = language_id.fit(train, pieces())
    assert m.languages == ["de", "en"]
    df = docs(spark, [None, "", "123 !!", "the dog", "die Katze", "the dog", "z" * 100_000])
    got = by_id(language_id.detect(df, m), "lang_pred", "score")
    assert got[0] == got[1] == got[2] == ("und", 0.0) and got[3][0] == got[5][0] == "en" and got[4][0] == "de"
    assert [r.doc_id for r in language_id.keep(df, m).orderBy("doc_id").collect()][:3] == [3, 4, 5]
    nothing = language_id.fit(train.limit(0), pieces())
    assert set(by_id(language_id.detect(df, nothing), "lang_pred").values()) == {("und",)} and language_id.detect(df.limit(0), m).collect() == []


# Quality classifier


def test_quality_model_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = q.op9_quality_model(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    good, bad = sorted(r.score for r in rows if r.quality == 1), sorted(r.score for r in rows if r.quality == 0)
    auc = sum(np.searchsorted(bad, s) for s in good) / len(good) / len(bad)
    assert auc > 0.97 and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_ftrl_and_sparse_scores(spark):
    rows = [("good plain words", 1), ("BAD!! WORDS!!", 0)] * 30
    how = quality_model.Fit(bits=12)
    w = quality_model.train(rows, how)
    h = quality_model.Hasher(12)
    dense = np.zeros(1 << 12)
    i, x = h.vector("good plain words")
    np.add.at(dense, i, x)
    got = by_id(quality_model.score(docs(spark, ["good plain words", "BAD!! WORDS!!", None, ""]), w), "score")
    assert got[0][0] == pytest.approx(quality_model.logistic(float(dense @ w))) and got[0][0] > 0.7 > got[1][0] and got[2] == got[3]
    assert quality_model.shape("THE!!") == "A!!" and quality_model.shape("Été9") == "Aa0"
    empty = quality_model.fit(docs(spark, ["x"]), spark.createDataFrame([], "doc_id long, quality int"))
    assert by_id(quality_model.score(docs(spark, ["x"]), empty), "score")[0] == (0.5,)


# Decontamination


def plain_alignment(a, b, match=2, mismatch=-1, gap=-1):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (match if x == y else mismatch), row[j + 1] + gap, new[j] + gap))
        row = new
        best = max(best, *row)
    return best


def test_alignment():
    r = random.Random(4)
    for _ in range(150):
        a, b = ([r.randrange(1, 5) for _ in range(r.randrange(1, 15))] for _ in range(2))
        assert decontaminate.smith_waterman(np.array(a), np.array(b), decontaminate.Rules())[0] == plain_alignment(a, b)


def test_decontaminate_query(spark):
    sf = "/root/testdata/sf0.01"
    words = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(r.doc_id, i) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for i, w in items if w in words(r.text)}
    got = {(r.doc_id, r.item_id): r.score for r in q.op10_decontaminate(spark, sf).collect()}
    assert want and want <= set(got) and all(got[p] == 1 for p in want)
    assert len(got) <= 1.2 * len(want)


def test_edited_copies_and_odd_rows(spark, monkeypatch):
    r = random.Random(9)
    word = lambda: "".join(r.choices("abcdefghijklmnop", k=6))
    item = [word() for _ in range(40)]
    noise = lambda n: [word() for _ in range(n)]
    edited = item[:10] + ["new"] + item[10:20] + item[22:30] + ["other"] + item[31:]
    texts = [None, "", " ".join(noise(400)), " ".join(noise(200) + item + noise(200)).upper(), " ".join(noise(30) + edited), " ".join(item[:12] + noise(50)), " ".join(noise(10) + item + noise(300) + item)]
    bench = spark.createDataFrame([(1, " ".join(item), "c"), (2, None, "c"), (3, "", "c"), (4, "short item", "c"), (1, " ".join(item), "c")], "item_id long, text string, id string")
    df = docs(spark, texts)
    for seeds in (2_000_000, 30):
        got = {(x.doc_id, x.item_id): x.score for x in decontaminate.find(df, bench, decontaminate.Rules(broadcast_words=seeds)).collect()}
        assert set(got) == {(3, 1), (4, 1), (6, 1)} and got[3, 1] == got[6, 1] == 1 and 0.8 <= got[4, 1] < 1
    clean = decontaminate.clean(df, bench)
    assert sorted(x.doc_id for x in clean.collect()) == [0, 1, 2, 5] and clean.columns == df.columns
    assert decontaminate.find(df.limit(0), bench).collect() == [] and decontaminate.find(df, bench.limit(0)).collect() == []
