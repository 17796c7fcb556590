"""HTML extraction, vector codes and phrases against plain brute force, and their edge cases."""

import hashlib
import random
import re
import time
from collections import Counter
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.llm import extraction, pages, phrases, vectorcodes
from pitpanel.llm.common import looked_up

SF = "/root/testdata/sf0.001"


# common: lookups that don't gather hot keys


def test_lookup_of_hot_and_null_keys(spark):
    keys = [None] * 3000 + [1] * 3000 + list(range(2000)) + [-1]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    table = spark.createDataFrame([(k, f"v{k}") for k in [None, *range(2000)]], "k int, v string")
    got = Counter((r.k, r.i, r.v) for r in looked_up(rows, table, ["k"]).collect())
    assert got == Counter((k, i, None if k == -1 else f"v{k}") for i, k in enumerate(keys))


# 11: HTML extraction


def texts(html):
    return [b.text for b in pages.blocks(html)]


@pytest.mark.parametrize(
    "html, want",
    [
        ("", []),
        ("just text &amp; more", ["just text & more"]),
        ("<p>a<br>b\n\t c</p><p>d", ["a b c", "d"]),
        ("<p><b>bold <i>x<br><p>next</p>", ["bold x", "next"]),
        ('<script>var t="</p>";</script><p>a</p><style>p{}</style>', ["a"]),
        ("<p>a<!-- <p>no</p> -->b<script>x</script>c</p>", ["abc"]),
        ("<ul><li>one<li>two<ul><li>in</ul></ul>tail", ["one", "two", "in", "tail"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("a < b and 3 <5 <p title='x>y'>z", ["a < b and 3 <5", "z"]),
        ("<p class=x' >it's</p><p>don't</p>", ["it's", "don't"]),
        ("<p>&eacute;&#233;&#xe9;&nbsp;x &unknown; &lt;p&gt;</p>", ["ééé x &unknown; <p>"]),
        ("<p>open <a href='x", ["open"]),
        ("<p>a<!-- never closed <p>b", ["a"]),
        ("<P>Upper</P><DIV>Case</DIV>", ["Upper", "Case"]),
        ("</div></p>stray<p>x</p></section>", ["stray", "x"]),
        ("<svg><path d='M0'/></svg><p>after", ["after"]),
    ],
)
def test_blocks(html, want):
    assert texts(html) == want


def test_paths_and_links():
    found = pages.blocks('<body><div class="postBody main-col" id=X1><p>plain</p><p><a href="/">link</a> no</p></div><nav><a>l</a></nav>')
    assert [[e.name for e in b.path] for b in found] == [["", "body", "div", "p"]] * 2 + [["", "body", "nav"]]
    assert found[0].path[2].words == ("<div", "post", "body", "main", "col", "x")
    assert [round(b.links, 2) for b in found] == [0, 0.67, 1]


@pytest.mark.parametrize("part", ["<b>", "<div>", "<p>", "<a '", '<a "', "<", "<!--", "</b>", "<i><div>", "<p><td><b>", "<a href=", "&amp", "<li>x", "</x></div>", "<b></p>"])
def test_markup_is_read_in_linear_time(part):
    began = time.time()
    pages.blocks(part * 60_000 + "<p>end")
    assert time.time() - began < 8


def test_gradient_is_that_of_the_loss():
    rng, reader = np.random.default_rng(0), extraction.Reader()
    model = extraction.Labeller()
    found = [pages.blocks("<nav>a b</nav><p>c d. e<p>f g h"), pages.blocks("<p>x</p>")]
    read, labels = [reader(b) for b in found], [np.array([0, 1, np.nan], np.float32), np.array([1], np.float32)]

    def loss():
        lengths = np.array([3, 1])
        x = np.zeros((2, 3, 2 * extraction.WIDTH + 3), np.float32)
        for i, page in enumerate(read):
            x[i, : lengths[i]] = model.vectors(page)
        z = model.logits(x, lengths).astype(np.float64)
        return np.mean([np.log1p(np.exp(-s * v)) for s, v in ((-1, z[0, 0]), (1, z[0, 1]), (1, z[1, 0]))])

    grads = model.gradients(read, labels)
    for p, g in zip(model.parameters(), grads, strict=True):
        at = np.unravel_index(np.argsort(-np.abs(g), axis=None)[rng.integers(5)], g.shape)
        kept, step = p[at], np.float32(1e-2)
        p[at] = kept + step
        high = loss()
        p[at] = kept - step
        low = loss()
        p[at] = kept
        assert abs((high - low) / (2 * step) - g[at]) < 2e-3 + 0.03 * abs(g[at])


@pytest.fixture(scope="module")
def model():
    import pyarrow.parquet as pq

    htmls = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    return extraction.trained([h for h in htmls if len(h) <= extraction.SAMPLE_CHARS])


def article(html):
    """By the one template of the given pages."""
    out = [" ".join(unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", re.search("<article>(.*?)</article>", html, re.S)[1])]
    return "\n\n".join(p for p in out if p)


def test_extraction_of_given_pages(spark, model):
    other = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 250")
    html = {r.page_id: r.html for r in other.select("page_id", "html").collect()}
    got = {r.page_id: r for r in extraction.extracted(other, model).collect()}
    assert got.keys() == html.keys() and all(r.n_chars == len(r.text) for r in got.values())
    assert sum(got[i].text == article(h) for i, h in html.items()) >= 0.99 * len(html)


def test_extraction_of_held_out_layouts(model):
    import pyarrow.parquet as pq

    htmls = pq.read_table("/root/testdata/sf0.1/pages.parquet").column("html").to_pylist()[500:800]
    found, rng, reader = [pages.blocks(h) for h in htmls], np.random.default_rng(77), extraction.Reader()
    words = [w for bs in found for b in bs for w in b.text.split()]

    def snip(a, b):
        start = rng.integers(len(words) - 100)
        return " ".join(words[start : start + rng.integers(a, b + 1)])

    made = [pages.layout(rng, [b.text for b in bs if pages.known(b) == 1][:50], snip) for bs in found]
    chosen = np.concatenate(model.judge([reader(b) for b, _ in made]))
    truth = np.concatenate([y for _, y in made]) > 0
    assert (chosen & truth).sum() >= 0.98 * truth.sum() and (chosen & truth).sum() >= 0.98 * chosen.sum()


SITE = """<html><head><title>T</title><style>a{}</style></head><body><div id="cookie-consent">We use cookies. <button>OK</button></div>
<header class="site-header"><a href="/">Logo</a><form><input><button>Search</button></form></header><ul class="menu"><li><a href="/">Home</a><li><a href="/x">News</a></ul>
<div class="wrapper"><div class="post-content"><h1>A title of the text</h1><p>The first paragraph of the text is here, and it is long enough to read.</p><div class="ad">Buy now</div>
<p>The second paragraph&#8212;with a <a href="/">link</a> in it.</p></div><aside class="sidebar"><h3>Related</h3><ul><li><a href="/1">One more text</a></ul></aside>
<div class="comments"><div class="comment"><p>I do not agree with the writer of this at all, it is wrong.</p></div></div></div><div class="footer">© 2024 All rights reserved</div></body></html>"""


def test_extraction_of_another_site(model):
    found = pages.blocks(SITE)
    got = extraction.main_text(found, model.judge([extraction.Reader()(found)])[0])
    assert got == "A title of the text\n\nThe first paragraph of the text is here, and it is long enough to read.\n\nThe second paragraph—with a link in it."


def test_extraction_edges(spark, model):
    long = "<article>" + "<p>a long paragraph of some words.</p>" * 30_000 + "</article>"
    rows = [(1, "u", None, 1), (2, None, "", 2), (3, "v", SITE, 3), (3, "v", SITE, 3), (None, "w", "<!-- -->", 4), (5, "x", long, 5), (6, "y", "<p>" + "word " * 400_000, 6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").withColumn("n_chars", F.lit("x"))
    got = extraction.extracted(df, model).collect()
    assert [(r.page_id, r.url) for r in got] == [r[:2] for r in rows]
    assert [r.text for r in got[:2]] == ["", ""] and got[4].text == "" and got[2] == got[3]
    assert len(pages.blocks(long)) == 30_000 and got[5].n_chars > 0.9 * 30_000 * 32
    assert extraction.extract(df.limit(0)).collect() == []


# 12: vector codes


def scan(parts, book):
    far = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    return far.argmin(axis=1), far.min(axis=1)


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = sorted(((i, v) for i, v in rows), key=lambda x: x[0])
    x = np.floor(np.array([v for _, v in kept], np.float64) * 1024).astype(np.int64).reshape(len(kept), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            code = scan(x[:, p], books[p])[0]
            for j in set(code.tolist()):
                own = x[code == j, p]
                books[p][j] = own.sum(axis=0) // len(own)
    found = [scan(x[:, p], books[p]) for p in range(parts)]
    codes = ["".join(f"{f[0][i]:02x}" for f in found) for i in range(len(kept))]
    h = hashlib.sha256(",".join(str(c) for b in books for e in b.tolist() for c in e).encode()).hexdigest()
    return {i: (codes[n], int(sum(f[1][n] for f in found))) for n, (i, _) in enumerate(kept)}, h


@pytest.mark.parametrize("n, k, d, most", [(300, 256, 16, 300), (200, 7, 3, 2), (40, 1, 1, 9), (500, 256, 2, 2), (30, 40, 5, 1 << 22), (30, 40, 5, 1 << 45)])
def test_nearest_equals_full_scan(n, k, d, most):
    rng = np.random.default_rng(n)
    parts, book = rng.integers(-most, most, (n, d)), rng.integers(-most, most, (k, d))
    book[k // 2 :] = book[: k - k // 2]  # ties
    code, far = vectorcodes.nearest(parts, book)
    want = scan(parts.astype(object), book.astype(object))
    assert code.tolist() == want[0].tolist() and [int(x) for x in far] == [int(x) for x in want[1]]


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 8).round(2).tolist(), i % 3 if i % 5 else None) for i in range(900)]
    rows[10:400] = [(i, rows[7][1], 1) for i in range(10, 400)]  # one vector many times
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(7)
    want, h = plain_codes([(i, v) for i, v, _ in rows])
    got = vectorcodes.compress(df).collect()
    assert {r.vec_id: (r.code, r.error) for r in got} == want and {r.codebooks_sha256 for r in got} == {h}
    sums = Counter()
    for i, _, label in rows:
        sums[label] += want[i][1]
    label = {i: n for i, _, n in rows}
    assert all(r.label_error == sums[label[r.vec_id]] for r in got)


def test_code_edges(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, 0), (2, [0.0, None, 0.0, 0.0], 0), (3, [nan, 0.0, 0.0, 0.0], 0), (4, [inf, 0.0, 0.0, 0.0], None)]
    good = [(5, [0.5, -0.5, 0.25, 1.0], 0), (5, [0.5, -0.5, 0.25, 1.0], 0), (None, [9.0, 9.0, 9.0, 9.0], None), (6, [1.0, 2.0], 0), (7, [1e6, -1e6, 3e9, 0.0], 2)]
    df = spark.createDataFrame(bad + good, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit(1)).withColumn("Error", F.lit(2))
    got = vectorcodes.compress(df).collect()
    assert Counter(r.vec_id for r in got) == Counter(r[0] for r in good)
    assert [(r.code, r.error) for r in got if r.vec_id == 6] == [(None, None)]
    assert [(r.code, r.error, r.label_error) for r in got if r.vec_id == 5] == [("00000000", 0, 0)] * 2  # equal entries: the lower index
    assert [(r.code, r.error) for r in got if r.vec_id in (None, 7)] and all(r.error == 0 for r in got if r.vec_id in (None, 7))
    assert vectorcodes.compress(df.limit(0)).collect() == []
    with pytest.raises(OverflowError):
        vectorcodes.integers(np.array([1e30]))


# 13: phrases


def plain_phrases(rows, least, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang, text = lang or "und", (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            c = f.setdefault(lang, Counter())
            c.update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        big = {p: a for p, a in c.items() if a >= least and len(p) > 1}
        gone = {p[i:j] for p, a in big.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and a >= big[p[i:j]]}
        found = []
        for p in big.keys() - gone:
            score, k = min((1000 * big[p] * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -big[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def given(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, 2) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, Phrase int")


@pytest.mark.parametrize("seed", range(3))
def test_phrases_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(phrases, "LEAST", 4)
    monkeypatch.setattr(phrases, "TOP", 30)
    monkeypatch.setattr(phrases, "SHARES", 3)
    rng = random.Random(seed)
    words = ["the", "THE", "of", "a", "é", "Ü", "x1", "\xa0", "日本"] + [f"w{i}" for i in range(20)]
    stock = [" ".join(rng.choices(words, k=60)) for _ in range(3)]
    rows = []
    for _ in range(120):
        parts = rng.choices(words, k=rng.randrange(40)) + [rng.choice(stock)] * (rng.random() < 0.3)
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(p + rng.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\x0b"]) for p in parts)))
    got = sorted(tuple(r) for r in phrases.collocations(given(spark, rows).repartition(5)).collect())
    want = plain_phrases(rows, 4, 30)
    assert got == want and len(want) > 50


def test_phrases_of_repeated_words_and_edges(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST", 10)
    rows = [("en", "spam " * 5000), ("en", "lorem ipsum dolor " * 3000), (None, None), ("de", ""), ("de", " .,;:!?\n\r\x0b\x0c\t "), ("en", "one"), *[("fr", "a b c d e f")] * 12]
    got = sorted(tuple(r) for r in phrases.collocations(given(spark, rows)).collect())
    assert got == plain_phrases(rows, 10)
    assert ("fr", 1, "a b c d e") in {r[:3] for r in got}
    assert phrases.collocations(given(spark, rows).limit(0)).collect() == []
    assert phrases.collocations(given(spark, rows[2:6])).collect() == []


def test_parse_cuts_equal_passages_alike_and_keeps_every_start():
    rng = random.Random(4)
    passage = [f"p{rng.randrange(400)}".encode() for _ in range(600)]
    chunks = [Counter(phrases.cut(b" ".join(head + passage))) for head in ([], [b"x"] * 7, passage[50:90])]
    shared = chunks[0] & chunks[1] & chunks[2]
    assert sum(shared.values()) >= 0.9 * sum(chunks[0].values())
    for tokens in (passage * 9, [b"a"] * 5400, [b"a", b"b", b"c"] * 1800, passage[:3], passage[:4], [b"a"] * 1028, [b"a"] * 1029):
        found, at = list(phrases.cut(b" ".join(tokens))), 0
        for chunk, last in found:
            words = chunk.split(b" ")
            assert words == tokens[at : at + len(words)]
            at += len(words) - (0 if last else phrases.WINDOW)
            assert len(words) <= phrases.STRETCH + 2 * phrases.WINDOW
        assert at == len(tokens) and [last for _, last in found] == [False] * (len(found) - 1) + [True]


def test_a_full_bit_map_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST", 5)
    rng = random.Random(8)
    rows = [("en", " ".join(rng.choices("abcdefg", k=30))) for _ in range(40)]
    want = plain_phrases(rows, 5)
    monkeypatch.setattr(phrases, "bit_map", lambda frequent: np.full(phrases.BITS // 8, 255, np.uint8))
    assert sorted(tuple(r) for r in phrases.collocations(given(spark, rows)).collect()) == want
