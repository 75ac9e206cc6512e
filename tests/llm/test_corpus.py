"""Small fixtures against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import json
import math
import random
import re
import zlib
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from strandline.llm import bpe, cutting_stock, exact_dedup, exact_topk, fuse, html_text, line_crf, ngram_join, packing, sharding, shingles, toxicity, url_filter

pt = pytest.importorskip("public_tokenizers")
PATH = pt.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, uid long, keep_id string, head string"


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, 7, 9, "x", "y") for i, t in rows], DOCS)


def texts():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 120))) for _ in range(25)]
    out = []
    for t in base:
        out.append(t)
        for _ in range(rnd.randint(0, 3)):
            w = t.split(" ")
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            out.append(rnd.choice([" ", "  ", "\n"]).join(w).title() if rnd.random() < 0.3 else " ".join(w))
    out += [None, "", " \n\t", "one", "One", "two words", "two  words", "a b c d", "a b c d e", "x" * 5000, " ".join(rnd.choice(words) for _ in range(20_000)), "naïve café 日本語 😀 it's 12½ <|endoftext|> end", base[0], base[0]]
    rows = list(enumerate(out))
    rnd.shuffle(rows)
    return [*rows, (None, base[1]), (None, "only here with no id"), rows[0], rows[1]]


ROWS = texts()


def by_row(found, key):
    out = {}
    for r in found:
        out.setdefault(r[key], []).append(r)
    return out


# url filter ----------------------------------------------------------------


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in url_filter.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *(best or (None, "allow"))


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://ORG", "http://org/", "http://a.ORG/x?y#z", "https://example.org/es/1", "https://www.example.org/en/12", "https://example.org/en/2", "https://notexample.org/es/", "http://x.com/fr/a", "http://x.com/de/a", "http://x.com/dex", "http://com/de/", "http://a.com?/de/", "ftp://é.org/ü", "x://a.b..org/", "http://.com/fr/", "a://b://c.org/", "http://" + "a." * 300 + "org/en/", "http://x.com/de/a"]
    rows = spark.createDataFrame([(i, u, "h", "p", 1) for i, u in enumerate(urls)] + [(None, "http://org/", "h", "p", 1)], "page_id long, url string, html string, path string, rule int")
    found = url_filter.judge(rows, url_filter.rules_frame(spark, url_filter.RULES)).collect()
    assert len(found) == len(urls) + 1
    for r in found:
        url = "http://org/" if r["page_id"] is None else urls[r["page_id"]]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(url), url
    assert url_filter.judge(rows.limit(0), url_filter.rules_frame(spark, url_filter.RULES)).count() == 0
    none = url_filter.judge(rows, url_filter.rules_frame(spark, [])).collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}


def test_url_rules_nest(spark):
    rules = url_filter.rules_frame(spark, [("allow", "a.org/"), ("block", "a.org/x/"), ("allow", "a.org/x/y/"), ("block", "b.a.org/"), ("allow", "a.org/x/"), ("block", "/nohost")])
    urls = ["http://a.org/x/z", "http://a.org/x/y/1", "http://a.org/xx", "http://b.a.org/x/y/1", "http://c.b.a.org/"]
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert found == {0: ("a.org/x/", "block"), 1: ("a.org/x/y/", "allow"), 2: ("a.org/", "allow"), 3: ("b.a.org/", "block"), 4: ("b.a.org/", "block")}


# search --------------------------------------------------------------------


def test_topk(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK", 50)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 2)
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(rnd.normal(size=8), 1)]) for i in range(400)]
    odd = [(100, None), (500, [None] * 8), (600, [float("nan")] * 8), (700, [float("inf")] * 8), (None, [1.0] * 8), (800, []), (900, [1.0, 2.0]), (200, rows[200][1]), (5, rows[5][1])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, label int, score string").repartition(3)
    found = exact_topk.search(*exact_topk.build(exact_topk.integers(table))).collect()
    own = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in rows + [(200, rows[200][1]), (5, rows[5][1]), (900, [1.0, 2.0])]]
    expected = []
    for k, (q, v) in enumerate(own):
        if q % 100 == 0:
            scored = sorted((-(int(v @ w)), i) for j, (i, w) in enumerate(own) if j != k and len(w) == len(v))[:10]
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert exact_topk.search(*exact_topk.build(exact_topk.integers(table.limit(0)))).count() == 0


def test_topk_large_components(spark):
    rows = [(i, [float(i % 7 - 3), 5.0 if i % 100 == 0 else 2.0**21 * (1 + i % 3), -3.0]) for i in range(120)]
    found = exact_topk.search(*exact_topk.build(exact_topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))).collect()
    own = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    wanted = []
    for q in (0, 100):
        scored = sorted((-sum(a * b for a, b in zip(own[q][1], w)), i) for i, w in own if i != q)[:10]
        wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, found)) == sorted(wanted)
    blob = lambda *v: np.array(v, np.int64).tobytes()
    assert exact_topk.products([blob(1 << 40, -(1 << 40))], [blob(1 << 40, 1 << 40)]) == [0]
    with pytest.raises(ValueError, match="fit 64 bits"):
        exact_topk.products([blob(1 << 32, 0)], [blob(1 << 32, 1)])


@pytest.mark.parametrize("blocks,held", [(512, 4_000_000), (1, 4_000_000), (512, 60)])
def test_survivors_of_a_task(monkeypatch, blocks, held):
    """No true result is let go over many blocks, nor when a task has to tell what it holds before its end."""
    for name, value in (("BLOCK", 50), ("QUERY_BLOCK", 2), ("QUERY_BLOCKS", blocks), ("HELD", held)):
        monkeypatch.setattr(exact_topk, name, value)
    rnd, k = np.random.default_rng(3), 10
    vectors = np.floor(1024 * rnd.normal(size=(400, 8))).astype(np.int64)
    vectors[40:80] = vectors[40]
    table = pa.RecordBatch.from_arrays([pa.array(np.arange(400)), pa.array(np.arange(400)), pa.array(np.full(400, 8, np.int32)), pa.array([v.tobytes() for v in vectors], pa.binary())], names=["uid", "vec_id", "dim", "exact"])
    queries = [q for b in exact_topk._query_rows(iter([table.select(["uid", "dim", "exact"]).slice(0, 7)])) for q in b.to_pylist()]
    file = [f for b in exact_topk._file_rows(k)(iter([table])) for f in b.to_pylist()]
    assert len(queries) == 4 and len(file) == 8
    names = ["dim", "uids", "open", "low", "step", "cells", "q_uids", "q_exact"]
    met = pa.RecordBatch.from_pylist([{c: (f | q)[c] for c in names} for f in file for q in queries])
    found = pd.concat(b.to_pandas() for b in exact_topk._meet(k)(iter([met])))
    assert not found.duplicated(["query_uid", "uid"]).any()
    for q in range(7):
        scores = vectors @ vectors[q]
        best = sorted((i for i in range(400) if i != q), key=lambda i: (-scores[i], i))[:k]
        own = found[found["query_uid"] == q]
        assert set(best) <= set(own["uid"]) and q not in set(own["uid"])
        assert ((own["lower"] <= scores[own["uid"]]) & (scores[own["uid"]] <= own["upper"])).all()
    if (blocks, held) == (512, 4_000_000):
        assert len(found) < 7 * 4 * k  # not k of every block


def test_topk_of_copies(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK", 30)
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i % 5), 1.0]) for i in range(150)] + [(300, [1.0, 2.0]), (0, [1.0, 2.0])]
    file = exact_topk.build(exact_topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)), 4)
    assert sum(sum(r["open"]) for r in file[1].collect()) < len(rows)
    wanted = []
    for k, (q, v) in enumerate(rows):
        if q % 100 == 0:
            scored = sorted((-int(1024 * 1024 * np.dot(v, w)), i) for j, (i, w) in enumerate(rows) if j != k)[:4]
            wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, exact_topk.search(*file, 4).collect())) == sorted(wanted)


# html ----------------------------------------------------------------------


def test_html():
    body = "".join(f"<p>Paragraph {i} with &lt;some&gt; words, enough of them to count &amp; more.</p>" for i in range(8))
    expected = "\n".join(["The title"] + [f"Paragraph {i} with <some> words, enough of them to count & more." for i in range(8)])
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>Section {i}</a></li>" for i in range(12)) + "</ul>"
    for home in ("<article>{}</article>", "<div id='content'>{}</div>", "<main><div>{}</div></main>", "<table><tr><td class='x'>{}</td></tr></table>"):
        page = f"<html><head><title>t</title><script>var a = '</p><p>no';</script><style>p{{}}</style></head><body><header><h2>Site</h2></header><nav>{menu}</nav><div class='cookie-notice'>We use cookies</div>" + home.format(f"<h1>The   title</h1>{body}") + "<aside class='sidebar'>Elsewhere</aside><form>Your name</form><div class='comments'><p>First! What a long reader comment this is, really.</p></div><footer>&copy; someone</footer>"
        assert html_text.extract(page) == expected, home
    assert html_text.extract(None) == html_text.extract("") == html_text.extract("<html><body></body></html>") == ""
    assert html_text.extract("just &eacute; text") == "just é text"
    assert html_text.extract("<p><b>Open<br><p>Second") == "Open\nSecond"
    assert html_text.extract("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert html_text.extract("<p>a < b and c</p>").startswith("a")


def test_html_selects_at_any_parent():
    part = lambda k: "".join(f"<p>Part {k}, paragraph {i}, has enough words in it to be content of its own.</p>" for i in range(4))
    said = lambda k: [f"Part {k}, paragraph {i}, has enough words in it to be content of its own." for i in range(4)]
    low = "<div>" + "<span>x</span>" * 40 + "</div>"
    for page in ("<body><div><div class='part1'>{}</div>{}</div><div><div class='part2'>{}</div></div></body>", "<body><article>{}</article>{}<div><div>{}</div></div></body>"):
        assert html_text.extract(page.format(part(1), low, part(2))).split("\n") == said(1) + said(2)


def test_html_wrappers_named_like_boilerplate():
    said = [f"Paragraph {i} of the text has enough words in it to be content." for i in range(6)]
    text = "".join(f"<p>{x}</p>" for x in said)
    beside = "<nav>Here there</nav><div class='site-footer ad-container'>Elsewhere and so on</div>"
    for wrapper in ("<div class='content has-sidebar'>{}</div>", "<div class='no-sidebar'>{}</div>", "<div class='page nav-open'>{}</div>", "<div class='post tags-news'>{}</div>", "<div id='widget-12'>{}</div>", "<form action='x'>{}</form>", "<div class='widget'>{}</div>"):
        assert html_text.extract(f"<body>{wrapper.format(beside + text)}</body>").split("\n") == said, wrapper
    assert html_text.extract(f"<html><head><title>t</title><body>{text}</body>").split("\n") == said
    assert html_text.extract("<body><form>Only a run of text</form></body>") == "Only a run of text"
    assert html_text.extract("<body><article><p>Tiny.</p></article><footer>Longer than the article it is below</footer></body>") == "Tiny."
    kept = html_text.extract(f"<article>{text}<p>where <math><mi>x</mi>=<mn>1</mn></math> holds</p><object data='a'><p>Instead of it</p></object><xmp><b>&lt;</xmp><p>End.</p></article>")
    assert kept.split("\n") == [*said, "where x=1 holds", "Instead of it", "<b>&lt;", "End."]


def test_html_keeps_links_of_the_article():
    said = [f"Paragraph {i} of the text has enough words in it to be content." for i in range(6)]
    text = "".join(f"<p>{x}</p>" for x in said)
    links = "<p><a href='1'>First cited work</a> and <a href='2'>the second cited work</a></p>"
    sources = "<ol>" + "".join(f"<li><a href='{i}'>Source number {i}</a></li>" for i in range(4)) + "</ol>"
    wanted = [*said, "First cited work and the second cited work", *(f"Source number {i}" for i in range(4))]
    for home in ("<article>{}</article>", "<div><div>{}</div></div>"):
        assert html_text.extract(f"<body>{home.format(text + links + sources)}</body>").split("\n") == wanted
    assert html_text.extract(f"<body><div>{sources}</div></body>").split("\n") == wanted[-4:]


def random_page(rnd, depth=0):
    if depth == 5 or rnd.random() < 0.25:
        text = "w" * rnd.randint(1, 9) + " x" * rnd.randint(0, 30)
        return text if rnd.random() < 0.7 else f"<a href='u'>{text}</a>" if rnd.random() < 0.5 else f"<b>{text}</b>"
    tag = rnd.choice(["div", "div", "section", "p" if depth == 4 else "div", "i"])
    return f"<{tag}>{''.join(random_page(rnd, depth + 1) for _ in range(rnd.randint(1, 4)))}</{tag}>"


def densest(root):
    """The content by the definition, everything counted anew for every node."""
    blocks = ("div", "section", "p", "body")
    kids = lambda x: [y for y in x.children if not isinstance(y, str)]
    below = lambda x: [z for y in kids(x) for z in (y, *below(y))]
    chars = lambda x, link=False: sum(len(" ".join(y.split())) * (not link or x.tag == "a") if isinstance(y, str) else chars(y, link and x.tag != "a") for y in x.children)
    body = next(x for x in below(root) if x.tag == "body")
    ratio = chars(body, True) / max(chars(body), 1)

    def density(x):
        c, lc, tags = chars(x), chars(x, True), below(x)
        if not c:
            return 0.0
        t, lt = max(len(tags), 1), max(sum(y.tag == "a" for y in tags), 1)
        base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
        return c / t * max(math.log(c / max(lc, 1) * t / lt), 0.0) / base

    def nexts(x):
        return [z for y in kids(x) for z in ([y] if y.tag in blocks else nexts(y))]

    total = lambda x: sum(map(density, nexts(x))) or density(x)
    every = lambda x: [x, *(z for y in nexts(x) for z in every(y))]
    best = lambda x: max(every(x), key=total)
    path, up = [], best(body)
    while up is not body.parent:
        path += [density(up)] if up.tag in blocks else []
        up = up.parent
    chosen = []

    def walk(x):
        if density(x) >= min(path):
            chosen.append(best(x))
            for y in nexts(x):
                walk(y)

    walk(body)
    return [x for x in every(body) if x in chosen and not any(z in chosen for y in chosen for z in [y] if x is not y and x in below(y))]


def test_html_density_by_definition():
    rnd = random.Random(12)
    several = 0
    for _ in range(60):
        page = "<html><body>" + "".join(random_page(rnd) for _ in range(rnd.randint(1, 5))) + "</body></html>"
        wanted = [html_text.blocks(x) for x in densest(html_text.tree(page))]
        assert [html_text.blocks(x) for x in html_text.main_nodes(html_text.tree(page))] == wanted, page
        several += len(wanted) > 1
    assert several > 5


@pytest.mark.parametrize("page", ["a <b c " * 60_000, "</b>" * 100_000, "<b><div>" + "<i>" * 40_000 + "</b>" * 40_000, '<a ">" ' * 60_000, "<p>x" * 60_000, "<textarea>" * 40_000, "<a '>" * 80_000, "<!--" * 100_000, "<div class='ad'>" * 20_000])
def test_html_malformed_pages_take_linear_time(page):
    import time

    began = time.process_time()
    html_text.extract(page)
    assert time.process_time() - began < 8  # a quadratic walk takes minutes


def test_html_rows(spark):
    rows = spark.createDataFrame([(1, "u", "<p>é  x</p>", "a"), (1, "u", "<p>é  x</p>", "a"), (None, None, None, None), (2, "v", "", "b")], "page_id long, url string, html string, text string")
    assert sorted(map(tuple, html_text.extract_pages(rows).collect()), key=str) == sorted([(1, "u", "é x", 3), (1, "u", "é x", 3), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert html_text.extract_pages(rows.limit(0)).count() == 0


# n-gram join ---------------------------------------------------------------


def shingle_set(text):
    raw = bytes(c | 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = (len(sets[i]), min(ids) if ids else None)
    return [(rows[i][0], *out[i]) for i in range(len(rows))]


@pytest.mark.parametrize("tile,bucket", [(2000, 1000), (3, 2)])
def test_ngram_join(spark, monkeypatch, tile, bucket):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    docs = docs_of(spark, ROWS).repartition(3, "n_chars")
    rows = ngram_join.near_duplicates(docs).collect()
    wanted = components(ROWS)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str) == sorted(wanted, key=str)
    kept = ngram_join.first_rows(docs)
    assert kept.columns == docs.columns
    # one row of each component, and every row without words
    bare = sum(not shingle_set(t) for _, t in ROWS)
    known = {c for i, n, c in wanted if n and c is not None}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None and shingle_set(r["text"])) == sorted(known)
    assert sum(not shingle_set(r["text"]) for r in kept.collect()) == bare


def test_rows_are_known_by_what_they_hold(spark, tmp_path):
    docs_of(spark, ROWS).write.parquet(str(tmp_path / "docs"))
    found = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "4k"):  # other splits number rows otherwise
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        docs = spark.read.parquet(str(tmp_path / "docs"))
        kept = exact_dedup.first_rows(docs)
        near = ngram_join.first_rows(docs)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k" if size == "128m" else "128m")  # between the plan's jobs, as when executors go
        found.append([sorted(map(str, x.collect())) for x in (kept, near)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1]
    assert len(found[0][0]) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in ROWS})


def test_common_shingles_come_last(spark):
    sets = spark.createDataFrame([(i, 3, np.sort(np.array([7, 100 + i, 5000 + 2 * i], np.uint64)).tobytes()) for i in range(200)], "node long, n long, tokens binary")
    load = ngram_join.loads(sets)
    assert len(load) == 1 << ngram_join.LEAST_BITS and load[7] == 4 and not load[:7].any() and not load[8:].any()


@pytest.mark.parametrize("part,tokens", [(1000, 4_000_000), (3, 4_000_000), (1000, 500)])
def test_ngram_links(spark, monkeypatch, part, tokens):
    monkeypatch.setattr(ngram_join, "PART", part)
    monkeypatch.setattr(ngram_join, "PART_TOKENS", tokens)
    rnd = random.Random(11)
    base = [f"v{i}" for i in range(90)]
    near = []
    for i in range(30):  # one component whose members are not all linked with each other
        w = base[: rnd.randint(70, 90)] + [f"t{rnd.randint(0, 3)}-{k}" for k in range(rnd.randint(0, 25))]
        if rnd.random() < 0.6:
            w[rnd.randrange(len(w))] = "other"
        near.append((4000 + i, " ".join(w)))
    rows = [*ROWS, *near, *near[:4]]
    sets = [shingle_set(t) for _, t in rows]
    wanted = [(rows[a][0], len(x), sum(b != a and bool(x and y) and 100 * len(x & y) >= 75 * len(x | y) for b, y in enumerate(sets))) for a, x in enumerate(sets)]
    found = ngram_join.near_duplicates(docs_of(spark, rows).repartition(3, "n_chars")).select("doc_id", "n_shingles", "n_links").collect()
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert len({n for i, _, n in wanted if i is not None and i >= 4000}) > 5


def test_ngram_rounds_follow_the_components(spark, monkeypatch):
    """A group of near copies gives the first rounds a pair a component, not all pairs of them."""
    rnd = random.Random(5)
    base, near = [f"g{i}" for i in range(200)], []
    for i in range(60):
        w = list(base)
        for k in rnd.sample(range(200), rnd.randint(1, 9)):
            w[k] = f"x{i}-{k}"
        near.append((i, " ".join(w)))
    rounds, verified = [], ngram_join.verified

    def seen(pairs, *rest):
        rounds.append(pairs.count())
        return verified(pairs, *rest)

    # anchors find nothing here, so that tiles meet 60 components
    monkeypatch.setattr(ngram_join, "anchored", lambda sets, percent: sets.select("node", sets["node"].alias("root")).limit(0))
    monkeypatch.setattr(ngram_join, "verified", seen)
    found = ngram_join.near_duplicates(docs_of(spark, near).repartition(3)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(components(near))
    assert 30 <= rounds[0] <= 60 and len(rounds) > 1


def test_best_pairs_stay_best_when_combined():
    rnd = np.random.default_rng(2)
    comp = np.sort(np.array([rnd.choice(40, 2, replace=False) for _ in range(700)]), 1).T
    pairs = np.stack([comp[0] + 100, comp[1] + 100, comp[0], comp[1], rnd.integers(0, 9, 700)])
    best = ngram_join.best_of(pairs)
    assert best.shape[1] <= 40 and set(best[2:4].ravel()) == set(pairs[2:4].ravel())
    for c in range(40):
        of = lambda p: p[4, (p[2] == c) | (p[3] == c)].max()
        assert of(best) == of(pairs)
    halves = np.concatenate([ngram_join.best_of(pairs[:, :300]), ngram_join.best_of(pairs[:, 300:])], axis=1)
    assert sorted(map(tuple, ngram_join.best_of(halves).T)) == sorted({tuple(p) for p in best.T})


def test_ngram_empty(spark):
    assert ngram_join.near_duplicates(docs_of(spark, []).limit(0)).count() == 0
    rows = ngram_join.near_duplicates(docs_of(spark, [(1, None), (2, ""), (3, "lonely")])).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in rows) == [(1, 0, 1, 0), (2, 0, 2, 0), (3, 1, 3, 0)]


def test_screening_keeps_linked_pairs():
    rnd = np.random.default_rng(0)
    for n in (1, 2, 3, 5, 8, 40, 333):
        for _ in range(20):
            x = np.sort(rnd.choice(10**6, n, replace=False))
            drop = rnd.integers(0, n // 4 + 1)
            y = np.sort(np.concatenate([rnd.permutation(x)[: n - drop], 10**6 + rnd.choice(10**6, rnd.integers(0, n // 8 + 1), replace=False)]))
            shared = len(np.intersect1d(x, y))
            if not ngram_join.links(len(x), len(y), shared, 75):
                continue
            sizes = np.array([len(x), len(y)])
            a, b = (set(z[:k]) for z, k in zip((x, y), ngram_join.screened(sizes, 75)))
            assert len(a & b) >= ngram_join.needed(sizes, 75).max()


def test_words():
    offsets, data = shingles.buffers(pa.array(["Ab  c", None, "", "x\x0by z", "ab C"]))
    hashes, bounds = shingles.word_hashes(offsets, data)
    assert bounds.tolist() == [0, 2, 2, 2, 5, 7]
    assert hashes[0] == hashes[5] and hashes[1] == hashes[6] and len(set(hashes.tolist())) == 5
    sliced = pa.array(["skip", "Ab  c", "ab C"]).slice(1)
    again, _ = shingles.word_hashes(*shingles.buffers(sliced))
    assert again.tolist() == [hashes[0], hashes[1]] * 2


# bpe, packing ----------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)


def test_bpe(spark, tokenizer):
    rnd = random.Random(5)
    pieces = list("aZ \n\t'sdt09_-é漢😀\u00a0\x1c\u2003½²\u0301<|>") + ["<|endoftext|>", "'ll", " \n", "  ", "the", "ing"]
    odd = [(1000 + i, "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 50)))) for i in range(400)] + [(None, "no id"), (1, "ab" * 4000)]
    rows = ROWS + odd
    found = bpe.round_trip(docs_of(spark, rows), PATH).collect()

    def told(i, text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())

    assert sorted(map(tuple, found), key=str) == sorted((told(*r) for r in rows), key=str)
    encoded = bpe.encode(docs_of(spark, rows), PATH)
    back = {(r["doc_id"], r["text"]) for r in bpe.decode(encoded, PATH).collect()}
    assert back == {(i, t or "") for i, t in rows}
    assert bpe.round_trip(docs_of(spark, rows).limit(0), PATH).count() == 0


def test_library_gives_the_same_ids(tokenizer):
    own = bpe.Encoder(PATH, library=True)
    texts = [t for _, t in ROWS]
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [len(ROWS), 3, 0])
def test_packing(spark, tokenizer, n):
    rows = ROWS[:n]
    found = packing.pack(docs_of(spark, rows).limit(n) if n == 0 else docs_of(spark, rows), PATH).collect()
    pieces = by_row(found, "doc_id")
    for i in {r[0] for r in rows}:
        wanted = sorted(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes() for j, t in rows if j == i)
        for r in pieces[i]:
            assert any(r["doc_tokens"] * 4 == len(w) and zlib.crc32(w[4 * r["start"] : 4 * (r["start"] + r["length"])]) == r["ids_crc32"] for w in wanted)
        assert sum(r["length"] for r in pieces[i]) == sum(len(w) // 4 for w in wanted)
    sequences = by_row(found, "sequence_id")
    assert sorted(sequences) == list(range(len(sequences)))
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 1024 and at & (at - 1) == 0  # full or a power of two: no padding


def test_cutting_stock():
    rnd = np.random.default_rng(2)
    for counts in ({}, {5: 3}, {512: 7}, {int(v): int(n) for v, n in zip(rnd.integers(1, 1024, 60), rnd.integers(1, 80, 60))}, {700: 40, 324: 10, 100: 33, 24: 50}):
        used = {}
        for times, lengths in cutting_stock.rounded(counts, 1024):
            assert sum(lengths) == 1024 and times > 0
            for v in lengths:
                used[v] = used.get(v, 0) + times
        assert all(n <= counts[v] for v, n in used.items())
    best, last = cutting_stock.knapsack(np.array([3, 5]), np.array([1.0, 1.5]), 11)
    assert best[11] == 3.5 and best[1] == math.inf and best[0] == 0 and last[1] == -1


def test_patterns_place_nearly_all_rests():
    rnd = np.random.default_rng(5)
    lengths, n = np.unique(rnd.integers(1, 1024, 10_000), return_counts=True)
    counts = dict(zip(lengths.tolist(), n.tolist()))
    placed = sum(times * len(pattern) for times, pattern in cutting_stock.rounded(counts, 1024))
    assert placed >= 0.9 * sum(counts.values())


# sharding, exact dedup -------------------------------------------------------


def test_sharding(spark):
    rows = ROWS + [(i, "copy " * 30) for i in range(2000, 2060)]
    found = sharding.shard(docs_of(spark, rows), 4).collect()
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in found} == {(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows}
    shards = by_row(found, "shard")
    assert all(sorted(r["slot"] for r in m) == list(range(len(m))) for m in shards.values())
    home = {}
    for r in found:
        assert home.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]
    assert sharding.shard(docs_of(spark, []).limit(0)).count() == 0


def test_differencing():
    assert sharding.differencing(np.array([8, 7, 6, 5, 4]), 2).tolist() in ([0, 1, 1, 0, 0], [1, 0, 0, 1, 1], [0, 1, 0, 1, 1], [1, 0, 1, 0, 0], [0, 0, 1, 1, 1])
    rnd = np.random.default_rng(1)
    w = rnd.integers(1, 10_000, 3000)
    loads = np.bincount(sharding.differencing(w, 40), w, 40)
    assert loads.max() - loads.min() <= 20
    assert len(sharding.differencing(np.zeros(0), 3)) == 0 and sharding.differencing(np.array([5]), 3).shape == (1,)


def test_fuse():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = rnd.integers(0, 2**63, n, dtype=np.uint64)
        blob = fuse.build(np.concatenate([keys, keys[: n // 2]]))
        assert fuse.contains(blob, keys).all()
        assert fuse.contains(blob, rnd.integers(0, 2**63, 20_000, dtype=np.uint64)).mean() < 0.01
        assert n < 1000 or len(blob) < 1.35 * n + 2000


def test_exact_dedup(spark):
    rows = ROWS + [(3000, " x  y"), (2999, "\tx\ny"), (3001, "x y"), (3002, "x\u00a0y")]
    found = exact_dedup.deduplicate(docs_of(spark, rows).repartition(3, "n_chars")).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    wanted = []
    for i, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        wanted.append((i, min(ids) if ids else None, len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=str) == sorted(wanted, key=str)
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len(groups) == len({r["text_sha256"] for r in kept}) and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert exact_dedup.deduplicate(docs_of(spark, []).limit(0)).count() == 0


def test_snapshot_finds_what_came_before(spark):
    first, second = docs_of(spark, [(1, "a"), (2, "b"), (9, "b")]), docs_of(spark, [(5, "b"), (6, "c"), (7, "c"), (0, "a")])
    known = exact_dedup.snapshot(exact_dedup.grouped(exact_dedup.digests(first), 4))
    found = exact_dedup.absorb(exact_dedup.grouped(exact_dedup.digests(second), 4), known, first.unionByName(second)).collect()
    sha = {hashlib.sha256(t.encode()).digest(): t for t in "abc"}
    assert {(sha[bytes(r["sha"])], r["first"]["label"], r["n"]) for r in found} == {("a", 0, 2), ("b", 2, 3), ("c", 6, 2)}


def test_bytes_are_compared(spark):
    docs = docs_of(spark, [(1, "a b"), (2, "a  b"), (3, "c")])
    rows = exact_dedup.digests(docs)
    met = lambda x, y: rows.where(f"label = {x}").selectExpr("sha", "bytes", "struct(label, key) as first").crossJoin(rows.where(f"label = {y}").selectExpr("struct(label, key) as own"))
    exact_dedup.compared(met(1, 2), docs)
    with pytest.raises(ValueError, match="SHA-256"):
        exact_dedup.compared(met(1, 3), docs)


# classifiers -----------------------------------------------------------------


def labelled(spark, n=240):
    rnd = random.Random(8)
    words = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randint(8, 60))]
        toxic, good = int(i % 4 == 0), int(i % 3 != 0)
        if toxic:
            w.insert(rnd.randrange(len(w)), rnd.choice(["rotter", "rotters", "scoundrel"]))
        lines = [" ".join(w[k : k + 9]) for k in range(0, len(w), 9)]
        rows.append((i, "\n".join(x if good else x.upper().replace(" ", "!! ") for x in lines)))
        marks.append((i, good, toxic))
    return rows + [(None, "no id"), (5000, None), (5001, ""), (5002, " \n "), (5003, "word1 " * 30_000)], spark.createDataFrame(marks + [marks[0], (None, 1, 1), (7000, None, None)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module,label,border", [(toxicity, 2, 0.5), (line_crf, 1, 0.3)])
def test_classifier(spark, module, label, border):
    rows, marks = labelled(spark)
    docs = docs_of(spark, rows)
    model = module.fit(docs, marks)
    found = module.scored(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= border) for r in found)
    truth = {r[0]: r[label] for r in marks.collect() if r[0] is not None and r[label] is not None}
    held = [r for r in found if r["doc_id"] in truth and r["held_out"]]
    assert len(held) > 20 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.9
    left = module.clean(docs, model) if module is toxicity else module.good(docs, model)
    assert left.columns == docs.columns
    assert module.scored(docs.limit(0), model).count() == 0
    nothing = module.fit(docs, marks.limit(0))
    assert {r["score"] for r in module.scored(docs, nothing).collect()} == {0.0}


def test_messages_are_marginals():
    rnd = np.random.default_rng(6)
    bounds = np.array([0, 4, 4, 5, 8])
    s, t = rnd.normal(size=8), rnd.normal(size=(2, 2))
    forward, backward = line_crf.messages(s, bounds, t)
    got = 1 / (1 + np.exp(-(forward + backward)))
    for a, b in zip(bounds[:-1], bounds[1:]):
        total, ones = 0.0, np.zeros(b - a)
        for y in product((0, 1), repeat=b - a):
            if b > a:
                p = np.exp(sum(s[a + i] * v for i, v in enumerate(y)) + sum(t[u, v] for u, v in zip(y, y[1:])))
                total += p
                ones += p * np.array(y)
        if b > a:
            assert np.allclose(got[a:b], ones / total)


def test_line_features():
    found = [x for x in line_crf.line_features(pa.array(["a b\n\nA B!!\na b", None, "\n \n", "x"]))]
    bits, size, bounds = found[0]
    assert bounds.tolist() == [0, 3, 3, 3, 4] and len(bits) == 4
    again = list(line_crf.features(pa.array(["a b\n\nA B!!\na b"])))[0]
    assert (line_crf.unpacked(again)[0] == bits[:3]).all()


# the pipeline ----------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows, marks = labelled(spark)
    docs_of(spark, rows + [(8000, rows[1][1]), (8001, rows[2][1] + " more")]).write.parquet(str(tmp_path / "documents.parquet"))
    marks.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    sizes = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"stage{i}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{i}"))
        sizes.append(docs.count())
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns, name
    kept = {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "stage3")).collect()}
    assert 8000 not in kept and sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] and {r["doc_id"] for r in docs.collect()} == kept


def test_json_is_a_vocabulary():
    assert json.load(open(PATH, encoding="utf-8"))["model"]["type"] == "BPE"
