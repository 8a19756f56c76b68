"""Operators over pages and vectors against brute force, on the small tables and on odd rows."""

from __future__ import annotations

import hashlib
import html
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_inputs import shipped  # noqa: F401 (fixtures)

from verity.llm import ann, queries, warc
from verity.llm.ann import nearest
from verity.llm.html_text import Forest, Model, _element, extract_text, labelled_pages, main_texts, trained
from verity.llm.url_filter import judge_urls
from verity.llm.warc import read_warc, round_trip

SF = "/root/testdata/sf0.01"
EVIL = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


@pytest.fixture(scope="module")
def odd_pages(spark):
    rng = np.random.default_rng(3)
    rows = [
        (1, "http://a/", None), (2, "http://a/\r\nContent-Length: 3", EVIL), (3, None, EVIL * 40), (4, "u", EVIL * 40), (5, "ü", "é" * 200), (6, "ü", "é" * 200),
        (None, "n", "x" * 500), (None, "n", "x" * 500), (7, "q", "short"), (8, "q", "short"), (9, "", ""), (10, "w", "WARC/1.1\r\n"),
        (11, "w", "WARC/1.1\r\n" * 300), (12, "z", "\r\n\r\n" * 60), (5, "ü", "é" * 200), (13, "http://big.example.org/fr/" + "a" * 5000, "<p>" + "long text. " * 30_000),
    ]
    pieces = ["WARC/1.1\r\n", EVIL, "abc", "é", "\r\n\r\n", "q" * 200]
    rows += [(100 + i, f"http://x/{i}", "".join(rng.choice(pieces, int(rng.integers(0, 30))))) for i in range(120)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "page_id bigint, url string, html string, digest int, header string, rule int")
    return rows, df


@pytest.mark.parametrize("split", ["128m", "9000", "1700"])
def test_warc_round_trip(spark, odd_pages, split):
    """Payloads full of version lines and whole records, files cut into many splits."""
    rows, df = odd_pages
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in round_trip(df.coalesce(2)).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    least = {}
    for page_id, _, source in rows:
        if page_id is not None:
            least[source or ""] = min(least.get(source or "", page_id), page_id)
    want = Counter()
    for page_id, _, source in rows:
        data, first = (source or "").encode(), least.get(source or "")
        again = len(data) >= 100 and first is not None and page_id != first
        want[page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    assert got == want


def test_warc_empty_table_and_foreign_bytes(spark, odd_pages, tmp_path):
    _, df = odd_pages
    assert round_trip(df.limit(0)).count() == 0
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    (tmp_path / "a.warc").write_bytes((record.format(1, 3, "abc") + record.format(2, 99, "cut off")).encode())
    got = {r.page_id: bytes(r.payload) for r in read_warc(spark, str(tmp_path)).collect()}
    assert got[1] == b"abc"


def test_warc_headers_of_others(spark, tmp_path):
    """Names in any case, no or an unreadable length, bytes before the first record: nothing fails, nothing is silent."""
    one = "WARC/1.1\r\nwarc-type: response\r\nWARC-RECORD-ID:<urn:page:1> \r\ncontent-length: 3\r\n\r\nabc\r\n\r\n"
    bare = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:2>\r\n{}\r\ndefg"
    (tmp_path / "a.warc").write_bytes((one + bare.format("")).encode())
    (tmp_path / "b.warc").write_bytes((one + bare.format("Content-Length: many\r\n")).encode())
    (tmp_path / "c.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nold")
    got = Counter((r.page_id, r.record_type, bytes(r.payload), r.problem) for r in read_warc(spark, str(tmp_path)).collect())
    assert got == {(1, "response", b"abc", None): 2, (2, "response", b"defg", "no length"): 2,
                   (None, None, b"WARC/1.0\r\nWARC-Type: response\r\n\r\nold", "no record"): 1}


def test_warc_splits_stay_between_the_scans(spark, odd_pages, tmp_path):
    """The caller's split settings change after the chain has been verified and before the data are read."""
    rows, df = odd_pages
    folder = str(tmp_path / "w")
    warc.write_warc(df.coalesce(2), folder)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k in names:
            spark.conf.set(k, "1500")
        read = read_warc(spark, folder)
        for k in names:
            spark.conf.set(k, "64m")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        assert read.filter("problem IS NULL").count() == len(rows)
        assert read.filter("record_type = 'response' AND sha2(payload, 256) <> digest").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        for k, v in before.items():
            spark.conf.set(k, v)


def test_warc_query_reads_every_page(spark):
    assert queries.QUERIES["op6_warc"](spark, SF).count() == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert warc.REVISIT_BYTES == 100


def test_main_text_of_the_tables_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()}
    found = main_texts(list(pages.values()), trained())
    wrong = 0
    for source, text in zip(pages.values(), found, strict=True):
        article = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S)
        wrong += text != " ".join(html.unescape(re.sub("<[^>]*>", " ", article[1])).split())
    assert wrong <= 0.002 * len(pages)


def test_model_on_fresh_layouts_and_exact_messages():
    forest, labels = Forest(), []
    for source, own in labelled_pages(200, seed=5):
        forest.add(source)
        labels += own
    marginal = trained().messages(Model.layout(forest))[0][:, 1]
    shown = np.array([marginal[t[0]] >= 0.5 for t in forest.texts if t[0] >= 0])
    assert (shown == np.array(labels)).mean() > 0.98
    # Sum-product on one small tree against the sum over all labellings.
    small = Forest()
    small.add("<div class=ad><p>a</p><p>b <b>c</b></p></div>")
    model, g = trained(), Model.layout(small)
    n = len(g["parent"])
    own = np.bincount(g["owner"], model.unary[g["features"]], n)
    weights = np.zeros((n, 2))
    for bits in range(1 << n):
        y = [bits >> i & 1 for i in range(n)]
        w = np.exp(sum(own[i] * y[i] for i in range(n)) + sum(model.pair[g["kind"][i], y[g["parent"][i]], y[i]] for i in range(1, n)))
        for i in range(n):
            weights[i, y[i]] += w
    assert np.allclose(model.messages(g)[0], weights / weights.sum(axis=1, keepdims=True))


PAGE = """<html><body><div class="cookie-banner">We use cookies. Accept all of them.</div><header><a href="/">Site</a></header>
<nav><a href=/a>A</a><a href=/b>B</a></nav><div id="wrap"><div class="post"><h1>Title here</h1><p>One <b>bo</b>ld and &lt;b&gt; it.
<p>Two lines\n of   text with a <a href="x">link</a>, then more.<ul><li>x one<li>y two</ul><aside class="related">Read also this one</aside>
<p>Three is the last paragraph.</p></div><section id="comments"><h3>Comments</h3><article class="comment"><p>Great post, I really liked what
you wrote here. Thanks a lot!</p></article></section></div><form action=x><label>Mail</label><input><button>Go</button></form>
<footer>Copyright 2024</footer><script>var x="<p>no</p>";</script></body></html>"""


def test_main_text_of_odd_pages(spark, odd_pages):
    text = main_texts([PAGE], trained())[0]
    assert text == "Title here One bold and <b> it. Two lines of text with a link, then more. x one y two Three is the last paragraph."
    assert main_texts([None, "", "<", "<p", "</p></p>", "<!-- x", "<script>x", "<div>" * 2000], trained()) == [""] * 8
    rows, df = odd_pages
    out = extract_text(df).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert extract_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("attributes", [
    'data-state="' + "x" * 600 + '" class="cookie banner"',
    'class="' + " ".join(f"u{chr(97 + i)}" for i in range(20)) + ' cookie banner"',
    'class="' + "ux " * 300 + 'cookie banner"',
    'style="' + "color: red; " * 60 + '" hidden',
])
def test_long_attributes_are_read_whole(attributes):
    forest, brief = Forest(), Forest()
    forest.add(f"<div {attributes}>x</div>")
    brief.add("<div class='cookie banner'>x</div>" if "cookie" in attributes else "<div hidden>x</div>")
    assert set(brief.node_features[1]) <= set(forest.node_features[1]) and forest.kind == brief.kind
    assert [t[2] for t in forest.texts] == [t[2] for t in brief.texts] == ([] if "hidden" in attributes else ["x"])


def test_values_of_other_attributes_are_not_read():
    value = "a hidden class='cookie banner' thing " * 40
    assert _element("p", f'title="{value}"') == _element("p", "")
    assert _element("p", f'title="{value}"class="post"') == _element("p", "class=post")


def test_large_attributes_take_little_time():
    start = time.time()
    main_texts(["<div " + 'class="a" ' * 40_000 + ">x</div>", "<div class=" + " " * 40_000 + "a>x</div>", "<div x" + " " * 40_000 + ">x</div>", "<div " + "x" * 400_000 + ">x</div>"], trained())
    assert time.time() - start < 30


def test_broken_tags_take_linear_time():
    """Attributes that never close: a megabyte each, also quotes and spaces that a regular expression might try again."""
    model = trained()
    for piece in ("<a '", '<a "', "<a =", "<a x='", "<a x=\"' ", "<a b = ", "< a", "<!-", "<a/"):
        start = time.time()
        main_texts([piece * (1_000_000 // len(piece))], model)
        assert time.time() - start < 8, piece


@pytest.mark.parametrize("tag", ["<a href=/o'neil>", '<a title=5">', "<a x='1'y=\"2\">", "<a 'x>", "<a =x>", "<a\nb/c = d\t>"])
def test_quotes_open_values_only_after_an_equals_sign(tag):
    forest = Forest()
    forest.add(f"<p>one {tag}two</a></p><p>it's three</p>")
    assert " ".join("".join(t[2] for t in forest.texts).split()) == "one twoit's three"


def rule_of(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.match("[^/?#]*", rest)[0])
    path = re.match("[^/?#]*([^?#]*)", rest)[1]
    best = None
    for kind, own, start in (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")):
        if (host == own or host.endswith("." + own)) and path.startswith(start) and (best is None or len(own + start) > len(best[1])):
            best = (kind, own + start)
    return host, path, best


def test_urls(spark, odd_pages):
    own = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    urls = [None, "", "x", "http://", "HTTP://A.Example.NET/en/?a=1&b=2", "http://net/", "http://xnet/", "http://a.net", "http://a.net?x", "http://org/fr/", "http://É.ORG/fr/x#y", "a://b://c/d", "http://example.com/de/\nx", "http://a/" + "b" * 9000]
    rows = own + [(None if i % 3 == 0 else 10**6 + i, u) for i, u in enumerate(urls)] + own[:3]
    got = judge_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()
    assert len(got) == len(rows)
    want = Counter((p, *rule_of(u)[:2], rule_of(u)[2][1] if rule_of(u)[2] else None) for p, u in rows)
    assert Counter((r.page_id, r.host, r["path"], r.rule) for r in got) == want
    for r in got:
        if r.rule:
            assert r.verdict == {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}[r.rule]
        else:
            assert r.verdict in ("allow", "block")
    listed = [r for r in got if not r.rule and re.search(r"(ads-track|spam-farm|casino-win|free-bets)", r.host)]
    assert listed and all(r.verdict == "block" for r in listed)
    rows, df = odd_pages
    assert judge_urls(df).count() == len(rows) and judge_urls(df.limit(0)).count() == 0


def test_urls_without_a_rule_go_by_their_host(spark):
    """Clean hosts are allowed and listed ones blocked on every suffix, also where no allow rule fits."""
    pages = [(r.page_id, r.url) for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()]
    pages += [(10**6 + i, f"https://www.clean{i}.example.{end}/it/{i}") for i in range(30) for end in ("com", "org")]
    got = [r for r in judge_urls(spark.createDataFrame(pages, "page_id bigint, url string")).collect() if not r.rule]
    clean = [r for r in got if "-" not in r.host]
    assert {r.host[-11:] for r in clean} == {"example.com", "example.org"} and all(r.verdict == "allow" for r in clean)
    listed = [r for r in got if re.search(r"(ads-track|spam-farm|casino-win|free-bets)", r.host)]
    assert listed and all(r.verdict == "block" for r in listed)


def brute_nearest(rows, k, is_query):
    fine = {}
    for vec_id, x in rows:
        if vec_id is not None and x is not None and len(x) == 4 and all(v is not None and np.isfinite(v) for v in x) and any(x):
            x = tuple(float(np.float32(v)) for v in x)
            fine[vec_id] = min(fine.get(vec_id, x), x)
    out = []
    for q in sorted(i for i in fine if is_query(i)):
        best = sorted((-float((np.array(fine[q]) * np.array(x)).sum()), i) for i, x in fine.items() if i != q)[:k]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return out


def test_nearest_of_odd_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(90)] + [(200 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(30)]
    rows += [(300, None), (301, [0.0] * 4), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan"), 0.0, 0.0, 1.0]), (304, [float("inf"), 0.0, 0.0, 1.0]), (None, [1.0, 2.0, 3.0, 4.0]), (306, [1.0, 2.0]), (307, [])]
    rows += [(5, rows[5][1]), (6, [9.0, 9.0, 9.0, 9.0])]
    df = spark.createDataFrame([(i, x, 1, "y") for i, x in rows], "vec_id bigint, embedding array<float>, list int, part string")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(df, "vec_id % 20 = 0", 20).collect())
    assert got == brute_nearest(rows, 20, lambda i: i % 20 == 0)
    few = df.filter("vec_id < 5")
    assert len(nearest(few, "vec_id % 20 = 0", 20).collect()) == 4
    assert nearest(df.limit(0), "true").count() == 0 and nearest(df.filter("vec_id = 1"), "true").count() == 0


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in queries.QUERIES["op2_nearest"](spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, {})[r.vec_id] = (r["rank"], r.score)
    rows = table.toPandas()
    x, ids = np.array(rows.embedding.tolist(), float), rows.vec_id.to_numpy()
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = (x * x[i]).sum(axis=1)
        score[i] = -np.inf
        best = np.lexsort((ids, -score))[:20]
        hits += len(set(ids[best]) & set(got[ids[i]]))
        total += 20
        assert all(score[np.flatnonzero(ids == v)[0]] == s for v, (_, s) in got[ids[i]].items())
    assert hits / total >= 0.9


def test_lists_spread_and_prune(spark):
    """Many lists: what is pruned away costs little recall, and an overfull list is cut into parts."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] + 0.3 * rng.normal(size=16)).tolist()) for i in range(6000)] + [(10_000 + i, centres[0].tolist()) for i in range(5000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {}
    for r in nearest(df, "vec_id < 6000 AND vec_id % 100 = 0", 20).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    x, ids = np.array([r[1] for r in rows], np.float32).astype(float), np.array([r[0] for r in rows])
    hits = 0
    for q in range(0, 6000, 100):
        score = (x * x[q]).sum(axis=1)
        score[q] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -score))[:20]]) & set(got[q].values()))
    assert hits / (60 * 20) >= 0.9


def test_recall_with_all_centroids(spark, monkeypatch):
    """As many lists as there can be, over vectors without clusters: the probed lists keep up with them."""
    monkeypatch.setattr(ann, "ROWS_PER_LIST", 16)
    x = np.random.default_rng(21).normal(size=(32_768, 64)).astype(np.float32).astype(float)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(float)
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<float>").repartition(8)
    got = {}
    for r in nearest(df, "vec_id % 160 = 0", 20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, len(x), 160):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20].tolist()) & got[q])
    assert hits / (len(got) * 20) >= 0.9


def test_a_list_returns_only_rows_at_or_above_the_floor():
    """What cannot be among a query's best does not leave the list; rows at the floor do, whatever their ids."""
    x = [[1.0, 0.0], [0.9, 0.1], [0.5, 0.5], [0.5, 0.2], [0.1, 0.9], [-1.0, 0.0]]
    members = pa.table({"vec_id": pa.array(range(6), pa.int64()), "x": pa.array(x, pa.list_(pa.float64()))})
    floors = {10: 0.5, 11: float("-inf"), 12: 0.95, 13: 2.0}
    queries_of = pa.table({
        "query_id": pa.array(list(floors), pa.int64()), "x": pa.array([[1.0, 0.0]] * 4, pa.list_(pa.float64())),
        "floor": pa.array(list(floors.values()), pa.float64()),
    })
    got = ann._scan(None, members, queries_of, 4).to_pylist()
    best = {q: [r["vec_id"] for r in got if r["query_id"] == q] for q in floors}
    assert best == {10: [0, 1, 2, 3], 11: [0, 1, 2, 3], 12: [0], 13: []}
    assert all(r["score"] == x[r["vec_id"]][0] for r in got)
