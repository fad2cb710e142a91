from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.llm import line_dedup, topk, url_filters

PAGES = "page_id long, url string, html string"


def link(url):
    return f'<html><head><link rel="canonical" href="{url}"></head><p>x</p></html>'


PAGE_ROWS = [
    (1, "http://a.example.com/en/1", "<p>x</p>"),
    (2, "HTTPS://WWW.Example.COM/en/1?q=1#top", None),
    (3, "http://m.b.net/es/9", ""),
    (4, "http://other.org/page", link("http://m.b.net/es/9")),
    (5, "https://www.other.org/page/?utm_source=x#y", "<p>no link</p>"),
    (6, "http://third.org/a", '<meta http-equiv="refresh" content="0; url=http://www.example.com/en/5">'),
    (7, "http://third.org/b", link("/a")),
    (8, "http://mixed.org/", link("http://z.net/fr/1")),
    (9, "http://mixed.org/index.html", link("https://x.com/ok")),
    (10, None, link("http://m.b.net/es/9")),
    (11, "no scheme here/es/", "<p>y</p>"),
    (12, "http://", "<p>y</p>"),
    (13, "ftp://net", "<p>y</p>"),
    (14, "http://xnet/es/", "<p>y</p>"),
    (14, "http://xnet/es/", "<p>y</p>"),
    (None, "http://deep.b.net/fr/?a=1&b=2", "<p>z</p>"),
    (15, "http://plain.org/q?b=2&a=1", link("http://deep.b.net/fr/?a=1&b=2")),
    (16, "https://plain.org/q.html?a=1&b=2&ref=x", None),
]
WANT = {
    1: ("a.example.com", "/en/1", "example.com/en/", "block"),
    2: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
    3: ("m.b.net", "/es/9", "net/es/", "block"),
    4: ("other.org", "/page", None, "block"),
    5: ("www.other.org", "/page/", None, "block"),
    6: ("third.org", "/a", None, "allow"),
    7: ("third.org", "/b", None, "allow"),
    8: ("mixed.org", "/", None, "allow"),
    9: ("mixed.org", "/index.html", None, "allow"),
    10: ("", "", None, "allow"),
    11: ("", "", None, "allow"),
    12: ("", "", None, "allow"),
    13: ("net", "", None, "allow"),
    14: ("xnet", "/es/", None, "allow"),
    None: ("deep.b.net", "/fr/", "net/fr/", "block"),
    15: ("plain.org", "/q", None, "block"),
    16: ("plain.org", "/q.html", None, "block"),
}


def test_rules_then_aliases_then_allow(spark):
    pages = spark.createDataFrame(PAGE_ROWS, PAGES).withColumns({c: F.lit("mine") for c in ("host", "rule", "verdict", "component", "a", "form")})
    rows = url_filters.judge(pages).collect()
    assert len(rows) == len(PAGE_ROWS)
    assert {r[0]: tuple(r)[1:] for r in rows} == WANT


def test_redirects_reach_further_and_cycles_end(spark):
    pages = spark.createDataFrame([(1, "http://p.org/1", None)], PAGES)
    redirects = spark.createDataFrame([("http://p.org/1", "http://q.org/2"), ("http://q.org/2", "http://p.org/1"), ("http://q.org/2", "http://r.net/fr/"), (None, "http://p.org/1")], "a string, b string")
    assert url_filters.judge(pages, redirects=redirects).first()["verdict"] == "block"
    assert url_filters.judge(pages.limit(0)).count() == 0


LINE_ROWS = [
    *[(i, "http://s.org/" + str(i), f"<nav>Menu</nav><p>Text {i}</p><p>Text {i}</p><!-- Menu --><script>Menu</script><b>bold &amp; {i}</b>") for i in range(6)],
    (6, "http://S.ORG/x", "<p>Menu</p><p>  Menu </p><div>own\t line</div>"),
    (7, "http://s.org/empty", ""),
    (8, "http://s.org/null", None),
    (9, "http://one.org/1", "<p>Menu</p><p>Alone</p>"),
    (10, None, "Menu\nplain text\n\n"),
    (11, "no host", "Menu"),
    (11, "no host", "Menu"),
    (None, "http://s.org/long", "<p>" + "w " * 60_000 + "</p><p>Menu</p>"),
]


def test_lines_over_the_ratio_go(spark):
    pages = spark.createDataFrame(LINE_ROWS, PAGES).withColumns({c: F.lit("mine") for c in ("host", "own", "content", "line", "n", "drop", "text", "pages")})
    rows = line_dedup.dedup(pages, 0.5).collect()
    assert len(rows) == len(LINE_ROWS)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["page_id"]].append(tuple(r)[1:])
    assert by_id[0] == [("s.org", 4, 1, "Text 0\nText 0\nbold & 0")]
    assert by_id[6] == [("s.org", 3, 2, "own line")]
    assert by_id[7] == by_id[8] == [("s.org", 0, 0, "")]
    assert by_id[9] == [("one.org", 2, 0, "Menu\nAlone")]
    assert by_id[10] == [("", 2, 1, "plain text")] and by_id[11] == [("", 1, 1, "")] * 2
    assert by_id[None][0][1:3] == (2, 1) and len(by_id[None][0][3]) == 119_999
    assert line_dedup.dedup(pages.limit(0)).count() == 0


def test_line_counts_as_by_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, f"http://h{i % 3}.org/", "\n".join(f"line {j}" for j in rng.integers(0, 12, rng.integers(0, 7)))) for i in range(60)]
    sites, counts = Counter(r[1] for r in rows), Counter((r[1], x) for r in rows for x in set(r[2].split("\n")) if x)
    want = {i: "\n".join(x for x in t.split("\n") if x and not (counts[u, x] > 1 and counts[u, x] > line_dedup.RATIO * sites[u])) for i, u, t in rows}
    assert {r["page_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, PAGES)).collect()} == want


LINKS = [
    ("http://a.org/x/y?q=1#f", "https://b.org/z", "https://b.org/z"),
    ("http://a.org/x/y?q=1#f", "//b.org/z", "http://b.org/z"),
    ("https://a.org/x/y", "/z?p=1", "https://a.org/z?p=1"),
    ("http://a.org/x/y?q=1", "?p=1&amp;r=2", "http://a.org/x/y?p=1&r=2"),
    ("http://a.org/x/y", "z", "http://a.org/x/z"),
    ("http://a.org/x/y/", "./z", "http://a.org/x/y/z"),
    ("http://a.org/x/y/w", "../z#f", "http://a.org/x/z#f"),
    ("http://a.org/x/y", "../../../z/..", "http://a.org/"),
    ("http://a.org/x/y", "/b/./c/../d", "http://a.org/b/d"),
    ("http://a.org", "z", "http://a.org/z"),
    ("http://a.org?q=1", "z/", "http://a.org/z/"),
    ("http://a.org/x", "#top", None),
    ("http://a.org/x", "", None),
    ("http://a.org/x", "mailto:me@b.org", None),
    ("no host", "/z", None),
    ("no host", "http://b.org/&#38;", "http://b.org/&"),
    (None, "/z", None),
]


@pytest.mark.parametrize("kind", ["canonical", "refresh"])
def test_every_form_of_link(spark, kind):
    def html(target):
        return f'<LINK REL=canonical href="{target}">' if kind == "canonical" else f"<meta http-equiv='Refresh' content=\"3; URL={target}\">"

    rows = [(i, url, html(target)) for i, (url, target, _) in enumerate(LINKS)]
    found = url_filters.page_links(spark.createDataFrame(rows, PAGES))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(((u, w) for u, _, w in LINKS if w), key=str)


def test_a_relative_link_carries_a_block(spark):
    rows = [(1, "http://www.q.net/es/a", ""), (2, "http://r.org/b/c", '<link rel="canonical" href="//www.q.net/es/a">'), (3, "http://r.org/b/d", '<link rel="canonical" href="../b/c">')]
    found = url_filters.judge(spark.createDataFrame(rows, PAGES)).collect()
    assert {r["page_id"]: r["verdict"] for r in found} == {1: "block", 2: "block", 3: "block"}


def truth(rows, queries, k):
    out = []
    for q, x in queries:
        sums = [(sum(int(a) * int(b) for a, b in zip(x, v, strict=True)), i) for i, v in rows if i != q]
        scored = sorted((-max(-(2**63), min(2**63 - 1, s)), i) for s, i in sums)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return out


def truth_of_row(rows, at, k):
    """Ids may be repeated or missing: only the row itself takes no part."""
    scored = sorted((-sum(a * b for a, b in zip(rows[at][1], v, strict=True)), i is None, i or 0, i) for n, (i, v) in enumerate(rows) if n != at)
    return [(rows[at][0], rank, i, -s) for rank, (s, _, _, i) in enumerate(scored[:k], 1)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 60), st.integers(1, 6), st.integers(1, 4))
def test_bounds_find_what_all_scores_find(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    x, ids = rng.integers(-spread, spread + 1, (n, dims)).astype(float), rng.permutation(n * 2)[:n]
    q, qids = np.vstack([x[:3], rng.integers(-9, 9, (2, dims))]).astype(float), np.append(ids[:3], [900, 901])[: len(x[:3]) + 2]
    qids = np.concatenate([ids[:3], [900, 901]])
    found = topk.nra(x, ids, ids, q, qids, 2)
    rows = list(zip(ids.tolist(), x.tolist(), strict=True))
    for (got, scores), own, asked in zip(found, qids.tolist(), q.tolist(), strict=True):
        want = truth(rows, [(own, asked)], 2)
        assert list(zip(ids[got].tolist(), scores.tolist(), strict=True)) == [(w[2], w[3]) for w in want]


def test_early_stops_are_exact_too():
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (2000, 8)).round(1) * 10
    x[:40] *= 30
    ids, lists = np.arange(2000), topk.Lists(x)
    for (got, scores), q in zip(topk.nra(x, ids, ids, x[:20], ids[:20], 5, lists), range(20), strict=True):
        all_scores = x @ x[q]
        all_scores[q] = -np.inf
        best = np.lexsort((ids, -all_scores))[:5]
        assert got.tolist() == best.tolist() and np.allclose(scores, all_scores[best])
    assert sum(lists.stops.values()) == 20 and lists.stops.get(1.0, 0) < 5


def test_given_vectors_stop_by_bounds(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").toPandas()
    x, ids = topk._matrix(rows["embedding"]), rows["vec_id"].to_numpy()
    lists, asks = topk.Lists(x), ids % 50 == 0
    found = topk.nra(x, ids, ids, x[asks], ids[asks], 5, lists)
    assert len(found) == 40 and lists.stops.get(1.0, 0) == 0


@pytest.mark.parametrize("blocks", [4096, 7])
def test_search_over_messy_vectors(spark, blocks, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", blocks)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(v) for v in rng.normal(0, 0.3, 4)]) for i in range(0, 60, 2)]
    rows += [(2**60, [0.5, -0.25, 1.0, 0.0]), (101, [0.1, 0.1]), (103, [])]
    bad = [(None, [1.0, None, 1.0, 1.0]), (105, None), (107, [1.0, None, 0.0, 0.0]), (109, [float("nan")] * 4), (111, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(0, rows[0][1]), (50, [0.9, 0.0, 0.2, 0.1]), (None, [0.4, 0.1, 0.0, 0.0])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumns({c: F.lit("mine") for c in ("asks", "score", "rank", "block", "run")})
    whole = [(i, [int(np.floor(256 * v)) for v in x] + [0] * (4 - len(x))) for i, x in rows]
    want = [w for at, r in enumerate(whole) if r[0] is not None and r[0] % 50 == 0 for w in truth_of_row(whole, at, 5)]
    found = topk.search(table, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert topk.search(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_sums_beyond_exact_floats(spark):
    rows = [(0, [1e12, 3.0]), (1, [1e12, 1.0]), (2, [1e12, 2.0]), (3, [-1e30, 0.0])]
    whole = [(i, [int(np.floor(256 * v)) for v in x]) for i, x in rows]
    found = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, found)) == sorted(truth(whole, whole[:1], 5))
