"""URL filters and HTML extraction."""

from __future__ import annotations

import html
import re
import time

import duckdb
import numpy as np
import pytest
from hand_pages import PAGES

from pairloom.llm import dom, extraction, layouts, urls

SF_DIR = "/root/testdata/sf0.001"

URLS = [
    (1, None), (2, "foo"), (3, "HTTP://A.EXAMPLE.Net"), (4, "x://example.net/en/?a"), (5, "a://x.net/en/"),
    (6, "a://net?x://b.net/"), (7, "a://b.ORG/fr/É#?"), (8, "a://É.net/\n?"), (9, "://"), (None, "a://myexample.net/en/x"),
    (10, "a://example.com/de"), (11, "a://q.example.com/de/x"), (11, "a://q.example.com/de/x"), (12, "a://..net//"),
    (13, ""), (14, "http://" + "a." * 3000 + "net/" + "p" * 50_000), (15, "a://example.net:80/en/"),
]


def plain_rule(host, path, rules):
    fits = []
    for rule in rules:
        own_host, own_path = rule.split("/", 1)
        if (host == own_host or host.endswith("." + own_host)) and path.startswith("/" + own_path):
            fits.append(rule)
    return max(fits, key=lambda r: (len(r), len(r.split("/")[0])), default=None)


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, "<p>x", 1, "v") for i, u in rows], "page_id long, url string, html string, host int, rule string")


@pytest.mark.parametrize("collide", [False, True])
def test_url_rules(spark, monkeypatch, collide):
    many = [*urls.RULES, ("net/", "block"), ("b.org/", "block"), *((f"h{i}.test/x{i}/", "block") for i in range(2_000))]
    rules = dict(many)
    if collide:
        array = urls.RuleArray(*_compiled(many, lambda r: len(r) % 3), [1, 4, 5, 6, 7])
        monkeypatch.setattr(urls, "digest", lambda r: len(r) % 3)
        hosts, paths = ["example.net", "q.h7.test", "h7.test"], ["/en/", "/x7/a", "/x8/"]
        assert [r for r, _ in array.longest(hosts, paths)] == ["example.net/en/", "h7.test/x7/", None]
        return
    rows = URLS + [(100 + i, f"http://s.h{i}.test/x{i}/y") for i in range(0, 2_000, 97)]
    got = urls.filtered(pages_of(spark, rows), many).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.rule == plain_rule(r.host, r.path, rules)
        assert r.verdict == rules.get(r.rule, "allow")
    assert urls.filtered(pages_of(spark, URLS), []).filter("rule is not null or verdict <> 'allow'").count() == 0
    assert urls.filtered(pages_of(spark, URLS).limit(0), many).count() == 0


def _compiled(rules, digest):
    ordered = sorted(dict(rules), key=lambda r: (digest(r), r))
    texts = [r.encode() for r in ordered]
    ends = np.cumsum([len(t) for t in texts])
    table = np.zeros(len(ordered), dtype=urls.ENTRY)
    table["digest"], table["begin"], table["end"] = [digest(r) for r in ordered], ends - [len(t) for t in texts], ends
    return table, np.frombuffer(b"".join(texts), np.uint8)


def test_url_query_equals_sql(spark):
    rows = sorted(map(tuple, urls.filtered(pages_of(spark, URLS), urls.RULES).collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", URLS)
    assert sorted(con.sql(urls.ORACLE_SQL).fetchall(), key=str) == rows


def texts_of(page):
    return [b.text for b in dom.blocks(page)]


def test_leaf_blocks():
    assert texts_of("<p>a &amp; b&nbsp;&eacute;<br>c</p><p>d <b>e</b>f<p>g<!-- x > <p>no</p> --><li>h<li>i") == [
        "a & b é c", "d ef", "g", "h", "i"]
    assert texts_of('<script>var t="</p>";</script>x<style>p{}</style><SCRIPT a=">">y</SCRIPT> z<noscript>n') == ["x z"]
    assert texts_of("a < b <3 </nothing> <div title='x > y' class=q>c</div") == ["a < b <3", "c</div"]
    assert texts_of('<div hidden>a</div><div style="display: none"><p>b</p></div><p>c') == ["a", "b", "c"]
    assert texts_of("") == texts_of("  <p> <div>\n") == []
    deep = dom.blocks('<body><nav class="Main-menu topNav"><ul><li><a href=x>link</a></li></ul></nav>t')
    assert deep[0].tags == ("body", "nav", "ul", "li") and deep[0].names == {"main", "menu", "top", "nav"}
    assert deep[0].link_chars == 4 and deep[1].tags == ("body",)


def test_nothing_is_swallowed():
    for first in ('<svg-icon></svg-icon>', '<svg class="i"/>', '<math/>', "<video-player></video-player>", "<style-guide>",
                  "<object-viewer></object-viewer>", "<style>p{}", "<iframe src=x>", "<script>f(1 < 2)", "<textarea>",
                  "<svg><title>icon", "<noscript>on", "<video src=x>", "<canvas></canvas>"):
        assert texts_of(f"<article>{first}<p>rest</p><p>more</p></article>") == ["rest", "more"], first
    assert texts_of("<p>a <svg><title>t</title><path d=x /><text>in</text></svg> b <math><mi>x</mi><mo>=</mo><mn>2</mn>"
                    "<annotation>x=2</annotation></math> c</p>") == ["a in b x=2 c"]  # fmt: skip
    assert texts_of("<p>a <noscript><img src=x></noscript> b</p><object>c<p>d</p></object><video><source src=x>e</video>") == [
        "a b", "c", "d", "e"]
    assert texts_of('<script>"</scripted><p>no</p>"</script ><p>a') == ["a"]
    many = "<script><p>a" * 20_000
    assert len(texts_of(many)) == 20_000


def hidden_of(page):
    return [b.text for b in dom.blocks(page) if b.hidden]


def test_hidden_is_an_attribute_and_not_a_word():
    """Hidden text is read, and marked: whether it is main text is for the model to say."""
    shown = ['title="the hidden door"', 'class="x hidden y"', "hidden=until-found", 'data-style="display:none"', 'alt="a style=\'display:none\'"']
    for attributes in shown:
        assert texts_of(f"<div {attributes}>a</div><p>c") == ["a", "c"] and hidden_of(f"<div {attributes}>a</div><p>c") == [], attributes
    for attributes in ("hidden", 'HIDDEN=""', 'hidden="hidden"', 'id=x style="color:red; Display : none"', "style=display:none"):
        page = f"<div {attributes}><ul><li>a</li></ul></div><p>c"
        assert texts_of(page) == ["a", "c"] and hidden_of(page) == ["a"], attributes
    assert hidden_of('<body style="display:none"><p>a</p><div hidden>b</div>') == ["b"]


def test_tags_end_as_written():
    assert texts_of('<p title="a > b">x</p>') == ["x"] and texts_of("<p title='a > b' class=\"q > r\">x</p>") == ["x"]
    assert texts_of('<p>a</p><p title="open>b</p><p>c</p>') == ["a", "b", "c"]  # quotes that never close
    assert texts_of("<p>a</p><!-- no <p>no</p>") == ["a"] and texts_of("a<!---->b<!-- > -->c") == ["abc"]
    assert texts_of("a <p") == ["a <p"] and texts_of("x <1> y </ z> <?php a ?> w") == ["x <1> y w"]


@pytest.mark.parametrize(
    "page",
    ["<p" * 100_000, "<p " * 60_000 + '"', '<a ">" ' * 30_000 + '"', "<!" * 100_000, "<div>" * 40_000 + "</p>" * 40_000,
     "<object>" * 20_000 + "x" + "</object>" * 20_000, "<video><source>" * 15_000 + "</video>", "<script>" * 30_000,
     "<li>" * 40_000, "<svg><title>" * 20_000, "<a class='" + "x " * 100_000 + "'>y", "&" * 200_000, "<!--" * 50_000],
)
def test_time_follows_the_length_of_a_page(page):
    start = time.process_time()
    dom.blocks(page)
    assert time.process_time() - start < 5


def test_deep_nesting_keeps_its_text():
    found = dom.blocks("<div>" * 3000 + "<p>a</p>" + "<b>c" + "</div>" * 3000 + "<p>d")
    assert [b.text for b in found] == ["a", "c", "d"] and len(found[0].tags) == dom.DEEPEST


def test_hand_written_pages():
    chain = extraction.default_chain()
    for page, main in PAGES:
        assert extraction.main_text(chain, page) == "\n".join(main), page


def test_marginals_equal_sums_over_all_labellings():
    rng = np.random.default_rng(4)
    emit, pairs = rng.normal(size=(3, 5, 2)), rng.normal(size=(2, 2))
    real = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], dtype=bool)
    emit[~real] = 0
    share, joint = extraction.marginals(emit, real, pairs)
    for i, t in enumerate(real.sum(axis=1)):
        every = [[k >> j & 1 for j in range(t)] for k in range(1 << t)]
        score = np.array([sum(emit[i, j, y] for j, y in enumerate(ys)) + sum(pairs[a, b] for a, b in zip(ys, ys[1:])) for ys in every])
        p = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
        for j in range(t):
            assert share[i, j] == pytest.approx(sum(q for q, ys in zip(p, every) if ys[j]))
        for j in range(t - 1):
            for a in (0, 1):
                for b in (0, 1):
                    assert np.exp(joint[i, j, a, b]) == pytest.approx(sum(q for q, ys in zip(p, every) if ys[j : j + 2] == [a, b]))


def test_viterbi_finds_the_best_labelling():
    chain = extraction.Chain({"bias": 0.3, "tag:p": 1.0, "tag:li": -2.0, "first": -0.7}, np.array([[0.4, -0.9], [-0.8, 0.6]]))
    found = dom.blocks("<p>a<li>b</li><p>c<div>d</div><p>e<li>f</li><li>g</li>")
    emit = [sum(chain.weights.get(x, 0) for x in names) for names in extraction.features(found)]

    def score(labels):
        return sum(e for e, y in zip(emit, labels) if y) + sum(chain.pairs[a, b] for a, b in zip(labels, labels[1:]))

    every = [[n >> i & 1 for i in range(len(found))] for n in range(1 << len(found))]
    assert score(chain.labels(found)) == pytest.approx(max(map(score, every)))


def test_labelled_pages_can_be_read():
    for page, main in layouts.labelled_pages(150, seed=3):
        assert sum(extraction.aligned(dom.blocks(page), main)) == len(main)


def test_held_out_layouts():
    chain, right, n = extraction.default_chain(), 0, 0
    for page, main in layouts.labelled_pages(200, seed=12345):
        found = dom.blocks(page)
        want, got = extraction.aligned(found, main), chain.labels(found)
        right, n = right + sum(a == b for a, b in zip(want, got)), n + len(want)
    assert right / n > 0.97


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r.page_id: r.text for r in extraction.extracted(pages).collect()}
    for r in pages.collect():
        article = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        parts = [html.unescape(re.sub("<[^>]*>", "", p)) for p in re.split("</?(?:p|h1)>", article.replace("<br>", " "))]
        assert got[r.page_id] == "\n".join(" ".join(p.split()) for p in parts if p.strip())


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (None, "u", "<nav>a"), (4, "u", "<article><p>" + "long " * 60_000),
            (5, "u", "<article><h1>T</h1><p>a</p></article>"), (5, "u", "<article><h1>T</h1><p>a</p></article>")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, text int, n_chars int")
    got = extraction.extracted(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[None] == "" and by[5] == "T\na" and by[4] == ("long " * 60_000).strip()
    assert extraction.extracted(df.limit(0)).count() == 0
