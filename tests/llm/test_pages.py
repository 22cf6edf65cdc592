import random
import re
import time
import tracemalloc

import pytest

from foliospark.llm import html_extract, url_filter
from foliospark.llm.html_extract import best, containers, text_at


def text(page, path=None):
    return text_at(containers(page), path)


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("plain &lt;text&gt;\n on  lines", "plain <text> on lines"),
        ("<p>one<p>two <b>bold</b>ly<br>three</p> tail", "one\ntwo boldly\nthree\ntail"),
        ("<ul><li>a<li>b</ul>", "a\nb"),
        ("<script>var x='<p>no</p>'</script>yes<style>p{}</style><!-- <p>no -->", "yes"),
        ("<nav>menu</nav><article><h1>T</h1><p>body text</p></article><footer>f</footer>", "T\nbody text"),
        ("<article><p>kept</p><div class='Comment-List'><p>no</p></div><p>also</p></article>", "kept\nalso"),
        ("<div id='sidebar-2'>no</div><div class=post>the story of it</div><form>no</form>", "the story of it"),
        ("<header>site</header><article><header><h1>T</h1></header><p>x</p></article>", "T\nx"),
        ("<p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p><p>yes</p>", "yes"),
        ("<p title='a>b'>quoted</p><a href=\"x>y\">z</a>", "quoted\nz"),
        ("1 < 2 && 3 > 2 <", "1 < 2 && 3 > 2 <"),
        ("&eacute;&#233;&#xe9;&nbsp;&amp;amp; &unknown;", "ééé &amp; &unknown;"),
        ("</p></div><p 'unbalanced>text</p>more", "text\nmore"),
        ("<SCRIPT>x</SCRIPT><P>Upper</P><script>unclosed", "Upper"),
    ],
)
def test_text(page, want):
    assert text(page) == want


def test_paths_are_generalised():
    page = "<div class='b post-12 a'><section><p>words words</p></section></div>"
    assert [n.path for n in containers(page)] == ["", "/div.a.b.post-#", "/div.a.b.post-#/section"]
    assert best(containers(page)).path.endswith("/section")


def test_random_markup_is_read_in_time():
    rng = random.Random(6)
    bits = ["<", ">", "<p", "</", "\"", "'", "<!--", "-->", "=", " a", "<div class=x>", "</div>", "&amp", "<script", "<td>", "<a href="]
    for _ in range(300):
        text("".join(rng.choice(bits) for _ in range(rng.randint(1, 200))))
    text("<a '" * 20000)
    text("<div>" * 3000 + "x")


def _pages_of(length):
    words = "some words "
    return {
        "unclosed divs": "<div>" * (length // 5) + "x",
        "divs with text": "<div>some words " * (length // 16),
        "divs with long names": f"<div class='{'n' * 40} m'>w " * (length // 55),
        "stray ends": "<i>" * (length // 6) + "</b>" * (length // 8),
        "breaks below open elements": "<i>" * (length // 6) + "<br>x" * (length // 10),
        "items below open elements": "<ul>" + "<i>" * (length // 6) + "<li>x" * (length // 10),
        "cells": "<table>" + "<b><td>x" * (length // 8),
        "nested names": "<div class=ad>w " * (length // 16),
        "articles": "<article>w <div class=widget>" * (length // 29),
        "paragraphs": words + "<p>w" * (length // 4),
        "headers": "<section>" * (length // 20) + "<header>" * (length // 16),
    }


@pytest.mark.parametrize("kind", list(_pages_of(0)))
def test_long_pages_are_read_in_time_and_space_of_their_length(kind):
    seconds, peaks = [], []
    for length in (100_000, 1_000_000):
        page = _pages_of(length)[kind]
        tracemalloc.start()
        start = time.perf_counter()
        text(page)
        seconds.append(time.perf_counter() - start)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert seconds[1] < 40 * seconds[0] + 2 and seconds[1] < 60
    assert peaks[1] < 15 * peaks[0] + 10_000_000 and peaks[1] < 400_000_000


def test_paths_of_many_hosts_are_joined(spark):
    rows = [(i, f"http://h{i % 7}.net/{i}", f"<div class='p{i % 7}'>story {i}</div><div class=x>other, longer than the story {i}</div>") for i in range(60)]
    df = spark.createDataFrame(rows + [(99, None, "<p>lost</p>")], "page_id long, url string, html string")
    few, many = (sorted(map(tuple, html_extract.extract(df, n).collect())) for n in (1000, 1))
    assert few == many and len(few) == 61


def test_hosts_agree_on_a_path(spark):
    story = "<div class='main s{0}'><p>story {0} with words</p></div>"
    aside = "<div class='related-x'>{0}</div><div class='extra'>{1}</div>"
    rows = []
    for i in range(40):
        # on the last pages the extra block is longer than the story
        noise = "word " * (60 if i >= 35 else 3)
        rows.append((i, f"http://a.net/{i}", "<body>" + story.format(i) + aside.format(i, noise) + "</body>"))
    rows.append((99, "http://b.net/", "<article>alone</article>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    win = {r.host: r.path for r in html_extract.winning_paths(df).collect()}
    assert win == {"a.net": "/div.main.s#", "b.net": "/article"}
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {**{i: f"story {i} with words" for i in range(40)}, 99: "alone"}


RULES = url_filter.RULES


def plain_judge(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.DOTALL)
    if not m or "://" not in (url or ""):
        return "", "", None
    at = url.index("://") + 3
    rest = re.split(r"[?#]", url[at:], maxsplit=1)[0]
    host, slash, tail = rest.partition("/")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = slash + tail
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text), default=None)


def test_rules_equal_plain(spark):
    rng = random.Random(7)
    hosts = "com a.com EXAMPLE.com www.example.com x.www.example.com wexample.com net b.net É.net xnet org".split()
    tails = ["", "/", "/en/", "/en", "/es/a", "/fr/", "?a=/en/", "#x", "/EN/", "/es/?q#f", "/a://b"]
    urls = [f"{s}://{h}{t}" for s in ("http", "https", "") for h in hosts for t in tails]
    urls += [None, "", "no", "a.com/en/", "://", ":// /", "http://", "x:/y", "http://[::1]/en/"]
    rng.shuffle(urls)
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r.page_id: r for r in url_filter.judge(df).collect()}
    for i, u in enumerate(urls):
        host, path, rule = plain_judge(u)
        r = out[i]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text), u
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")
        assert 0 <= r.score <= 1


def test_features(spark):
    url = "https://ab1.example.org/x/Y-2/?a=1&b=%20#f"
    row = url_filter.described(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert row.suffix == "org" and row.depth == 3 and row.host_labels == 3 and row.parameters == 2
    assert row.query_length == 9 and row.has_fragment == 1 and row.is_https == 1 and row.ends_in_slash == 1
    from math import log2

    shares = [url.count(c) / len(url) for c in set(url)]
    assert row.entropy == pytest.approx(-sum(p * log2(p) for p in shares))


def test_trees_learn_what_rules_label(spark):
    """Urls of an unknown suffix are judged by their likeness to labelled ones."""
    rows = [(i, f"http://h{i}.net/es/{i}{'0' * 30}?a=1&b=2&c=3") for i in range(200)]
    rows += [(1000 + i, f"https://h{i}.com/{'abcdefgh'[i % 8]}") for i in range(200)]
    rows += [(5000, "http://u.org/es/7" + "0" * 30 + "?a=1&b=2&c=3"), (5001, "https://u.org/abc")]
    out = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert out[5000].verdict == "block" and out[5001].verdict == "allow"


def test_one_label_only(spark):
    df = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.org/")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge(df).collect()} == {1: "allow", 2: "allow"}
