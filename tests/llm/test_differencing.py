"""Extraction of page texts: lines, alignment, partners and whole pages."""

from __future__ import annotations

import html as standard
import os
import random
import re

import pytest

from cartlens.llm import differencing
from tests.llm import brute

SCHEMA = "page_id long, url string, html string, row string, text int, host long, lines string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(3)


def texts(df) -> dict:
    return {r["page_id"]: r["text"] for r in df.collect()}


def longest(a, b) -> int:
    rows = [[0] * (len(b) + 1)]
    for x in a:
        above = rows[-1]
        rows.append([0])
        for j, y in enumerate(b):
            rows[-1].append(above[j] + 1 if x == y else max(above[j + 1], rows[-1][j]))
    return rows[-1][-1]


@pytest.mark.parametrize("cells", [2**28, 30, 1])
def test_alignment(monkeypatch, cells):
    monkeypatch.setattr(differencing, "CELLS", cells)
    rng = random.Random(cells)
    for _ in range(400):
        a, b = (rng.choices("abcdefg"[: rng.randint(1, 7)], k=rng.randint(0, 25)) for _ in range(2))
        found = differencing.common_lines(a, b)
        assert found == sorted(set(found)) and len(found) == longest(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def test_long_pages_align_quickly():
    a = [i % 5000 for i in range(30_000)]
    b = [i % 4999 for i in range(30_000)]
    found = differencing.common_lines(a, b)
    rest = iter(b)
    assert len(found) > 10_000 and all(a[i] in rest for i in found)


@pytest.mark.parametrize(
    "html,lines",
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>one<br>two\n\t three&nbsp;four<p>five", ["one two three four", "five"]),
        ("<p>a<b>b</b>c</p>d<div>e", ["abc", "d", "e"]),
        ("<script>var t='</p>';<p>no</script >yes<style>p{}</style>", ["yes"]),
        ("<script>never closed <p>text", []),
        ("before<!-- a > b -->after<!-->x<!-- open", ["beforeafterx"]),
        ("<div class='post ad'>no</div><p class=\"adult\">yes</p>", ["yes"]),
        ("<div title='class=ad'>yes</div><div data-id=ad>yes too</div>", ["yes", "yes too"]),
        ("<div title=\"a>b\" id=sidebar><p>no</div>yes", ["yes"]),
        ("<div role=navigation>no</div><div hidden>no</div>yes", ["yes"]),
        ("<span class=ad>no <b>no</b></span>yes", ["yes"]),
        ("<ul><li>a<li class=ad>no<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", ["a", "b", "c", "d", "e"]),
        ("<p class=notice>no<p>yes", ["yes"]),
        ("</div></p>yes</b>", ["yes"]),
        ("1 < 2 <3 and a<b", ["1 < 2 <3 and a"]),
        ("<p>tag that never ends <p class=\"", ["tag that never ends"]),
        ("&lt;p&gt; &copy;2 &#x41; &amp", ["<p> ©2 A &"]),
        ("<section><header>top</header><article><header><h1>Head</h1></header>text<footer>no</footer></article></section>", ["Head", "text"]),
        ("<article>text<article class='comment'>reply</article></article>", ["text"]),
        ("<form><label>no</label></form><button>no</button><nav>no</nav><aside>no</aside>yes", ["yes"]),
        ("<DIV CLASS=AD>no</DIV><P>yes</P>", ["yes"]),
    ],
)
def test_lines(html, lines):
    assert [text for text, _ in differencing.lines_of(html)] == lines


def test_hostile_pages_take_linear_time():
    for html in ("<" * 10**6, "<a " * 10**6, "<div>" * 10**5 + "x", "<p>x" * 10**5, "<!--" * 10**5, "<a b='" * 10**5, "&am" * 10**5):
        differencing.lines_of(html)
    assert len(differencing.lines_of("<ul><li>" * 10**5 + "x")) == 1


def page(*lines, tag="p"):
    return "<html><body>" + "".join(f"<{tag}>{x}</{tag}>" for x in lines) + "</body></html>"


def test_shared_lines_go_where_nothing_is_marked(spark):
    rows = [
        (1, "http://a.org/x/1", page("Site name", "first text of its own", "and more of it here", "Imprint")),
        (2, "http://a.org/x/2", page("Site name", "second text, quite another", "Imprint")),
        (3, "http://a.org/y/1", page("Other part", "third text, all its own", "Imprint")),
        (4, "http://b.org/x/1", page("Site name", "alone on its host", "Imprint")),
    ]
    found = {r["page_id"]: r for r in differencing.extract(table(spark, rows)).collect()}
    assert {k: r["text"] for k, r in found.items()} == {
        1: "first text of its own\nand more of it here",
        2: "second text, quite another",
        3: "Other part\nthird text, all its own",
        4: "Site name\nalone on its host\nImprint",
    }
    assert {k: (r["partner"], r["n_shared"], r["n_deleted"]) for k, r in found.items()} == {
        1: (2, 2, 2), 2: (1, 2, 2), 3: (2, 1, 1), 4: (None, 0, 0)
    }


def test_copies_and_quotes_stay(spark):
    article = "<nav>menu {}</nav><div>Site</div><article><h1>Head</h1><p>same text</p></article>"
    rows = [
        (1, "http://a.org/1", article.format(1)),
        (2, "http://a.org/2", article.format(2)),
        (3, "http://c.org/1", page("all of this", "is a copy")),
        (4, "http://c.org/1?again", page("all of this", "is a copy")),
    ]
    found = texts(differencing.extract(table(spark, rows)))
    assert found == {1: "Head\nsame text", 2: "Head\nsame text", 3: "all of this\nis a copy", 4: "all of this\nis a copy"}


@pytest.mark.parametrize("seed,pages", [(1, 60), (2, 400), (3, 5)])
def test_partners(spark, seed, pages):
    rng = random.Random(seed)
    hosts = ["hot" if rng.random() < 0.5 else f"h{rng.randint(0, 9)}" for _ in range(pages)]
    urls = [f"http://{h}/" + "".join(rng.choices("ab", k=rng.randint(0, 5))) for h in hosts]
    rows = [(i, url, f"<p>{i}") for i, url in enumerate(urls)]
    found = {r["page_id"]: r["partner"] for r in differencing.extract(table(spark, rows)).collect()}
    wanted = {}
    for host in set(hosts):
        own = sorted((url, i) for i, url, _ in rows if hosts[i] == host)
        for k, (url, i) in enumerate(own):
            near = [own[x] for x in (k - 1, k + 1) if 0 <= x < len(own)]
            best = max(near, key=lambda x: (len(os.path.commonprefix([url, x[0]])), x < (url, i)), default=(None, None))
            wanted[i] = best[1]
    assert found == wanted


def test_missing_repeated_and_empty(spark):
    rows = [(None, None, None), (1, None, "<p>x"), (1, None, "<p>x"), (2**60 + 1, "no host", "<p>" + "long " * 10**5), (3, "", "")]
    found = differencing.extract(table(spark, rows)).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in found) == [(0, 0), (1, 1), (1, 1), (3, 0), (2**60 + 1, 499_999)]
    assert differencing.extract(table(spark, [])).collect() == []


def test_given_pages(spark):
    pages = spark.read.parquet(f"{brute.FOLDER}/pages.parquet")
    wanted = {}
    for r in pages.collect():
        inner = re.search("(?s)<article>(.*)</article>", r["html"]).group(1)
        blocks = re.split(r"</?(?:p|h1)\b[^>]*>", inner)
        blocks = [" ".join(standard.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in blocks]
        wanted[r["page_id"]] = "\n".join(x for x in blocks if x)
    found = differencing.extract(pages)
    assert found.columns[:4] == ["page_id", "url", "text", "n_chars"]
    assert texts(found) == wanted
