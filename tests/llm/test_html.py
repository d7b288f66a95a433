"""HTML extraction: markup cases, repeated runs against brute force, and whole tables."""

import collections
import time

import pytest

import __spark_entry__ as entry
from millrace.llm import html_extract

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "page_id bigint, url string, html string, host string, row bigint, text string"
T = "one two three four five six"


@pytest.mark.parametrize(
    ("page", "article", "texts"),
    [
        ("<nav>Menu</nav><div class='ad'>Buy<article><h1>T &amp; U</h1><p>one<br>two <b>three<p>four<aside>x</aside></article><footer>f", True, ["T & U", "one", "two three", "four"]),
        ("<article>A<section id=comments><article class='comment'>c</article></section></article>", True, ["A"]),
        ("<article>A<article class=ad>buy</article></article><aside><article>teaser</article></aside>", True, ["A"]),
        ("<body class='has-sidebar'><p>a", False, ["a"]),
        ("<html class='modal'><body class='social home'><p>a", False, ["a"]),
        ("<div id=menu-cuisine>food</div><div class=post-header-share>s</div><div class='main-nav'>m</div>", False, ["food", "s"]),
        ("<aside>side<main>M <p>text</main>", False, ["M", "text"]),
        ("<div class=banner><div>only text</div></div>", False, ["only text"]),
        ("a < b &lt; c <3 <b>x</b>y<!-- z", False, ["a < b < c <3 xy"]),
        ("<head><title>t</title><p>text", False, ["text"]),
        ("x<span class=ad>buy</span>y", False, ["x", "y"]),
        ("a<script>if (a < b) '</p>'</script>b<style>p{}</style> c", False, ["a", "b", "c"]),
        ("<p hidden>h</p><p style='display: none'>n</p><p title='a > b'>t&nbsp;&nbsp;u\n v</p>", False, ["t u v"]),
        ("<div itemprop=articleBody><p>x</div><p>y", True, ["x"]),
        ("text <a href='unfinished", False, ["text"]),
        (None, False, []),
        ("", False, []),
        (" \n ", False, []),
    ],
)
def test_markup(page, article, texts):
    assert html_extract.chosen_blocks(page) == (article, texts)


def test_junk_takes_linear_time():
    for junk in ("<a ", '<a href="', "<!--", "</", "<script>", "<div class=ad>", "<p>x</b>", "<![CDATA[", "<a x='", "<", "&"):
        began = time.process_time()
        html_extract.blocks_of(junk * 60_000)
        assert time.process_time() - began < 5


def brute(rows, length=6, pages=3):
    """The page texts, from all runs of all pages of a host."""
    chosen = [(i, u, (u or "").split("/")[2] if "//" in (u or "") else "", *html_extract.chosen_blocks(h)) for i, u, h in rows]
    on, of_host = collections.defaultdict(set), collections.Counter()
    for k, (_, _, host, _, texts) in enumerate(chosen):
        words = " ".join(texts).split()
        of_host[host] += 1
        for j in range(len(words) - length + 1):
            on[host, tuple(words[j : j + length])].add(k)
    out = []
    for i, u, host, article, texts in chosen:
        words = " ".join(texts).split()
        least = pages if not article else max(pages, -(-of_host[host] // 2)) if of_host[host] >= 8 else 1 << 60
        gone = set()
        for j in range(len(words) - length + 1):
            if len(on[host, tuple(words[j : j + length])]) >= least:
                gone |= set(range(j, j + length))
        if article:
            at, whole = 0, set()
            for text in texts:
                own = set(range(at, at + len(text.split())))
                at += len(own)
                whole |= own if own <= gone else set()
            gone = whole if 2 * len(whole) <= len(words) else set()
        text = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, u, text, len(text)))
    return sorted(out, key=repr)


def pages():
    rows = []
    for i in range(40):
        shared = f"<p>all rights of this site are kept {'always' if i % 2 else ''}</p>" if i < 30 else ""
        own = f"<p>own text of page number {i} is this one</p>"
        rows.append((i, f"http://a.example/{i}", f"<div>{own}{shared}</div>"))
        rows.append((100 + i, f"https://b.example/x/{i}", f"<article>{own * 2}<p>please read our other fine pages too</p>passage that only a few have {i % 9}</article>"))
    for i in (3, 17, 29, 38):  # four of many pages, far apart
        rows[2 * i] = (*rows[2 * i][:2], rows[2 * i][2] + "<p>this line stands on four pages only")
    copies = [(200 + i, "http://c.example/", f"<article><p>{T} seven eight</p><p>{T}</article>") for i in range(12)]
    rest = [(300, None, f"<p>{T}"), (301, None, f"<p>{T}"), (302, None, None), (None, "", ""), (None, "nothing", f"{T} x"), (303, "http://d.example", "é " * 30_000)]
    return rows + copies + rest + [rows[0]]


@pytest.mark.parametrize(("parts", "broadcast"), [(1, 1 << 20), (7, 1 << 20), (3, 20)])
def test_runs_by_brute_force(spark, parts, broadcast):
    rows = pages()
    table = spark.createDataFrame([(*r, "h", 1, "t") for r in rows], SCHEMA).repartition(parts)
    got = html_extract.extract(table, broadcast_runs=broadcast).collect()
    want = brute(rows)
    assert sorted((tuple(r) for r in got), key=repr) == want
    texts = {i: t for i, _, t, _ in want}
    assert texts[3] == "own text of page number 3" and "please read" not in texts[105] and texts[200] == f"{T} seven eight {T}"


def test_query_and_no_pages(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html").collect()]
    got = entry.queries()["op1_html_extraction"](spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert html_extract.extract(spark.createDataFrame([], SCHEMA)).collect() == []
