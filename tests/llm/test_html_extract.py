import re

import pytest

from machinewatch.llm.html_extract import best_path, extract, extract_pages, host_paths, parse

WORDS = "A sentence of the article that is long enough to count, with a comma or two. "


def _page(body):
    return f'<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var x="</p><p>no";</script></head><body>{body}</body></html>'


def test_semantic_page():
    page = _page(
        '<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy now</div><!-- <p>hidden</p> -->'
        '<article><header><h1>Head&shy;line</h1><span>by Someone</span></header><p>First <b>bold</b>ly\n  set &lt;text&gt;.<p>Second'
        '&nbsp;one<br>broken.<aside>Related</aside><form><input><button>Send</button></form>'
        '<div class="comments"><p>A reader writes at length about this and that and more.</p></div></article>'
        '<footer>&copy; 2020</footer>')
    assert extract(page, []) == "Head\xadline First boldly set <text>. Second one broken."


def test_containers_without_semantic_tags():
    page = _page(
        f'<div id="top-menu"><a href="/a">A</a> <a href="/b">B</a></div><div class="wrap"><div class="post-12"><h2>Title</h2><p>{WORDS * 3}</p>'
        f'<div class="share">Share this</div><p>{WORDS}</p></div><div class="sidebar"><p>{WORDS}</p></div></div>'
        '<div class="cookie-notice">We use cookies.</div>')
    path, _ = best_path(parse(page))
    assert path == "/html/body/div.wrap/div.post-"
    assert extract(page, []) == " ".join(["Title", *(WORDS * 4).split()])


def test_broken_markup():
    assert extract("<article><p>cut in the mid", []) == "cut in the mid"
    assert extract("<article><p>cut &am", []) == "cut &am"
    assert extract("plain words only", []) == "plain words only"
    assert extract("<article><p>a < b <p>c</article", []) == "a < b c"
    assert extract("<article>one<script>two", []) == "one"
    assert extract("<p>x</p></div></span><p>y</p>", []) == "x y"
    assert extract("<nav><a href=x>only a menu</a></nav>", []) == "" and extract("", []) == "" and extract(None, ["/p"]) == ""


def test_host_consensus_overrules_a_page(ready):
    usual = _page(f'<div class="story-7"><p>{WORDS * 2}</p><p>{WORDS}</p></div><div class="extra"><p>Short.</p></div>')
    odd = _page(f'<div class="story-9"><p>Brief story.</p></div><div class="extra"><p>{WORDS * 5}</p></div>')
    other = _page(f'<div class="extra"><p>{WORDS}</p></div>')
    rows = [(i, f"https://Site.example/{i}", usual) for i in range(5)] + [
        (5, "http://site.example:8080/x?y", odd), (6, "http://site.example/z", other), (7, "no url", odd), (8, None, other)]
    pages = ready.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, host string")
    got = {r["page_id"]: r["text"] for r in extract_pages(pages).collect()}
    assert got[5] == "Brief story."
    assert got[6] == got[8] == WORDS.strip()
    assert got[7] == (WORDS * 5).strip()
    assert all(got[i] == (WORDS * 3).strip() for i in range(5))


BODY, LEAD = f"<p>{WORDS * 4}</p>", "The lead says what the article is about, in a sentence or two of its own. "


@pytest.mark.parametrize("page, expected", [
    (f'<article class="post comments-open">{BODY}</article>', WORDS * 4),
    (f'<section class="post comments-open">{BODY}</section>', WORDS * 4),
    (f'<div class="content no-sidebar">{BODY}</div>', WORDS * 4),
    (f'<div class="layout has-sidebar"><div class="sidebar"><p>{WORDS}</p></div><div class="text">{BODY}</div></div>', WORDS * 4),
    (f'<div class="wrap"><div class="lead"><p>{LEAD}</p></div><div class="body">{BODY}</div></div>', LEAD + WORDS * 4),
    (f'<div class="page"><div class="lead"><p>{LEAD}</p></div><div class="a-b"><div class="body">{BODY}</div></div></div>', LEAD + WORDS * 4),
    (f'<div id="widget-area"><article>{BODY}</article></div>', WORDS * 4),
    (f'<div class="banner page"><h1>Head</h1>{BODY}</div>', "Head " + WORDS * 4),
    (f'<div class="post">{BODY}</div><div class="comments"><article class="comment"><p>{WORDS * 9}</p></article></div>', WORDS * 4),
    (f'<article>{BODY}<div class="comments-area"><p>{WORDS * 9}</p></div></article>', WORDS * 4),
    (f'<div class="w-1/2 text">{BODY}</div>', WORDS * 4)])
def test_names_and_wrappers(page, expected):
    assert extract(_page(page), []) == expected.strip()


def test_deep_and_stray_markup():
    import time
    import tracemalloc

    tracemalloc.start()
    began = time.time()
    assert extract("<div>" * 100_000 + WORDS, []) == WORDS.strip()
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    assert extract("<div>" * 20_000 + "</span></section>" * 20_000 + WORDS, []) == WORDS.strip()
    assert extract("<custom>" * 20_000 + "<p>x</p>" * 20_000, []) == " ".join("x" * 20_000)
    assert time.time() - began < 60


def _slow_votes(rows):
    """Votes and winners host by host, from the definition."""
    votes = {}
    for _, url, page in rows:
        host = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", url or "")
        best = best_path(parse(page)) if host and page else None
        if best:
            own = votes.setdefault(host[1].lower(), {})
            own[best[0]] = own.get(best[0], 0) + 1
    out = {}
    for host, own in votes.items():
        order = sorted(own, key=lambda p: (-own[p], p))[:5]
        out[host] = [p for i, p in enumerate(order) if i == 0 or own[p] >= 0.05 * sum(own.values())]
    return out


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_votes_and_pages_equal_brute_force(ready, limit):
    """One host with most pages, hosts with several layouts, pages without a host; broadcast and salted."""
    kinds = [f'<div class="{c}"><p>{WORDS * n}</p></div><div class="x{i % 3}"><p>Short {i}.</p></div>'
             for i, (c, n) in enumerate([("a-1", 1), ("a-2", 2), ("b", 3), ("c", 2), ("d", 1), ("e", 4), ("f", 1)])]
    rows = [(i, "http://Big.example/%d" % i if i % 10 else [None, "no url", "https://u@h%d.example:1/x" % (i // 30 % 3)][i // 10 % 3],
             _page(kinds[i * i % 7]) if i % 23 else None) for i in range(300)]
    pages = ready.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, k string, salt int")
    won = {r["host"]: list(r["paths"]) for r in host_paths(pages).collect()}
    assert won == _slow_votes(rows) and len(won) == 4
    got = {r["page_id"]: r["text"] for r in extract_pages(pages, limit=limit).collect()}
    hosts = {i: re.search(r"(big|h\d)\.example", (url or "").lower()) for i, url, _ in rows}
    assert got == {i: extract(page, won.get(hosts[i][0], []) if hosts[i] else []) for i, _, page in rows}


def test_html_is_not_shuffled_by_host(ready):
    pages = ready.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = extract_pages(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(h" not in plan


def test_pages_of_the_tables(ready):
    import html

    pages = ready.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extract_pages(pages).collect():
        plain = re.sub(r"(?s)<(script|style).*?</\1>", "", source[r["page_id"]])
        article = re.search(r"(?s)<article>(.*?)(?:</article>|\Z)", plain).group(1)
        article = re.sub(r"<[^>]*(?:>|\Z)", " ", re.sub(r"</?(?:b|i|a)\b[^>]*>", "", article))
        assert r["text"] == " ".join(html.unescape(article).split()) and r["n_chars"] == len(r["text"])


def test_odd_rows(ready):
    schema = "page_id long, url string, html string"
    long_page = _page("<article>" + f"<p>{WORDS}</p>" * 20_000 + "</article>")
    rows = [(1, "http://a.example/1", None), (2, "http://a.example/2", ""), (None, None, None), (3, "http://a.example/3", long_page),
            (3, "http://a.example/3", long_page)]
    pages = ready.createDataFrame(rows, schema)
    got = extract_pages(pages).collect()
    assert len(got) == 5
    assert all(r["n_chars"] == len(r["text"]) == (20_000 * len(WORDS) - 1 if r["page_id"] == 3 else 0) for r in got)
    assert extract_pages(ready.createDataFrame([], schema)).count() == 0
