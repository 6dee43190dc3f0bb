import pytest

from metrolens.llm.html_text import extract_text, main_text

ARTICLE = "<article><h1>T &amp; U</h1><p>one <b>two</b>three<p>four<br>five</article>"
TEXT = "T & U\n\none twothree\n\nfour five"


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("just words &lt;b&gt; &copy", "just words <b> ©"),
        (f"<html><body><nav><ul><li>m</li></ul></nav>{ARTICLE}<footer>f</footer></body></html>", TEXT),
        (f"<div class='x sidebar-left'><p>s</div>{ARTICLE}<aside><p>a</aside><form>q</form>", TEXT),
        (f"<script>var t='</p><article>no</article>';</script><style>p{{}}</style>{ARTICLE}", TEXT),
        (f"<div class='with-sidebar page'>{ARTICLE}</div><section id='comments'><article><p>{'long ' * 99}</article></section>", TEXT),
        (ARTICLE.replace("</article>", "<div class=ad>buy</div><div role=alert>!</div><p hidden>h</article>"), TEXT),
        ("<main><header><h1>H</h1></header><p>a\n\t b&nbsp;c</main><p>after", "H\n\na b c"),
        ("<p>a<p>b<!-- x <p>c --><p>d<!-- open", "a\n\nb\n\nd"),
        ("<p>a < b and 1<2</p><p>cut <a hr", "a < b and 1<2\n\ncut"),
        ("<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><th>3</table>z", "x\n\ny\n\n1\n\n2\n\n3\n\nz"),
        ("<ul><li><a href=/a>home</a></li><li><a href=/b>news</a></li></ul><p>body <a>link</a></p>", "body link"),
        ("<header>site</header><article><p>x</article><div class='cookie-notice'>c</div>", "x"),
        ("<article></article><p>y</p>", "y"),
        ("</p></div></article>x</b>", "x"),
        ("<P CLASS=Ad>no</P><P>yes</P>", "yes"),
        ("&#128512; &#x41; &bogus; &am", "\U0001f600 A &bogus; &am"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


LONG = " ".join(f"w{i}" for i in range(60))


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<main><p>{LONG}</p><div><article><p>teaser</article></div></main>", f"{LONG}\n\nteaser"),
        (f"<body><p>{LONG}</p><div><article><p>teaser</article></div></body>", f"{LONG}\n\nteaser"),
        (f"<main><p>{LONG}</p></main><article><p>teaser</article>", LONG),
        ("<article><p>part one</article><article><p>part two, longer</article><p>x", "part one\n\npart two, longer"),
        ("<main><h1>Title</h1><article><p>story</article></main><p>x", "Title\n\nstory"),
        (f"<article><p>story</article><nav>{LONG}</nav><div class='ad'>{LONG}</div>", "story"),
        (f"<article><p>story</article><ul><li><a href=/>{LONG}</a></li></ul>", "story"),
    ],
)
def test_root_holds_the_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><p>one</p><svg-icon></svg-icon><p>two</p>", "one\n\ntwo"),
        ("<article><p>one</p><title-bar>t</title-bar><template-x></template-x><p>two</p>", "one\n\nt\n\ntwo"),
        ("<article><p>one</p><svg viewBox='0 0'/><p>two</p>", "one\n\ntwo"),
        ("<article><p>one <svg/>more<p>two</p><svg><path/></svg>", "one more\n\ntwo"),
        ("<article><p>one</p><svg><p>two</p>", "one\n\ntwo"),
        ("<article><p>one</p><noscript><p>two</p>", "one\n\ntwo"),
        ("<article><p>one</p><iframe src='a>b'><p>two</p>", "one\n\ntwo"),
        ("<article><p>one</p><template><p>two</p>", "one\n\ntwo"),
        ("<article><p>one</p><svg><svg>a</svg>b</svg><template><p>c<template>d</template>e</template><p>two", "one\n\ntwo"),
        ("<article><p>one</p><svg><!-- <svg> --><text>a</text></svg ><script>'<svg>'</script><p>two", "one\n\ntwo"),
        ("<article><p>one</p><script>var a = 1;<p>two</p>", "one"),
        ("<article><p>one</p><style>p{}<p>two</p>", "one"),
        ("<article><p>one</p>" + "<svg><noscript>" * 9999 + "<p>two", "one\n\ntwo"),
    ],
)
def test_raw_elements_end(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "inner,text",
    [
        ("<h2 id='related-work'>a</h2><h2 id='social-impact'>b</h2><h2 id=related>c</h2>", "a\n\nb\n\nc"),
        ("<p class='share-price'>a</p><section id='notice-of-claim'><p>b</section>", "a\n\nb"),
        ("<section id='alert'><p>a</section><p class='notice'>b</p><p id='ad'>c</p>", "a\n\nb\n\nc"),
        ("<div class='cookie-recipe'>a</div><div class='no-sidebar'>b</div>", "a\n\nb"),
        ("<div class='share'>x</div><p class='ad'>x</p><div class='related-posts'>x</div><p>a", "a"),
        ("<div id='sidebar'>x</div><ul class='social-share-buttons'><li>x</ul><div id='google_ads_2'>x</div><p>a", "a"),
    ],
)
def test_names_of_parts(inner, text):
    assert main_text(f"<article>{inner}</article>") == text


def test_counts_decide_names_in_doubt():
    from metrolens.llm.html_text import deletable, parse

    page = "<article><p class='notice'>b</p><p>c</p><h2 id='related'>d</h2></article>"
    elements, _ = parse(page)
    notice = next(e for e in elements if e.doubt)
    assert [elements[i] for i in deletable(elements)] == [notice]
    assert main_text(page) == "b\n\nc\n\nd" and main_text(page, [notice.hash]) == "c\n\nd"


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string")


def test_site_templates_go(spark):
    """The box on every page of one host goes; the same text as a paragraph of articles stays."""
    box = "<div><p>Follow us</p><p>Since 1999</p></div>"
    rows = [(i, f"https://u@A.example:80/{i}", f"<body><p>own {i}</p>{box}</body>", "t", "h") for i in range(12)]
    rows += [(20 + i, "http://b.example/x", f"<article><p>same</p><p>own {i}</p></article>", "t", "h") for i in range(12)]
    rows += [(40, "http://c.example/", f"<body><p>own</p>{box}</body>", "t", "h")]
    rows += [(50 + i, "http://d.example/", f"<body>copy{box}</body>", "t", "h") for i in range(30)]
    got = {r.page_id: r.text for r in extract_text(pages_of(spark, rows), keep=["page_id", "url"]).collect()}
    for i in range(12):
        assert got[i] == f"own {i}"
        assert got[20 + i] == f"same\n\nown {i}"
    assert got[40] == "own\n\nFollow us\n\nSince 1999"
    assert all(got[50 + i] == "copy\n\nFollow us\n\nSince 1999" for i in range(30))  # one page, copied


def test_templates_of_large_and_small_hosts(spark):
    """A fifth of a host's pages are many, and so are all four of a small host; a heading on a fifth is none."""
    box = "<div class='x'><p>Our fair</p></div>"
    rows = [
        (i, "http://a/", f"<p>own {i}</p>{box}<h2>Notes</h2>" if i < 20 else f"<p>own {i}</p>", "t", "h") for i in range(100)
    ]
    rows += [(200 + i, "http://b/", f"<p>own {i}</p>{box}", "t", "h") for i in range(4)]
    rows += [(300 + i, None, f"<p>own {i}</p>{box if i < 9 else ''}", "t", "h") for i in range(40)]
    aside = "<aside><article><p>own {}</p><div>same</div></article></aside>"
    rows += [(400 + i, "http://c/", aside.format(i), "t", "h") for i in range(30)]
    got = {r.page_id: r.text for r in extract_text(pages_of(spark, rows), keep=["page_id"]).collect()}
    assert all(got[i] == f"own {i}" + ("\n\nNotes" if i < 20 else "") for i in range(100))
    assert all(got[200 + i] == f"own {i}" for i in range(4))
    assert all(got[300 + i] == f"own {i}\n\nOur fair" for i in range(9))  # pages without a host are no site
    assert all(got[400 + i] == f"own {i}" for i in range(30))


def test_named_parts_count_as_templates():
    from metrolens.llm.html_text import deletable, parse

    elements, _ = parse("<nav><ul><li>m</ul></nav><article><p>x</article>")
    assert [elements[i].tag for i in deletable(elements)] == ["nav", "ul", "li"]


def test_awkward_rows(spark):
    rows = [
        (None, None, None, None, None),
        (1, None, "<p>a", "t", "h"),
        (1, None, "<p>a", "t", "h"),
        (2, "not a url", "", "t", "h"),
        (3, "http://h/", "<div>" * 500 + "deep" + "</div>" * 400, "t", "h"),
        (4, "http://h/", "<p>" + "word " * 100_000, "t", "h"),
    ]
    found = extract_text(pages_of(spark, rows))
    assert found.columns[:4] == ["page_id", "url", "text", "host"] and len(found.columns) == 6
    got = found.collect()
    assert sorted(((r[0], r[4][:5], r[5]) for r in got), key=str) == sorted(
        [(None, "", 0), (1, "a", 1), (1, "a", 1), (2, "", 0), (3, "deep", 4), (4, "word ", 499_999)], key=str
    )
    assert extract_text(pages_of(spark, [])).count() == 0


def test_pages_of_the_smallest_table(spark):
    """The generator's articles are a heading and paragraphs between plain tags."""
    import html
    import re

    from metrolens.llm.html_text import op4_html

    sf = "/root/testdata/sf0.001"
    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op4_html(spark, sf).collect()
    assert len(got) == len(source)
    for r in got:
        body = source[r.page_id].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub("</?b>|<br>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(p for p in parts if p)
        assert r.n_chars == len(r.text)


def test_pages_with_one_article_keep_it(spark):
    """Print versions and copies under other menus: the article's parts stand on many pages, in one article."""
    article = (
        "<article><h1>Same story</h1><div class='body'><p>First paragraph of it.</p><p>Second one.</p></div>"
        "<ul><li>Salt</li><li>Pepper</li></ul><table><tr><td>1</td><td>2</td></tr></table></article>"
    )
    want = "Same story\n\nFirst paragraph of it.\n\nSecond one.\n\nSalt\n\nPepper\n\n1\n\n2"
    rows = [(i, f"http://a/{i}", f"<div><p>Menu {i}</p></div>{article}", "t", "h") for i in range(9)]
    rows += [(100 + i, f"http://b/{i}", f"<div><p>Menu {i}</p></div>{article}", "t", "h") for i in range(3)]
    # another title each, one body: it is the larger part
    rows += [(200 + i, f"http://c/{i}", article.replace("Same story", f"Story {i}"), "t", "h") for i in range(9)]
    # an unnamed box in different articles goes, also where no name gives it away
    box = "<div class='q7'><p>Read our other pages</p></div>"
    rows += [
        (300 + i, f"http://d/{i}", f"<article><p>An article of its own, number {i}</p>{box}</article>{box}", "t", "h")
        for i in range(9)
    ]
    got = {r.page_id: r.text for r in extract_text(pages_of(spark, rows), keep=["page_id"]).collect()}
    assert {got[i] for i in [*range(9), 100, 101, 102]} == {want}
    for i in range(9):
        assert "First paragraph of it.\n\nSecond one." in got[200 + i]
        assert got[300 + i] == f"An article of its own, number {i}"


def plain_templates(rows, share=0.3, least=8, fewest=3):
    """Templates of each page by counting in plain Python."""
    from metrolens.llm.html_text import LONE, articles, deletable, parse

    trees, hosts = {}, {}
    for _, url, page in rows:
        host = (url or "").split("//")[-1].split("/")[0] if "//" in (url or "") else ""
        trees.setdefault((host, page), parse(page)[0])
        hosts.setdefault(host, set()).add(page)
    out = {}
    for host, pages in hosts.items():
        standing: dict[int, set] = {}
        for page in pages:
            elements = trees[host, page]
            tops = articles(elements)
            name = tuple(elements[i].hash for i, t in enumerate(tops) if t == i)
            outer = {e.hash for e, t in zip(elements, tops) if t < 0}
            for e, top in zip(elements, tops):
                standing.setdefault(e.hash, set()).add(("page", page) if e.hash in outer else ("article", name))
        for page in pages:
            elements, found = trees[host, page], set()
            for i in deletable(elements):
                n = len(standing[elements[i].hash])
                many = n >= least and host and elements[i].tag not in LONE
                if n >= fewest and (n >= share * len(pages) or many):
                    found.add(elements[i].hash)
            out[host, page] = found
    return out


def test_counts_against_plain_python(spark):
    import random

    rnd = random.Random(6)
    boxes = [f"<div class='b{i}'><p>box {i}</p><p>more</p></div>" for i in range(6)]
    boxes += ["<ul><li>one</li><li>two</li></ul>", "<h2>News</h2>", "<p>Same line</p>", "<table><tr><td>x</td></tr></table>"]
    rows = []
    for i in range(160):
        host = rnd.choice(["http://a/", "http://a/", "http://b/", "http://c/", None])
        pick = lambda n: "".join(rnd.sample(boxes, rnd.randint(0, n)))
        article = f"<article><h1>Title {rnd.randint(0, 40)}</h1>{pick(2)}<p>words of text {rnd.randint(0, 60)}</p></article>"
        page = f"<body>{pick(3)}{article if rnd.random() < 0.8 else pick(2) + 'plain ' + str(i)}{pick(2)}</body>"
        rows.append((i, host and host + str(i), page))
    template = plain_templates(rows)
    assert sum(map(bool, template.values())) > 50
    docs = spark.createDataFrame([(*r, "t", "h") for r in rows], "page_id long, url string, html string, text string, host string")
    got = {r.page_id: r.text for r in extract_text(docs.repartition(5), keep=["page_id"]).collect()}
    for page_id, url, page in rows:
        host = url.split("//")[1].split("/")[0] if url else ""
        assert got[page_id] == main_text(page, template[host, page]), page


@pytest.mark.parametrize(
    "bad",
    ["<a b='" * 170_000 + "\">", "<div>" * 100_000 + "</p>" * 120_000, "<div>x" * 60_000, "<svg a='" * 120_000 + ">",
     "<" * 1_000_000, "</div>" * 170_000, "<p a" + " " * 1_000_000 + ">x", "<!--" * 250_000, "<template a=\"" * 80_000],
)
def test_a_megabyte_of_bad_markup_takes_seconds(bad):
    import time

    start = time.process_time()
    assert main_text("<article><p>one</p>" + bad).startswith("one")
    assert time.process_time() - start < 15


def test_tag_ends():
    import random
    import re

    from metrolens.llm.html_text import TagEnds

    whole = re.compile(r"(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>")
    rnd = random.Random(2)
    for _ in range(3000):
        text = "".join(rnd.choice("ab>>\"'") for _ in range(rnd.randint(0, 12)))
        slow = TagEnds(text)
        slow.work_out()
        for at in range(len(text) + 1):
            found = whole.match(text, at)
            want = found.end() if found else -1
            assert slow.of(at) == want and TagEnds(text).of(at) == want, (text, at)
