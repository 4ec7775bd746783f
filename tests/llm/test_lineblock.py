import time

import pytest

from procura.llm import lineblock
from procura.llm.lineblock import between, main_text

LONG = "The council met on Tuesday and agreed on the plan for the harbour, which had been open to comment since the spring of last year."
MORE = "Work begins in May; two piers close for a month & ferries leave from the old quay until then, so allow a quarter of an hour more."

PAGES = {
    "named article": (
        f"<html><head><title>x</title><style>p{{}}</style></head><body><nav><ul><li><a href=/a>Home</a></ul></nav><div class='ad'>{LONG}</div>"
        f"<article><h1>The harbour</h1><p>{LONG}</p><p>Yes.</p><ul><li>one</li><li>two</li></ul><p>{MORE.replace('&', '&amp;')}</p></article>"
        f"<footer>&copy; someone {LONG}</footer></body></html>",
        ["The harbour", LONG, "Yes.", "one", "two", MORE]),
    "boilerplate inside the article": (
        f"<main><article><header><h1>A title</h1></header><script>if (a < b) x('</p>');</script><p>{LONG}</p><aside>{MORE}</aside>"
        f"<div class='share-buttons'>Share this</div><form><label>Mail</label><input></form><p>End.</p><footer>By someone</footer></article>"
        f"<section id='comments'><article class='comment'><p>{LONG} {LONG} {LONG}</p></article></section></main>",
        ["A title", LONG, "End."]),
    "divs only": (
        f"<body class='has-sidebar'><div id='header'>Site name and a motto</div><div class='menu'><a href=1>One</a><a href=2>Two</a></div>"
        f"<div class='cookie-notice'>{LONG} {MORE}</div><div class='content'><h2>A title</h2><div><p>{LONG}</p><p>Short.</p><p>{MORE}</p></div></div>"
        f"<div class='sidebar'>{LONG}</div><div id='disqus_thread'>{LONG} {LONG}</div><div class='site-footer'>{LONG}</div></body>",
        ["A title", LONG, "Short.", MORE]),
    "links do not surge": (
        f"<div><p>{LONG}</p><p>{MORE}</p></div><br><div><ul>" + "".join(f"<li><a href={i}>A story about something else {i}</a></li>" for i in range(9))
        + "</ul></div>", [LONG, MORE]),
    "white space and references": (
        f"<article><p>a\n b\t<b>c</b>d<br>e &lt;f&gt; &#233;&nbsp;&amp;amp; &amp g</p><p> \n </p>tail {LONG}</article>",
        ["a b cd e <f> é &amp; & g", f"tail {LONG}"]),
    "tags in capitals, odd quotes": (
        f"<ARTICLE data-x='a > b'><P CLASS=\"lead\" title=\"it's > x\">{LONG}</P><p>1 < 2 and 3 > 2, a<3</p></ARTICLE>",
        [LONG, "1 < 2 and 3 > 2, a<3"]),
    "cut page": (f"<article><h1>T</h1><p>{LONG}</p><p>and th<a hre", ["T", LONG, "and th"]),
    "unclosed advert": (f"<body><div class='ad'>{MORE}<article><p>{LONG}</p></article></body>", [LONG]),
    "hidden": (f"<article><p>{LONG}</p><p hidden>{MORE}</p><p style='display: none'>x</p><span class='ad'>a <span>b</span> c</span><p>d</p></article>",
               [LONG, "d"]),
    "comment to the end": (f"<article><p>{LONG}</p><!-- {MORE}", [LONG]),
    "largest article": (f"<article class='teaser'><p>See also</p></article><article><p>{LONG}</p></article>", [LONG]),
    "long gap inside the article": (f"<article><p>{LONG}</p><div><div><div><hr><hr><hr></div></div></div><p>Then.</p></article>", [LONG, "Then."]),
    "null": (None, []), "empty": ("", []), "no text": ("<article><p> </p></article>", []), "script only": ("<script>var a = 'x';", []),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_pages(name):
    page, want = PAGES[name]
    assert main_text(page) == "\n\n".join(want)


def test_surging_text_tells_the_named_article():
    links = "".join(f"<li><a href={i}>A story about something else {i}</a></li>" for i in range(9))
    short = "<hr><hr><hr>".join(f"<p>Short line {i}.</p>" for i in range(20))
    for kind in ("article", "main"):
        own = f"<{kind}><h2>T</h2><p>{LONG}</p><hr><hr><hr><p>Then.</p></{kind}>"
        for other in (f"<ul>{links}</ul>", short):
            for page in (f"<{kind}>{other}</{kind}>{own}", f"{own}<{kind}>{other}</{kind}>"):
                assert main_text(page) == "\n\n".join(["T", LONG, "Then."])
    # where nothing surges, the named article with most text
    assert main_text("<article><p>a</p></article><article><p>bc</p></article>") == "bc"


def test_surge_and_dive():
    assert between([0, 5, 0, 0, 0, 90, 0, 3, 0, 0, 0, 1], 80) == [False] * 3 + [True] * 5 + [False] * 4
    assert between([1, 0, 0, 0, 1], 1) == [True, False, True, True, True]
    assert between([], 1) == []


def test_long_and_hostile_pages_take_linear_time():
    def seconds(page):
        t = time.process_time()
        main_text(page)
        return time.process_time() - t
    for unit in ("<div>", "<p>word word ", "</x>", "<a title=\"", "<!-", "<", "<li><a href='x'>y", "<article>", "&amp;", "<span class='ad'>z"):
        small, large = seconds(unit * 10_000), seconds(unit * 80_000)
        assert large < 40 * max(small, 0.02), unit


def test_frames(spark):
    page = PAGES["named article"]
    rows = [(1, "u", page[0], "x", 5), (1, "u", page[0], "x", 5), (2, None, None, "x", 5), (None, "v", "", "x", 5)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(2)
    text = "\n\n".join(page[1])
    got = lineblock.extract(d, d.columns)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted([(r["page_id"], r["text"], r["n_chars"]) for r in got.collect()], key=str) == sorted(
        [(1, text, len(text))] * 2 + [(2, "", 0), (None, "", 0)], key=str)
    assert lineblock.extract(d.limit(0), ["page_id", "url"]).collect() == []
