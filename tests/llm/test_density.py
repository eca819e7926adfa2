import html
import re

import pytest

from tendersift.llm.density import extracted, main_text, op5_text_density

LONG = "The river rose in the night and by morning the lower road was under water for a mile. " * 3
OTHER = "Engineers opened the second gate at noon, which took the worst of the pressure off the old wall. " * 3


def squeezed(*parts):
    return " ".join(" ".join(parts).split())


CASES = {
    "article": (f"<body><nav><a href=x>Home</a></nav><header><h1>Site</h1></header><article><h1>Flood</h1><p>{LONG}</p><p>Er.</p></article>"
                f"<footer>&copy; us</footer></body>", squeezed("Flood", LONG, "Er.")),
    "divs": (f"<body><div id=menu><ul><li><a href=a>one</a><li><a href=b>two</a></ul></div><div class='content'><h2>Flood</h2><p>{LONG}<p>{OTHER}</div>"
             f"<div class='sidebar'><p>{LONG}</p></div></body>", squeezed("Flood", LONG, OTHER)),
    "comments": (f"<body><main><p>{LONG}</p><section class='reader-comments'><p>First!</p></section></main></body>", squeezed(LONG)),
    "cookie": (f"<div class=cookie-notice>We use cookies</div><div><p>{LONG}</p><form>mail <input></form><aside>ad</aside></div>", squeezed(LONG)),
    "inline": (f"<article><p>{LONG}a<b>b</b>c <i>d</i>&amp;&lt;&eacute;&#233;&nosuch; e<br>f</p></article>", squeezed(LONG, "abc d&<éé&nosuch; e f")),
    "script": (f"<script>var t=\"</p><article>\";</script><style>p{{}}</style><article><p>{LONG}</p><script>x</script></article>", squeezed(LONG)),
    "comment": (f"<!-- <article>no</article> --><article><p>{LONG}<!-- x --></p></article><!-- open", squeezed(LONG)),
    "wrapper class": (f"<body class='has-header sidebar'><div class='page header'><p>{LONG}</p><p>{OTHER}</p></div></body>", squeezed(LONG, OTHER)),
    "stray": (f"</div></p><article><p>1 < 2 {LONG}</b></p></i></article", squeezed("1 < 2", LONG)),
    "plain": ("just   words\n here", "just words here"), "empty": ("", ""), "null": (None, ""), "no text": ("<html><body><img src=x></body></html>", ""),
    "hidden": (f"<article><p>{LONG}</p><p hidden>secret</p><p style='display: none'>x</p></article>", squeezed(LONG)),
    "two blocks": (f"<body><div><p>{LONG}</p><p>{OTHER}</p></div><div><p>{OTHER}</p><p>{LONG}</p><p>{OTHER}</p></div></body>", squeezed(LONG, OTHER, OTHER, LONG, OTHER)),
}


@pytest.mark.parametrize("name", CASES)
def test_case(name):
    source, want = CASES[name]
    assert main_text(source) == want


def test_hostile_pages_end():
    assert main_text("<a" * 20000) == "" and main_text("x " + "<a" * 20000) == "x"
    assert main_text("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    assert main_text("<p title=\"x>" * 3000 + "y") is not None
    assert len(main_text("<article>" + "<p>word word</p>" * 20000 + "</article>")) == 20000 * 10 - 1


def test_rows(spark):
    rows = [(1, "u", CASES["article"][0], "x"), (1, "u", CASES["article"][0], "x"), (None, None, None, None), (2, "v", "", "x")]
    got = extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = CASES["article"][1]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "u", want, len(want))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string").limit(0)).count() == 0


def test_query(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op5_text_density(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:   # the test pages hold their text in one element
        inner = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]))
        assert r["text"] == " ".join(html.unescape(inner).split()) and r["n_chars"] == len(r["text"])


SHORT = "The gate held and the road is open."
MANY = "".join(f"<p>{LONG}</p><p>{OTHER}</p>" for _ in range(5))


@pytest.mark.parametrize("source,want", [
    (f"<body><article><p>{SHORT}</p></article><div class='comments'>{MANY}</div></body>", SHORT),
    (f"<body><div><p>{SHORT}</p></div><div id='comments'>{MANY}</div></body>", SHORT),
    (f"<body><article><p>{SHORT}</p><div class='reader-comments'>{MANY}</div></article></body>", SHORT),
    (f"<body><article><p>{SHORT}</p></article><div class='comments'><article>{MANY}</article></div></body>", SHORT),
    (f"<body><div><p>{SHORT}</p></div><div class='cookie-notice'>{MANY}</div><div class='ads'>{MANY}</div></body>", SHORT),
    (f"<body><div><p>{SHORT}</p></div><div class='sidebar'>{MANY}</div></body>", SHORT),
    (f"<body><article><p>{SHORT}</p></article><div class='related'><article>{MANY}</article></div></body>", SHORT),
    (f"<body><div class='page header'><article><p>{LONG}</p></article></div><div><p>{SHORT}</p></div></body>", squeezed(LONG)),
])
def test_boilerplate_longer_than_the_article(source, want):
    assert main_text(source) == want


@pytest.mark.parametrize("start", [
    "<html><head><title>t</title><body>", "<head><meta charset=utf-8><title>t</title><script>x</script><body class=a>", "<html><head><title>t</title>",
    "<html><title>t</title><body>", "<html><head><title>t</title></head>", "<title>t</title>", "<head>", "<head></head><body>", "<head><body><head>"])
def test_pages_without_some_of_head_and_body(start):
    assert main_text(f"{start}<div><p>{LONG}</p><p>{OTHER}</p></div>") == squeezed(LONG, OTHER)
    assert main_text(f"{start}{SHORT}") == SHORT


@pytest.mark.parametrize("attrs", [
    "class='post hentry category-promotion'", "class='layout ad-free'", "class='entry comments-open'", "class='page no-ads has-sidebar'",
    "class='post tag-sponsored status-publish'", "id=promo", "class=modal-content", "class='notice'", "id=header", "class='banner'"])
def test_wrappers_by_name(attrs):
    want = squeezed("Flood", LONG, OTHER)
    inner = f"<h1>Flood</h1><p>{LONG}</p><p>{OTHER}</p>"
    assert main_text(f"<body><nav>a</nav><div {attrs}>{inner}</div><div class=footer>us</div></body>") == want
    assert main_text(f"<body><div {attrs}><div class='comment-list'><p>{OTHER}</p></div>{inner}<div class='ad-slot-3'><p>{LONG}</p></div></div></body>") == want


def test_form_around_the_page():
    inner = f"<div id=menu><a href=x>one</a></div><div id=main-body><p>{LONG}</p><p>{OTHER}</p></div>"
    control = "<label>Mail</label><input><select><option>x</select><button>Go</button>"
    assert main_text(f"<body><form id=aspnetForm>{inner}{control}</form></body>") == squeezed(LONG, OTHER)
    assert main_text(f"<body><div><p>{SHORT}</p></div><form id=aspnetForm>{inner}{inner}</form></body>").endswith(squeezed(LONG, OTHER))
    assert main_text(f"<body><div><p>{LONG}</p><form><p>Write to us</p>{control}</form></div></body>") == squeezed(LONG)
    assert main_text(f"<body><form class=newsletter><p>Write to us</p>{control}</form><article><p>{SHORT}</p></article></body>") == SHORT


@pytest.mark.parametrize("attrs", ["class='comments-area'", "id=comment-list", "class='reader_comments_section'", "class='adContainer'", "class='ad-300x250'",
                                   "id=cookie-law-info", "class='related-posts'", "class='sideBar'", "class='x sidebar-left'", "class='sponsored-content'"])
def test_named_parts_go(attrs):
    assert main_text(f"<body><div><p>{SHORT}</p></div><div {attrs}>{MANY}</div></body>") == SHORT


def test_only_comments_is_empty():
    assert main_text(f"<body><nav>a</nav><div class=comments>{MANY}</div></body>") == ""
