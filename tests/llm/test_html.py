import pytest
from pyspark.sql import types as T

from viaduct.llm.html_text import extract_text, main_text

STORY = "<p>The river rose in the night, and people went up.</p><p>It was cold there &amp; dark.</p>"
TEXT = "The river rose in the night, and people went up.\nIt was cold there & dark."


def page(before="", after="", inner=STORY):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{before}{inner}{after}</body></html>"


@pytest.mark.parametrize("html", [
    page(), page("<nav><ul><li><a href='/a'>Home</a></li></ul></nav>", "<footer>&copy; x</footer>"),
    page("<header>Site name and slogan</header>", "<aside>More to read here</aside>"),
    page("<div class='cookie-notice'>We use cookies on this site</div>", "<form>Your name <input></form>"),
    page('<script>var t="</p><p>x";</script><div class="ad">Buy now for less than ever</div>', "<!-- note <p>no</p> -->"),
    page(inner=f"<div id=sidebar><p>Old posts</p></div><article>{STORY}</article>"),
    page(inner=f"<main><article>{STORY}</article><section class='comments'><p>First comment!</p></section></main>"),
    page(inner=f"<div class='wrap'><div class='post'>{STORY}</div></div>"),
    page(inner="<article><p><b>The river rose in the night, and people<br>went up.<p>It was cold\n there &amp; dark.</article>"),
    page(inner=STORY.upper().replace("&AMP;", "&amp;")).replace("THE RIVER ROSE IN THE NIGHT, AND PEOPLE WENT UP.",
         "The river rose in the night, and people went up.").replace("IT WAS COLD THERE", "It was cold there").replace("DARK", "dark"),
    page(inner=f"<article>{STORY}")[:-14],
    page(inner=f"<article>{STORY}</article><div hidden>never seen</div>"),
])
def test_article_without_its_surroundings(html):
    assert main_text(html) == TEXT


@pytest.mark.parametrize("html", [
    page(inner=f"<div class='content-sidebar-wrap'><article>{STORY}</article></div>"),
    page(inner=f"<div class='content has-sidebar'>{STORY}</div>"),
    page("<p>Hi</p>", inner=f"<div class='sidebar-wrapper'><main>{STORY}</main></div>").replace("<p>Hi</p>", ""),
    page(inner=f"<div class='widget'>{STORY}</div>", after="<div class='comments'><p>First!</p></div>"),
    page(inner=f"<div class='search'><div id=notice><article>{STORY}</article></div></div>"),
    page(inner=f"<div class='modal'><div role=main>{STORY}</div></div><div class=sidebar><p>Old posts</p></div>"),
    page(inner=f"<article>{STORY.replace('<p>It', '<section id=related-work><p>It')}</section></article>"),
    page(inner=f"<article>{STORY.replace('<p>It', '<section id=search-algorithms><p>It')}</section></article>"),
    page(inner=f"<article>{STORY.replace('<p>It', '<section id=legal><p>It')}</section></article>"),
    page(inner=f"<article>{STORY.replace('<p>It', '<div class=notice><p>It')}</div></article>"),
    page(inner=f"<article>{STORY.replace('<p>It', '<section id=navigation><p>It')}</section></article>"),
    page(inner=f"<div class=post>{STORY.replace('<p>It', '<section id=copyright><p>It')}</section></div>"),
    page(inner=f"<div class=post>{STORY.replace('<p>The', '<p title=display:none data-x=&quot;hidden&quot;>The')}</div>"),
    page(inner=STORY.replace("<p>The", "<p class='not hidden here' data-style='display:none'>The")),
    page(inner=f"<article>{STORY}<ul class='related'><li><a href=/a>Another story</a></li></ul></article>"),
    page(inner=f"<article>{STORY}<div class='newsletter'><p>Get our letter</p></div></article>"),
    page(inner=f"<article>{STORY}</article><div class='comment-list'><article class=comment-body><p>"
               + "I think so too. " * 40 + "</p></article></div>"),
    page(inner=f"<article>{STORY}</article><div style='color:red; DISPLAY : none !important'>never seen</div>"),
    page(inner=f"<article>{STORY}</article><p aria-hidden = 'true'>never seen</p>"),
])
def test_names_of_parts_are_evidence_only(html):
    assert main_text(html) == TEXT


def test_names_do_not_empty_a_page():
    parts = [f"<div class={name}><p>Some text of part {name}.</p></div>" for name in ("search", "notice", "social")]
    assert main_text(page(inner="".join(parts))) == "\n".join(f"Some text of part {n}." for n in ("search", "notice", "social"))


def test_headings_are_not_left_out_by_their_ids():
    html = page(inner="<div class=post><h2 id='legal'>Legal</h2><p>The court sat for a long day and more.</p>"
                      "<h2 id='search'>Search</h2><p>They looked in every house of the town.</p></div>")
    assert main_text(html) == ("Legal\nThe court sat for a long day and more.\nSearch\n"
                               "They looked in every house of the town.")


def test_title_and_short_paragraphs_stay():
    html = page("<nav><a href=/>Home</a></nav>", "<footer>x</footer>",
                "<article><header><h1>A title</h1></header><p>A longer paragraph of some words here.</p><p>Ah.</p>"
                "<ul><li>One<li>Two</ul></article>")
    assert main_text(html) == "A title\nA longer paragraph of some words here.\nAh.\nOne\nTwo"


@pytest.mark.parametrize("html", [None, "", "<", "<p", "<script>", "<!--", "<nav>only a menu</nav>", "</p></div>", "<a href='"])
def test_pages_without_text(html):
    assert main_text(html) in ("", "<")


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "deep") == "deep"
    assert main_text("<p>" + "word " * 200_000) == ("word " * 200_000).strip()
    for broken in ("<" * 20_000, "<a href='" * 2000, "<p " + "a='" * 5000, "<!-- " * 3000, "<script>" * 3000):
        main_text(broken)


def test_rows(spark):
    schema = T.StructType([T.StructField(n, T.LongType() if n == "page_id" else T.StringType())
                           for n in ("page_id", "url", "html", "text", "n_chars")])
    rows = [(1, "u", page(), "x", "y"), (2, None, None, None, None), (None, "v", "", None, None), (1, "u", page(), "x", "y")]
    found = extract_text(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=repr)
    assert extract_text(spark.createDataFrame([], schema)).count() == 0


def test_time_grows_with_the_length_of_nested_named_parts():
    from time import perf_counter

    def seconds(depth):
        page = "<body>" + "<div class='related'>word " * depth + "</div>" * depth + "<p>" + "text and more. " * 50 + "</p></body>"
        start = perf_counter()
        assert "text and more." in main_text(page)
        return perf_counter() - start
    seconds(1000)
    short, long = min(seconds(5_000) for _ in range(3)), seconds(50_000)
    assert long < 40 * short  # ten times the depth; a quadratic walk takes a hundred times as long
