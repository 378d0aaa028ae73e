import html
import re

from gtfsforge.llm import html_text
from gtfsforge.llm.html_text import best_region, extract_text, learn_weights, main_text
from gtfsforge.llm.queries_pages import op10_html_text


def test_table_against_its_own_markup(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in op10_html_text(spark, sf).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        blocks = [" ".join(html.unescape(x.replace("<br>", " ").replace("<b>", "").replace("</b>", "")).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text)


W = learn_weights([])


def page(body):
    return f"<html><head><title>t</title></head><body>{body}</body></html>"


TEXT = "<p>One two three four five six seven.</p><div>Eight nine ten eleven twelve.</div>"
WANT = "One two three four five six seven.\nEight nine ten eleven twelve."


def test_what_is_left_out():
    for extra in (
        "<nav>menu words here</nav>", "<header><h2>Site name here</h2></header>", "<footer>all rights</footer>", "<aside>see also this</aside>", "<div class='ad-box'>buy this now</div>",
        "<div id=cookie-notice>we use cookies</div>", "<form>name <input><button>send it</button></form>", "<script>var a = '<p>no</p>';</script>", "<style>p{}</style>",
        "<section class='comments'><p>first reader says</p></section>", "<!-- a <p>hidden</p> note -->", "<div role=navigation>go home</div>", "<noscript>turn it on</noscript>",
    ):
        assert main_text(page(extra + TEXT), W) == WANT, extra
        assert main_text(page(TEXT + extra), W) == WANT, extra
        assert main_text(page(TEXT.replace("<div>", extra + "<div>")), W) == WANT, extra
        assert main_text(page(f"<div>other words</div><article>{extra}{TEXT}{extra}</article><div>after words</div>"), W) == WANT, extra


def test_a_header_with_the_articles_main_heading_belongs_to_it():
    assert main_text(page(f"<header>Site</header><article><header><h1>Heading here</h1></header>{TEXT}</article>"), W) == "Heading here\n" + WANT


def test_everyday_names_in_an_article_lose_nothing():
    for part, want in (
        ('<section id="discussion"><p>What it means.</p></section>', "What it means."), ('<h2 id="job-search">Finding work</h2>', "Finding work"), ('<p class="notice">Mind this.</p>', "Mind this."),
        ('<div id="related-work" class="level2"><p>Others did.</p></div>', "Others did."), ('<section id="comments">Our own.</section>', "Our own."), ('<div data-id="sidebar">Kept text.</div>', "Kept text."),
        ('<div title="id=ad class=ad">Kept text.</div>', "Kept text."), ('<p title="a hidden door">Kept text.</p>', "Kept text."), ('<div class="cookie-recipe no-sidebar ad-free-story">Bake.</div>', "Bake."),
        ('<section class="search" aria-label="Side effects discussion">Kept text.</section>', "Kept text."), ('<h2 id="comments">Remarks</h2>', "Remarks"),
    ):
        for around in ("article", "main"):
            assert main_text(page(f"<{around}>{TEXT}{part}{TEXT}</{around}>"), W) == f"{WANT}\n{want}\n{WANT}", part
    for part in ('<section id="search"><p>How we looked.</p></section>', '<h2 id="search">How we looked.</h2>', '<p class="notice">How we looked.</p>', '<div class="section" id="search">How we looked.</div>'):
        assert main_text(page(TEXT + part + TEXT), W) == f"{WANT}\nHow we looked.\n{WANT}", part


def test_linked_titles_and_link_only_last_blocks_stay():
    menus = page("<div>" + "<a href=x>Menu entry</a>" * 30 + f"</div><article>{TEXT}</article>")
    for weights in (W, learn_weights([menus] * 40)):
        for title in ("<h1><a href=x>Title</a></h1>", "<a href=x><h1>Title</h1></a>"):
            assert main_text(page(title + TEXT), weights) == "Title\n" + WANT, title
            assert main_text(page(f"<article>{title}{TEXT}</article>"), weights) == "Title\n" + WANT, title
        for last, want in (("<p><a href=x>Source one</a></p>", "Source one"), ("<ul><li><a href=x>One</a></li><li><a href=y>Two more</a></li></ul>", "One\nTwo more")):
            assert main_text(page(f"<article>{TEXT}{last}</article><div>after</div>"), weights) == f"{WANT}\n{want}", last
        assert main_text(page(TEXT + "<h2><a href=x>Sources</a></h2>"), weights) == WANT + "\nSources"


def test_references_space_and_broken_markup():
    assert main_text(page("<p>a &amp; b&nbsp;&lt;c&gt; &eacute;\n\t d<b>e</b>f<br>g</p><p>h < i"), W) == "a & b <c> é def g\nh < i"
    assert main_text("just words", W) == "just words"
    assert main_text("<p>one<p>two</div></p><ul><li>three<li>four</ul>", W) == "one\ntwo\nthree\nfour"
    assert main_text("<div><p>open", W) == "open" and main_text("<", W) == "<" and main_text("a<b", W) == "a"


def test_region_is_the_best_of_all():
    import random

    rng = random.Random(0)
    for _ in range(300):
        x = [rng.randint(-5, 5) for _ in range(rng.randint(0, 12))]
        a, b = best_region(x)
        assert sum(x[a:b]) == max([0, *(sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1))])


def test_nulls_repeats_long_and_clashing_names(spark):
    rows = [(1, "u", None, "x"), (1, "u", "", "x"), (2, None, page(TEXT), "x"), (2, None, page(TEXT), "x"), (None, "v", page("<p>" + "word " * 100_000 + "</p>"), "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 9, r.url or "", len(r.text)) for r in extract_text(df).collect()))
    assert got == [(1, "u", 0), (1, "u", 0), (2, "", len(WANT)), (2, "", len(WANT)), (9, "v", 499_999)]
    assert extract_text(df.limit(0)).count() == 0


def test_readers_comments_notices_and_related_links_in_an_article():
    comments = "<section class='comment-list'><article class='comment'><p>Reader one says much.</p></article><article class='comment depth-2'><p>Two.</p></article></section>"
    for extra in (comments, "<article class='comment'><p>Reader says.</p></article>", "<div class='notice'>Site notice.</div>", "<div class='related'><a href=x>Other story</a></div>", "<ul class='related-posts'><li><a href=x>Other</a></li></ul>"):
        for around in ("article", "main"):
            assert main_text(page(f"<{around}>{TEXT}{extra}</{around}>"), W) == WANT, extra
        assert main_text(page(f"<main><article>{TEXT}</article>{extra}</main>"), W) == WANT, extra
    assert main_text(page(f"<main><article class='post has-comments'>{TEXT}</article></main>"), W) == WANT


def test_names_that_say_something_else_lose_nothing_without_an_article():
    for name in ("related-work", "search-engines", "side-effects", "comment-culture", "no-sidebar", "share-prices"):
        assert main_text(page(f"{TEXT}<div class='{name}'>How it went.</div>{TEXT}"), W) == f"{WANT}\nHow it went.\n{WANT}", name


def test_characters_that_grow_in_lower_case():
    first = "İ" * 40
    assert main_text(page(f"<p>{first}</p><SCRIPT>var a = 1;</Script><p>One two.</p><p>Three four.</p>"), W) == f"{first}\nOne two.\nThree four."


def test_bad_markup_takes_linear_time():
    import time

    for bad in ("<div></p>", "<header>", "<b><div></b>", "<p><i>", "<script></script>", "<li></ul>", "<article class=x>"):
        took = []
        for n in (20_000, 80_000):
            began = time.perf_counter()
            main_text(bad * n + TEXT, W)
            took.append(time.perf_counter() - began)
        assert took[1] < 10 * max(took[0], 0.05), bad


def test_very_long_pages_teach_nothing_and_come_out_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(html_text, "learn_weights", lambda pages: seen.extend(pages) or W)
    short, long = (page(f"<article>{TEXT * n}</article>") for n in (1, 3000))
    assert len(short) < html_text.LONGEST < len(long)
    got = extract_text(spark.createDataFrame([(1, "a", short), (2, "b", long), (3, "c", None)], "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {1: WANT, 2: "\n".join([WANT] * 3000), 3: ""}
    assert seen == [short]
