from foldwise.llm import html_density

ARTICLE = "<h1>Title &amp; more</h1><p>First  paragraph with\nsome <b>bold</b> words and an <a href='/x'>inline link</a> in it.</p><p>Second.<br>Line</p>"
WANT = "Title & more\n\nFirst paragraph with some bold words and an inline link in it.\n\nSecond. Line"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script>{head}</head><body>{body}</body></html>"


AROUND = ("<header><h2>Site</h2></header><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav><!-- ad --><div class='ad'>Buy now, great offer today.</div>",
          "<aside class='sidebar'>Popular posts of the week</aside><form><p>Subscribe here</p><input><button>Go</button></form><div id='comments'><p>Reader says hello to everybody here.</p></div>"
          "<div class='cookie-notice'>We use cookies.</div><footer>&copy; site</footer>")


def test_article_element():
    assert html_density.main_text(page(AROUND[0] + f"<article>{ARTICLE}</article>" + AROUND[1])) == WANT


def test_no_article_element():
    long = "".join(f"<p>Paragraph {i} holds a good number of words so that it looks like text.</p>" for i in range(5))
    body = AROUND[0] + f"<div><div class='x'>{ARTICLE}{long}</div></div><div><a href='/1'>one</a> <a href='/2'>two</a></div>" + AROUND[1]
    text = html_density.main_text(page(body))
    assert text.startswith(WANT) and text.count("Paragraph") == 5 and "one" not in text.split() and "Buy" not in text


def test_sections_beside_the_densest_one_stay():
    part = lambda n, k: "<section>" + "".join(f"<p>Part {k} sentence {i} of the text with a few more words.</p>" for i in range(n)) + "</section>"
    text = html_density.main_text(page(AROUND[0] + f"<div>{part(9, 1)}{part(8, 2)}</div>" + AROUND[1]))
    assert text.count("Part 1") == 9 and text.count("Part 2") == 8 and "cookies" not in text


def test_malformed_markup():
    html = page(AROUND[0] + "<article><h1>H</h1><p><b>Bold start.<br><p>One.</p><p>Two<p><b>Three.<br><ul><li>a<li>b</ul>" + AROUND[1].split("<footer>")[0])
    assert html_density.main_text(html).startswith("H\n\nBold start.\n\nOne.\n\nTwo\n\nThree.\n\na\n\nb")
    assert html_density.main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert html_density.main_text("plain text &lt;b&gt;") == "plain text <b>"
    assert html_density.main_text("<article><p>a</article><script>never closed <p>x") == "a"


def test_comments_inside_the_article_go():
    html = page(f"<article>{ARTICLE}<section class='comments'><p>nice</p></section><div class='share'>Share this</div></article>")
    assert html_density.main_text(html) == WANT


def test_short_article_beside_a_long_advert():
    html = page("<div class='advert'>" + "Long advert text. " * 40 + "</div><article><h1>Hi</h1><p>Ok.</p></article>")
    assert html_density.main_text(html) == "Hi\n\nOk."


def test_wrappers_named_like_other_parts():
    long = "".join(f"<p>Paragraph {i} holds a good number of words so that it looks like text.</p>" for i in range(5))
    inner = "<div class='sidebar'><p>Popular posts of the week</p></div><div id='comments'><article><p>Reader says hello.</p></article></div>"
    opened = [f"<div class='{c}'>" for c in ("content-sidebar-wrap", "no-sidebar", "has-share", "related-layout", "post no-comments")] + ["<form action='./page.aspx'>"]
    for start in opened:
        end = "</form>" if "form" in start else "</div>"
        for held in (f"<article>{ARTICLE}{long}</article>{inner}", f"<div>{ARTICLE}{long}</div>{inner}"):
            text = html_density.main_text(page(AROUND[0] + start + held + end + "<p>Some words below.</p>" + AROUND[1]))
            assert text.startswith(WANT) and text.count("Paragraph") == 5 and "Popular" not in text and "Reader" not in text, start
        text = html_density.main_text(page(AROUND[0] + f"<main>{start}<article>{ARTICLE}{long}</article>{inner}{end}</main>" + AROUND[1]))
        assert text.startswith(WANT) and text.count("Paragraph") == 5 and "Popular" not in text and "Reader" not in text, start
    assert html_density.main_text(page("<div id='comments'><p>All there is.</p></div>")) == "All there is."


def test_long_comments_go():
    body = f"<div>{ARTICLE}</div><div id='comments'>" + "<article><p>A reader says a good deal about this text.</p></article>" * 20 + "</div>"
    assert html_density.main_text(page(body)) == WANT


def test_empty_pages():
    assert [html_density.main_text(h) for h in (None, "", " \n", "<html></html>", "<nav>x</nav>", page("<footer>x</footer>"))] == [""] * 6


def test_deep_and_long_pages():
    assert html_density.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert len(html_density.main_text(page("<article>" + "<p>word word word</p>" * 20_000 + "</article>")).split("\n\n")) == 20_000


def test_edge_rows(spark):
    kind = "page_id long, url string, html string, text string, n_chars long"
    rows = [(1, "u", page(f"<article>{ARTICLE}</article>"), "t", 0), (1, "u", page(f"<article>{ARTICLE}</article>"), "t", 0), (None, None, None, None, None), (2, "u", "", "t", 1)]
    out = [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html_density.extract(spark.createDataFrame(rows, kind)).collect()]
    assert out == [(1, "u", WANT, len(WANT))] * 2 + [(None, None, "", 0), (2, "u", "", 0)]
    assert html_density.extract(spark.createDataFrame([], kind)).count() == 0
