import html as chars
import re
import time

import numpy as np
import pytest

from tidewright.llm import pages, queries

SCHEMA = "page_id long, url string, html string"


def plain(source):
    """The text of the article of a page from the sample, without a parser."""
    m = re.search(r"<article>(.*?)</article>", source or "", re.S)
    if not m:
        return ""
    blocks = [re.sub(r"<br>", " ", b) for b in re.split(r"</?(?:p|h1|h2|div|ul|li)>", m[1])]
    out = [" ".join(chars.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in out if b)


def test_whole_sample_matches_its_articles(spark):
    given = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = queries.op6_pages(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(given)
    assert {r.page_id: r.text for r in got} == {k: plain(h) for k, h in given.items()}
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.fixture(scope="module")
def model(spark):
    return pages.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


BODY = "<p>First &amp; long paragraph, with words. More of <b>it</b> here.</p><p>Second   one\n is also long enough to read. It goes on.</p>"
TEXT = "First & long paragraph, with words. More of it here.\nSecond one is also long enough to read. It goes on."
OTHERS = [
    '<div class="comments"><p>I like this, said a reader. So do I.</p></div>', '<aside class="sidebar"><p>Elsewhere on the site.</p></aside>',
    '<form><label>Your mail</label><button>Send it</button></form>', '<div class="cookie-notice">We use cookies. Accept all.</div>',
    "<script>var x = '<p>no</p>';</script><style>p{}</style>", '<div class="ad">Buy now, today only.</div>',
]


@pytest.mark.parametrize("other", OTHERS)
def test_what_is_no_main_text_goes(model, other):
    for source in (
        f"<html><body><nav><a href='/'>Home</a></nav><article>{BODY}</article>{other}<footer>the end</footer></body></html>",
        f"<html><body><header>Site</header>{other}<article>{BODY}{other}</article></body></html>",
        f"<html><body><div class='content'>{BODY}</div>{other}</body></html>",
    ):
        assert pages.extract_batch([source], model) == [TEXT], source


def test_choices_never_contradict(model):
    draw = np.random.default_rng(0)
    page = pages.Page("<div><p>a<b>c</b></p><div><ul><li>x<li>y</ul><p>z</div></div>" * 5)
    for _ in range(50):
        kept = page.choose(draw.normal(size=len(page.tag)))
        assert all(kept[p] or not kept[i] for i, p in enumerate(page.parent) if p >= 0)


def test_awkward_pages(spark, write, model):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>a<p>b"), (3, "u", "plain < text & more"), (3, "u", "plain < text & more"),
            (4, "u", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>"), (5, "u", "</p><br/><a><!-- x"), (6, "u", "<article><p>" + "word " * 50_000)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 text", "2 key", "3 n_chars")
    got = queries.op6_pages(spark, write(pages=frame)).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == texts[2] == texts[5] == ""
    assert pages.extract_batch([rows[7][2]], model) == [("word " * 50_000).strip()]
    assert queries.op6_pages(spark, write(pages=frame.limit(0))).count() == 0


@pytest.mark.parametrize(
    "icon",
    ['<svg class="i"/>', "<svg-icon></svg-icon>", "<title-bar></title-bar>", "<template-x></template-x>", '<svg class="i">', "<noscript>", "<template>",
     '<svg viewBox="0 0 1 1"><title>a mark</title></svg>', "<script>if (a < b) document.write('</p>');</script >"],
)
def test_icons_and_custom_elements_swallow_nothing(model, icon):
    for source in (
        f"<html><body>{icon}<article>{BODY}</article></body></html>",
        f"<html><body><div>{icon}</div><article>{icon}{BODY}</article><footer>the end</footer></body></html>",
    ):
        assert pages.extract_batch([source], model) == [TEXT], source


def test_many_open_icons_are_read_in_one_pass(model):
    page = pages.Page("<svg><template>" * 100_000 + "<p>text")
    assert [t for _, _, t, _ in page.pieces] == ["text"]


@pytest.mark.parametrize(
    "piece",
    ["<a ", "<a", "<a '", "<a \"'", "</a ", "</a '", "<a b='>", "</script ", "<!-", "<svg ", "'<b \"", "<a =", "</b\"", "&", "&amp"],
)
def test_broken_tags_take_linear_time(piece):
    source = "<p>text" + piece * (1_000_000 // len(piece))
    began = time.process_time()
    page = pages.Page(source)
    assert time.process_time() - began < 10
    assert page.pieces[0][2].startswith("text")


@pytest.mark.parametrize(
    "opening, piece",
    [("<div>" * 20_000, "</p></x>"), ("<b>" * 20_000, "<li></li>"), ("<li><div>" + "<i>" * 20_000, "<li>a</li>"), ("<script>", "</script "),
     ("<p>" + "<b>" * 20_000, "<p>a</p>"), ("", "<div></p><p></div>")],
)
def test_stray_end_tags_take_linear_time(opening, piece):
    began = time.process_time()
    pages.Page(opening + piece * 50_000)
    assert time.process_time() - began < 10


def test_tag_ends_match_a_plain_scan():
    draw = np.random.default_rng(5)
    for _ in range(300):
        source = "".join(draw.choice(list("<>a\"' /"), size=40))
        ends = pages._TagEnds(source)
        for at in range(len(source)):
            quote, want = "", -1
            for i in range(at, len(source)):
                c = source[i]
                if quote:
                    quote = "" if c == quote else quote
                elif c == ">":
                    want = i
                    break
                elif c in "\"'":
                    quote = c
            assert ends.after(at) == want, (source, at)
