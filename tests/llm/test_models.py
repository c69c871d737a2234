"""Quality classifier and main-text labeller: gradients, held-out accuracy, edges."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenecast.llm import html_blocks, quality
from scenecast.llm.queries import op8_quality, op10_main_text, table
from tests.conftest import SF_MID, SF_SMALL


def numeric(loss, array, at, step=1e-3):
    kept = array[at]
    array[at] = kept + step
    high = loss()
    array[at] = kept - step
    low = loss()
    array[at] = kept
    return (high - low) / (2 * step)


def test_quality_gradients():
    net = quality._start(3)
    for name in ("byte_vectors", "filters", "bias", "weights", "offset"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    texts = [quality._padded(b"some bytes of a text" * 9), quality._padded(b"other, quite short")]
    y = np.array([1.0, 0.0])

    def loss():
        p = quality._forward(net, texts)[-1]
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
    for part, grad in zip(net.parts(), quality._gradients(net, texts, y)):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        assert numeric(loss, part, at, 1e-5) == pytest.approx(float(grad[at]), rel=0.02, abs=1e-6)


def test_scorer_equals_the_network():
    net = quality._start(4)
    rng = np.random.default_rng(0)
    texts = [b"", b"x", b"short text", rng.bytes(64), rng.bytes(65), rng.bytes(5_000),
             rng.bytes(300_001)]
    got = quality.Scorer(net).scores(texts)
    want = [float(quality._forward(net, [quality._padded(t)])[-1][0]) for t in texts]
    assert np.allclose(got, want, atol=1e-4)


def test_quality_query_on_held_out_rows(spark):
    rows = {r["doc_id"]: r for r in op8_quality(spark, SF_MID).collect()}
    assert len(rows) == table(spark, SF_MID, "documents").count()
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_MID, "labels").collect()}
    right = []
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"] and i in labels:
            right.append(r["predicted"] == labels[i])
    assert np.mean(right) >= 0.9


def test_quality_edges(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0), (999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    net = quality.train(odd_docs, labels)
    scored = quality.score_documents(odd_docs.withColumn("score", F.lit("x")), net).collect()
    assert len(scored) == 15 and all(0 <= r["score"] <= 1 for r in scored)
    none = quality.train(odd_docs, labels.limit(0))
    assert none.constant == 0.5
    assert {r["score"] for r in quality.score_documents(odd_docs, none).collect()} == {0.5}
    assert quality.train(empty_docs, labels).constant == 0.5
    assert quality.score_documents(empty_docs, net).count() == 0
    assert odd_docs.select(quality.held_out(F.col("doc_id")).alias("h")).filter(
        F.col("h").isNull()).count() == 0


def test_quality_sample_keeps_both_classes(spark, make_docs):
    """Long documents and repeated rows of one id leave the other ids in the sample."""
    ids = [r["id"] for r in spark.range(400).filter(~quality.held_out(F.col("id"))).orderBy(
        F.xxhash64("id")).collect()][:60]
    labels = spark.createDataFrame([(i, n % 2, 0) for n, i in enumerate(ids)],
                                   "doc_id long, quality int, toxic int")
    long = "long text " * (quality.TRAIN_BYTES // 8)
    docs = make_docs([(i, long if n % 2 and n < 50 else f"text {i}") for n, i in enumerate(ids)])
    assert quality.train(docs, labels, per_class=5).constant is None
    low = min(ids)
    docs = make_docs([(low, f"copy {j}") for j in range(500)]
                     + [(i, f"text {i}") for i in ids if i != low])
    assert quality.train(docs, labels, per_class=50).constant is None


# --- main text -----------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site"><h1>Site</h1><a href="/">Home</a></header><nav><ul><li><a>A</a><li><a>B</a></ul></nav>
<div id="cookie-notice">We use cookies</div><!-- note --><script>var x = "</p>";</script>
<article><h1>My &amp; title</h1><p><b>First &lt;para&gt;<br>line
 two</b><aside>Related</aside><p>Second &copy <i>it</i>alic&nbsp;x.</p><form>Name <input></form>
<section id="comments"><p>Nice post</p></section></article><footer>&copy; me</footer></body></html>"""


def plain_main(html):
    """The labelling rule applied straight to the blocks."""
    blocks = html_blocks.blocks_of(html)
    marked = any(html_blocks.weak_label(b, True) for b in blocks)
    return "\n".join(b.text for b in blocks if html_blocks.weak_label(b, marked))


def test_blocks():
    blocks = html_blocks.blocks_of(PAGE)
    texts = [b.text for b in blocks]
    assert texts == ["Site", "Home", "A", "B", "We use cookies", "My & title",
                     "First <para> line two", "Related", "Second © italic x.", "Name", "Nice post",
                     "© me"]
    assert plain_main(PAGE) == "My & title\nFirst <para> line two\nSecond © italic x."
    assert [b.text for b in html_blocks.blocks_of("<p>a<p>b &am <a href='x")] == ["a", "b &am"]
    assert html_blocks.blocks_of("<script>never closed") == []
    assert len(html_blocks.blocks_of("<p>" + "word " * 200_000)) == 1
    assert len(html_blocks.blocks_of("<div>" * 3_000 + "deep")) == 1


def test_lstm_gradients():
    w = html_blocks.start_weights(2)
    rng = np.random.default_rng(1)
    for k in w:
        w[k] = (w[k] + rng.normal(0, 0.1, w[k].shape)).astype(np.float64)
    pages = [html_blocks.blocks_of(PAGE), html_blocks.blocks_of(PAGE)[3:8]]
    y = rng.integers(0, 2, sum(map(len, pages))).astype(float)

    def loss():
        p = html_blocks.forward(w, pages, True)[0]
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
    for name, grad in html_blocks._gradients(w, pages, y).items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        assert numeric(loss, w[name], at) == pytest.approx(float(grad[at]), rel=0.03, abs=2e-5), name


def test_main_text_query(spark):
    html = {r["page_id"]: r for r in table(spark, SF_SMALL, "pages").collect()}
    rows = op10_main_text(spark, SF_SMALL).collect()
    assert len(rows) == len(html)
    for r in rows:
        assert r["text"] == plain_main(html[r["page_id"]]["html"]) and r["text"]
        assert r["n_chars"] == len(r["text"]) and r["url"] == html[r["page_id"]]["url"]


def test_main_text_of_unseen_page_parts(spark):
    pages = table(spark, SF_SMALL, "pages")
    w = html_blocks.train(pages)
    htmls = [PAGE, None, "", "just text <b", "<article></article>"]
    assert html_blocks.extract_texts(htmls, w)[:3] == [plain_main(PAGE), "", ""]
    rng = np.random.default_rng(8)
    blocks = [html_blocks.blocks_of(r["html"]) for r in pages.limit(40).collect()]
    spare = [b.text[:200] for p in blocks for b in p]
    varied = [html_blocks._varied(p, spare, rng) for p in blocks]
    wrong = total = 0
    for page, prob in zip(varied, html_blocks.forward(w, varied)):
        marked = any(html_blocks.weak_label(b, True) for b in page)
        for b, p in zip(page, prob):
            total += 1
            wrong += (p >= 0.5) != html_blocks.weak_label(b, marked)
    assert wrong <= 0.02 * total


def test_main_text_edges(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>plain")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "text", F.lit("other")).withColumn("n_chars", F.lit("x"))
    out = html_blocks.extract(pages, html_blocks.train(pages)).collect()
    assert len(out) == 5 and all(r["n_chars"] == len(r["text"]) for r in out)
    assert html_blocks.extract(pages.limit(0), html_blocks.start_weights()).count() == 0
    assert html_blocks.fit([]).keys() == html_blocks.start_weights().keys()


def test_deeply_nested_page_keeps_its_text_and_stays_small():
    page = html_blocks.blocks_of("<article>" + "<div class='a b'>x " * 20_000)
    assert [b.text for b in page] == ["x"] * 20_000
    assert max(len(b.path) for b in page) <= 3 * html_blocks.MAX_DEPTH
    assert [b.text for b in html_blocks.blocks_of("<b>x " * 20_000)] == [" ".join("x" * 20_000)]


@pytest.mark.parametrize("html, want", [
    ('<p>One <svg class="i"/> two.</p><p>Three.</p>', ["One two.", "Three."]),
    ('<p>One <svg class="i"> two.</p><p>Three.</p>', ["One two.", "Three."]),
    ("<p>One <svg><svg>in</svg>out<title>Icon</title></svg> two.</p>", ["One two."]),
    ("<p>One <svg><style/><title/><path d='x'/></svg> two.</p><p>Three.</p>",
     ["One two.", "Three."]),
    ("<p>One <svg><title>Icon</svg> two.</p><p>Three <svg><title>B</title></svg></p>",
     ["One two.", "Three"]),
    ("<svg><path><p>One <svg><foreignObject><p>in</foreignObject></svg> two.", ["One two."]),
    ("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>", ["So x=2 holds."]),
    ("<p>So <math/> holds.</p><p>Three.</p>", ["So holds.", "Three."]),
    ("<head><title>T</title><p>One", ["One"]),
    ("<div><object>a<object>b</object>c<p>d</object>two</div>", ["two"]),
])
def test_foreign_and_nested_elements(html, want):
    assert [b.text for b in html_blocks.blocks_of(html)] == want


@pytest.mark.parametrize("name", sorted(html_blocks.UNSEEN - {"svg"}))
def test_hidden_element_without_end_tag_loses_no_text(name):
    page = f"<article><p>One <{name} class='ad'> two.</p><p>Three.</p></article><p>Four.</p>"
    blocks = html_blocks.blocks_of(page)
    assert [b.text for b in blocks] == ["One two.", "Three.", "Four."]
    assert plain_main(page) == "One two.\nThree."
    assert not any(name in w for b in blocks for w in b.path)
    closed = page.replace("<p>Three", f"<{name}>in<{name}>in</{name}>in</{name}><p>Three")
    assert [b.text for b in html_blocks.blocks_of(closed)] == ["One two.", "Three.", "Four."]


def test_training_sample_has_distinct_pages(spark, monkeypatch):
    monkeypatch.setattr(html_blocks, "fit", lambda htmls: htmls)
    pages = spark.createDataFrame([(f"<p>page {i}",) for i in range(8)], "html string")
    first = pages.orderBy(F.xxhash64("html")).limit(1).collect()[0]["html"]
    copies = pages.unionByName(spark.range(40).select(F.lit(first).alias("html")))
    got = html_blocks.train(copies, n=4)
    assert len(set(got)) == 4 and got == html_blocks.train(pages, n=4)


ARTICLE = "<p>One two three four five.</p><p>Six seven eight nine.</p>"
TRUTH = "One two three four five.\nSix seven eight nine."


# Pages with the main text written by hand.
@pytest.mark.parametrize("html,want", [
    (f'<body class="single has-sidebar comments-open"><article>{ARTICLE}</article></body>', TRUTH),
    (f'<div class="page search-results header-fixed"><main>{ARTICLE}</main></div>', TRUTH),
    (f'<article class="post form-factor">{ARTICLE}</article>', TRUTH),
    (f'<body id="footer-less" class="sidebar"><div class="with-banner">'
     f'<article class="entry">{ARTICLE}</article></div></body>', TRUTH),
    (f'<article>{ARTICLE}<div class="share-buttons"><a href="/">Share</a></div></article>', TRUTH),
    (f'<article>{ARTICLE}<section id="comments"><p>Nice.</p></section></article>', TRUTH),
    (f'<div class="site-header"><p>Site</p></div><article>{ARTICLE}</article>'
     '<div class="sidebar-left"><p>More</p></div>', TRUTH),
    (f'<main>{ARTICLE}</main><aside><article class="card"><p>Other story</p></article></aside>',
     TRUTH),
    (f'<div class="related"><article><p>Card</p></article></div><article>{ARTICLE}</article>', TRUTH),
    (f'<ol class="comment-list"><li><article class="comment"><p>Me too</p></article></li></ol>'
     f'<article>{ARTICLE}</article>', TRUTH),
    (f'<div class="content no-sidebar">{ARTICLE}</div><div class="cookie-notice"><p>OK?</p></div>',
     TRUTH),
    (f'<div class="content"><div class="is-open">{ARTICLE}</div></div><footer><p>x</p></footer>',
     TRUTH),
])
def test_wrappers_do_not_empty_a_page(html, want):
    assert plain_main(html) == want


def test_network_on_wrapped_pages(spark):
    w = html_blocks.train(table(spark, SF_SMALL, "pages"))
    pages = [f'<html><body class="single has-sidebar comments-open"><div class="page header-fixed">'
             f'<header class="site-header"><p>My site {i}</p></header><nav><a href="/">Home</a></nav>'
             f'<article class="post form-factor">{ARTICLE}</article><aside><p>Related</p></aside>'
             f'<footer><p>About us {i}</p></footer></div></body></html>' for i in range(20)]
    assert html_blocks.extract_texts(pages, w) == [TRUTH] * 20
