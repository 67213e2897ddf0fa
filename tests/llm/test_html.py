import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline.llm import html_extract as hx
from firnline.llm.html_parse import blocks_of


def test_blocks_are_decoded_and_folded():
    page = """<html><head><title>no</title><style>p{}</style></head><body><!-- c --><nav class="top menu"><a href="/x">Go &amp; see</a></nav>
      <article><h1>A&nbsp;<b>b</b>c</h1><p><b>one<br>two<p>three &lt;p&gt; &am</article><script>if (a<b) "</p>"</script></body></html>"""
    got = [(b.text, [t for t, _ in b.path][-1]) for b in blocks_of(page)]
    assert got == [("Go & see", "nav"), ("A bc", "h1"), ("one", "p"), ("two", "p"), ("three <p> &am", "p")]
    assert blocks_of(page)[0].path[-1] == ("nav", ("top", "menu")) and blocks_of(page)[0].linked == 8
    assert blocks_of(None) == [] and blocks_of("") == [] and [b.text for b in blocks_of("<p title='unclosed")] == []
    assert len(blocks_of("<div>" * 5000 + "deep")) == 1


def test_gradients():
    rng = np.random.default_rng(0)
    model = hx.Labeller.fresh()
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    x, lengths = hx.padded([rng.normal(size=(n, hx.WIDTH)) for n in (3, 5)])
    y, mask = (rng.random((2, 5)) > 0.5).astype(float), np.array([[1, 1, 1, 0, 0], [1] * 5], float)

    def loss():
        s, _ = model.forward(x.astype(np.float64), lengths)
        return float(((np.log1p(np.exp(s)) - y * s) * mask).sum() / mask.sum())

    grad = model.step(x.astype(np.float64), lengths, y, mask)
    for name, g in grad.items():
        at = tuple(int(rng.integers(0, n)) for n in g.shape)
        old = model.w[name][at]
        model.w[name][at] = old + 1e-2
        up = loss()
        model.w[name][at] = old - 1e-2
        down = loss()
        model.w[name][at] = old
        assert abs((up - down) / 2e-2 - g[at]) < 2e-3 + 0.05 * abs(g[at]), name


def test_held_out_accuracy():
    data = hx.examples(150, 4321)
    marks = hx.trained().labels([x for x, _ in data])
    right = np.concatenate([a == b.astype(bool) for a, (_, b) in zip(marks, data)])
    assert right.mean() > 0.96


def wanted(page):
    inside = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1|br)\b[^>]*>", re.sub(r"<[^>]*\Z", "", inside[1])) if inside else []
    return " ".join(t for t in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts) if t)


def test_articles_of_the_given_pages(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in hx.extract_text(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id] == (wanted(r.html), len(wanted(r.html)))


def test_nulls_repeats_and_empty_table(spark):
    page = "<body><article><h1>Title here</h1><p>" + "Some words of prose, again. " * 3000 + "</p></article></body>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", page), (None, "u", page)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = hx.extract_text(docs).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == sorted([(1, 0), (2, 0)] + [(0, len(wanted(page)))] * 2)
    assert hx.extract_text(docs.where("false")).collect() == []


@pytest.mark.parametrize("page", ["<" * 3000, "<p " + 'a="' * 2000, "&" * 5000, "<!--" * 500])
def test_hostile_pages_end(page):
    blocks_of(page)


ARTICLE = "<article><h1>Snow line</h1><p>First, a line of plain prose about snow.</p><p>Then a second line, about ice.</p></article>"


@pytest.mark.parametrize("before", [
    "<svg viewBox='0 0 1 1'/>", "<svg class=x />", "<svg><path d='M0 0'/><title>Icon</svg>", "<div><svg><g></div>", "<svg><path d=''>",
    "<svg/><math/>", "<math>", "<div><button>", "<button>Go", "<select><option>One<option>Two", "<div><object data='a.pdf'></div>",
])
def test_article_after_drawings_and_controls(before):
    for page in (f"<html><head><title>t</title></head><body>{before}{ARTICLE}</body></html>", f"<body>{before}<p>lead</p>{ARTICLE}"):
        texts = [b.text for b in blocks_of(page)]
        assert texts[-3:] == ["Snow line", "First, a line of plain prose about snow.", "Then a second line, about ice."]
        assert hx.main_texts(hx.trained(), [page])[0].endswith(" ".join(texts[-3:]))


def test_formulas_objects_and_controls_keep_their_text():
    page = """<article><p>so <math><mi>x</mi><mo>=</mo><mspace width="1"/><mn>2</mn></math> holds<svg width="1"/> x<svg><text>no</text></svg>y</p>
      <object data="f.swf"><p>in its place</p></object><p>a <button type="button">Share</button></p></article>"""
    got = [(b.text, [t for t, _ in b.path]) for b in blocks_of(page)]
    assert got == [
        ("so x=2 holds xy", ["article", "p"]), ("in its place", ["article", "object", "p"]),
        ("a", ["article", "p"]), ("Share", ["article", "p", "button"]),
    ]


@pytest.mark.parametrize("head", [
    "<head><title>t</title><meta charset=utf-8><link rel=x href=y>", "<html><head><style>p{}</style><script>1</script>", "<head>",
])
def test_head_ends_without_its_tag(head):
    assert [b.text for b in blocks_of(head + ARTICLE)] == ["Snow line", "First, a line of plain prose about snow.", "Then a second line, about ice."]
    assert [b.text for b in blocks_of(head + "bare text")] == ["bare text"]
    assert hx.main_texts(hx.trained(), [head + ARTICLE])[0] == "Snow line First, a line of plain prose about snow. Then a second line, about ice."


@pytest.mark.parametrize("page", ["<svg>" * 5000, "<svg><a>" * 3000 + "</b>" * 3000, "<svg " + "=" * 5000 + "/>" * 2, "<title>" * 3000, "<button>" * 3000])
def test_hostile_drawings_end(page):
    blocks_of(page)


@pytest.mark.parametrize("control", ["<button>Share</button>", "<select><option>One</option><option>Two</option></select>"])
def test_controls_in_an_article_are_not_its_text(control):
    p = "<p>First, a line of plain prose about snow and the long winter, told in full.</p>"
    got = hx.main_texts(hx.trained(), [f"<body><article><h1>Head</h1>{p}{control}{p}{p}</article></body>"])[0]
    assert got == " ".join(["Head"] + [p[3:-4]] * 3)
