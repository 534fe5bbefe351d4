"""The block reader, the labeller's gradients, and held-out pages."""

import time

import numpy as np
import pytest

from palimpsest.llm import page_blocks as pages


def texts(html):
    return [b.text for b in pages.blocks_of(html)]


def test_reader():
    assert texts("<p>a<b>b</b> c<p>d<br>e&amp;amp;&nbsp;f") == ["ab c", "d e&amp; f"]
    assert texts("<script>var t='<p>x</p>';</script><style>p{}</style><!-- no --><p>yes") == ["yes"]
    assert texts("<head><title>t</title><body><ul><li>1<li>2</ul>") == ["1", "2"]
    assert texts("<p>un<i>closed</p></x></div>tail") == ["unclosed", "tail"]
    assert texts("") == [] and texts("<<<>>> <p") is not None


def test_gradients():
    rng = np.random.default_rng(0)
    model = pages.Labeller.start(5, 1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, mask = pages.padded([rng.normal(size=(n, 5)) for n in (4, 2)])
    x = x.astype(np.float64)
    y = (rng.random(mask.shape) > 0.5).astype(float)

    def loss():
        z = model.logits(x, mask)
        return ((np.logaddexp(0, z) - y * z) * mask).sum() / mask.sum()

    for k, g in model.step(x, mask, y).items():
        w = model.weights[k].reshape(-1)
        for i in rng.choice(len(w), 3):
            old = w[i]
            w[i] = old + 1e-2
            high = loss()
            w[i] = old - 1e-2
            low = loss()
            w[i] = old
            assert abs((high - low) / 2e-2 - np.asarray(g).reshape(-1)[i]) < 1e-3


def test_held_out_pages():
    model, maker, right, all_blocks = pages.trained(), pages.PageMaker(99), 0, 0
    for _ in range(100):
        x, y = maker.labelled()
        if len(x):
            row, mask = pages.padded([x])
            right += int(((model.logits(row, mask)[:, 0] > 0) == (y > 0)).sum())
            all_blocks += len(y)
    assert right / all_blocks > 0.99


def test_table(spark):
    html = "<body><nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>Title</h1><p>One  two.</p></article><footer>&copy; us</footer></body>"
    rows = [(1, html, "q"), (2, None, "q"), (3, "", "q"), (4, "<p", "q"), (5, html, "q")]
    got = {r.page_id: r.main_text for r in pages.extract_text(spark.createDataFrame(rows, "page_id int, html string, main_text string")).collect()}
    assert got[1] == got[5] == "Title One two." and got[2] == got[3] == ""


MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li><li><a href="/n">News</a></li></ul></nav>'
FOOT = "<footer><p>&copy; 2020 The Owners. All rights reserved.</p></footer>"
BODIES = {
    "long": ["The river in winter", *(f"Paragraph {k} tells, at some length, what was seen by the river that winter, and who saw it; nobody there had known a colder one." for k in "abcde")],
    "short": ["A short note", "It rained today.", "Tomorrow it may not."],
    "least": ["Notice of closure", "The library is closed on Monday."],
}
WRAPPERS = [("", ""), ("<div>", "</div>"), ('<div class="story">', "</div>"), ('<div id="post-12">', "</div>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<table><tr><td>", "</td></tr></table>"), ('<div class="entry-content">', "</div>"), ('<div class="text-body">', "</div>"), ('<section class="qx7">', "</section>")]


@pytest.mark.parametrize("body", BODIES)
@pytest.mark.parametrize("wrapper", WRAPPERS, ids=lambda w: w[0] or "bare")
def test_ordinary_pages(body, wrapper):
    head, *rest = BODIES[body]
    inner = f"<h1>{head}</h1>" + "".join(f"<p>{x}</p>" for x in rest)
    html = f"<html><head><title>T</title></head><body>{MENU}{wrapper[0]}{inner}{wrapper[1]}{FOOT}</body></html>"
    assert pages.main_texts([html], pages.trained()) == [" ".join(BODIES[body])]


def test_deep_and_long_pages():
    deep = "<div><p>x" * 20_000
    began = time.time()
    assert len(pages.blocks_of(deep)) == 20_000
    assert len(pages.blocks_of("<b><p>y</i>" * 20_000)) == 20_000
    assert time.time() - began < 20
    long = "<article>" + "<p>some words of this page</p>" * 3000 + "</article>"
    assert pages.main_texts([long], pages.trained())[0].count("words") == 3000


def test_empty_table(spark):
    assert pages.extract_text(spark.createDataFrame([], "page_id int, html string")).collect() == []
