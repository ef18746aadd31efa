from __future__ import annotations

import html
import random

import numpy as np
import pytest

from demandspark.llm.html_extract import IN_SVG, TOKEN, BiLstm, Tags, fit, label_pages, main_text, padded, page_blocks, vectors, weak_label

SCHEMA = "page_id long, url string, html string, text string"


def texts(page):
    return [b.text for b in page_blocks(page)]


@pytest.mark.parametrize("page, expected", [
    ("", []), ("plain  text\n here", ["plain text here"]), ("<p>a<b>b</b>c<p>d", ["abc", "d"]), ("<p>a<br>b</p>", ["a b"]),
    ("<p>x &amp; y &lt;z&gt; &#233; &eacute</p>", ["x & y <z> é é"]), ("<script>var t='</p>';</script><style>p{}</style><p>k</p>", ["k"]),
    ("<!-- <p>no</p> --><p>yes<!-- open", ["yes"]), ("<p title='a>b'>q</p>", ["q"]), ("a < b and <1> c", ["a < b and <1> c"]),
    ("<ul><li>one<li>two</ul><table><tr><td>c<td>d<tr><td>e</table>", ["one", "two", "c", "d", "e"]), ("<SCRIPT>x</Script>y", ["y"]),
    ("<p>\xa0é\t\r\n </p>", ["\xa0é"]), ("<div>" * 3000 + "deep", ["deep"])])
def test_blocks(page, expected):
    assert texts(page) == expected


@pytest.mark.parametrize("page, expected", [
    ('<p>One.</p><svg class="i"/><p>Two.</p>', ["One.", "Two."]), ('<svg-icon name="x"></svg-icon><p>Two.</p>', ["Two."]),
    ("<p>a<template-x>b</template-x> <style-x/>c<script-y>d</p><p>e", ["ab cd", "e"]), ("<p>a<svg data-x='/>' />b</p>", ["ab"]),
    ("<p>a<svg viewBox='0 0 1 1'><title>t</title><path d='M0'/><text>x</text></svg>b</p>", ["ab"]), ("<p>a<svg class=i/></p><p>b</p>", ["a", "b"]),
    ("<p>a<svg><g><svg><style/></svg><text>x</text></g></svg>b<p>c", ["ab", "c"]), ("<p>a<svg><path></p><p>b<svg></svg>c", ["a", "bc"]),
    ("<p>a<svg><foreignObject><div>x</div></foreignObject></svg>b", ["ab"]), ("<p>a<svg><!-- </svg> --><text>x</text></SVG >b", ["ab"]),
    ("<p title=don't>One isn't.</p><p>Two.</p>", ["One isn't.", "Two."]), ('<p 5" class=a>One "x".</p><p>Two.', ['One "x".', "Two."]),
    ("<p title='a>b' alt = \"c>d\" e=>One.<p f=g'h=\"i>Two \"j\".", ["One.", 'Two "j".']), ("<script>x</script y><p>k", ["k"]),
    ("<template><p>x</p></template><style media=a>p{}</style><noscript>n</noscript><p>k", ["k"])])
def test_icons_custom_elements_and_stray_quotes_lose_no_text(page, expected):
    assert texts(page) == expected


def test_a_page_of_open_drawings_is_read_in_linear_time():
    assert texts("<svg><foreignObject>" * 50_000 + "</svg>" * 50_000 + "<p>k") == ["k"]


def test_paths_close_what_browsers_close():
    found = page_blocks("<html><body><nav><ul><li>a<li>b</ul></nav><div class='Ad-Box' id=x><p>c<div>d</div></div><article><p><b>e<br><p>f</article>g")
    assert [[e[0] for e in b.path] for b in found] == [["html", "body", "nav", "ul", "li"]] * 2 + [
        ["html", "body", "div", "p"], ["html", "body", "div", "div"]] + [["html", "body", "article", "p"]] * 2 + [["html", "body"]]
    assert found[2].path[2] == ("div", "class:ad", "class:box", "id:x")
    assert [weak_label(b.path) for b in found] == [0, 0, 0, 0, 1, 1, -1]


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    model = BiLstm(width=5, hidden=3, seed=2)
    x, mask = padded([rng.normal(size=(n, 5)) for n in (4, 2, 3)])
    target, weight = (rng.random(mask.shape) < 0.5).astype(float), mask * rng.random(mask.shape)
    _, grad = model.gradients(x, mask, target, weight)
    for name, g in grad.items():
        flat = model.p[name].reshape(-1)
        for k in rng.choice(len(flat), min(6, len(flat)), replace=False):
            old = flat[k]
            sides = []
            for e in (1e-5, -1e-5):
                flat[k] = old + e
                sides.append(model.gradients(x, mask, target, weight)[0])
            flat[k] = old
            assert g.reshape(-1)[k] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6)


def test_padding_changes_nothing():
    model = BiLstm(width=4, hidden=3)
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(6, 4)), rng.normal(size=(2, 4))
    both = model.probability(*padded([a, b]))
    assert np.allclose(both[:2, 1], model.probability(*padded([b]))[:, 0])


def words(rng, n):
    return " ".join(rng.choice(["river", "stone,", "walks", "&", "light.", "été", "<far>", "house"]) for _ in range(n))


def page(rng):
    """A page and its main text."""
    body, main = ["<html><head><title>" + html.escape(words(rng, 3)) + "</title></head><body>"], []
    body.append("<nav><ul>" + "".join(f"<li><a href=x>{html.escape(words(rng, 1))}</a></li>" for _ in range(rng.randint(2, 5))) + "</ul></nav>")
    body.append(f"<div class=ad>{html.escape(words(rng, 6))}</div><article>")
    for tag in ["h1"] + ["p"] * rng.randint(1, 6):
        main.append(words(rng, rng.randint(2, 30)))
        body.append(f"<{tag}>{html.escape(main[-1])}</{tag}>")
    body.append(f"</article><footer>&copy; {html.escape(words(rng, 4))}</footer>")
    return "".join(body), "\n\n".join(main)


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, "u", page(rng)[0], "clash") for i in range(120)]
    return fit(spark.createDataFrame(rows, SCHEMA))


def test_fresh_pages(spark, model):
    rng = random.Random(2)
    made = [page(rng) for _ in range(200)]
    got = main_text(spark.createDataFrame([(i, "u", p, "clash") for i, (p, _) in enumerate(made)], SCHEMA), model).collect()
    assert sum(r.text == made[r.page_id][1] for r in got) >= 196
    assert all(r.n_chars == len(r.text) for r in got)


def test_other_designs(model):
    pages = ["<div id=content><h1>Head</h1><p>River stone, walks light. House far walks stone.<p>Light walks, house.</div><div class=sidebar>"
             "<a href=x>More</a></div><div class=comments><p>Like it, river.</p></div><footer>2020</footer>",
             "<body><header><a href=/>Site</a></header><main><p>River stone, walks light. House, far.</p><aside>Buy now</aside><p>Light walks, "
             "house stone far.</p><form><label>Name</label></form></main><section class=comments><p>Nice</p></section>"]
    expected = [[1, 1, 1, 0, 0, 0], [0, 1, 0, 1, 0, 0]]
    blocks = [page_blocks(p) for p in pages]
    right = sum(int(a == b) for e, x in zip(expected, label_pages(blocks, model)) for a, b in zip(e, x))
    assert right >= 11


def test_odd_pages(spark, model):
    long = "<article>" + "<p>river stone, walks</p>" * 20_000 + "</article>"
    rows = [(1, None, None, ""), (2, "u", "", ""), (2, "u", "", ""), (None, "u", "<p></p>", ""), (4, "u", long, "")]
    for m in (model, None):
        got = main_text(spark.createDataFrame(rows, SCHEMA), m).collect()
        assert len(got) == 5
        assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id != 4)
        assert [r.text.count("\n\n") for r in got if r.page_id == 4] == [19_999]
    empty = spark.createDataFrame([], SCHEMA)
    assert fit(empty) is None and main_text(empty, None).count() == 0


def test_vectors_of_any_text():
    assert np.isfinite(vectors(page_blocks("<p>\x00</p><p>é</p>" + "<p>" + "w" * 100_000))).all()


@pytest.mark.parametrize("page", ["<a " * 350_000, "<a " * 350_000 + '="', "<a " * 300_000 + '="' + ">", "x" + "<div>y" * 100_000, "<center>z" * 100_000,
                                  "<script>" + "</script " * 100_000, "<svg>" + "<a " * 300_000 + "='", "<p>" * 200_000 + "</div>" * 100_000,
                                  "<ul>" + "<li>a" * 100_000, "<!--" * 200_000, "<p title='" * 80_000, "&amp" * 200_000])
def test_long_pages_take_linear_time(page):
    import time

    start = time.perf_counter()
    blocks = page_blocks(page)
    if blocks:
        vectors(blocks[:2000])
    assert time.perf_counter() - start < 4  # some seconds were minutes if a step looked at the whole page each time


def test_skipped_starts_are_those_that_cannot_match():
    rng = random.Random(5)
    bits = ["<a ", "<p>", "</p>", "<div class='x'>", "='", '="', '"', "'", ">", "<", "text", "<svg>", "<!--", "-->", "<script>", "</script ", "</script>", " ", "=", "/",
            "<![CDATA[", "]]>", "<p title=don't>", '<p a= "', "<style "]
    for _ in range(20_000):
        page = "".join(rng.choice(bits) for _ in range(rng.randint(1, 40)))
        for pattern in (TOKEN, IN_SVG):
            tags, at = Tags(page), 0
            for want in pattern.finditer(page):
                found = tags.search(pattern, at)
                assert found.span() == want.span(), page
                at = found.end()
            assert tags.search(pattern, at) is None
