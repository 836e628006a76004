import itertools
import random

import numpy as np
import pytest

from conftest import SF_SMALL
from scoutlab.llm.crf import Crf, fit
from scoutlab.llm.html_blocks import blocks
from scoutlab.llm.html_extract import extract, features, labelled_chains, main_text, train

PAGE = """<!DOCTYPE html><html><head><title>Site - T</title><style>p{}</style><script>var a="</p><p>x</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/a">About us</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for all who read it here.</p></div>
<article><h1>The &eacute;vent &amp; more</h1><p>First   paragraph with <b>bold</b> and&nbsp;a <a href=x>link</a> in a text that
goes on &lt;here&gt;.</p><aside class="ad"><p>Buy this fine thing now at a good price, only today and here.</p></aside>
<p>Second one, unclosed and long enough to be read as a text.<p>Third &#8212; the last of them, which ends here.</article>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/r">Other story</a></ul></aside>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I like this text very much, thank you for it and more of it.</p></div></section>
<form action="/s"><label>Email</label><input name=e><button>Send</button></form><footer><p>&copy; 2024 Site name</p></footer></body></html>"""


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))


def test_article_of_a_design_not_seen(model):
    assert main_text(PAGE, model).split("\n") == [
        "The évent & more", "First paragraph with bold and a link in a text that goes on <here>.",
        "Second one, unclosed and long enough to be read as a text.", "Third — the last of them, which ends here."]


@pytest.mark.parametrize("page,want", [
    (None, []), ("", []), ("<", ["<"]), ("a < b", ["a < b"]), ("<!-- open", []), ("<script>if (a<b) {", []), ("<p>a<p>b", ["a", "b"]),
    ("<div>a<p>b <i>c</i><br>d</div>e", ["a", "b c d", "e"]), ("<p>&amp;&am; &#x41; &nbsp; x</p>", ["&&am; A x"]),
    ("<a title='x>y' href=q>l</a> t", ["l t"]), ("<ul><li>x<li>y</ul>z", ["x", "y", "z"]), ("</p></div>t", ["t"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]), ("<p " + "x" * 100_000, ["<", "p " + "x" * 100_000][1:] or []),
])
def test_blocks_of_odd_markup(page, want):
    got = [b.text for b in blocks(page)]
    if page and page.startswith("<p x"):
        got, want = [" ".join(got)[-10:]], ["x" * 10]
    assert got == want


@pytest.mark.parametrize("page,want", [
    ('<article><p>one</p><video-js id="v" controls></video-js><p>two</p><p>three</p></article>', ["one", "two", "three"]),
    ("<style-guide><p>a</p></style-guide><p>b</p>", ["a", "b"]), ('<svg class="i"/><p>main text</p>', ["main text"]),
    ("<svg/><p>a</p><math /><p>b</p><svg><text>c</text></svg><p>d</p>", ["a", "b", "d"]),
    ("<svg><text>c</text></svg ><p>d</p>", ["d"]), ("<VIDEO controls><p>a</p>", ["a"]),
    *((f"<{name} x='>'><p>a</p><{name}><p>b</p>", ["a", "b"]) for name in "noscript template iframe object svg math canvas audio video noembed noframes".split()),
    *((f"<p>a</p><{name}><p>b</p></{name.upper()}\n><p>c</p>", ["a", "c"]) for name in "script style template iframe object svg math canvas video".split()),
    ("<\u017fvg><p>a</p>", ["a"]), ("<p>a</p><script src=x /><p>b</p>", ["a"]), ("<p>a</p><style>p{}<p>b</p>", ["a"]), ("<p>a</p>" + "<canvas>" * 50_000 + "<p>b</p>", ["a", "b"]),
])
def test_blocks_beside_raw_elements(page, want):
    assert [b.text for b in blocks(page)] == want


def test_held_out_accuracy(model, spark):
    pages = [r.html for r in spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/pages.parquet").limit(240).collect()]
    wrong = total = 0
    for rows, kinds, ys in labelled_chains(pages, 3, seed=991):
        wrong += sum(a != b for a, b in zip(model.decode(rows, kinds), ys))
        total += len(ys)
    assert total > 5000 and wrong / total < 0.02


def test_viterbi_and_gradient_against_all_label_sequences():
    rng = random.Random(5)
    chains = [([rng.sample("abcdef", 2) for _ in range(5)], [rng.choice("xy") for _ in range(4)], [rng.randrange(2) for _ in range(5)]) for _ in range(8)]

    def score(m, rows, kinds, ys):
        s = m.scores(rows)
        return m.first[ys[0]] + sum(s[i, y] for i, y in enumerate(ys)) + sum(m.pairs[m.links[k], a, b] for k, a, b in zip(kinds, ys, ys[1:]))

    def likelihood(m):
        total = -0.25 * sum((p ** 2).sum() for p in (m.unary, m.pairs, m.first))
        for rows, kinds, ys in chains:
            every = [score(m, rows, kinds, z) for z in itertools.product((0, 1), repeat=5)]
            total += score(m, rows, kinds, ys) - np.log(np.exp(every).sum())
        return total

    m = fit(chains, rounds=3000, l2=0.5, min_count=1, step_size=0.3)
    best = likelihood(m)
    for p in (m.unary, m.pairs, m.first):  # the optimum: no step in any direction gains
        for i in np.ndindex(p.shape):
            for d in (-0.01, 0.01):
                p[i] += d
                assert likelihood(m) <= best + 1e-6
                p[i] -= d
    for rows, kinds, _ in chains:
        want = max(itertools.product((0, 1), repeat=5), key=lambda z: score(m, rows, kinds, z))
        assert score(m, rows, kinds, m.decode(rows, kinds)) == pytest.approx(score(m, rows, kinds, want))


def test_rows_and_empty_table(model, spark):
    rows = [(1, "u", PAGE, 7), (1, "u", PAGE, 7), (None, None, None, 7), (3, "u", "", 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = extract(pages, model).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, len(main_text(PAGE, model))), (1, len(main_text(PAGE, model))), (3, 0)]
    assert all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert extract(pages.limit(0), train(pages.limit(0))).count() == 0
    assert isinstance(train(pages.limit(0)), Crf) and features([]) == ([], [])


@pytest.mark.parametrize("page,want", [
    ("<article><p data-x=it's>one</p><p>two</p><p>don't three</p></article>", ["one", "two", "don't three"]),
    ('<p title="a"b">one text', ["one text"]),
    ("<p title='a'b'>one</p><p x=\"y>z\" class=c>two</p>", ["one", "two"]),
    ("<p a = 'x>y' b=/c/d>one</p><div =x>two</div><p a=>three", ["one", "two", "three"]),
    ('<p title="never ended>one</p><p>two</p>', ["one", "two"]),
    ("<p>one</p>a < b <i>c</i> <d", ["one", "a < b c <d"]),
])
def test_attributes_are_read_as_browsers_do(page, want):
    assert [b.text for b in blocks(page)] == want


@pytest.mark.parametrize("part", ["<a ", "<div>", "<div>x", '<a x="', "<a x='>'", "<li><h1>", "</p>", "<p><b>", "<!--", "<svg ", "<table><td>y"])
def test_hostile_markup_takes_linear_time(part):
    import time
    page = part * (1_000_000 // len(part))
    began = time.process_time()
    blocks(page)
    assert time.process_time() - began < 6
