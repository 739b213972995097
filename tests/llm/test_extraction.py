"""Main text of pages: the reading of blocks, the field against enumeration, unseen pages."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from stopweave.llm import extraction as x

SCHEMA = "page_id long, url string, html string, text string, n_chars string, number string, page string"

PAGE = """<!doctype html><html><head><title>My Site - Post</title></head><body class="home">
<div id="cookie-consent"><p>We use cookies to improve your experience, and to show ads.</p><button>Accept</button></div>
<header><h2><a href="/">My Site</a></h2><p>A site about many things.</p><nav><ul><li><a href=/a>Home</a><li><a>About</a></ul></nav></header>
<div class="wrap">SHELL<h1>Real &lt;title&gt;  of\tthis post</h1><p>First paragraph of the text, with <a href=x>a link</a> &amp; more.
<div class="ad"><p>Buy our product now, it is the best product there is.</p></div>
<p>Second paragraph<br>goes&nbsp;on.<!-- <p>not this</p> --></p><ul><li>item one<li>item two</ul>
<form action=/s><label>Your mail</label><input name=q><button>Send it</button></form>
<p>Last <b>words</b>.</p>END<div class="sidebar"><h3>Recent posts</h3><ul><li><a href=1>One post</a></li></ul></div>
<div id="comments"><h3>3 comments</h3><div class="comment"><p>Great article, thanks a lot for writing it.</p></div></div></div>
<footer><p>&copy; 2024 My Site. All rights reserved.</p></footer><script>var x="<p>no</p>";</script>"""
MAIN = "Real <title> of this post\nFirst paragraph of the text, with a link & more.\nSecond paragraph goes on.\nitem one\nitem two\nLast words."
SHELLS = [("<article>", "</article>"), ('<main><div class="c1">', "</div></main>"), ('<div class="entry-content">', "</div>"), ('<div id="article-text">', "</div>")]


@pytest.fixture(scope="module")
def model(spark):
    return x.train_extractor(x.annotated_pages(spark.read.parquet(f"{TESTDATA}/sf0.01/pages.parquet")))


def texts(page):
    return [block.text for block in x.blocks_of(page)]


def test_blocks():
    assert texts("a<b>b</b> c<p>d\n e</p>f<br>g") == ["ab c", "d e", "f g"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("<p>a<style>p{}</style><script>if (a < b) '</p>'</script>b<!-- x > y -->c") == ["abc"]
    assert texts("<p title=\"a>b\">c &lt;p&gt; &#233;&eacute;&notanentity; 1 < 2") == ["c <p> éé¬anentity; 1 < 2"]
    assert texts("<P>A</P ><DIV>B</DIV>") == ["A", "B"]
    assert texts("<p>a<script>never closed <p>b") == ["a"]
    assert texts("<p>a<!-- never closed <p>b") == ["a"]
    assert texts('<p>a<a href="x>b</a> <p>c') == ["ab", "c"]
    assert texts("</div></p></b>x</table>") == ["x"]
    assert texts("") == texts("  \n ") == texts("<p></p>") == []
    assert texts("a  b") == ["a b"]


def test_long_and_deep_pages_take_time_in_proportion():
    assert len(texts("<div>" * 20_000 + "x" + "</div>" * 20_000)) == 1
    assert len(texts("<p>x" * 50_000)) == 50_000
    assert texts("<b>" * 20_000 + "x" + "</i>" * 20_000) == ["x"]
    assert texts("y" * 3_000_000) == ["y" * 3_000_000]


def chains(rng, sizes):
    page = np.repeat(np.arange(len(sizes)), sizes)
    place = np.concatenate([np.arange(n) for n in sizes])
    same = (rng.random(len(page)) < 0.5) & (place > 0)
    return page, place, same.astype(int), (rng.random(len(page)) < 0.5).astype(int)


def likelihoods(scores, same, following, first):
    """The weight of every labelling of one page."""
    out = {}
    for labels in product((0, 1), repeat=len(scores)):
        total = first[labels[0]] + sum(s for s, y in zip(scores, labels) if y)
        total += sum(following[same[k], labels[k - 1], labels[k]] for k in range(1, len(scores)))
        out[labels] = total
    return out


def test_gradients_equal_those_of_all_labellings():
    rng = np.random.default_rng(0)
    sizes = [1, 4, 6, 2]
    page, place, same, label = chains(rng, sizes)
    scores, following, first = rng.normal(0, 1, len(page)), rng.normal(0, 1, (2, 2, 2)), rng.normal(0, 1, 2)
    to_main, to_following, to_first = x._Chains(page, place, same, label).gradients(scores, following, first)
    want_main, want_following, want_first = label.astype(float), np.zeros((2, 2, 2)), np.zeros(2)
    for p in range(len(sizes)):
        at = np.flatnonzero(page == p)
        weights = likelihoods(scores[at], same[at], following, first)
        total = np.logaddexp.reduce(list(weights.values()))
        for labels, sign in [(tuple(label[at]), 1.0), *((y, -np.exp(w - total)) for y, w in weights.items())]:
            want_first[labels[0]] += sign
            for k in range(1, len(at)):
                want_following[same[at][k], labels[k - 1], labels[k]] += sign
            if sign < 0:
                want_main[at] += sign * np.array(labels)
    assert np.allclose(to_main, want_main) and np.allclose(to_following, want_following) and np.allclose(to_first, want_first)


def test_decoding_finds_the_likeliest_labels():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 9):
        blocks = [x.Block(f"w{k}", frozenset({f"f{k}"}), (), int(rng.integers(3)), 0, False) for k in range(size)]
        model = x.Extractor({f"f{k}": rng.normal(0, 1) for k in range(size)}, rng.normal(0, 1, (2, 2, 2)), rng.normal(0, 1, 2))
        same = [0] + [int(a.parent == b.parent) for a, b in zip(blocks, blocks[1:])]
        weights = likelihoods([model.weights[f"f{k}"] for k in range(size)], same, model.following, model.first)
        assert tuple(map(int, x._Decoder(model).main(blocks))) == max(weights, key=weights.get)


@pytest.mark.parametrize("shell", SHELLS)
def test_a_page_of_unseen_layout(model, shell):
    assert x.main_text(PAGE.replace("SHELL", shell[0]).replace("END", shell[1]), x._Decoder(model)) == MAIN


def test_blocks_of_held_out_layouts(model):
    decoder, right, count = x._Decoder(model), 0, 0
    sentences = [f"Sentence {k} is about the {k}th thing, and it is not short at all." for k in range(40)]
    for seed in range(10**6, 10**6 + 300):
        blocks = x.blocks_of(x.layout(sentences, seed))
        right += sum(found == block.marked for found, block in zip(decoder.main(blocks), blocks, strict=True))
        count += len(blocks)
    assert right / count > 0.99


def test_marks_are_no_features():
    plain, marked = x.blocks_of("<article><p>a</article>")[0], x.blocks_of(f"<article {x.MARK}><p>a</article>")[0]
    assert plain.features == marked.features and plain.near == marked.near and marked.marked and not plain.marked


def test_nulls_copies_and_empty_tables(spark, model):
    page = PAGE.replace("SHELL", "<article>").replace("END", "</article>")
    rows = [(1, "u", page), (1, "u", page), (None, None, None), (2, None, ""), (3, "v", "<nav>menu</nav>")]
    df = spark.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], SCHEMA)
    found = x.extract(df, model)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, "u", MAIN, len(MAIN))] * 2 + [(None, None, "", 0), (2, None, "", 0), (3, "v", "", 0)], key=repr
    )
    nothing = df.where(F.lit(False))
    assert x.extract(nothing, x.train_extractor(x.annotated_pages(nothing))).isEmpty()
    few = x.train_extractor(x.annotated_pages(df))
    assert x.main_text(page, x._Decoder(few)) == MAIN


def test_learned_pages_are_bounded(spark):
    pages = spark.createDataFrame([(k, "u", f"<article><p>text {k}</article>" * (1 + 9 * (k == 3)), "", "", "", "") for k in range(50)], SCHEMA)
    assert x.annotated_pages(pages, most=10, chars=100).select("page").distinct().count() == 10 * 81
