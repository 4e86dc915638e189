from __future__ import annotations

import itertools
import random
import time

import numpy as np
import pytest

from sparkloom.llm import html, queries

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav><div class="cookie-notice"><p>We use cookies.</p></div>
<article><h1>The  title &amp; more</h1><p><b>First paragraph of the story,<br>with a break.<p>Second one &mdash; caf&eacute; &#233;.</p>
<div class="ad">Buy this thing.</div><p>Third one has a <a href="/x">link</a> inside it.</p></article>
<section id="comments"><h3>Comments</h3><div class="comment"><b>Bob</b> I do not agree at all.</div></section>
<form><label>Name</label><textarea>typed</textarea><button>Send</button></form><footer>&copy; Example &middot; All rights reserved.</footer>"""


@pytest.fixture(scope="module")
def field():
    return html.trained()


def test_page(field):
    assert field.extract(PAGE).split("\n") == ["The title & more", "First paragraph of the story, with a break.", "Second one — café é.", "Third one has a link inside it."]


@pytest.mark.parametrize("source", [None, "", "   ", "<p></p>", "<!-- only a comment", "<script>x", "<a", "<a b='", "</p></div>", "<button>x</button>", "<!---->", "<svg/>", "<html><head><title>t</title></head></html>"])
def test_no_text(field, source):
    assert field.extract(source) == ""
    assert html.blocks(source) == []


def texts(source):
    return [b.text for b in html.blocks(source)]


def test_unclosed_controls_keep_what_follows(field):
    for tag in ("button", "object", "svg", "math", "select", "template"):
        assert texts(f"<article><p>One.</p><p>Two <{tag}>x<p>Three.</p><p>Four.</p></article>") == (["One.", "Two x", "Three.", "Four."] if tag == "math" else ["One.", "Two", "x", "Three.", "Four."])
        assert texts(f"<p>One <{tag}>x</{tag}> two.</p>tail") == (["One x two.", "tail"] if tag == "math" else ["One two.", "tail"])
        body = "".join(f"<p>Sentence number {i} of the story, which goes on.</p>" for i in range(3))
        assert field.extract(f"<body><nav><a href=x>Home</a></nav><article><h1>Head</h1><{tag}>{body}</article></body>").count("Sentence number") == 3
    assert texts("<p>a<object>x<object>y</object>z</object>b</p>") == ["a b"]
    assert texts("<p>a<button>x<div>y</div>z</button>b</p>") == ["a b"]
    assert texts("<div>a<button>x</div><p>b<button>y</button>c") == ["a", "x", "b c"]


def test_marks():
    assert texts("<") == ["<"] and texts("1 < 2 <3 </") == ["1 < 2 <3 </"] and texts("a</ b>c") == ["ac"]
    assert texts("a<!-->b<!--->c<!-- x --!>d<!-- y") == ["abcd"]
    assert texts('<p title="a>b">x</p><p t=\'"\'>y') == ["x", "y"] and texts('<p a"b>x</p><i>y') == ["x", "y"]
    assert texts('<p>x<a b="c>y</p><p>z</p>') == ["x y".replace(" ", ""), "z"]
    assert texts("<p>a<script>if (a<b) '</p>'</script>b</p><script>c") == ["ab"]
    assert texts("<p>x <math><mi>a</mi><mo>=</mo><mn>1</mn></math> y") == ["x a=1 y"]


@pytest.mark.parametrize("source", ['<a b="x>' * 20_000, "<div>" * 60_000 + "x", "<b><div>" * 12_000 + "</b>" * 30_000, "<a " * 80_000, "x<button>a" * 20_000, "<!--" * 60_000, '<div class="' + "ab cd " * 10_000 + '">' + "<i id=qq>y<p>" * 8_000, "<table>" + "<div>" * 500 + "<td>x" * 20_000])
def test_hostile_pages_take_linear_time(source):
    began = time.process_time()
    html.blocks(source)
    once = time.process_time() - began
    began = time.process_time()
    html.blocks(source * 4)
    assert time.process_time() - began < 12 * once + 1


def tree(rng, depth=0):
    """Markup with the runs of text between its block-level tags."""
    out, runs = [], [""]
    for _ in range(rng.randint(1, 5)):
        kind = rng.random()
        if kind < 0.4 or depth > 4:
            word = rng.choice(["one", " two ", "three&amp;", "f  our\n"])
            out.append(word)
            runs[-1] += word.replace("&amp;", "&")
        elif kind < 0.6:
            own, inner = tree(rng, depth + 1)
            tag = rng.choice(["b", "a", "span", "em"])
            out.append(f"<{tag}>{own}</{tag}>")
            runs = [*runs[:-1], runs[-1] + inner[0], *inner[1:]]
        elif kind < 0.9:
            own, inner = tree(rng, depth + 1)
            tag = rng.choice(["div", "section", "ul", "article"])
            out.append(f"<{tag}>{own}</{tag}>")
            runs += [*inner, ""]
        else:
            out.append(rng.choice(["<script>no</script>", "<!-- no -->", "<button>no</button>"]))
            runs[-1] += " " if "button" in out[-1] else ""
    return "".join(out), runs


def test_blocks_against_brute_force():
    rng = random.Random(6)
    for _ in range(400):
        source, runs = tree(rng)
        assert texts(source) == [" ".join(x.split()) for x in runs if x.strip()], source


def test_blocks():
    found = html.blocks("<ul><li>one<li>two</ul><table><tr><td>a<td>b</table><p>x<p>y &lt;tag&gt; 1 < 2<div>z <i>in</i>line</div>tail")
    assert [b.text for b in found] == ["one", "two", "a", "b", "x", "y <tag> 1 < 2", "z inline", "tail"]
    assert found[0].tag == "li" and "<ul" in found[0].chain and "<li" not in html.blocks("<ul><li>a</ul><p>b</p>")[1].chain
    deep = html.blocks("<div>" * 3000 + "deep" + "</div>" * 3000)
    assert [b.text for b in deep] == ["deep"]


def test_held_out_layouts(field):
    layouts, wrong, total = html.Layouts(987), 0, 0
    for _ in range(150):
        page, truth = layouts.page()
        wrong += sum(a != b for a, b in zip(field.decode(page), truth, strict=True))
        total += len(page)
    assert wrong / total < 0.01


def test_viterbi_is_the_best_path(field):
    page = html.Layouts(3).page()[0][:9]
    e = field.emissions(page)

    def score(path):
        s = sum(x for x, y in zip(e, path, strict=True) if y) + (field.start if path[0] else 0)
        return s + sum(field.moves[int(a), int(b)] for a, b in itertools.pairwise(path))

    best = max(itertools.product((False, True), repeat=len(page)), key=score)
    assert score(field.decode(page)) == pytest.approx(score(best))


def test_gradient_reaches_a_maximum():
    rng = np.random.default_rng(0)
    blocks = [html.Block("word " * int(n), ("<article",) if n % 2 else ("<nav",), "p", 0) for n in rng.integers(1, 30, 40)]
    truth = [b.chain == ("<article",) for b in blocks]
    made = html.fit([(blocks[i : i + 5], truth[i : i + 5]) for i in range(0, 40, 5)], epochs=20)
    assert made.weights["<article"] > 0 > made.weights["<nav"]


def test_query(spark, tmp_path):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", PAGE)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r for r in queries.op4_html(spark, str(tmp_path)).collect()}
    assert got[2]["text"] == got[3]["text"] == "" and got[2]["n_chars"] == 0
    assert got[1]["text"] == got[4]["text"] and got[1]["n_chars"] == len(got[1]["text"])
