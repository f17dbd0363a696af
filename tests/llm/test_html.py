import math
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import extract
from tidemark.llm.html_blocks import _Tags, blocks


@pytest.fixture(scope="module")
def labeller(spark):
    rows = [(i, "http://x", f"<html><body><nav><ul><li><a href=x>home page</a></li></ul></nav><article><h1>Title {i}</h1><p>Some words of the story, number {i}.</p></article><footer>&copy; us</footer>") for i in range(20)]
    return extract.fit(spark.createDataFrame(rows, "page_id long, url string, html string"), made=400)


def texts(html):
    return [b.text for b in blocks(html)]


@pytest.mark.parametrize(
    "html, want",
    [
        (None, []),
        ("", []),
        ("plain", ["plain"]),
        ("<p>a &amp; b &eacute;&#233;<p>c\n\t d", ["a & b éé", "c d"]),
        ("<div>one<b>two</b> <i>three</i><br>four</div>five", ["onetwo three four", "five"]),
        ("<script>var a='<p>x</p>';</script><style>p{}</style>t<!-- <p>no</p> -->u", ["tu"]),
        ("<title>no</title><p>x<textarea><p>y</textarea>z", ["x", "z"]),
        ("<ul><li>a<li>b</ul></div></p>c<", ["a", "b", "c<"]),
        ("a < b and <3 c > d", ["a < b and <3 c > d"]),
        ('<p title="a>b">x</p><p class=\'k\'>y', ["x", "y"]),
        ("<p>open <b>never closed <script>to the end", ["open never closed"]),
        ("<!-- never closed <p>x", []),
        ("<![CDATA[x]]><?php y ?><!doctype html>z", ["z"]),
    ],
)
def test_blocks(html, want):
    assert texts(html) == want


def test_paths():
    got = blocks('<div class="main-text side" id=top><p>a</p><table><tr><td>b<td>c</table></div><p>d')
    assert [b.path for b in got] == [("div", ".main", ".text", ".side", ".top", "p"), ("div", ".main", ".text", ".side", ".top", "table", "tr", "td")] + [
        ("div", ".main", ".text", ".side", ".top", "table", "tr", "td"), ("p",)]
    assert blocks("<p><a href=x>all of it</a></p>")[0].linked == 9


def test_deep_and_long_pages_end():
    assert len(texts("<div>" * 3000 + "x")) == 1
    assert len(texts("<p>word</p>" * 20_000)) == 20_000
    assert texts('<a href="' * 2000) != ["x"]


UNIT = ["<p x='", '<p x="', "<p x ", "<p", "<p '>' ", "<div>x", "<div>", "</x>", "<a href=\"'", "<!", "<p class=", "</", "<p \"'\" '\"' "]


@pytest.mark.parametrize("unit", UNIT)
def test_time_grows_with_the_page_alone(unit):
    begin = time.process_time()
    got = blocks("<div>" * 20_000 + unit * 60_000)
    extract.vectors(got)
    extract.semantic_labels(got)
    assert time.process_time() - begin < 20


def plain_tags(html):
    """Begin, end and name of every tag, each looked for from scratch."""
    out, at = [], 0
    while at < len(html):
        if html[at] != "<":
            at += 1
            continue
        name = re.compile(r"</?([a-zA-Z][^\s/>]*)").match(html, at)
        end = None
        if name:
            end = name.end()
            while end is not None and end < len(html) and html[end] != ">":
                if html[end] in "'\"":
                    close = html.find(html[end], end + 1)
                    end = close + 1 if close >= 0 else None
                else:
                    end += 1
            end = end + 1 if end is not None and end < len(html) else None
        if end is None:
            at += 1
            continue
        out.append((at, end, name[1]))
        at = end
    return out


@settings(max_examples=2000, deadline=None)
@given(st.text(st.sampled_from("<</>>\"' ap="), max_size=40))
def test_tags_are_those_of_a_plain_scan(html):
    html = re.sub("<(?=/?[^/a-z]|/?$|//)", "_", html)
    tags, got, at = _Tags(html), [], 0
    while found := tags.after(at):
        got.append((found[0], found[1], found[3]))
        at = found[1]
    assert [g for g in got if g[2]] == plain_tags(html)


def test_long_pages_are_read_as_short_ones(labeller):
    rng = random.Random(4)
    for _ in range(20):
        page, _ = extract.labelled_made(rng, ["some", "words"])
        if page:
            whole, _ = labeller.run(*extract._padded([extract.vectors(page)]))
            assert np.allclose(whole[0], labeller.read(page, step=3), atol=1e-4)


def test_logits_are_those_of_a_plain_lstm(labeller):
    def squash(x):
        return 1 / (1 + math.exp(-x))

    page, _ = extract.labelled_made(random.Random(8), ["some", "words"])
    x, n = extract.vectors(page).astype(float), extract.HIDDEN
    want = [float(labeller.c[0])] * len(page)
    for d, order in ((0, range(len(page))), (1, range(len(page) - 1, -1, -1))):
        h, c = [0.0] * n, [0.0] * n
        for t in order:
            z = [sum(x[t, k] * labeller.w[d, k, j] for k in np.flatnonzero(x[t])) + sum(h[k] * labeller.u[d, k, j] for k in range(n)) + labeller.b[d, j] for j in range(4 * n)]
            c = [squash(z[n + j]) * c[j] + squash(z[j]) * math.tanh(z[3 * n + j]) for j in range(n)]
            h = [squash(z[2 * n + j]) * math.tanh(c[j]) for j in range(n)]
            want[t] += sum(h[j] * labeller.v[d * n + j] for j in range(n))
    got, _ = labeller.run(*extract._padded([extract.vectors(page)]))
    assert np.allclose(got[0], want, atol=1e-3)


def test_article_only(spark, labeller):
    page = (
        "<html><head><title>t</title></head><body><header><p>Site name</p></header><nav class=menu><ul><li><a href=/>Home</a><li><a href=/>About</a></ul></nav>"
        "<div class='cookie notice'><p>We use cookies.</p></div><article><h1>The story</h1><p>First part &amp; more.<p>Second   part.<div class=ad>Buy this now</div><p>Third part.</article>"
        "<aside class=sidebar><h3>Related</h3><p>Another story</p></aside><div class=comments><h3>Comments</h3><div class=comment><p>I liked it.</p></div></div>"
        "<form><label>Name</label><input><button>Send</button></form><footer>&copy; nobody</footer></body></html>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "v", ""), (4, "w", "<div></div>"), (1, "u", page), (None, "z", page)]
    table = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = extract.main_text(table, labeller).collect()
    assert len(got) == 6
    want = "The story First part & more. Second part. Third part."
    assert [r["text"] for r in got if r["url"] in ("u", "z")] == [want] * 3
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["url"] not in ("u", "z")] == [""] * 3
    assert extract.main_text(table.limit(0), labeller).count() == 0


def test_made_pages_are_learned(labeller):
    rng = random.Random(99)
    words = "some other words than those it was trained on make up these pages".split()
    pages = [p for p in (extract.labelled_made(rng, words) for _ in range(150)) if p[0]]
    found = extract.label(labeller, [p for p, _ in pages])
    right = sum(int((f == (y > 0)).sum()) for f, (_, y) in zip(found, pages))
    assert right / sum(len(y) for _, y in pages) > 0.97


def test_gradients_match_differences():
    import numpy as np

    rng = np.random.default_rng(0)
    x, sizes, y = rng.normal(size=(3, 5, extract.SIZE)).astype(np.float32), np.array([5, 2, 4]), (rng.random((3, 5)) > 0.5).astype(np.float32)
    net = extract.train([x[0]], [y[0]], epochs=1)
    weights = [net.w, net.u, net.b, net.v, net.c]

    def loss():
        logits, _ = net.run(x, sizes)
        real = np.arange(5)[None, :] < sizes[:, None]
        return float((np.logaddexp(0, logits) - y * logits)[real].sum() / real.sum())

    for w, g in zip(weights, extract._gradients(net, x, sizes, y)):
        for _ in range(4):
            at = tuple(int(rng.integers(n)) for n in w.shape)
            keep = w[at]
            w[at] = keep + 1e-2
            up = loss()
            w[at] = keep - 1e-2
            down = loss()
            w[at] = keep
            assert abs((up - down) / 2e-2 - g[at]) < 2e-3
