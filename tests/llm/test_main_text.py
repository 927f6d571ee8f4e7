import html
import re
import time

import numpy as np
import pytest

from curvelab.llm import main_text
from curvelab.llm.blocks import leaf_blocks
from curvelab.llm.labeller import BlockLabeller, encode_page
from tests.llm import layouts


def article(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", body)
    return "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks) if x)


def test_every_page_of_the_table(table):
    pages = table("pages")
    got = {r["page_id"]: r["text"] for r in main_text.extract(pages, main_text.train(pages)).collect()}
    assert got == {r["page_id"]: article(r["html"]) for r in pages.collect()}


def test_unseen_layout(table):
    pages = table("pages")
    model = main_text.train(pages)
    page = (
        "<html><head><title>T</title></head><body><div class='cookie-notice'><p>We use cookies here.</p></div>"
        "<div id=navbar><ul class=menu><li><a href=/>Home</a><li><a href=/x>News</a></ul></div>"
        "<div class='post content'><h2>Onthe reti</h2><p>Thand of the ertion &amp; there.<p>More\n of  it&nbsp;<b>was</b> said.</div>"
        "<div id='comments'><div class=comment><p>I liked that very much, said one reader of it.</p></div></div>"
        "<form class=newsletter><p>Your mail</p></form><div class=footer>&copy; 2020</div></body></html>"
    )
    blocks = main_text.page_blocks(page)
    labels = model.label([encode_page(blocks)])[0] >= 0.5
    assert [t for (_, t, _), y in zip(blocks, labels) if y] == ["Onthe reti", "Thand of the ertion & there.", "More of it was said."]


def test_edges(spark, table):
    model = main_text.train(table("pages"), max_pages=20, epochs=1)
    rows = [(1, "u", None), (2, None, ""), (3, "u", "  "), (4, "u", "<p"), (5, "u", "<script>x"), (None, "u", "<p>a" * 3000), (7, "u", "a"), (7, "u", "a")]
    pages = spark.createDataFrame([(*r, "clash", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = main_text.extract(pages, model).collect()
    assert sorted(str(r["page_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(r["text"] == "" for r in got if r["page_id"] in (1, 2, 3, 5))
    assert main_text.extract(pages.where("false"), model).count() == 0
    assert main_text.extract(pages, main_text.train(pages.where("false"))).count() == len(rows)


def test_blocks():
    page = "<!DOCTYPE html><body><!-- x --><p>a<b>b</b> c<br>d<p>e</p><ul><li>1<li>2</ul><script>var t='</p>'</script>&lt;f&amp"
    assert [(p, t) for p, t, _ in leaf_blocks(page)] == [
        (("body", "p"), "ab c d"),
        (("body", "p"), "e"),
        (("body", "ul", "li"), "1"),
        (("body", "ul", "li"), "2"),
        (("body",), "<f&"),
    ]
    assert leaf_blocks('<div class="x-y" title="a>b"><a href=1>link</a> t</div>') == [(("div", ".x", ".y"), "link t", 4 / 6)]
    assert leaf_blocks(None) == [] and leaf_blocks("</p></div>") == []


def test_blocks_with_drawings_formulas_and_fallbacks():
    said = lambda page: [t for _, t, _ in leaf_blocks(page)]
    assert said('<svg class="icon"/><p>a</p><SVG viewBox="0 0 1 1" /><p>b</p>') == ["a", "b"]
    assert said("<p>a<svg><text>x</text><svg/><svg><g/></svg><text>y</text></svg>b</p>") == ["ab"]
    assert said("<p>a</p><svg><!-- </svg> --><text>x</text></svg><p>b</p>") == ["a", "b"]
    assert said("<svg><p>a</p>") == ["a"] and said("<p>a</p><svg><svg>x</svg><p>b</p>") == ["a", "b"]
    assert said("<template><template>x</template>y</template><p>a</p>") == ["a"]
    assert said("<math/><p>if <math><mi>x</mi><mo>=</mo><mspace/><mn>2</mn></math> then</p>") == ["if x=2 then"]
    page = "<article><p>a<object data=x>b</object>c<noscript>d</noscript></p><object data=y /><p>e</article>"
    assert [(p, t) for p, t, _ in leaf_blocks(page)] == [
        (("article", "p"), "a"),
        (("article", "p", "object"), "b"),
        (("article", "p"), "c"),
        (("article", "p", "noscript"), "d"),
        (("article", "p"), "e"),
    ]


def test_icon_before_the_article(spark, table):
    pages = table("pages")
    first = pages.limit(1).collect()[0]
    page = first["html"].replace("<body>", '<body><svg class="icon" viewBox="0 0 8 8"/>')
    assert page != first["html"]
    one = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert main_text.extract(one, main_text.train(pages)).collect()[0]["text"] == article(page)


def test_gradients():
    rng = np.random.default_rng(0)
    pages = [[(("body", "p"), "some words here", 0.0)] * 3, [(("nav", "li"), "x", 1.0), (("body", "p"), "Long text. " * 5, 0.0)]]
    encoded = [encode_page(p) for p in pages]
    labels = [[1, 0, 1], [0, 1]]
    model = BlockLabeller(3, 2, 3)
    _, grad = model.gradients(encoded, labels)
    for name, value in model.p.items():
        flat = np.flatnonzero(grad[name])
        for k in rng.choice(flat, min(4, len(flat)), replace=False):
            at = np.unravel_index(k, value.shape)
            value[at] += 1e-5
            up, _ = model.gradients(encoded, labels)
            value[at] -= 2e-5
            down, _ = model.gradients(encoded, labels)
            value[at] += 1e-5
            assert abs((up - down) / 2e-5 - grad[name][at]) < 1e-7


def test_context_decides():
    """The same block is text or not by what comes before it; only a recurrent reader can tell."""
    rng = np.random.default_rng(1)
    one, two, same = ((("a1",), "x", 0.0), (("a2",), "x", 0.0), (("p",), "the same words", 0.0))
    pages, labels = [], []
    for _ in range(200):
        first = rng.random() < 0.5
        pages.append([one if first else two, *[same] * int(rng.integers(1, 6))])
        labels.append([0, *[int(first)] * (len(pages[-1]) - 1)])
    model = BlockLabeller()
    model.fit([encode_page(p) for p in pages], labels, epochs=12)
    got = model.label([encode_page([one, same, same]), encode_page([two, same, same]), encode_page([])])
    assert got[0][1:].min() > 0.8 and got[1][1:].max() < 0.2 and len(got[2]) == 0


def said(page):
    return [t for _, t, _ in leaf_blocks(page)]


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<p>a</p><option>x<p>b long text</p>", ["a", "x", "b long text"]),
        ("<div><select name=a><option>1</div><p>rest of the page</p>", ["rest of the page"]),
        ("<p>a<select><option>1<optgroup><option>2</select>b</p>", ["ab"]),
        ("<select><option>1<p>b</p>", ["b"]),
        ("<p>a<datalist><option>1</datalist>b", ["ab"]),
        ('<p class="x"">hello there</p>', ["hello there"]),
        ("<p title=it's>hello</p>", ["hello"]),
        ("<p title=it's>hello</p><p>world</p><p>don't</p>", ["hello", "world", "don't"]),
        ("<p title='a>b' class = \"c'd\" e='f'g>hello</p>", ["hello"]),
        ('<p title="x>hello</p><p>world</p>', ["hello", "world"]),
        ('<p title="x>hello</p><p id="y">world</p>', ["world"]),  # the value runs to the next quote
        ("a < b and <c", ["a < b and <c"]),
        ("<!--><p>a</p><!-- <p>b --!>c<!-- d", ["a", "c"]),
        ("</ x>a<? b>c<!d>e", ["ace"]),
        ("<b><p>a</b>b</p>c", ["ab", "c"]),
        ("<p>x &amp<b>lt;</b></p>", ["x &lt;"]),
        ("<svg><foreignObject><p>x</p></foreignObject></svg><p>y", ["y"]),
        ("<div><template><p>x</div><p>y</p></template>z</div>", ["z"]),
        ("<script>a</script >b<SCRIPT>c</Script/>d<script>e", ["bd"]),
    ],
)
def test_tags_as_browsers_read_them(page, texts):
    assert said(page) == texts


@pytest.mark.parametrize(
    "page, blocks",
    [
        ("<a ' " * 200_000, 1),
        ("<a ' " * 200_000 + ">", 0),
        ('<p a="' * 170_000, 1),
        ('<p a="x>t ' * 100_000, 50_000),
        ("<div>x" * 20_000, 20_000),
        ("<div>" * 20_000 + "</p>" * 20_000 + "</div>" * 20_000, 0),
        ("<dl><dd><div>" + "<b>" * 20_000 + "<dt>x</dt>" * 20_000, 20_000),
        ("<" * 500_000 + ">", 1),
        ("<svg>" * 100_000, 0),
        ("<select><option>" * 60_000, 0),
        ("<script></script " * 60_000, 1),
    ],
)
def test_long_odd_pages(page, blocks):
    start = time.process_time()
    assert len(leaf_blocks(page)) == blocks
    assert time.process_time() - start < 5


def test_all_words_count():
    """No word of a block is passed over, whatever its length."""
    for n in (1, 47, 48, 960, 5000):
        text = " ".join(f"w{i}" for i in range(n))
        assert len(encode_page([(("p",), text, 0.0)])[1][0]) == n


def test_batches_give_what_single_pages_give():
    rng = np.random.default_rng(8)
    pages = [[(("body", "p"), "word " * int(rng.integers(1, 9)), 0.0)] * int(rng.integers(0, 3000)) for _ in range(30)]
    model, encoded = BlockLabeller(), [encode_page(p) for p in pages]
    for page, got in zip(encoded, model.label(encoded)):
        assert np.allclose(model.label([page])[0], got)


def test_held_out_layouts(table):
    """Twelve layouts that training does not hold, block by block against the text they were made from."""
    rows = table("pages")
    model = main_text.train(table("pages", "/root/testdata/sf0.1"))
    blocks = [b for r in rows.collect() for b in main_text.page_blocks(r["html"])]
    texts = sorted({t for p, t, _ in blocks if main_text.own_label(p) and len(t.split()) >= 8})
    figures = {}
    for name, page, want in layouts.pages(texts, 20, seed=1):
        found = main_text.page_blocks(page)
        labels = model.label([encode_page(found)])[0] >= 0.5
        got, want = [t for (_, t, _), y in zip(found, labels) if y], want.split("\n")
        right, n, m = figures.get(name, (0, 0, 0))
        figures[name] = (right + sum(t in want for t in got), n + len(got), m + len(want))
    precision = {k: right / n for k, (right, n, _) in figures.items()}
    recall = {k: right / m for k, (right, _, m) in figures.items()}
    print({k: (round(precision[k], 3), round(recall[k], 3)) for k in figures})
    assert len(figures) == 12 and min(precision.values()) > 0.7 and min(recall.values()) > 0.4
    assert np.mean([*precision.values()]) > 0.95 and np.mean([*recall.values()]) > 0.93


def test_training_takes_whole_pages(spark):
    """Pages are taken or left, never cut."""
    small, large = "<p>" + "a " * 100, "<p>" + "b " * 1000
    rows = spark.createDataFrame([(small,), (small,), (large,), (None,)], "html string")
    read = lambda **k: sorted(len(b[0][1]) for b in main_text.sample_blocks(rows, **k))
    assert read(max_pages=9, max_page_chars=5000, max_chars=9000) == [199, 1999]
    assert read(max_pages=9, max_page_chars=1000, max_chars=9000) == [199]
    assert read(max_pages=9, max_page_chars=5000, max_chars=300) == [199]
    assert read(max_pages=9, max_page_chars=5, max_chars=300) == []
