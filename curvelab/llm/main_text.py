"""Main text of web pages by a recurrent block labeller (operator 4).

1.  ``blocks.leaf_blocks`` turns a page into its leaf blocks, in page order.
2.  ``labeller.BlockLabeller``, a bidirectional LSTM, reads tag-path and hashed-word vectors of
    the whole sequence and labels every block main text or not.
3.  The labelled blocks are joined by line feeds.

Training has no labelled pages to learn from, so it labels its own: a bounded sample
(``max_pages``, ``max_page_chars``, ``max_chars``) of the pages, where the elements that HTML defines for it say what is article
and what is not, and rearrangements of these pages' blocks into layouts without such elements
(``LAYOUTS``), where class names and order must tell.  Only block sequences of the sample
reach the driver.

Defined results: a null or blank page has an empty text of 0 characters; every input row
gives one row, repeated ones too; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.llm.blocks import leaf_blocks
from curvelab.llm.labeller import Block, BlockLabeller, encode_page
from curvelab.llm.pieces import small_batches

# fixed values: elements and class words that say what a part of a page is
ARTICLE = frozenset(["article", "main"])
ASIDE = frozenset(["nav", "header", "footer", "aside", "form", "head", "title", "menu", "dialog", "fieldset", "button"])
ASIDE_WORDS = frozenset(
    ".ad .ads .advert .advertisement .sponsored .promo .sidebar .menu .nav .navbar .breadcrumb .breadcrumbs .footer .header .cookie"
    " .consent .notice .banner .popup .modal .subscribe .newsletter .comment .comments .commentlist .respond .related .share .social"
    " .login .search .widget .pagination .copyright".split()
)

#: Ways to wrap each part of a page, as paths below html and body (fixed values).
LAYOUTS: dict[str, tuple[tuple[str, ...], ...]] = {
    "text": (
        ("article",),
        ("main", "article"),
        ("main",),
        ("div", ".content"),
        ("div", ".main", ".content"),
        ("div", ".post"),
        ("div", ".entry", ".content"),
        ("div", ".wrapper", "div", ".article", ".body"),
        ("section", ".story"),
        ("div", ".text"),
    ),
    "menu": (
        ("nav", "ul", "li"),
        ("header", "nav", "ul", "li"),
        ("div", ".menu", "ul", "li"),
        ("div", ".navbar"),
        ("ul", ".nav", "li"),
        ("div", ".breadcrumbs"),
    ),
    "header": (("header", "h"), ("header", "p"), ("div", ".header", "h"), ("div", ".topbar"), ("div", ".site", ".title")),
    "footer": (("footer",), ("footer", "p"), ("div", ".footer"), ("div", ".copyright"), ("div", ".bottom", "ul", "li")),
    "sidebar": (("aside",), ("aside", "ul", "li"), ("div", ".sidebar", "p"), ("div", ".widget", "ul", "li"), ("div", ".related", "li")),
    "notice": (("div", ".cookie", ".notice", "p"), ("div", ".notice"), ("div", ".banner", "p"), ("div", ".consent"), ("div", ".alert"), ("div", ".popup", "p")),
    "advert": (("div", ".ad"), ("div", ".ads"), ("div", ".advert"), ("div", ".sponsored", "p"), ("aside", ".ad", "p"), ("div", ".promo")),
    "form": (("form",), ("form", "p"), ("div", ".newsletter", "form", "p"), ("form", ".search"), ("div", ".subscribe", "p"), ("div", ".login")),
    "comments": (
        ("section", ".comments", "div", ".comment", "p"),
        ("div", ".comments", "p"),
        ("ol", ".commentlist", "li", ".comment", "p"),
        ("div", ".comment"),
        ("div", ".discussion", "div", ".reply", "p"),
        ("ul", ".responses", "li"),
    ),
}
_BEFORE = ("menu", "header", "notice", "advert", "form", "sidebar")
_INSIDE = ("advert", "notice", "sidebar", "form")
_AFTER = ("comments", "sidebar", "form", "advert", "footer", "notice", "menu")


def own_label(path: tuple[str, ...]) -> int:
    """1 if the path itself says main text: inside an article element and nothing set aside."""
    return int(bool(ARTICLE & set(path)) and not (ASIDE & set(path)) and not (ASIDE_WORDS & set(path)))


def rearranged(texts: list[str], others: list[str], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A page of these paragraphs in a random layout, among parts made of other pages' text.  Two pages of
    five have class words of their own, so that text and order must tell."""
    own = rng.random() < 0.4
    made = lambda: "." + "".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(1, 6))))
    words_of: dict[str, str] = {}
    common = (made(),) if rng.random() < 0.5 else ()  # a word that all of them begin with

    def names(path: tuple[str, ...]) -> tuple[str, ...]:
        if not own:
            return path
        return tuple(w for n in path for w in ((*common, words_of.setdefault(n, made())) if n[0] == "." else (n,)))

    pick = lambda some: some[int(rng.integers(len(some)))]
    blocks: list[Block] = []
    labels: list[int] = []

    def put(kind: str, around: tuple[str, ...] = ()) -> None:
        path = ("html", "body", *around, *names(pick(LAYOUTS[kind])))
        for _ in range(int(rng.integers(1, 7 if kind in ("menu", "sidebar", "comments") else 3))):
            words = pick(others).split()
            long = kind == "comments" or (kind in ("sidebar", "notice") and rng.random() < 0.3)
            size = int(rng.integers(3, 60)) if long else int(rng.integers(1, 12))
            text = " ".join(words[:size]) or "x"
            linked = 1.0 if kind == "menu" or (kind == "sidebar" and rng.random() < 0.6) else 0.0
            if kind == "footer" and rng.random() < 0.7:
                text = "© " + text
            blocks.append((path, text, linked))
            labels.append(0)

    for kind in _BEFORE:
        if rng.random() < 0.45:
            put(kind)
    around = names(pick(LAYOUTS["text"]))
    for k, text in enumerate(texts):
        leaf = ("h",) if k == 0 and rng.random() < 0.7 else pick((("p",), ("p",), ("p",), ("li",), ("blockquote", "p"), ()))
        blocks.append((("html", "body", *around, *leaf), text, 0.0))
        labels.append(1)
        if rng.random() < 0.05:
            put(pick(_INSIDE), around)
    for kind in _AFTER:
        if rng.random() < 0.45:
            put(kind, around if kind == "comments" and rng.random() < 0.4 else ())
    return blocks, labels


def _headings(path: tuple[str, ...]) -> tuple[str, ...]:
    """h1 to h6 as one name."""
    return tuple("h" if len(p) == 2 and p[0] == "h" and p[1].isdigit() else p for p in path)


def page_blocks(page: str | None) -> list[Block]:
    return [(_headings(path), text, linked) for path, text, linked in leaf_blocks(page)]


def sample_blocks(pages: DataFrame, max_pages: int, max_page_chars: int, max_chars: int) -> list[list[Block]]:
    """Whole block sequences of at most ``max_pages`` pages of at most ``max_page_chars`` characters of
    HTML, those with the smallest hashes, as far as they fit ``max_chars`` characters in all."""
    size = F.length("html")
    marked = pages.select("html", F.xxhash64("html").alias("mark"), size.alias("size")).where(size <= max_page_chars)
    chosen = marked.groupBy("mark").agg(F.min("size").alias("size")).orderBy("mark").limit(max_pages).collect()
    marks, left = [], max_chars
    for r in chosen:
        if r["size"] <= left:
            marks.append((r["mark"],))
            left -= r["size"]
    spark = pages.sparkSession
    # at most ``max_pages`` hashes meet the pages, so pages are not shuffled; of copies one counts
    some = marked.join(F.broadcast(spark.createDataFrame(marks, "mark long")), "mark")
    some = some.groupBy("mark").agg(F.min("html").alias("html")).select("html")

    def run(batches):
        for batch in batches:
            for page in batch.column("html").to_pylist():
                blocks = [{"path": " ".join(p), "text": t, "linked": k} for p, t, k in page_blocks(page)]
                yield pa.RecordBatch.from_pylist([{"blocks": blocks}], schema=kind)

    kind = pa.schema([("blocks", pa.list_(pa.struct([("path", pa.string()), ("text", pa.string()), ("linked", pa.float64())])))])
    rows = some.mapInArrow(run, "blocks array<struct<path:string,text:string,linked:double>>").collect()
    return [[(tuple(b["path"].split()), b["text"], b["linked"]) for b in r["blocks"]] for r in rows]


def train(
    pages: DataFrame,
    max_pages: int = 400,
    rearrangements: int = 2,
    epochs: int = 6,
    seed: int = 17,
    max_page_chars: int = 256 << 10,
    max_chars: int = 16 << 20,
) -> BlockLabeller:
    """The labeller for these pages."""
    rng = np.random.default_rng(seed)
    sample = [blocks for blocks in sample_blocks(pages, max_pages, max_page_chars, max_chars) if blocks]
    sample.sort(key=lambda blocks: [b[1] for b in blocks])
    others = [text for blocks in sample for _, text, _ in blocks]
    sequences, labels = [], []
    for blocks in sample:
        own = [own_label(path) for path, _, _ in blocks]
        texts = [text for (_, text, _), y in zip(blocks, own) if y]
        if texts:
            sequences.append(blocks)
            labels.append(own)
        for _ in range(rearrangements):
            new, y = rearranged(texts or [b[1] for b in blocks], others, rng)
            sequences.append(new)
            labels.append(y)
    model = BlockLabeller()
    model.fit([encode_page(b) for b in sequences], labels, epochs=epochs)
    return model


def extract(pages: DataFrame, model: BlockLabeller) -> DataFrame:
    """page_id, url, text for every row of ``pages`` (page_id, url, html)."""

    def run(batches):
        for batch in small_batches(batches, "html"):
            found = [page_blocks(page) for page in batch.column("html").to_pylist()]
            probabilities = model.label([encode_page(b) for b in found])
            texts = ["\n".join(t for (_, t, _), p in zip(b, q) if p >= 0.5) for b, q in zip(found, probabilities)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string")
