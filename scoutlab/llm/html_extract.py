"""Main text of web pages by a conditional random field (operator 3).

A page is a chain of DOM leaf blocks.  Each block has binary features of its
ancestors (tags, words of classes and ids) and of its text (length, links,
punctuation).  A linear-chain CRF with the labels boilerplate and main text is
trained on labelled pages and decoded by Viterbi over the whole page.

Labelled pages are a bounded sample (TRAINING_PAGES pages of at most
TRAINING_CHARS characters, those with the smallest hash of page_id).  A sampled
page is labelled by its own design, the article element holding the main text;
and its texts are laid out anew in LAYOUTS other page designs, whose labels are
known by construction: other containers, menus, notices, side bars, adverts and
forms inside the article, reader comments, footers.

Extraction is a map without a shuffle.  Blocks are joined in page order by one
line feed; white space inside a block is one space.  Null or empty html gives
an empty text; markup that does not end is read as far as it goes.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scoutlab.llm.crf import Crf, fit
from scoutlab.llm.html_blocks import Block, blocks

TRAINING_PAGES = 150
TRAINING_CHARS = 20_000
LAYOUTS = 4
_LENGTHS = (1, 2, 4, 8, 16, 32, 64)
# Page designs for training: containers of main text and of everything else.
MAIN = (
    "article", "main", "div content", "div main", "div post", "div entry content", "div article body", "div post content",
    "section story", "div text", "section article", "div page content", "article post", "div id-content",
)
FURNITURE = (
    "nav", "nav menu", "div menu", "div nav", "ul nav", "div navigation", "div breadcrumb", "header", "div header", "div masthead",
    "header site header", "div banner", "div topbar", "div skip",
)
INSIDE = (
    "div ad", "div ads", "div advert", "div advertisement", "aside", "aside related", "div promo", "div sponsored", "div newsletter",
    "form", "form subscribe", "form search", "form login", "div share", "div social", "div related", "div notice", "div sidebar",
    "figure ad", "section newsletter", "div widget", "div banner ad",
)
BEFORE = ("div cookie notice", "div cookie", "div consent", "div notice", "div alert", "div gdpr", "section notice", "div popup",
          "div cookie banner", "div modal", "aside notice", "p notice")
AFTER = (
    "aside", "aside sidebar", "div sidebar", "div side", "section sidebar", "div widget", "section comments", "div comments",
    "div id-comments", "ol commentlist", "div comment", "section reader comments", "div responses", "div disqus", "form comment",
    "div related", "section related posts", "div ads", "div ad",
)
LAST = ("footer", "div footer", "footer site footer", "div copyright", "div legal", "div bottom", "div colophon")


def features(bs: list[Block]) -> tuple[list[list[str]], list[str]]:
    """Features of each block, and the kind of link between neighbours."""
    rows, kinds = [], []
    for i, b in enumerate(bs):
        words = b.text.count(" ") + 1
        length = sum(words > n for n in _LENGTHS)
        links = min(3, 4 * b.linked // max(1, len(b.text)))
        own = b.own or "-"
        fs = {f"t:{t}" for t in b.tags} | {f"m:{w}" for w in b.marks}
        fs |= {f"o:{own}", f"n:{length}", f"a:{links}", f"no:{length}:{own}", f"na:{length}:{links}",
               f"e:{b.text[-1] in '.!?:;…»”\"'}", f"c:{'©' in b.text}", "bias"}
        if b.outer:
            fs.add(f"u:{b.outer}>{own}")
        rows.append(sorted(fs))
        if i:
            kinds.append("same" if b.parent == bs[i - 1].parent else "other")
    return rows, kinds


def _element(spec: str, inner: str, rng: random.Random) -> str:
    tag, *words = spec.split()
    attrs = ""
    if words and words[0].startswith("id-"):
        attrs = f' id="{words[0][3:]}"'
    elif words:
        attrs = f' {rng.choice(("class", "class", "id"))}="{rng.choice("- _").join(words)}"'
    return f"<{tag}{attrs}>{inner}</{tag}>"


def lay_out(texts: list[str], other: list[str], rng: random.Random) -> tuple[str, list[int]]:
    """A page of a random design with ``texts`` as its main text and ``other``
    as furniture; the label of each of its blocks in order."""
    labels: list[int] = []

    def leaf(tag: str, text: str, keep: int) -> str:
        labels.append(keep)
        return f"<{tag}>{text.replace('&', '&amp;').replace('<', '&lt;')}</{tag}>"

    def short() -> str:
        return " ".join(rng.choice(other).split()[:rng.randint(1, 4)]) or "menu"

    def prose() -> str:
        return " ".join(rng.choice(other).split()[:rng.randint(4, 60)]) or "notice"

    def links() -> str:
        if rng.random() < 0.6:
            n = rng.randint(2, 7)
            items = "".join(f"<li><a href='/{i}'>{short()}</a></li>" for i in range(n))
            labels.extend([0] * n)
            return f"<ul>{items}</ul>"
        return "".join(leaf(rng.choice(("p", "div")), short(), 0).replace(">", "><a href='/x'>", 1).replace("</", "</a></", 1)
                       for _ in range(rng.randint(1, 4)))

    def filler(spec: str) -> str:
        if spec.startswith(("form", "div newsletter", "section newsletter")):
            inner = "".join(leaf(rng.choice(("p", "div", "legend", "h4")), rng.choice((short, prose))(), 0) for _ in range(rng.randint(1, 3)))
            return _element(spec, inner + "<input name='q'>", rng)
        if spec.startswith("ol"):
            return _element(spec, "".join(leaf("li", prose(), 0) for _ in range(rng.randint(1, 4))), rng)
        if spec.startswith("ul"):
            n = rng.randint(2, 6)
            labels.extend([0] * n)
            return _element(spec, "".join(f"<li><a href='/{i}'>{short()}</a></li>" for i in range(n)), rng)
        if spec.startswith("p ") or rng.random() < 0.3:
            labels.append(0)
            return _element(spec, prose().replace("&", "&amp;").replace("<", "&lt;"), rng)
        kind = rng.random()
        inner = leaf(rng.choice(("h2", "h3", "h4")), short(), 0) if kind < 0.4 else ""
        if "comment" in spec or "responses" in spec or kind > 0.5:
            inner += "".join(leaf(rng.choice(("p", "div", "p")), prose(), 0) for _ in range(rng.randint(1, 4)))
        else:
            inner += links()
        return _element(spec, inner, rng)

    def menu(spec: str) -> str:
        if spec.startswith("ul"):
            return filler(spec)
        if rng.random() < 0.2:
            labels.append(0)
            return _element(spec, short(), rng)
        title = leaf(rng.choice(("h1", "h1", "h2", "p", "div")), short(), 0) if "nav" not in spec and rng.random() < 0.6 else ""
        return _element(spec, title + (links() if not title or rng.random() < 0.5 else ""), rng)

    page = "".join(menu(rng.choice(FURNITURE)) for _ in range(rng.randint(0, 2)))
    page += "".join(filler(rng.choice(BEFORE)) for _ in range(rng.randint(0, 1)))
    page += filler(rng.choice(AFTER)) if rng.random() < 0.2 else ""
    main = ""
    if rng.random() < 0.2:
        main += menu(rng.choice(FURNITURE))
    for i, text in enumerate(texts):
        if i == 0:
            main += leaf("h1", " ".join(text.split()[:10]), 1)
        kind = rng.random()
        if kind < 0.1:
            main += leaf(rng.choice(("h2", "h3")), " ".join(text.split()[:6]) or text, 1)
        if kind > 0.92:
            words = text.split()
            cut = max(1, len(words) // 3)
            items = [" ".join(words[k:k + cut]) for k in range(0, len(words), cut)]
            main += f"<ul>{''.join(leaf('li', x, 1) for x in items)}</ul>"
        else:
            main += leaf(rng.choice(("p",) * 8 + ("blockquote", "pre", "div")), text, 1)
        if rng.random() < 0.15:
            main += filler(rng.choice(INSIDE))
    if rng.random() < 0.25:
        main += filler(rng.choice(AFTER))
    wrapped = main
    for spec in rng.sample(MAIN, rng.randint(0, 2)):
        wrapped = _element(spec, wrapped, rng)
    page += wrapped
    page += "".join(filler(rng.choice(AFTER + INSIDE)) for _ in range(rng.randint(0, 2)))
    page += "".join(filler(rng.choice(LAST)) for _ in range(rng.randint(0, 1)))
    return f"<html><head><title>x</title></head><body>{page}</body></html>", [0, *labels]


def labelled_chains(pages: list[str], layouts: int = LAYOUTS, seed: int = 7) -> list[tuple]:
    """Training chains from sampled pages: as they are, and laid out anew."""
    rng = random.Random(seed)
    chains, bodies, others = [], [], ["home about contact more", "read all news", "you can change this any time"]
    for page in pages:
        bs = blocks(page)
        if any("article" in b.tags for b in bs):
            ys = [int("article" in b.tags) for b in bs]
            chains.append((*features(bs), ys))
            bodies.append([b.text for b, y in zip(bs, ys) if y and b.text])
            others += [b.text for b, y in zip(bs, ys) if not y]
    if not bodies:
        words = "an early line of plain words that tells a reader something and goes on for a while".split()
        bodies = [[" ".join(rng.choices(words, k=rng.randint(5, 60))) + "." for _ in range(rng.randint(1, 6))] for _ in range(TRAINING_PAGES)]
    others += [t for body in bodies for t in body[1:2]]
    for body in bodies:
        for _ in range(layouts):
            html, ys = lay_out(rng.sample(body, min(len(body), rng.randint(1, 8))), others, rng)
            bs = blocks(html)
            if len(bs) == len(ys):
                chains.append((*features(bs), ys))
    return chains


def train(pages: DataFrame, sample: int = TRAINING_PAGES) -> Crf:
    """Fit the model on a bounded sample of ``pages`` (page_id, html)."""
    short = pages.filter(F.length("html") <= TRAINING_CHARS).select("page_id", "html", F.xxhash64("page_id").alias("_h"))
    # About twice the sample has a hash below this, so few rows leave their tasks.
    share = min(1.0, 2.0 * sample / max(1, pages.count()))
    low = short.filter(F.col("_h") <= F.lit(min(2**63 - 1, int(share * 2**64) - 2**63)))
    rows = low.orderBy("_h", "page_id").limit(sample).select("html").collect() if sample else []
    return fit(labelled_chains([r.html for r in rows]))


def main_text(page: str | None, model: Crf) -> str:
    bs = blocks(page)
    return "\n".join(b.text for b, y in zip(bs, model.decode(*features(bs))) if y)


def extract(pages: DataFrame, model: Crf) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Pages go one by one, so a batch's texts are all that is held.
            texts = [main_text(x.as_py(), model) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
