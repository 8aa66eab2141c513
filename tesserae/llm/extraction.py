"""Main text of web pages: boosted trees over DOM nodes, decoded along the hierarchy.

The trees judge every block node (and every bare text run) from its tag, attribute tokens, depth, subtree density and
siblings. The decoder picks the set of nodes with the largest sum of log-odds in which a kept node's ancestors are all
kept, so no part of a rejected subtree stays and no kept text hangs below a rejected ancestor. Kept runs are joined in page order.

The training pages are generated here with known labels: many layouts of articles among menus, headers, footers, sidebars,
notices, adverts, forms and reader comments, with broken markup, some without any telling attribute; TRAIN_PAGES of them
bound the sample.

Defined cases: a null or empty html, or one of which nothing is kept, gives an empty text; a page cut off anywhere is read to its
end (an unfinished tag is markup); repeated rows give equal rows; pages of any length are read whole in linear time;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import tidied
from tesserae.llm.dom import Page, features, kept_text, parse
from tesserae.llm.trees import Trees, fit

TRAIN_PAGES, SEED = 1000, 5
#: Nodes whose features are judged at once.
TOGETHER = 20_000


def decode(page: Page, logits: np.ndarray) -> np.ndarray:
    """The best set of nodes that is closed under ancestors."""
    nodes = page.nodes
    gain = logits.astype(np.float64).copy()
    gain[0] = max(gain[0], 0.0)
    total = gain.tolist()
    for i in range(len(nodes) - 1, 0, -1):
        if total[i] > 0:
            total[nodes[i].parent] += total[i]
    keep = np.zeros(len(nodes), dtype=bool)
    for i, x in enumerate(nodes):  # parents come before children
        keep[i] = total[i] > 0 and (x.parent < 0 or keep[x.parent])
    return keep


class _Writer:
    """A page under construction: markup, and the label of each text."""

    def __init__(self, rng: random.Random):
        self.rng, self.out = rng, []
        self.opaque = rng.random() < 0.15  # names that tell nothing, as build tools make them

    def words(self, least: int, most: int) -> str:
        r = self.rng
        style = r.random()
        made = ["".join(r.choice(("an", "er", "on", "the", "re", "st", "é", "in", "qu", "o", "li")) for _ in range(r.randint(1, 4))) for _ in range(r.randint(least, most))]
        if style < 0.1:
            made = [w + r.choice(("%%%", "###", "|", "!!", "")) for w in made]
        elif style < 0.15:
            made = [w.upper() for w in made]
        return " ".join(made) + r.choice((".", ".", "", "!", "?"))

    def text(self, main: bool, least: int = 1, most: int = 60, lead: str = "") -> None:
        """A text with a mark that tells its label after parsing; it may begin with one of the leads."""
        said = self.rng.choice(lead.split("|")) + " " if lead and self.rng.random() < 0.6 else ""
        self.out.append(f"{'§+' if main else '§-'}{said}{self.words(least, most)}")

    def heading(self, lead: str) -> None:
        """A heading over what is no main text, often a plain saying alone."""
        tag = self.rng.choice(("h2", "h3", "h3", "h4", "p", "div"))
        said = self.rng.choice(lead.split("|")) if tag in ("p", "div") or self.rng.random() < 0.7 else self.words(1, 4)
        self.out.append(f"<{tag}>§-{said}</{tag}>")

    def box(self, tag: str, names: str, inside, close: bool = True, sure: bool = False) -> None:
        r = self.rng
        if tag == "p":  # a paragraph without a name is main text as far as anyone can tell
            tag, sure = ("div", sure) if self.opaque else ("p", True)
        name = r.choice(names.split()) if names and (sure or r.random() < 0.85) else ""
        if self.opaque:
            name = r.choice(("", f"x{r.randint(1, 9)}", f"c{r.randint(10, 99)}", "css-" + "".join(r.choice("abcdefgh0123") for _ in range(5))))
        elif name and r.random() < 0.3:
            name += r.choice(("-wrap", "-box", " c12", "_1", "-inner", " clearfix"))
        attr = f' {r.choice(("class", "class", "id"))}="{name}"' if name else ""
        self.out.append(f"<{tag}{attr}>")
        inside()
        if close:
            self.out.append(f"</{tag}>")

    def links(self, main: bool, least: int = 3, most: int = 9) -> None:
        r = self.rng
        plain = r.random() < 0.2
        if not plain:
            self.out.append("<ul>")
        for _ in range(r.randint(least, most)):
            self.out.append("<a href='/x'>" if plain else "<li><a href='/x'>")
            self.text(main, 1, 4)
            self.out.append("</a> " if plain else "</a></li>")
        if not plain:
            self.out.append("</ul>")

    def paragraphs(self, main: bool, least: int, most: int, long: int) -> None:
        r = self.rng
        for _ in range(r.randint(least, most)):
            kind = r.random()
            if main and kind < 0.05:
                self.out.append(r.choice(("<h2>", "<h3>")))
                self.text(True, 1, 8, "Comment on|Related|Contact between|The main" if r.random() < 0.1 else "")
                self.out.append(self.out[-2].replace("<", "</"))
            elif main and kind < 0.1:
                self.out.append("<ul>")
                for _ in range(r.randint(2, 5)):
                    self.out.append("<li>")
                    self.text(True, 2, 20)
                    self.out.append(r.choice(("</li>", "")))
                self.out.append("</ul>")
            elif main and kind < 0.13:
                self.out.append("<blockquote><p>")
                self.text(True, 5, 40)
                self.out.append("</p></blockquote>")
            elif main and kind < 0.16:
                self.out.append("<table><tr><td>")
                self.text(True, 1, 5)
                self.out.append("<td>")
                self.text(True, 1, 5)
                self.out.append("</table>")
            elif main and kind < 0.18:
                self.out.append("<pre>")
                self.text(True, 3, 30)
                self.out.append("</pre>")
            elif main and kind < 0.2:
                self.out.append("<figure><img src=x><figcaption>")
                self.text(True, 2, 15)
                self.out.append("</figcaption></figure>")
            elif main and kind < 0.23:
                self.text(True, 3, long)
                self.out.append("<br><br>")
            elif main and kind < 0.25 and not self.opaque:
                self.box("p", "ad ads advert sponsor promo advertisement sponsored notice newsletter subscribe", lambda: self.text(False, 2, 12), sure=True)
            else:
                harmless = main and r.random() < 0.06
                self.out.append(f"<p class={r.choice(('lead', 'intro', 'text', 'p1', 'first', 'dropcap'))}>" if harmless else "<p><b>" if r.random() < 0.15 else "<p>")
                self.text(main, 1, long)
                self.out.append(r.choice(("</p>", "</p>", "</p>", "<br>", "")))


def training_page(rng: random.Random) -> str:
    """One generated page; each text begins with § and + (main text) or -."""
    w = _Writer(rng)
    pick, chance = rng.choice, rng.random

    def advert():
        w.box(pick(("div", "div", "aside", "section", "p")), "ad ads advert adsense sponsor promo banner sponsored advertisement", lambda: w.text(False, 2, 40, "Advertisement|Sponsored|Ad|Promoted"))

    def notice():
        w.box(pick(("div", "section", "aside", "p")), "cookie cookie-notice consent notice alert popup gdpr newsletter subscribe", lambda: w.paragraphs(False, 1, 2, 30) if chance() < 0.5 else w.text(False, 3, 30, "Subscribe|This site uses cookies|Newsletter|We value your consent"))

    def form():
        w.box("form", "search login signup subscribe contact", lambda: (w.text(False, 1, 5), w.out.append("<label>"), w.text(False, 1, 4), w.out.append("</label><input name=q><button>go</button>")))

    def share():
        w.box("div", "share social sharing tags", lambda: w.links(False, 2, 4))

    def header():
        w.box(pick(("header", "header", "div")), "header masthead top site-header banner", lambda: (w.out.append(pick(("<h1>", "<p>", "<div>"))), w.text(False, 1, 6), w.out.append(pick(("</h1>", "</div>", ""))), w.links(False) if chance() < 0.4 else None))

    def nav():
        w.box(pick(("nav", "nav", "nav", "div", "ul")), "nav menu navigation navbar breadcrumb topbar", lambda: w.links(False))

    def aside():
        w.box(pick(("aside", "aside", "div", "section")), "sidebar side related widget popular rail recommended", lambda: (w.heading("Related stories|Popular|Recommended|Trending now|Related"), pick((lambda: w.links(False), lambda: w.paragraphs(False, 1, 3, 30)))()))

    def footer():
        w.box(pick(("footer", "footer", "footer", "div")), "footer bottom copyright legal site-footer colophon", lambda: pick((lambda: w.text(False, 2, 30, "Copyright 2024|©|All rights reserved"), lambda: w.paragraphs(False, 1, 3, 20), lambda: w.links(False)))())

    def comments():
        def one():
            w.box(pick(("li", "div", "article", "p")), "comment reply", lambda: w.paragraphs(False, 1, 2, 50) if chance() < 0.5 else w.text(False, 2, 50))

        w.box(pick(("section", "div", "ol", "div")), "comments commentlist comment-list discussion respond replies", lambda: (w.heading("Comments|3 comments|Reader comments|Discussion|Replies|Leave a reply"), [one() for _ in range(rng.randint(1, 6))]))

    def related():
        """Links to other pages under a heading, in a box without a name or in none."""
        boxed = chance() < 0.6
        said = lambda: (w.heading("Related stories|Read more|Related|More stories|You may also like"), w.links(False, 2, 6))
        w.box(pick(("section", "div")), "", said) if boxed else said()

    def inside():
        if chance() < 0.85:
            wrapped = chance() < 0.1
            w.out.append("<header><h1>" if wrapped else pick(("<h1>", "<h1>", "<h1 class=title>", "<h1 class='entry-title headline'>")))
            w.text(True, 1, 12)
            w.out.append("</h1></header>" if wrapped else "</h1>")
        long = pick((8, 30, 60, 150))
        w.paragraphs(True, 1, pick((1, 3, 8, 20, 40, 90)), long)
        for part, often in ((advert, 0.15), (share, 0.1), (form, 0.08), (notice, 0.08), (aside, 0.08), (nav, 0.03), (related, 0.08)):
            if chance() < often:
                part()
                if chance() < 0.6:
                    w.paragraphs(True, 1, pick((4, 4, 40)), long)
        if chance() < 0.08:
            comments()
        if chance() < 0.06:
            footer()

    def article():
        kind = chance()
        if kind < 0.45:
            w.box("article", "post article entry hentry" if chance() < 0.4 else "", inside)
        elif kind < 0.6:
            w.box("main", "main content", inside)
        elif kind < 0.7:
            w.box("main", "content", lambda: w.box("article", "post", inside))
        else:
            w.box(pick(("div", "div", "section", "td")), "content article post-body entry-content story main article-body page-content post", inside)

    w.out.append("<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>" if chance() < 0.9 else "<html><body>")
    for part, often in ((notice, 0.2), (header, 0.45), (nav, 0.6), (advert, 0.35), (form, 0.12), (aside, 0.1)):
        if chance() < often:
            part()
            if chance() < 0.1:
                w.out.append("<!-- x -->")
    if chance() < 0.04:
        w.text(False, 1, 10)
    wrap = chance() < 0.3
    if wrap:
        w.out.append(pick(("<div class='wrapper'>", "<div id=page>", "<div>", "<div class='container main'>")))
    article()
    if chance() < 0.25:
        aside()
    if wrap:
        w.out.append("</div>")
    for part, often in ((comments, 0.3), (advert, 0.2), (aside, 0.2), (form, 0.1), (nav, 0.1), (notice, 0.1), (footer, 0.75)):
        if chance() < often:
            part()
    w.out.append("</body></html>" if chance() < 0.85 else "")
    return "".join(w.out)


def training_rows(pages: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes; a node that holds main text, itself or below, is kept."""
    rng, x, y = random.Random(seed), [], []
    for _ in range(pages):
        page = parse(training_page(rng))
        label = np.full(len(page.nodes), -1)
        for node, text in page.runs:
            label[node] = max(label[node], int("§+" in text))
        for i in range(len(label) - 1, 0, -1):
            label[page.nodes[i].parent] = max(label[page.nodes[i].parent], label[i])
        for run, (node, text) in enumerate(page.runs):  # the marks are no part of what is learned from
            own = page.nodes[node]
            own.chars -= 2 * text.count("§")
        told = label >= 0
        x.append(features(page)[told])
        y.append(label[told])
    return np.concatenate(x), np.concatenate(y).astype(np.float64)


@lru_cache(maxsize=2)
def trained(pages: int = TRAIN_PAGES, seed: int = SEED) -> Trees:
    return fit(*training_rows(pages, seed), rounds=100, depth=5, share=0.6)


def extract_texts(pages: list[str], trees: Trees) -> list[str]:
    parsed = [parse(p) for p in pages]
    rows = [features(p) for p in parsed]
    out, lo = [], 0
    while lo < len(parsed):
        hi, size = lo, 0
        while hi < len(parsed) and (size < TOGETHER or hi == lo):
            size += len(rows[hi])
            hi += 1
        logits, at = trees.logits(np.concatenate(rows[lo:hi])), 0
        for page in parsed[lo:hi]:
            own = logits[at : at + len(page.nodes)]
            at += len(page.nodes)
            out.append(kept_text(page, decode(page, own)))
        lo = hi
    return out


def main_texts(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(trees or trained())  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                texts = extract_texts(batch.column(2).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(tidied(run), "page_id long, url string, text string, n_chars long")
