"""A forgiving HTML reader: block nodes with their text runs, in document order, and features of each node."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from zlib import crc32

import numpy as np

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</[^A-Za-z][^>]*>"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_TOKEN = re.compile(r"[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")

BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Elements without content, and elements whose content is no text of the page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = set("head noscript template svg math select button object canvas audio video datalist".split())
#: Text directly in one of these is a node of its own; in other blocks it belongs to the block.
CONTAINERS = set("html body div section article main center td th form fieldset header footer nav aside figure li dd blockquote details #text".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
_FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}}


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: frozenset
    children: list = field(default_factory=list)
    place: int = 0  # among the parent's children
    chars: int = 0
    words: int = 0
    punct: int = 0
    links: int = 0
    runs: list = field(default_factory=list)  # numbers of text runs


@dataclass
class Page:
    nodes: list
    runs: list  # (node, text); a run ends where a block begins or ends


_NO_TOKENS: frozenset = frozenset()


def parse(source: str) -> Page:
    nodes, runs = [Node("html", -1, 0, _NO_TOKENS)], []
    stack, opened = [0], {"html": 1}
    hidden: list[str] = []
    pieces: list[str] = []
    linked = link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        text = html.unescape("".join(pieces)) if pieces else ""
        pieces.clear()
        plain = text.strip()
        if plain:
            at = stack[-1]
            if nodes[at].tag in CONTAINERS:
                nodes.append(Node("#text", at, nodes[at].depth + 1, _NO_TOKENS))
                nodes[-1].place = len(nodes[at].children)
                nodes[at].children.append(len(nodes) - 1)
                at = len(nodes) - 1
            node = nodes[at]
            node.runs.append(len(runs))
            runs.append((at, text))
            node.chars += len(plain)
            node.words += plain.count(" ") + 1
            node.punct += sum(map(plain.count, ".,;:!?"))
            node.links += min(link_chars, len(plain))
        link_chars = 0

    def pop_to(place: int) -> None:
        while len(stack) > place:
            opened[nodes[stack.pop()].tag] -= 1

    def close(tags: set, fence: set) -> None:
        for place in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[place]].tag
            if tag in tags:
                pop_to(place)
                return
            if tag in fence:
                return

    at, n = 0, len(source)
    while at < n:
        m = _TAG.search(source, at)
        if not hidden:
            own = source[at : m.start() if m else n]
            if own:
                pieces.append(own)
                if linked:
                    link_chars += len(own)
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        ending = bool(m[1] or m[4])
        if name in RAW:
            if not ending:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(source, at)
                at = end.end() if end else n
            continue
        if hidden:
            if ending and name == hidden[-1]:
                hidden.pop()
            elif not ending and name == hidden[-1] and name != "head":
                hidden.append(name)
            elif hidden[-1] == "head" and (name in BLOCKS and not ending):
                hidden.clear()  # the head was not closed
            else:
                continue
            if hidden or ending or name not in BLOCKS:
                continue
        if name in HIDDEN:
            if not ending:
                hidden.append(name)
            continue
        if name == "a":
            linked = 0 if ending else 1
        if name in ("br", "hr"):
            pieces.append(" ")
        if name not in BLOCKS:
            continue
        flush()
        if ending:
            if opened.get(name) and name != "html":
                for place in range(len(stack) - 1, 0, -1):
                    if nodes[stack[place]].tag == name:
                        pop_to(place)
                        break
            continue
        if name == "html" or (name == "body" and opened.get("body")):
            continue
        if opened.get("p"):
            close({"p"}, {"td", "th", "table", "blockquote", "div", "section", "article", "main", "aside", "body"})
        if name in _CLOSES:
            close(_CLOSES[name], _FENCE[name])
        tokens = _NO_TOKENS
        if attrs := (m[3] or m[6]):
            tokens = frozenset(t for _, v in _ATTR.findall(attrs) for t in _TOKEN.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", v).lower()))
        parent = stack[-1]
        nodes.append(Node(name, parent, nodes[parent].depth + 1, tokens))
        nodes[-1].place = len(nodes[parent].children)
        nodes[parent].children.append(len(nodes) - 1)
        stack.append(len(nodes) - 1)
        opened[name] = opened.get(name, 0) + 1
        linked = 0
    flush()
    return Page(nodes, runs)


def kept_text(page: Page, keep: np.ndarray) -> str:
    """Runs of the kept nodes, white space folded, joined by one blank."""
    return " ".join(" ".join(" ".join(text.split()) for node, text in page.runs if keep[node]).split())


#: Attribute tokens by what they say.
HINTS = {
    "main": "article content contents main post body entry story text page prose document news blog hentry",
    "navigation": "nav navigation navbar menu menubar breadcrumb breadcrumbs pagination pager toc tabs topbar toolbar links skip",
    "edge": "header footer masthead banner logo branding copyright legal bottom top colophon contentinfo",
    "side": "sidebar side aside widget widgets related recommended popular trending rail complementary tags author bio",
    "advert": "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner dfp outbrain taboola",
    "comment": "comment comments commentlist reply replies respond disqus discussion reader feedback",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup paywall warning",
    "form": "form search login register contact input share sharing social",
}
_HINTS = {k: frozenset(v.split()) for k, v in HINTS.items()}
_KINDS = ("nav", "header", "footer", "aside", "form", "article", "main")
_GROUPS = {"ul": "list", "ol": "list", "li": "list", "dl": "list", "dd": "list", "dt": "list", "menu": "list", "p": "flow", "pre": "flow", "blockquote": "flow", "h1": "head", "h2": "head", "h3": "head", "h4": "head", "h5": "head", "h6": "head", "table": "table", "tr": "table", "td": "table", "th": "table", "tbody": "table", "figure": "figure", "figcaption": "figure", "div": "box", "section": "box", "center": "box", "#text": "bare", "body": "body", "html": "body"}
_GROUP_NAMES = ("list", "flow", "head", "table", "figure", "box", "bare", "body")
#: Numbers that attribute tokens are hashed to; words of a text at most for its first ones to count as hints, and how many count.
HASHED, SHORT, LEADING = 32, 12, 4
N_FEATURES = 2 * len(_KINDS) + len(_GROUP_NAMES) + 4 * len(_HINTS) + HASHED + 10 + 24


@lru_cache(maxsize=100_000)
def _bucket(token: str) -> int:
    return crc32(token.encode()) % HASHED


def _said(text: str) -> list:
    """Which hints the first words of a short text give, such as those of a heading above comments or links."""
    words = text.split(None, SHORT)
    if not 0 < len(words) <= SHORT:
        return _SILENT
    tokens = {w for w in _WORD.findall(" ".join(words[:LEADING]).lower()) if len(w) > 3}
    return [int(not h.isdisjoint(tokens)) for h in _HINTS.values()]


_SILENT = [0] * len(_HINTS)


def features(page: Page) -> np.ndarray:
    """A row for each node: tag, attributes (own, above, below), depth, subtree density, siblings, place in the page, hints that
    the first text gives where it is short."""
    nodes, n = page.nodes, len(page.nodes)
    hints = list(_HINTS.values())
    chars, words, punct, links = ([getattr(x, a) for x in nodes] for a in ("chars", "words", "punct", "links"))
    tags, flows, items, heads, texts = [1] * n, [0] * n, [0] * n, [0] * n, [0] * n
    below = [[0] * (len(_HINTS) + 2) for _ in range(n)]
    last = list(range(n))  # node of a subtree, the last in order
    first_run = [x.runs[0] if x.runs else len(page.runs) for x in nodes]
    own_hints = [[int(not h.isdisjoint(x.tokens)) for h in hints] if x.tokens else None for x in nodes]
    for i in range(n - 1, -1, -1):
        x = nodes[i]
        flows[i] += x.tag == "p"
        items[i] += x.tag == "li"
        heads[i] += _GROUPS.get(x.tag) == "head"
        texts[i] += bool(x.runs)
        if x.parent >= 0:
            p = x.parent
            last[p] = max(last[p], last[i])
            first_run[p] = min(first_run[p], first_run[i])
            for total in (chars, words, punct, links, tags, flows, items, heads, texts):
                total[p] += total[i]
            b, o = below[p], below[i]
            mine = own_hints[i]
            for k in range(len(hints)):
                if o[k] or (mine and mine[k]):
                    b[k] = 1
            b[-2] |= o[-2] or x.tag == "article"
            b[-1] |= o[-1] or x.tag == "main"
    said = [_said(page.runs[r][1]) if r < len(page.runs) else _SILENT for r in first_run]
    alike = Counter((x.parent, x.tag, x.tokens) for x in nodes)
    h1 = next((i for i, x in enumerate(nodes) if x.tag == "h1"), -1)
    whole = max(1, chars[0])
    before, seen = [0] * n, 0
    out = np.zeros((n, N_FEATURES), dtype=np.float32)
    above: list = [None] * n
    for i, x in enumerate(nodes):
        before[i] = seen
        seen += x.chars
        p = x.parent
        up = above[p] if p >= 0 else ([0] * len(_KINDS), [0] * len(hints))
        kinds = up[0].copy()
        mine = own_hints[i] or [0] * len(hints)
        around = up[1]
        if x.tag in _KINDS:
            kinds[_KINDS.index(x.tag)] = 1
        above[i] = (kinds, [max(a, b) for a, b in zip(around, mine)] if own_hints[i] else around)
        group = _GROUPS.get(x.tag, "box")
        row = [int(x.tag == k) for k in _KINDS] + kinds + [int(group == g) for g in _GROUP_NAMES] + mine + around + below[i][: len(hints)]
        kids = nodes[p].children if p >= 0 else [0]
        place = x.place
        prev = kids[place - 1] if 0 < place < len(kids) else -1
        after = kids[place + 1] if place + 1 < len(kids) else -1
        hashed = [0] * HASHED
        for token in x.tokens:
            hashed[_bucket(token)] = 1
        row += hashed + said[i]
        row += [
            int(p >= 0 and any(said[p][1:])), int(prev >= 0 and _GROUPS.get(nodes[prev].tag) == "head" and any(said[prev][1:])),
            int(x.tag == "h1"), 0 if h1 < 0 else (i > h1) - (i < h1), links[prev] / max(1, chars[prev]) if prev >= 0 else 0,
            links[after] / max(1, chars[after]) if after >= 0 else 0, int(after >= 0 and _GROUPS.get(nodes[after].tag) == "list"), alike[p, x.tag, x.tokens],
            chars[p] / whole if p >= 0 else 1, int(p >= 0 and p < h1 <= last[p]),
        ]
        row += [
            x.depth, place, len(kids), place / len(kids), math.log1p(chars[i]), math.log1p(words[i]), links[i] / max(1, chars[i]),
            math.log1p(chars[i] / tags[i]), punct[i] / max(1, words[i]), words[i] / max(1, texts[i]), math.log1p(tags[i]), flows[i], items[i],
            heads[i], chars[i] / whole, before[i] / whole, (before[i] + chars[i]) / whole, below[i][-2], below[i][-1],
            chars[prev] / whole if prev >= 0 else -1, chars[after] / whole if after >= 0 else -1,
            chars[i] / max(1, chars[p]) if p >= 0 else 1, flows[p] if p >= 0 else 0, links[p] / max(1, chars[p]) if p >= 0 else 0,
        ]
        out[i] = row
    return out
