"""Main text of web pages by a tree-structured graphical model.

A page is a tree of block elements; each has a label, main text or not. The potential of an element depends on its tag, the
words of its class, id and role, and on how much text and how many links are below it; the potential of an edge on the
labels of parent and child and the child's tag. Sum-product messages, upward and then downward, give each element's
marginal; the text that stands directly in elements of at least THRESHOLD is kept, block by block.

Weights maximise the likelihood of labelled pages (its gradient is exact, from node and edge marginals). Labelled are pages
that mark their main text themselves, by exactly one article (or, without one, one main) element; what is marked as
navigation, aside, header with no heading, footer or form within it is not main text. Of these at most about MAX_TRAIN are
learnt from, chosen by hash, in one task. Each is also laid out anew in other page forms, with the same blocks in
containers of other tags and names, among menus, headers, footers, sidebars, notices, adverts, forms and comments;
FILLERS pages of invented words are laid out so too, so that a table without any labelled page has a model. Layouts follow
from the page's hash, so the model depends on the table alone.

Text: character references are decoded once; white space within a block is one space; br is white space; scripts, styles,
comments, head, templates, frames, drawings, text areas and lists of options have no text. A tag that never ends takes the rest of the page, as
in browsers. Defined results: null and empty pages have an empty text. Repeated rows are extracted each; rows without an id
or address are rows like any other; other columns, whatever their names, pass through. Pages are read whole.
"""

from __future__ import annotations

import html as markup
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import hidden

MAX_TRAIN = 300
FILLERS = 200
LAYOUTS = 2  # of each labelled page
ROUNDS = 120
PENALTY = 0.05
THRESHOLD = 0.5
BITS = 14
KINDS = 64
BATCH_CHARS = 4 << 20
SEED = 42

# Fixed values of HTML: elements within a line, elements without an end, elements whose text is no text of the page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
SILENT = frozenset("head noscript template svg math canvas object audio video select datalist".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section "
    "summary table ul dd dt tr td th".split()
)
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
WITHIN = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "tbody": ("table",), "tfoot": ("table",)}

# Linear in the page: attribute values in quotes may hold any character, and a quote that stays open takes what is left.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'\s])))*+)(?:>|\Z|=.*+)|<[!?/][^>]*+(?:>|\Z)", re.S
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
MARK = re.compile(r"\bdata-y=([01])")

_HASHED: dict[str, int] = {}


def _hashed(name: str) -> int:
    if name not in _HASHED:
        if len(_HASHED) > 200_000:
            _HASHED.clear()
        _HASHED[name] = zlib.crc32(name.encode()) & ((1 << BITS) - 1)
    return _HASHED[name]


class Page:
    """Block elements in page order with their parents, and the blocks of text with the element they stand in."""

    def __init__(self, source: str, marks: str = "") -> None:
        """marks: how labels are found: "markup", by article or main; "given", by data-y attributes; none otherwise."""
        self.tag, self.up, self.depth, self.names, self.label = ["#page"], [-1], [0], [""], [0]
        self.blocks: list[tuple[int, str, int]] = []
        self.open, self.silent, self.marks = [0], 0, marks
        self.piece: list[str] = []
        self.linked, self.link = 0, False
        self._read(source)
        self._flush()

    def _flush(self) -> None:
        text = " ".join("".join(self.piece).split()) if self.piece else ""
        if text:
            self.blocks.append((self.open[-1], text, min(self.linked, len(text))))
        self.piece, self.linked = [], 0

    def _text(self, raw: str) -> None:
        if raw and not self.silent:
            text = markup.unescape(raw) if "&" in raw else raw
            self.piece.append(text)
            if self.link:
                self.linked += len(text.strip())

    def _close(self, at: int) -> None:
        """Ends the open elements from place at on."""
        self._flush()
        for i in self.open[at:]:
            self.silent -= self.tag[i] in SILENT
        del self.open[at:]
        self.link = False

    def _close_last(self, tags: tuple[str, ...], stop: tuple[str, ...] = ()) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[at]]
            if tag in tags:
                return self._close(at)
            if tag in stop:
                return None
        return None

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ENDS:
            last = None
            for at in range(len(self.open) - 1, 0, -1):  # the outermost one that this tag ends, up to its list or table
                name = self.tag[self.open[at]]
                if name in ENDS[tag]:
                    last = at
                elif name in WITHIN[tag]:
                    break
            if last is not None:
                self._close(last)
        if tag in CLOSES_P and self.tag[self.open[-1]] == "p":
            self._close(len(self.open) - 1)
        if tag == "body":
            self._close_last(("head",))
        self._flush()
        if tag in VOID:
            return
        up = self.open[-1]
        label = self.label[up]
        if self.marks == "given" and (m := MARK.search(attributes)):
            label = int(m[1])
        elif self.marks == "markup":
            label = 1 if tag in ("article", "main") else 0 if tag in ("nav", "aside", "footer", "form") else label
        self.tag.append(tag)
        self.up.append(up)
        self.depth.append(self.depth[up] + 1)
        self.names.append(" ".join(x.strip("\"'") for x in NAMES.findall(attributes)) if attributes else "")
        self.label.append(label)
        self.open.append(len(self.tag) - 1)
        self.silent += tag in SILENT
        self.link = False

    def _read(self, source: str) -> None:
        at = 0
        while at < len(source) and (m := TOKEN.search(source, at)):
            self._text(source[at : m.start()])
            at, tag = m.end(), (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if tag == "a":
                    self.link = False
                elif tag not in INLINE and tag not in VOID:
                    if tag == "p":  # without an open one it stands for an empty p
                        self._flush()
                    self._close_last((tag,))
            elif tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
            elif tag == "br":
                self._text(" ")
            elif tag == "a":
                self.link = True
            elif tag not in INLINE and (tag not in VOID or tag == "hr"):
                self._start(tag, m[3])
        self._text(source[at:])


def _bucket(n: int) -> int:
    return min(n, 1 << 20).bit_length()


def features(page: Page) -> list[list[int]]:
    """Hashed indicator features of each element."""
    n = len(page.tag)
    own, below, linked, last, before, kids = [0] * n, [0] * n, [0] * n, [""] * n, [0] * n, [0] * n
    first = [-1] * n
    seen = 0
    for i, text, in_links in page.blocks:
        own[i] += len(text)
        linked[i] += in_links
        last[i] = text[-1]
        first[i] = seen if first[i] < 0 else first[i]
        seen += len(text)
    for i in range(n - 1, 0, -1):
        below[i] += own[i]
        up = page.up[i]
        below[up] += below[i]
        linked[up] += linked[i]
        kids[up] += 1
        if first[i] >= 0:
            first[up] = first[i] if first[up] < 0 else min(first[up], first[i])
    below[0] += own[0]
    for i in range(1, n):
        before[i] = first[i] if first[i] >= 0 else before[page.up[i]]
    out = []
    for i in range(n):
        tag, up = page.tag[i], page.tag[max(0, page.up[i])]
        names = ["bias", f"t:{tag}", f"u:{up}>{tag}", f"l:{_bucket(own[i])}", f"b:{_bucket(below[i])}", f"k:{4 * linked[i] // max(1, below[i])}", f"s:{4 * below[i] // max(1, seen)}", f"c:{min(kids[i], 8)}", f"q:{4 * before[i] // max(1, seen)}", f"e:{last[i] in '.!?…:;'}:{own[i] > 0}"]
        if page.names[i]:
            words = {w.lower() for w in WORD.findall(page.names[i])}
            names += [x for w in sorted(words) for x in (f"n:{w}", f"n4:{w[:4]}", f"n:{w}@{tag}")]
        out.append([_hashed(x) for x in names])
    return out


class Forest:
    """Pages side by side as one set of arrays; messages go level by level."""

    def __init__(self, pages: list[Page]) -> None:
        starts = np.cumsum([0, *(len(p.tag) for p in pages)])
        self.starts, self.n = starts, int(starts[-1])
        of = [f for p in pages for f in features(p)]
        self.row = np.repeat(np.arange(self.n), [len(f) for f in of])
        self.feature = np.array([x for f in of for x in f], np.int64)
        self.up = np.concatenate([np.array(p.up) + s * (np.array(p.up) >= 0) for p, s in zip(pages, starts, strict=False)])
        self.kind = np.array([_hashed(f"edge:{t}") % KINDS for p in pages for t in p.tag], np.int64)
        depth = np.array([d for p in pages for d in p.depth])
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])
        self.label = np.array([y for p in pages for y in p.label], np.int64)

    def marginals(self, node: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The probability of each label of each element, and of each pair of labels (parent, child) of each edge."""
        own = np.zeros((self.n, 2))
        own[:, 1] = np.bincount(self.row, weights=node[self.feature], minlength=self.n)
        pair = edge[self.kind]  # (element, label of parent, label of element)
        sent = np.zeros((self.n, 2))
        for level in self.levels[:0:-1]:
            sent[level] = np.logaddexp.reduce(pair[level] + own[level, None, :], axis=2)
            np.add.at(own, self.up[level], sent[level])
        whole, pairs = own.copy(), np.zeros((self.n, 2, 2))
        for level in self.levels[1:]:
            without = whole[self.up[level]] - sent[level]
            joint = without[:, :, None] + pair[level] + own[level, None, :]
            whole[level] = np.logaddexp.reduce(joint, axis=1)
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            pairs[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
        p = np.exp(whole - whole.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), pairs


def fit(pages: list[Page], rounds: int = ROUNDS, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Node and edge weights by gradient ascent with moments (Adam); every step sees all pages."""
    forest = Forest(pages)
    inner = np.flatnonzero(forest.up >= 0)
    truth = np.zeros((forest.n, 2, 2))
    truth[inner, forest.label[forest.up[inner]], forest.label[inner]] = 1
    weights = np.zeros((1 << BITS) + 4 * KINDS)
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        node, edge = weights[: 1 << BITS], weights[1 << BITS :].reshape(KINDS, 2, 2)
        p, pairs = forest.marginals(node, edge)
        g_node = np.bincount(forest.feature, weights=(forest.label - p[:, 1])[forest.row], minlength=1 << BITS)
        g_edge = np.zeros((KINDS, 2, 2))
        np.add.at(g_edge, forest.kind[inner], truth[inner] - pairs[inner])
        g = np.concatenate([g_node, g_edge.ravel()]) - penalty * weights
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        weights = weights + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
    return weights[: 1 << BITS], weights[1 << BITS :].reshape(KINDS, 2, 2)


# How pages commonly mark what is and what is not their main text.
MAIN = (
    "article", "main", "div class=content", "div id=content", "div class=post", "div class='entry-content'", "div class='article-body'", "div class=story", "section class=text",
    "div class='main-content'", "div", "section", "div role=main", "td",
)
NOISE = {
    "menu": ("nav", "nav class=menu", "div class=menu", "div id=nav", "div class=navbar", "div class=breadcrumbs", "ul class='nav-links'", "div class=pagination", "div role=navigation", "div class=toolbar"),
    "header": ("header", "header class='site-header'", "div id=header", "div class=masthead", "div class='top-bar'", "div role=banner", "div class='page-header'"),
    "footer": ("footer", "footer class='site-footer'", "div id=footer", "div class=copyright", "div class='footer-links'", "div role=contentinfo", "div class=legal"),
    "sidebar": ("aside", "aside class=sidebar", "div class=sidebar", "div id=sidebar", "div class=widget", "div class=related", "div class='related-posts'", "div class=trending", "section class=recommended", "div class='most-popular'", "div role=complementary"),
    "notice": ("div class='cookie-notice'", "div class=cookies", "div id='cookie-banner'", "div class=notice", "div class=alert", "div role=alert", "div class=consent", "div class=gdpr", "div role=dialog", "div class=popup", "section class='notification'", "div class=modal", "div class=paywall"),
    "advert": ("div class=ad", "div class=ads", "div class=advert", "div class=advertisement", "aside class=ad", "div class=sponsored", "div class=promo", "div id='ad-slot'", "div class=banner", "section class=promotion", "div class='ad-container'"),
    "form": ("form", "form class=search", "form class=newsletter", "div class=subscribe", "form id=login", "form class='contact-form'", "div class='signup'", "form action='/s'"),
    "comments": ("section class=comments", "div id=comments", "div class=comments", "ol class='comment-list'", "div class=discussion", "section id=responses", "div class=replies", "div class='user-comments'", "section class='reader-comments'"),
    "share": ("div class=share", "div class='social-links'", "ul class=social", "div class='share-buttons'", "div class=tags"),
}


def _tag(opening: str, inside: str, label: int | None = None) -> str:
    mark = "" if label is None else f" data-y={label}"
    return f"<{opening}{mark}>{inside}</{opening.split()[0]}>"


def _noise(kind: str, say, r: random.Random) -> str:  # noqa: ANN001
    links = [f"<a href='/{i}'>{say(1, 3)}</a>" for i in range(r.randint(2, 7))]
    opening = r.choice(NOISE[kind])
    listed = "".join(f"<li>{x}</li>" for x in links)
    if kind == "menu":
        inside = listed if opening.startswith("ul") else r.choice((f"<ul>{listed}</ul>", " ".join(links), f"<ul>{listed}</ul>"))
    elif kind == "header":
        inside = r.choice((f"<a href='/'>{say(1, 3)}</a>", f"<h1>{say(1, 4)}</h1>", f"<p>{say(2, 8)}</p>")) + r.choice(("", f"<p>{say(3, 9)}</p>", f"<nav><ul>{listed}</ul></nav>"))
    elif kind == "footer":
        inside = r.choice((f"&copy; {say(3, 12)}", f"<p>&copy; {say(2, 9)}</p>", f"<p>{say(4, 20)}</p><ul>{listed}</ul>", " | ".join(links)))
    elif kind == "sidebar":
        inside = r.choice(("", f"<h3>{say(1, 4)}</h3>", f"<h2>{say(1, 4)}</h2>")) + r.choice((f"<ul>{listed}</ul>", f"<p>{say(8, 40)}</p>", "".join(f"<div>{x}</div>" for x in links)))
    elif kind == "comments":
        each = r.choice(("div class=comment", "article class=comment", "li", "div class='comment-body'"))
        each = "li" if opening.startswith("ol") else each
        said = [_tag(each, r.choice(("", f"<b>{say(1, 2)}</b> ", f"<h4>{say(1, 2)}</h4>", f"<div class=author>{say(1, 2)}</div>")) + f"<p>{say(3, 60)}</p>") for _ in range(r.randint(1, 5))]
        inside = ("" if opening.startswith("ol") else r.choice(("", f"<h2>{say(1, 3)}</h2>", f"<h3>{say(1, 3)}</h3>"))) + "".join(said)
    elif kind == "form":
        inside = r.choice(("", f"<p>{say(3, 15)}</p>", f"<h3>{say(2, 5)}</h3>")) + f"<label>{say(1, 2)}</label><input name=q><button>{say(1, 2)}</button>"
    elif kind == "share":
        inside = listed if opening.startswith("ul") else " ".join(links)
    else:
        inside = r.choice((say(4, 25), f"<p>{say(5, 35)}</p>", f"<h3>{say(2, 5)}</h3><p>{say(5, 30)}</p>")) + r.choice(("", f"<button>{say(1, 2)}</button>", f" <a href='/x'>{say(1, 2)}</a>"))
    return _tag(opening, inside, 0)


def layout(blocks: list[str], spare: list[str], r: random.Random) -> str:
    """A labelled page: blocks as main text in a container, among page parts made of words of spare."""

    def say(low: int, high: int) -> str:
        n, at = r.randint(low, high), r.randrange(max(1, len(spare)))
        return markup.escape(" ".join((spare[at:] + spare)[:n]))

    def block(text: str) -> str:
        text = markup.escape(text)
        tag = r.choice(("p",) * 9 + ("h2", "h3", "blockquote", "pre", "li", "ul", "div", "figcaption", "tr"))
        if r.random() < 0.2 and len(words := text.split(" ")) > 3:
            text = " ".join([words[0], f"<{(t := r.choice(('b', 'em', 'a', 'span')))}>{words[1]}</{t}>", *words[2:]])
        if tag == "ul":
            return f"<ul><li>{text}</li></ul>"
        return f"<ol><li>{text}</li></ol>" if tag == "li" else f"<table><tr><td>{text}</td></tr></table>" if tag == "tr" else f"<figure><figcaption>{text}</figcaption></figure>" if tag == "figcaption" else f"<{tag}>{text}</{tag}>"

    title, *rest = blocks or [""]
    head = f"<h1>{markup.escape(title)}</h1>"
    body = [r.choice((head, head, head, f"<header>{head}</header>", f"<h2>{markup.escape(title)}</h2>", ""))] + [block(b) for b in rest]
    for kind in r.sample(("advert", "sidebar", "share", "notice", "form", "menu"), r.choice((0, 0, 1, 2))):
        body.insert(r.randint(1, len(body)), _noise(kind, say, r))
    if r.random() < 0.25:
        body.append(_noise("comments", say, r))
    if r.random() < 0.15:
        body.append(_tag("footer", say(2, 12), 0))
    if r.random() < 0.2:  # parts within the main text
        body = [_tag(r.choice(("section", "div")), "".join(body[i : i + 4])) for i in range(0, len(body), 4)]
    container = r.choice(MAIN)
    text = _tag(container, "".join(body), 1)
    text = f"<table><tr>{text}</tr></table>" if container == "td" else text
    if r.random() < 0.3:
        text = _tag(r.choice(("main", "div class=container", "div id=page", "div class=wrapper", "div")), text)
    above = [_noise(k, say, r) for k in ("header", "menu", "notice", "advert", "form") if r.random() < 0.45]
    under = [_noise(k, say, r) for k in ("comments", "sidebar", "share", "advert", "form", "notice", "menu", "footer") if r.random() < 0.4]
    return f"<html><head><title>{say(1, 5)}</title></head><body>{''.join(above)}{text}{''.join(under)}</body></html>"


def _invented(r: random.Random, n: int) -> list[str]:
    return ["".join(r.choice("aeioulnrst") for _ in range(r.randint(1, 9))) + ("." if r.random() < 0.1 else "") for _ in range(n)]


def learn(sample: list[str], fillers: int = FILLERS, layouts: int = LAYOUTS) -> tuple[np.ndarray, np.ndarray]:
    """Weights from pages that mark their main text, their rearrangements and invented ones."""
    pages = []
    for source in sample:
        page = Page(source, "markup")
        pages.append(page)
        kept = [t for i, t, _ in page.blocks if page.label[i]]
        spare = " ".join(t for i, t, _ in page.blocks if not page.label[i]).split() + " ".join(kept).split()[:400]
        for k in range(layouts):
            r = random.Random(zlib.crc32(source.encode("utf-8", "replace")) + k + SEED)
            some = [" ".join(t.split()[: r.choice((3, 10, 40, 100))]) for t in kept[: r.randint(2, 14)]]
            pages.append(Page(layout(some, spare, r), "given"))
    for k in range(fillers):
        r = random.Random(SEED * 1_000_003 + k)
        texts = [" ".join(_invented(r, r.choice((1, 3, 8, 20, 60)))) for _ in range(r.randint(2, 12))]
        pages.append(Page(layout(texts, _invented(r, 200), r), "given"))
    return fit(pages)


def main_text(pages: list[Page], node: np.ndarray, edge: np.ndarray, threshold: float = THRESHOLD) -> list[str]:
    if not pages:
        return []
    forest = Forest(pages)
    kept = forest.marginals(node, edge)[0][:, 1] >= threshold
    return ["\n".join(t for i, t, _ in p.blocks if kept[s + i]) for p, s in zip(pages, forest.starts, strict=False)]


def labelled_sample(pages: DataFrame, html: str, max_train: int) -> DataFrame:
    """(html) of about max_train pages with marked main text, by hash; rows are counted from the files' footers first, so few texts are sorted."""
    n = max(1, pages.count())
    plain = [c for c, kind in pages.dtypes if c != html and not re.search("map|array|struct|variant", kind)]  # what can be hashed
    place = F.xxhash64(*plain, F.substring(html, 1, 500))
    share = min(1.0, 3 * max_train / n)
    near = pages.select(place.alias("_at"), F.col(html).alias("html")).filter(F.col("_at") <= min(2**63 - 1, int(-(2**63) + share * 2**64)))
    count = lambda tag: F.size(F.regexp_extract_all("html", F.lit(rf"(?i)<{tag}[\s>]"), F.lit(0)))
    marked = near.filter((count("article") == 1) | ((count("article") == 0) & (count("main") == 1)))
    return marked.orderBy("_at", "html").limit(max_train).select("html")


def model(pages: DataFrame, html: str = "html", max_train: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray]:
    """Trained in one task, from a bounded sample; only the weights (0.1 MB) come back."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [x for b in batches for x in b.column(0).to_pylist() if x]
        node, edge = learn(sample)
        yield pa.RecordBatch.from_arrays([pa.array([node.tobytes()]), pa.array([edge.tobytes()])], ["node", "edge"])

    row = labelled_sample(pages, html, max_train).coalesce(1).mapInArrow(train, "node binary, edge binary").first()
    if row is None:  # no task ran, as there was no row at all
        return learn([])
    return np.frombuffer(row["node"]), np.frombuffer(row["edge"]).reshape(KINDS, 2, 2)


def extract(pages: DataFrame, html: str = "html", max_train: int = MAX_TRAIN, text: str = "text") -> DataFrame:
    """pages with their main text (a column of that name is replaced) in place of the markup."""
    node, edge = model(pages, html, max_train)
    others = [c for c in pages.columns if c not in (html, text)]
    (new,) = hidden(pages.select(*others), "_main_text")
    source = pages.select(*others, F.col(html).alias(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts: list[str] = []
            group, size = [], 0
            for s in range(0, b.num_rows, 64):
                for x in b.column(len(others)).slice(s, 64).to_pylist():
                    group.append(Page(x or ""))
                    size += len(x or "")
                    if size >= BATCH_CHARS:
                        texts += main_text(group, node, edge)
                        group, size = [], 0
            texts += main_text(group, node, edge)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], b.schema.names)

    return source.mapInArrow(run, source.schema).withColumnRenamed(new, text)


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html)."""
    found = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
