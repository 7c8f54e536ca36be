"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is a sequence of leaf blocks, the runs of text between block-level tags.
Each block has features from the tags above it and from its text; the field
scores labels of single blocks and of neighbours, is trained by the gradient of
its likelihood on labelled pages, and is decoded by Viterbi.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\Z))"
#: A quote opens only at the start of a value; a quote without an end is an ordinary letter.
TOKEN = re.compile(COMMENT + r"""|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*+"[^"]*"|=\s*+'[^']*'|[^>])*+)>|<[!?][^>]*>""", re.S)
#: The same without quotes, for the rest of a page where they hide every end of a tag.
UNQUOTED = re.compile(COMMENT + r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose inside is text and not tags; an open one runs to the end of the page.
RAW = frozenset("script style title textarea iframe noscript".split())
#: Other elements that show no text of the page; an open one ends with the element around it.
HIDDEN = frozenset("template svg object select canvas button".split())
#: What may stand in ``head``; any other tag ends it, and so does text.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Formulas are read as part of the line they stand in; cells of a formula are set apart.
MATH = frozenset("math maction annotation annotation-xml menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms msqrt mstyle msub msubsup msup mtable mtext munder munderover none semantics".split())
INLINE |= MATH
#: Blocks that are no part of a hidden element left open: they end it.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre section summary table tbody td th tr ul".split())


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


class Tokens:
    """Tags and comments of a page in order, in time linear in the page."""

    def __init__(self, page: str):
        self.page, self.last, self.pattern = page, page.rfind(">"), TOKEN

    def find(self, at: int) -> re.Match | None:
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if at > self.last:
                at = page.find("<!--", at)
                return self.pattern.match(page, at) if at >= 0 else None
            m = self.pattern.match(page, at)
            if m is None and self.pattern is TOKEN and page[at + 1 : at + 3].lstrip("/")[:1].isalpha():
                # the quotes from here on hold all that is left of the page
                self.pattern = UNQUOTED
                m = self.pattern.match(page, at)
            if m:
                return m
            at += 1
        return None


def raw_end(page: str, tag: str, at: int) -> int:
    """Where the raw text of an element ends that begins at ``at``."""
    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
    return close.end() if close else len(page)


def left_open(page: str) -> set[int]:
    """Where hidden elements begin that have no closing tag of their own."""
    open_at: dict[str, list[int]] = {}
    at, tokens = 0, Tokens(page)
    while m := tokens.find(at):
        at = m.end()
        tag = (m[2] or "").lower()
        if m[1]:
            if open_at.get(tag):
                open_at[tag].pop()
        elif m[2] and not m[3].rstrip().endswith("/"):
            if tag in RAW:
                at = raw_end(page, tag, at)
            elif tag in HIDDEN:
                open_at.setdefault(tag, []).append(m.start())
    return {n for places in open_at.values() for n in places}


def leaf_blocks(page: str) -> list[Block]:
    """Blocks in page order: different tags above with their names, the nearest last, text with single spaces, letters inside links.

    ``head`` may be left open; the first tag or text that cannot stand in it
    ends it. A hidden element ends with its closing tag or with the element
    around it, and one without a closing tag also where the next block begins.
    """
    out: list[Block] = []
    # open elements: tag, different labels of the blocks from the top to here, open links and paragraphs
    stack: list[tuple[str, tuple[str, ...], int, int]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0
    place: tuple[str, ...] = ()
    links = 0
    head = False
    # hidden elements on the stack: their place, and whether a block ends them
    veils: list[tuple[int, bool]] = []
    loose: set[int] | None = None

    def push(tag: str, label: str) -> None:
        _, path, above, paragraphs = stack[-1] if stack else ("", (), 0, 0)
        if tag not in INLINE and path[-1:] != (label,):
            path = (*(x for x in path if x != label), label)
        stack.append((tag, path, above + (tag == "a"), paragraphs + (tag == "p")))
        opened[tag] += 1

    def cut(n: int) -> None:
        for tag, *_ in stack[n:]:
            opened[tag] -= 1
        del stack[n:]
        while veils and veils[-1][0] >= n:
            veils.pop()

    def path_now() -> tuple[str, ...]:
        return stack[-1][1] if stack else ()

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(place, text, min(linked, len(text))))
            parts, linked = [], 0

    at, size, tokens = 0, len(page), Tokens(page)
    while at < size:
        m = tokens.find(at)
        stop = m.start() if m else size
        if head and page[at:stop].strip():
            head = False
        if stop > at and not veils:
            if not parts:
                place = path_now()
            parts.append(page[at:stop])
            if links:
                linked += stop - at
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "head":
            flush()
            head = not m[1]
            continue
        if head and tag not in HEAD and tag != "html" and (not m[1] or tag in ("body", "br")):
            head = False
        if tag in RAW or (head and tag == "noframes"):
            flush()
            if not m[1] and not m[3].rstrip().endswith("/"):
                at = raw_end(page, tag, at)
            continue
        if tag in ("mtr", "mtd", "mspace"):
            if parts:
                parts.append(" ")
            continue
        if tag == "br":
            if not veils:
                parts.append(" ")
            continue
        if tag == "button":
            if not veils:
                parts.append(" ")
        elif tag not in INLINE:
            flush()
        if tag in BLOCKS and not m[1]:
            for n, ends in veils:
                # a block leaves a drawing, but for the parts of it that hold blocks
                if ends or (stack[n][0] == "svg" and not any(t in ("foreignobject", "desc") for t, *_ in stack[n:])):
                    cut(n)
                    break
        if m[1]:
            for n in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[n][0] == tag:
                    veiled = len(veils)
                    cut(n)
                    if len(veils) < veiled and tag != "button":
                        flush()
                    break
        elif tag in HIDDEN:
            if not m[3].rstrip().endswith("/"):
                loose = left_open(page) if loose is None else loose
                veils.append((len(stack), m.start() in loose))
                push(tag, tag)
        elif tag not in VOID and not m[3].endswith("/"):
            if tag not in INLINE:
                # a paragraph or list item left open ends where the next block begins
                while stack and (stack[-1][0] in INLINE or stack[-1][0] == "p" or (stack[-1][0] == tag and tag in ("li", "td", "th", "tr", "dt", "dd", "option"))):
                    if stack[-1][0] in INLINE and not stack[-1][3]:
                        break
                    cut(len(stack) - 1)
            named = [re.sub(r"\d+", "0", w) for x in NAMES.finditer(m[3]) for w in re.findall(r"[a-z]+|\d+", (x[1] or x[2] or x[3] or "").lower())]
            push(tag, " ".join([tag, *named]))
        links = stack[-1][2] if stack else 0
    flush()
    return out


def path_features(path: tuple[str, ...]) -> list[str]:
    out = set()
    for label in path:
        tag, *named = label.split(" ")
        out.add(f"in:{tag}")
        out.update(f"name:{w}" for w in named if len(w) > 1)
    if path:
        out.add(f"leaf:{path[-1].split(' ')[0]}")
    return sorted(out)


def text_features(block: Block) -> list[str]:
    text = block.text
    out = [f"size:{min(10, len(text).bit_length())}", f"links:{4 * block.linked // max(1, len(text))}", f"words:{min(6, (text.count(' ') + 1).bit_length())}"]
    if text[-1] in ".!?:;\"'”»…":
        out.append("ends")
    if "©" in text or "copyright" in text.lower():
        out.append("rights")
    if "|" in text or "»" in text or "›" in text:
        out.append("bars")
    return out


class Field:
    """Weights of features, of neighbouring labels and of the first label; 1 is main text."""

    def __init__(self):
        self.weight: dict[str, float] = {}
        self.next = [[0.0, 0.0], [0.0, 0.0]]
        self.first = [0.0, 0.0]
        self.paths: dict[tuple[str, ...], float] = {}

    def scores(self, blocks: list[Block]) -> list[float]:
        """How much each block by itself speaks for main text."""
        out = []
        for b in blocks:
            path = self.paths.get(b.path)
            if path is None:
                path = sum(self.weight.get(f, 0.0) for f in path_features(b.path))
                if len(self.paths) < 100_000:
                    self.paths[b.path] = path
            out.append(path + sum(self.weight.get(f, 0.0) for f in text_features(b)))
        return out

    def decode(self, blocks: list[Block]) -> list[int]:
        """Most likely labels, by Viterbi."""
        if not blocks:
            return []
        scores = self.scores(blocks)
        no, yes = self.first[0], self.first[1] + scores[0]
        back = []
        for s in scores[1:]:
            from_no = (self.next[0][0] + no, self.next[0][1] + no)
            from_yes = (self.next[1][0] + yes, self.next[1][1] + yes)
            back.append((from_yes[0] > from_no[0], from_yes[1] > from_no[1]))
            no, yes = max(from_no[0], from_yes[0]), max(from_no[1], from_yes[1]) + s
        labels = [int(yes > no)]
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]

    def train(self, pages: list[tuple[list[Block], list[int]]], rounds: int = 6, rate: float = 0.3, decay: float = 1e-4, seed: int = 3) -> None:
        """Stochastic gradient on the log likelihood, with step sizes by past gradients."""
        past: dict[object, float] = {}
        order = random.Random(seed)
        ready = [([path_features(b.path) + text_features(b) for b in blocks], blocks, labels) for blocks, labels in pages if blocks]

        def step(key, value: float, gradient: float) -> float:
            past[key] = past.get(key, 1e-3) + gradient * gradient
            return value + rate * (gradient - decay * value) / math.sqrt(past[key])

        for _ in range(rounds):
            order.shuffle(ready)
            for features, _, labels in ready:
                score = np.array([sum(self.weight.get(f, 0.0) for f in row) for row in features])
                emit = np.stack((np.zeros(len(score)), score), 1)
                trans = np.array(self.next)
                ahead = np.zeros((len(score), 2))
                after = np.zeros((len(score), 2))
                ahead[0] = np.array(self.first) + emit[0]
                for t in range(1, len(score)):
                    ahead[t] = np.logaddexp.reduce(ahead[t - 1][:, None] + trans, 0) + emit[t]
                for t in range(len(score) - 2, -1, -1):
                    after[t] = np.logaddexp.reduce(trans + emit[t + 1] + after[t + 1], 1)
                whole = np.logaddexp.reduce(ahead[-1])
                likely = np.exp(ahead + after - whole)
                for row, label, p in zip(features, labels, likely[:, 1]):
                    for f in row:
                        self.weight[f] = step(f, self.weight.get(f, 0.0), label - p)
                both = np.exp(ahead[:-1, :, None] + trans + (emit + after)[1:, None, :] - whole).sum(0)
                for a, b in zip(labels, labels[1:]):
                    both[a, b] -= 1
                for a in (0, 1):
                    self.first[a] = step(("first", a), self.first[a], (labels[0] == a) - likely[0, a])
                    for b in (0, 1):
                        self.next[a][b] = step(("next", a, b), self.next[a][b], -both[a, b])
        self.weight = {f: float(w) for f, w in self.weight.items()}
        self.next = [[float(x) for x in row] for row in self.next]
        self.first = [float(x) for x in self.first]
        self.paths = {}


#: What labelled pages name their parts; a page draws one for each part, or none.
MAIN = ["article", "main", "div class=content", "div id=main-content", "div class=post-body", "section class=entry", "div class=story", "div role=main", "div"]
ASIDE = {
    "menu": ["nav", "div class=menu", "ul id=navigation", "div class=breadcrumb", "div role=navigation"],
    "header": ["header", "div class=header", "div id=masthead", "div class=topbar"],
    "notice": ["div class=cookie-notice", "div class=banner", "div class=notice", "div id=consent", "div role=alert"],
    "advert": ["div class=ad", "div class=ads", "aside class=advert", "div class=sponsored", "div class=promo", "ins class=adsbygoogle"],
    "sidebar": ["aside", "div class=sidebar", "div class=related", "div id=widgets", "section class=recommended"],
    "form": ["form", "form class=newsletter", "div class=subscribe", "form id=search"],
    "comments": ["div class=comments", "section id=comments", "div class=comment-list", "ol class=replies", "div id=disqus"],
    "footer": ["footer", "div class=footer", "div id=copyright", "div class=bottom"],
}


def labelled_page(rng: random.Random) -> tuple[str, list[str]]:
    """A page made of drawn parts, and the blocks that are its main text."""
    letters = "aeiounrstldmégäñ"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))
    words = lambda n: " ".join(word() for _ in range(n))

    def sentence() -> str:
        return words(rng.randint(3, 18)).capitalize() + rng.choice(".....!?")

    def text(most: int) -> str:
        return " ".join(sentence() for _ in range(rng.randint(1, most)))

    def wrap(tag: str, inner: str) -> str:
        name, _, attribute = tag.partition(" ")
        if attribute:
            key, _, value = attribute.partition("=")
            attribute = f' {key}="{value}"'
        return f"<{name}{attribute}>{inner}</{name}>"

    def aside(kind: str) -> str:
        if kind in ("menu", "sidebar"):
            items = "".join(wrap("li", f'<a href="/{word()}">{words(rng.randint(1, 4))}</a>') for _ in range(rng.randint(2, 8)))
            inner = wrap("ul", items) if rng.random() < 0.8 else wrap("p", text(2)) + items
        elif kind == "form":
            inner = wrap("label", words(2)) + "<input>" + wrap("button", word()) + (wrap("p", sentence()) if rng.random() < 0.5 else "")
        elif kind == "comments":
            inner = "".join(wrap("div class=comment", wrap("p", text(3))) for _ in range(rng.randint(1, 5)))
        elif kind == "footer":
            inner = rng.choice(["&copy; ", "Copyright ", ""]) + words(3) + rng.choice(["", " &middot; ", " | "]) + text(2)
        elif kind == "header":
            inner = wrap("span", words(2)) + (wrap("p", words(4)) if rng.random() < 0.5 else "")
        else:
            inner = text(2) if rng.random() < 0.6 else wrap("p", text(2))
        return wrap(rng.choice(ASIDE[kind]), inner)

    body = [wrap(rng.choice(["h1", "h2"]), words(rng.randint(1, 9)))] if rng.random() < 0.9 else []
    for _ in range(rng.randint(0, 12)):
        kind = rng.random()
        if kind < 0.75:
            style = rng.random()
            inner = text(6) if style < 0.6 else words(rng.randint(1, 60)) if style < 0.8 else f"<b>{text(3)}</b> <a href='#'>{word()}</a>"
            body.append(wrap("p", inner) if rng.random() < 0.9 else wrap("div", inner))
        elif kind < 0.85:
            body.append(wrap("ul", "".join(wrap("li", words(rng.randint(2, 14))) for _ in range(rng.randint(1, 4)))))
        elif kind < 0.92:
            body.append(wrap(rng.choice(["h2", "h3"]), words(rng.randint(1, 6))))
        elif kind < 0.96:
            body.append(wrap("blockquote", text(2)))
        else:
            body.append(wrap("pre", words(rng.randint(2, 30))))
    main = "".join(body)
    article = [b.text for b in leaf_blocks(main)]
    inside = [aside("advert")] if rng.random() < 0.15 else []
    before = [aside(k) for k in ("notice", "header", "menu", "advert") if rng.random() < 0.5]
    after = [aside(k) for k in ("advert", "sidebar", "form", "comments", "footer") if rng.random() < 0.5]
    rng.shuffle(before)
    page = "".join([*before, wrap(rng.choice(MAIN), main + "".join(inside)), *after])
    return f"<!DOCTYPE html><html><head><title>{word()}</title></head><body>{page}</body></html>", article


def trained_field(pages: int = 400, seed: int = 5) -> Field:
    """A field trained on ``pages`` labelled pages drawn by ``seed``; a fixed bound, whatever the corpus."""
    rng = random.Random(seed)
    ready = []
    for _ in range(pages):
        page, article = labelled_page(rng)
        blocks = leaf_blocks(page)
        # the main text is one run of blocks, found in order
        labels, at = [], 0
        for b in blocks:
            hit = at < len(article) and b.text == article[at]
            labels.append(int(hit))
            at += hit
        ready.append((blocks, labels))
    field = Field()
    field.train(ready)
    return field


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page) if page else []
    return "\n".join(b.text for b, label in zip(blocks, field.decode(blocks)) if label)


def extractor(field: Field | None = None) -> Callable[[Column], Column]:
    """Column function: html to main text.

    Character references are decoded, white space inside a block becomes one
    space, and the blocks of the article are joined by line feeds in page order.
    A null or empty page, or one without main text, gives an empty text.
    """
    field = field or trained_field()
    return F.arrow_udf(lambda pages: pa.array([main_text(p, field) for p in pages.to_pylist()], pa.string()), "string").asNondeterministic()
