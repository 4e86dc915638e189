"""Main text of web pages by a linear-chain conditional random field over the
leaf blocks of the page.

A page is read into leaf blocks: runs of text between block-level tags, with
character references decoded and white space turned into single spaces. Each
block has features of its ancestors (tags and the words of class, id and role)
and of its text (length, share of links, punctuation, signs of notices and
credits). The field has the states main and other; it is trained on labelled
pages made by a seeded generator of page layouts, and decoded by Viterbi.

Defined results: null, empty and markup-free pages of no text give an empty
text; text outside any element is a block like others; scripts, styles and the
head are never text, form controls, drawings and templates not where they are
closed; where they are not, what follows is text as in browsers. Unclosed and
stray tags are closed as browsers do in the common cases; a tag that never ends
cuts off the rest, as there. Elements more than DEPTH deep are siblings.
Repeated pages give equal results.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import text_batches

#: A tag; quotes count where a value begins.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)>")
#: The same up to the next sign that can end it.
SHORT = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
COMMENT_END = re.compile(r"--!?>")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
NAMES = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")

# Elements by how HTML treats them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr"
    " math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes noembed".split())
#: Elements whose content is no text of the page where they are closed.
CONTROLS = frozenset("button select object svg template annotation annotation-xml".split())
#: Raw elements end at their own end tag, whatever stands inside.
RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I) for tag in RAW}
#: Elements open at once; browsers stop there too.
DEPTH = 512
#: Words of class, id and role that an element has as features.
WORDS = 32
#: A start tag ends open elements of these kinds up to the nearest of the stops.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: All others end an open paragraph, up to these.
PARAGRAPH = (frozenset(["p"]), frozenset("button object template select svg table td th caption".split()))
SIGNS = ("cookie", "privacy", "copyright", "©", "all rights reserved", "subscribe", "newsletter", "advert", "sponsored", "comment", "reply", "log in", "login", "sign up", "share", "related", "read more", "menu", "search", "follow us", "terms")


class Chain:
    """The features of an element that none around it has; ``outer``: of the element around it."""

    __slots__ = ("outer", "own")

    def __init__(self, outer: Chain | None, own: tuple[str, ...]):
        self.outer, self.own = outer, own

    def __iter__(self) -> Iterator[str]:
        at, found = self, []
        while at is not None:
            found.append(at.own)
            at = at.outer
        return (x for own in reversed(found) for x in own)


@dataclass
class Block:
    text: str
    chain: Chain  # features of the ancestors
    tag: str
    linked: int  # characters inside links


def _words(attributes: str) -> list[str]:
    """Features of an element's class, id, role and visibility."""
    out = []
    for name, value in NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("hidden", "aria-hidden"):
            out.append("hidden" if value.lower() != "false" else "shown")
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                out.append("hidden")
        else:
            out += [f".{p.lower()}" for p in islice((p for p in PARTS.findall(value) if len(p) > 1), WORDS)]
    return out[:WORDS]


@dataclass
class _Open:
    """An open element. saved: of a control, the text before it, its place among
    the blocks and what flush() needs for it."""

    tag: str
    added: tuple[str, ...]
    chain: Chain
    block: str  # the nearest element that is not inline
    saved: tuple | None = None


class _Reader:
    """Reads a page in one pass; every step is bounded by DEPTH, not by the page."""

    def __init__(self):
        self.out: list[Block] = []
        self.stack: list[_Open] = [_Open("", (), Chain(None, ()), "")]
        self.open: Counter[str] = Counter()
        self.active: Counter[str] = Counter()
        self.held: list[str] = []
        self.linked = self.links = 0
        self.head = False

    def take(self, piece: str) -> None:
        self.held.append(piece)
        self.linked += len(piece) if self.links else 0

    def made(self, held: list[str], linked: int, top: _Open) -> Block | None:
        text = " ".join(unescape("".join(held)).split())
        return Block(text, top.chain, top.block, linked) if text and not self.head else None

    def flush(self) -> None:
        if self.held:
            if block := self.made(self.held, self.linked, self.stack[-1]):
                self.out.append(block)
            self.held = []
        self.linked = 0

    def push(self, tag: str, attributes: str) -> None:
        if len(self.stack) > DEPTH:
            self.leave(len(self.stack) - 1)
        outer = self.stack[-1]
        inline = tag in INLINE or tag in CONTROLS
        features = [*(() if inline else (f"<{tag}",)), *(_words(attributes) if attributes.strip() else ())]
        own = tuple(x for x in dict.fromkeys(features) if not self.active[x])
        self.active.update(own)
        self.open[tag] += 1
        self.links += tag == "a"
        self.head = self.head or tag == "head"
        new = _Open(tag, own, Chain(outer.chain, own) if own else outer.chain, outer.block if inline else tag)
        if tag in CONTROLS:
            new.saved = (self.held, self.linked, outer, len(self.out))
            self.held, self.linked = [], 0
        self.stack.append(new)

    def leave(self, at: int, drop: bool = False) -> None:
        """Close the elements from ``at`` on. A control that was not closed itself
        keeps its text; with ``drop`` the one at ``at`` loses it."""
        while len(self.stack) > at:
            one = self.stack[-1]
            if one.saved and not drop:
                self.flush()
                held, linked, outer, place = one.saved
                if held and (block := self.made(held, linked, outer)):
                    self.out.insert(place, block)
            elif one.saved and len(self.stack) == at + 1:
                held, self.linked, _, place = one.saved
                self.held = [*held, " "]
                del self.out[place:]
            self.stack.pop()
            self.open[one.tag] -= 1
            self.links -= one.tag == "a"
            self.head = self.head and one.tag != "head"
            self.active.subtract(one.added)

    def nearest(self, tags: frozenset[str], stops: frozenset[str] = frozenset()) -> int:
        """The place of the innermost open element of ``tags`` inside the innermost of ``stops``, or 0."""
        if any(self.open[t] for t in tags):
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in tags:
                    return i
                if self.stack[i].tag in stops:
                    break
        return 0

    def end(self, tag: str) -> None:
        at = self.nearest(frozenset([tag]))
        if tag in CONTROLS:
            if at:
                self.leave(at, drop=True)
            return
        if tag not in INLINE:
            self.flush()
        if not at:
            return
        if tag in INLINE and any(x.tag not in INLINE for x in self.stack[at:]):
            # It ends for what follows, and stays where it is in the order.
            self.open[tag] -= 1
            self.links -= tag == "a"
            self.stack[at].tag = "\0"
            self.open["\0"] += 1
        else:
            self.leave(at)

    def begin(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.held.append(" ")
            return
        if tag not in INLINE and tag not in CONTROLS:
            self.flush()
            self.head = self.head and tag != "body"
            kinds, stops = ENDS.get(tag, PARAGRAPH)
            if at := self.nearest(kinds, stops):
                self.leave(at)
        foreign = attributes.endswith("/") and (tag in ("svg", "math") or self.open["svg"] or self.open["math"])
        if tag not in VOID and not foreign:
            self.push(tag, attributes)

    def read(self, html: str) -> list[Block]:
        size, at, begin, quoted = len(html), 0, 0, True
        while (mark := html.find("<", at)) >= 0:
            sign = html[mark + 1 : mark + 2]
            m = None
            if sign in LETTERS or sign == "/" and html[mark + 2 : mark + 3] in LETTERS:
                m = TAG.match(html, mark) if quoted else None
                if m is None:
                    # No end outside quotes is left: tags end at the next sign, or cut off the rest.
                    quoted = False
                    m = SHORT.match(html, mark)
                stop = m.end() if m else size
            elif sign and sign in "!?" or sign == "/" and mark + 2 < size:
                if html.startswith("<!--", mark):
                    found = COMMENT_END.search(html, mark + 2)
                    stop = found.end() if found else size
                else:
                    stop = html.find(">", mark) + 1 or size
            else:
                at = mark + 1
                continue
            if mark > begin:
                self.take(html[begin:mark])
            at = begin = stop
            if m is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self.end(tag)
            elif tag in RAW:
                found = RAW_ENDS[tag].search(html, stop)
                at = begin = found.end() if found else size
            else:
                self.begin(tag, m[3])
        if begin < size:
            self.take(html[begin:])
        self.flush()
        self.leave(1)
        return self.out


def blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page in order."""
    return _Reader().read(html) if html else []


def text_features(block: Block, at: int, count: int) -> list[str]:
    """Features of a block's text and place."""
    text = block.text
    n = len(text)
    words = text.count(" ") + 1
    share = block.linked / max(1, n)
    stops = sum(map(text.count, ".!?"))
    out = [f"tag={block.tag}", f"words={min(8, int(math.log2(words)))}", f"links={min(4, int(share * 4.01))}", f"stops={min(3, stops)}", f"place={int(4 * at / count)}"]
    out.append(f"tag={block.tag}|links={int(share > 0.6)}|words={min(4, int(math.log2(words)) // 2)}")
    if text[-1] in ".!?…\"”»:":
        out.append("ended")
    if text[0].isupper():
        out.append("capital")
    if "|" in text or "·" in text or "»" in text[:2]:
        out.append("divider")
    if sum(c.isdigit() for c in text[:80]) * 4 > min(n, 80):
        out.append("digits")
    if n < 300:
        lower = text.lower()
        out += [f"sign={s}" for s in SIGNS if s in lower]
    return out


@dataclass
class Field:
    """weights: of features for the state main (other has none); moves: of
    (state, next state); start: of beginning in main."""

    weights: dict[str, float] = field(default_factory=dict)
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0

    def emissions(self, page: list[Block]) -> list[float]:
        known: dict[Chain | None, float] = {None: 0.0}
        out = []
        get = self.weights.get
        for i, b in enumerate(page):
            todo, at = [], b.chain
            while at not in known:
                todo.append(at)
                at = at.outer
            for at in reversed(todo):
                known[at] = known[at.outer] + sum(get(x, 0.0) for x in at.own)
            out.append(known[b.chain] + sum(get(x, 0.0) for x in text_features(b, i, len(page))))
        return out

    def decode(self, page: list[Block]) -> list[bool]:
        """The likeliest states, by Viterbi; True is main."""
        if not page:
            return []
        (oo, om), (mo, mm) = self.moves.tolist()
        scores = self.emissions(page)
        other, main, back = 0.0, scores[0] + self.start, []
        for e in scores[1:]:
            back.append((mo + main > oo + other, mm + main >= om + other))
            other, main = max(oo + other, mo + main), max(om + other, mm + main) + e
        state = main >= other
        states = [state]
        for from_other, from_main in reversed(back):
            state = from_main if state else from_other
            states.append(state)
        return states[::-1]

    def extract(self, html: str | None) -> str:
        page = blocks(html)
        return "\n".join(b.text for b, main in zip(page, self.decode(page), strict=True) if main)


def _sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def fit(pages: list[tuple[list[Block], list[bool]]], epochs: int = 8, rate: float = 0.3, decay: float = 1e-4, seed: int = 11) -> Field:
    """The field of largest likelihood, by adaptive gradient steps page by page;
    marginals come from the forward and backward sums."""
    made = Field()
    squares: dict = {}

    def step(table, key, gradient: float) -> None:
        slot = (id(table), key)
        squares[slot] = squares.get(slot, 1e-6) + gradient * gradient
        old = table.get(key, 0.0) if isinstance(table, dict) else table[key]
        table[key] = old + rate * (gradient - decay * old) / math.sqrt(squares[slot])

    start = {"s": 0.0}
    order, rng = list(range(len(pages))), random.Random(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        for k in order:
            page, truth = pages[k]
            if not page:
                continue
            made.start = start["s"]
            features = [(*b.chain, *text_features(b, i, len(page))) for i, b in enumerate(page)]
            e = [sum(made.weights.get(x, 0.0) for x in fs) for fs in features]
            t = made.moves.tolist()
            n = len(page)
            fwd, bwd = [(0.0, e[0] + made.start)], [(0.0, 0.0)]
            for i in range(1, n):
                a, b = fwd[-1]
                fwd.append((_sum(a + t[0][0], b + t[1][0]), _sum(a + t[0][1], b + t[1][1]) + e[i]))
            for i in range(n - 1, 0, -1):
                a, b = bwd[-1]
                bwd.append((_sum(t[0][0] + a, t[0][1] + e[i] + b), _sum(t[1][0] + a, t[1][1] + e[i] + b)))
            bwd.reverse()
            z = _sum(*fwd[-1])
            errors = [truth[i] - math.exp(fwd[i][1] + bwd[i][1] - z) for i in range(n)]
            step(start, "s", errors[0])
            moves = np.zeros((2, 2))
            for i in range(1, n):
                moves[int(truth[i - 1]), int(truth[i])] += 1
                for x in (0, 1):
                    for y in (0, 1):
                        moves[x, y] -= math.exp(fwd[i - 1][x] + t[x][y] + (e[i] if y else 0.0) + bwd[i][y] - z)
            for x in (0, 1):
                for y in (0, 1):
                    step(made.moves, (x, y), float(moves[x, y]))
            for fs, error in zip(features, errors, strict=True):
                if abs(error) > 1e-4:
                    for x in fs:
                        step(made.weights, x, error)
    made.start = start["s"]
    return made


class Layouts:
    """Labelled pages: a generator of page layouts whose main blocks are known."""

    MAIN = ("content", "post-body", "entry-content", "article-body", "story", "main-content", "text", "post", "article__body", "entry", "page-content", "article-text")
    SIDE = ("sidebar", "widget", "side-column", "rail", "aside", "widget-area", "secondary")
    ADS = ("ad", "ads", "advert", "advertisement", "banner-ad", "sponsored", "promo", "ad-slot", "sponsor", "promotion")
    NAV = ("nav", "menu", "navbar", "breadcrumb", "breadcrumbs", "main-menu", "navigation", "topbar", "pagination", "skip-link")
    NOTES = ("cookie-notice", "cookie-banner", "notice", "consent", "gdpr", "alert", "paywall", "message-bar", "privacy-notice", "popup", "modal")
    COMMENTS = ("comments", "comment-list", "comment", "disqus", "responses", "reader-comments", "discussion", "replies")
    RELATED = ("related", "related-posts", "more-stories", "recommended", "read-next", "see-also", "share", "social", "share-buttons", "tags", "author-bio", "newsletter", "subscribe")
    FOOT = ("footer", "site-footer", "copyright", "legal", "credits", "footer-links", "colophon")
    HEAD = ("header", "site-header", "masthead", "branding", "logo", "top", "site-title")
    BARE = ("row", "col", "inner", "wrap", "container", "box", "block", "section", "clearfix", "grid")

    def __init__(self, seed: int = 5):
        self.rng = random.Random(seed)

    def pick(self, xs):
        return self.rng.choice(xs)

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def word(self) -> str:
        return "".join(self.pick("bcdfghklmnprstvw") + self.pick(("a", "e", "i", "o", "u", "é", "ö", "ie", "an", "er")) for _ in range(self.rng.randint(1, 4)))

    def sentence(self, low: int = 3, high: int = 18) -> str:
        words = [self.word() for _ in range(self.rng.randint(low, high))]
        style = self.rng.random()
        if style < 0.08:
            return " ".join(w.upper() + "!!" for w in words)
        if style < 0.16:
            return " ".join(w + self.pick(("%%%", "&amp;&amp;&amp;", "$$$", "###")) for w in words)
        if style < 0.22:
            return " | ".join(words)
        return " ".join(words).capitalize() + self.pick((".", ".", ".", "!", "?", ","))

    def prose(self, low: int = 1, high: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.rng.randint(low, high)))

    def links(self, low: int = 2, high: int = 7) -> str:
        items = [f'<a href="/{self.word()}">{" ".join(self.word() for _ in range(self.rng.randint(1, 4)))}</a>' for _ in range(self.rng.randint(low, high))]
        return f"<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>" if self.chance(0.7) else self.pick((" | ", " ", " &middot; ")).join(items)

    def label(self, names) -> str:
        own = self.pick(names)
        more = f" {self.pick(self.BARE)}" if self.chance(0.3) else ""
        return f' {self.pick(("class", "class", "id"))}="{own}{more}"'

    def page(self) -> tuple[list[Block], list[bool]]:
        """A page's blocks with their states. Main text is marked in the source
        by a sign that is taken out again."""
        main = lambda x: f"\x01{x}" if x[:1] != "<" else x
        parts: list[str] = []
        if self.chance(0.8):
            parts.append(f"<head><meta charset=utf-8><title>{self.sentence()}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>")
        before: list[str] = []
        if self.chance(0.5):
            tag = self.pick(("header", "div"))
            before.append(f"<{tag}{self.label(self.HEAD) if tag == 'div' or self.chance(0.5) else ''}><a href='/'>{self.word()}</a> {self.sentence(2, 6) if self.chance(0.5) else ''}{self.links() if self.chance(0.4) else ''}</{tag}>")
        if self.chance(0.8):
            tag = self.pick(("nav", "nav", "div", "ul"))
            before.append(f"<nav>{self.links()}</nav>" if tag == "nav" else f"<div{self.label(self.NAV)}>{self.links()}</div>")
        extra = lambda: self.pick((self.ad, self.note, self.form, self.related))()
        before += [extra() for _ in range(self.rng.randint(0, 2))]
        if self.chance(0.4):
            before.append(self.ad())
        inside: list[str] = []
        title = self.sentence(2, 9)
        if self.chance(0.85):
            h = self.pick(("h1", "h1", "h2"))
            heading = f"<{h}>{main(title)}</{h}>"
            inside.append(f"<header>{heading}</header>" if self.chance(0.15) else heading)
        for _ in range(self.rng.randint(1, 12)):
            kind = self.rng.random()
            text = self.prose() if kind > 0.15 else self.sentence(1, 5)
            if self.chance(0.2):
                cut = text.split(" ")
                cut[len(cut) // 2] = f'<a href="/{self.word()}">{cut[len(cut) // 2]}</a>'
                text = " ".join(cut)
            if self.chance(0.08):
                inside.append(self.pick((self.ad, self.ad, extra))())
            if kind < 0.75 or kind > 0.97:
                inside.append(f"<p>{main(text)}</p>" if self.chance(0.85) else self.pick((f"<p><b>\x01{text}<br>", f"<p>{main(text)}", f"<p>\x01<em>{text}</em></p>", f"<div>{main(text)}</div>")))
            elif kind < 0.80:
                inside.append(f"<h2>{main(self.sentence(1, 6))}</h2>")
            elif kind < 0.83:
                inside.append("<ul>" + "".join(f"<li>{main(self.sentence())}</li>" for _ in range(self.rng.randint(2, 5))) + "</ul>")
            elif kind < 0.87:
                inside.append(f"<blockquote>{main(text)}</blockquote>")
            elif kind < 0.90:
                inside.append("<table>" + "".join(f"<tr><td>{main(self.word())}</td><td>{main(self.sentence(1, 5))}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.92:
                inside.append(f"<pre>{main(self.sentence())}</pre>")
            elif kind < 0.94:
                inside.append(f"<figure><img src=x><figcaption>{main(self.sentence())}</figcaption></figure>")
            else:
                inside.append(extra())
        if self.chance(0.25):
            inside.append(self.comments() if self.chance(0.5) else self.related())
        body = "".join(inside)
        tag = self.pick(("article", "article", "main", "div", "div", "section", ""))
        if tag:
            named = tag in ("div", "section") and self.chance(0.85) or self.chance(0.3)
            body = f"<{tag}{self.label(self.MAIN) if named else ''}>{body}</{tag}>"
        if self.chance(0.3):
            body = f"<div{self.label(self.BARE)}>{body}</div>"
        if self.chance(0.2):
            body = f"<main>{body}</main>"
        after = [self.pick((self.side, self.side, self.related, self.comments, self.ad, self.form))() for _ in range(self.rng.randint(0, 3))]
        if self.chance(0.85):
            credit = f"&copy; {self.word()}.example &middot; {self.sentence()}" if self.chance(0.7) else self.prose(1, 2)
            tag = self.pick(("footer", "footer", "div"))
            after.append(f"<{tag}{self.label(self.FOOT) if tag == 'div' or self.chance(0.3) else ''}>{credit if self.chance(0.6) else f'<p>{credit}</p>'}{self.links() if self.chance(0.3) else ''}</{tag}>")
        if self.chance(0.1):
            before, after = before + [self.side()], after
        source = f"<!DOCTYPE html><html>{''.join(parts)}<body>{''.join(before)}{body}{''.join(after)}{self.pick(('</body></html>', ''))}"
        page = blocks(source)
        truth = ["\x01" in b.text for b in page]
        for b in page:
            b.text = b.text.replace("\x01", "").strip() or "-"
        return page, truth

    def ad(self) -> str:
        tag = self.pick(("div", "div", "div", "aside", "section"))
        text = self.sentence(2, 6) if self.chance(0.4) else self.prose(1, 2)
        return f"<!-- ad --><{tag}{self.label(self.ADS)}>{text if self.chance(0.7) else f'<p>{text}</p>'}</{tag}>"

    def note(self) -> str:
        text = self.pick(("We use cookies. ", "", "", "Subscribe to read more. ")) + self.prose(1, 2)
        return f"<{'div'}{self.label(self.NOTES)}>{text if self.chance(0.5) else f'<p>{text}</p>'}{'<button>OK</button>' if self.chance(0.4) else ''}</div>"

    def form(self) -> str:
        return f"<form action=/x><label>{self.sentence(1, 4)}</label><input name=q><p>{self.sentence()}</p><button>{self.word()}</button></form>"

    def side(self) -> str:
        tag = self.pick(("aside", "aside", "div"))
        return f"<{tag}{self.label(self.SIDE) if tag == 'div' or self.chance(0.6) else ''}><h3>{self.sentence(1, 3)}</h3>{self.links() if self.chance(0.6) else f'<p>{self.prose(1, 3)}</p>'}</{tag}>"

    def related(self) -> str:
        tag = self.pick(("div", "section", "aside"))
        return f"<{tag}{self.label(self.RELATED)}><h3>{self.sentence(1, 3)}</h3>{self.links() if self.chance(0.7) else f'<p>{self.prose(1, 2)}</p>'}</{tag}>"

    def comments(self) -> str:
        tag, own = self.pick(("div", "section")), self.pick(("div", "li", "p", "article"))
        each = "".join(f"<{own}{self.label(self.COMMENTS) if self.chance(0.6) else ''}><b>{self.word()}</b> {self.prose(1, 3)}</{own}>" for _ in range(self.rng.randint(1, 4)))
        return f"<{tag}{self.label(self.COMMENTS)}><h3>{self.sentence(1, 3)}</h3>{each}</{tag}>"


@lru_cache(4)
def trained(pages: int = 700, seed: int = 5) -> Field:
    """The field trained on ``pages`` labelled pages."""
    layouts = Layouts(seed)
    return fit([layouts.page() for _ in range(pages)])


def main_text(pages: DataFrame, model: Field | None = None, html: str = "html", key: str = "page_id", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """``key``, ``keep``, and the main text of each whole page."""
    field = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sources in text_batches(batches, html):
            made = [field.extract(x) for x in sources]
            yield pa.RecordBatch.from_arrays([*(part.column(x) for x in (key, *keep)), pa.array(made, pa.string())], [key, *keep, "text"])

    kept = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in pages.select(key, *keep).schema)
    return pages.select(key, *keep, html).mapInArrow(run, f"{kept}, text string")
