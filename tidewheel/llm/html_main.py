"""Main-text extraction: a linear-chain conditional random field over a page's leaf blocks.

A page is cut into leaf blocks (runs of text between block-level tags). Each has features of its
ancestors (tags, and hints in their class and id), of its text (length, links, punctuation) and of
its surroundings. The field's two labels (main text or not) are decoded by Viterbi, and the main
blocks are joined. Scripts, styles, comments and other markup never become blocks.

The field is trained on labelled pages: those given, or else pages that labelled_pages() composes by
rule (articles in several layouts amid menus, adverts, notices, forms, reader comments). Their
number is a parameter, so training doesn't depend on the corpus. Extraction is one pass, row by
row, without a shuffle.
"""

from __future__ import annotations

import functools
import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.shared import broadcast

#: Composed pages that a field is trained on.
TRAINING_PAGES = 500
#: Blocks whose features are held at a time.
BATCH = 4096

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
_STOP = re.compile(r"""[>"']""")
_HINT = re.compile(r"""\b(?:class|id|role|aria-label)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))""", re.I)
#: Character references of too many digits, and zeros that lead others.
_VAST = re.compile(r"&#(?:0*+[0-9]{8,}+|[xX]0*+[0-9a-fA-F]{7,}+);?")
_ZEROS = re.compile(r"&#([xX]?)0++(?=[0-9a-fA-F])")
_PART = re.compile(r"[a-z]+")
#: Elements whose content is text up to their end tag, whatever it looks like.
_RAW = frozenset("script style title iframe textarea".split())
#: Elements whose text isn't shown; those of them and of _APART end with their end tag, whatever is open in them.
_SILENT = frozenset("svg template noscript noframes noembed annotation annotation-xml".split())
_APART = _SILENT | {"math", "object"}
#: Start tags that end an svg or math element, unless they stand in one of its elements for text.
_BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var article aside main section nav header footer figure".split())
_FOREIGN, _FOREIGN_TEXT = ("svg", "math"), ("foreignobject", "desc", "title", "annotation-xml", "mtext", "mi", "mo", "mn", "ms")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td textarea tfoot th thead tr ul".split())
#: Block-level tags that end an open p; those of a kind also end an open one of the kind.
_SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table body article section div nav aside main header footer form blockquote svg template noscript object".split())

_TAGS = "article main section div nav header footer aside form ul ol li table td th p h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption a button label select textarea dialog details summary dl dt dd address fieldset menu".split()
_HINTS = {
    "comment": "comment comments commentlist reply replies respond disqus discussion feedback", "ad": "ad ads advert adverts advertisement banner sponsor sponsored promo promotion adsbygoogle doubleclick",
    "side": "sidebar side rail aside widget widgets complementary", "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pagination pager topbar",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription paywall toast", "foot": "footer foot copyright legal colophon contentinfo",
    "head": "masthead header head top logo", "social": "share sharing social follow tweet", "related": "related recommended recommendations more trending popular also", "form": "form search login signup contact",
    "text": "article content post entry story body text main page prose",
}
_HINT_OF = {w: k for k, ws in _HINTS.items() for w in ws.split()}
_TEXT_FEATURES = ["bias", "empty-links", "links", "mostly-links", "short", "medium", "long", "very-long", "stop", "comma", "mark", "copyright", "digits", "upper", "first", "last"]
_NAMES = [*(f"in-{t}" for t in _TAGS), *(f"own-{t}" for t in _TAGS), *(f"hint-{h}" for h in _HINTS), *(f"near-{h}" for h in _HINTS), *_TEXT_FEATURES, "article-depth", "in-article-header"]
_INDEX = {n: k for k, n in enumerate(_NAMES)}
WIDTH = len(_NAMES)


class Element:
    """An open element, linked with the one around it. What blocks inherit from all elements around them is made
    once per element, and shared with the element above where nothing is added."""

    __slots__ = ("tag", "hints", "above", "block", "main", "common", "articles", "silent")

    def __init__(self, tag: str, hints: frozenset[str], label: bool | None, above: "Element | None", silent: bool = False):
        self.tag, self.hints, self.above = tag, hints, above
        self.silent = silent or above is not None and above.silent
        if tag in ("body", "html"):  # a hint of these speaks of the page, not of the block
            self.hints = hints = frozenset()
        self.block = tag if tag in _BLOCK else above.block if above else "body"
        self.main = label if label is not None else above.main if above else False
        self.articles = (above.articles if above else 0) + (tag == "article")
        own = {_INDEX[f"in-{tag}"]} if f"in-{tag}" in _INDEX else set()
        own |= {_INDEX[f"hint-{h}"] for h in hints}
        if self.articles > 1:
            own.add(_INDEX["article-depth"])
        if self.articles and tag == "header":
            own.add(_INDEX["in-article-header"])
        inherited = above.common if above else frozenset()
        self.common = inherited if own <= inherited else inherited | own


@dataclass(slots=True)
class Block:
    """A leaf block: its text with white space as single spaces, the characters of it within links, and the
    innermost open element around it (None: none)."""

    text: str
    linked: int
    inside: Element | None

    @property
    def main(self) -> bool:
        """The label that the nearest labelled element around it carries."""
        return self.inside is not None and self.inside.main


def unescaped(raw: str) -> str:
    """Text with its character references decoded, those of numbers beyond any character as U+FFFD."""
    if "&" not in raw:
        return raw
    return html.unescape(_VAST.sub("\ufffd", _ZEROS.sub(r"&#\1", raw)) if "&#" in raw else raw)


class Tags:
    """The tags of a page in order. Every character is passed a bounded number of times: where a tag has no end, or
    a quote none, is remembered."""

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.quote = {q: page.rfind(q) for q in "\"'"}
        self.unclosed: set[int] = set()  # quotes after which no tag ends

    def end(self, at: int) -> int:
        """Where the tag ends (its `>`) whose name ends at `at`: a `>` in quotes doesn't count, unless else none
        would be left. -1 if there is none."""
        if at > self.last:
            return -1
        tried, start = [], at
        while (m := _STOP.search(self.page, at)) and m.start() not in self.unclosed:
            k = m.start()
            if m[0] == ">":
                return k
            tried.append(k)
            if k >= self.quote[m[0]]:
                break
            at = self.page.index(m[0], k + 1) + 1
        self.unclosed.update(tried)
        return self.page.find(">", start)

    def __iter__(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """(start, stop, whether it ends an element, tag, attributes); comments and declarations have an empty tag.
        send() moves on to a place."""
        page, at = self.page, 0
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            if m := _NAME.match(page, start):
                if (stop := self.end(m.end())) < 0:
                    continue
                found = start, stop + 1, bool(m[1]), m[2].lower(), page[m.end() : stop]
            elif page.startswith("<!--", start):
                stop = page.find("-->", start + 2)
                found = start, stop + 3 if stop >= 0 else len(page), False, "", ""
            elif page.startswith(("<!", "<?"), start) and start < self.last:
                found = start, page.index(">", start) + 1, False, "", ""
            else:
                continue
            moved = yield found
            at = found[1] if moved is None else moved
            if moved is not None:
                yield found  # the answer to send()


class _Open:
    """The stack of open elements, with the places of each tag in it."""

    def __init__(self) -> None:
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []

    def push(self, tag: str, hints: frozenset[str], label: bool | None, silent: bool = False) -> None:
        k = len(self.stack)
        self.stack.append(Element(tag, hints, label, self.stack[-1] if k else None, silent))
        self.places.setdefault(tag, []).append(k)
        if tag in _BLOCK:
            self.blocks.append(k)
        if tag in _SCOPE:
            self.scopes.append(k)

    def close(self, k: int) -> None:
        """Everything from place k on."""
        while len(self.stack) > k:
            self.places[self.stack.pop().tag].pop()
        for places in (self.blocks, self.scopes):
            while places and places[-1] >= k:
                places.pop()

    def end(self, tag: str) -> None:
        """An end tag: up to the innermost such element, which inline ones look for in their block only."""
        places = self.places.get(tag)
        if places and (tag in _BLOCK or tag in _APART or not self.blocks or places[-1] > self.blocks[-1]):
            self.close(places[-1])

    def implied(self, tag: str) -> None:
        """A block begins: ends an open p (with what was left open in it) and elements that the tag implies to be over."""
        least = self.scopes[-1] if self.scopes else -1
        for t in ("p", *_SELF_CLOSING.get(tag, ())):
            places = self.places.get(t)
            if places and places[-1] > least:
                self.close(places[bisect_right(places, least)])

    def is_open(self, tag: str) -> bool:
        return bool(self.places.get(tag))

    @property
    def silent(self) -> bool:
        return bool(self.stack) and self.stack[-1].silent

    def break_out(self, tag: str) -> None:
        """A start tag of HTML within svg or math, but not in one of their elements for text, ends these."""
        within = [p[0] for t in _FOREIGN if (p := self.places.get(t))]
        if within and tag in _BREAKS_OUT and not any(p and p[-1] > min(within) for p in map(self.places.get, _FOREIGN_TEXT)):
            self.close(min(within))

    def foreign(self) -> bool:
        return any(map(self.is_open, _FOREIGN))


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order, empty ones left out. Time and memory grow with the page's length only.

    Elements whose text isn't shown (svg, template, noscript and the like) leave it out up to their own end tag, or up to the
    end of a block around them. One without any end tag after it hides nothing. What math and object hold is text."""
    out: list[Block] = []
    open_ = _Open()
    parts: list[str] = []
    linked, at = 0, 0
    last_ends: dict[str, int] = {}

    def ends_later(tag: str) -> bool:
        """Whether an end tag follows; looked up once for each tag."""
        if tag not in last_ends:
            last_ends[tag] = max((m.start() for m in re.finditer(rf"</{tag}\s*+>", page, re.I)), default=-1)
        return last_ends[tag] >= at

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, open_.stack[-1] if open_.stack else None))
            parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not open_.is_open("head") and not open_.silent:
            text = unescaped(raw)
            parts.append(text)
            if open_.is_open("a"):
                linked += len(text.strip())

    tags = iter(Tags(page))
    for start, stop, ending, tag, attributes in tags:
        say(page[at:start])
        at = stop
        if not tag:
            continue
        if ending:
            if tag in _BLOCK:
                flush()
            open_.end(tag)
            continue
        open_.break_out(tag)
        if tag == "br":
            parts.append(" ")
            continue
        if open_.is_open("head") and not open_.silent and (tag in _BLOCK or tag == "body"):  # a head that was never closed
            open_.close(open_.places["head"][0])
        if tag in _BLOCK:
            flush()
            open_.implied(tag)
        if tag in _VOID or attributes.endswith("/") and (tag in ("iframe", *_FOREIGN) or open_.foreign()):
            continue
        hints = frozenset(h for x in _HINT.findall(attributes) for w in _PART.findall("".join(x).lower()) if (h := _HINT_OF.get(w))) if attributes else frozenset()
        label = None if "data-main" not in attributes else 'data-main="1"' in attributes
        if tag in _RAW and not (tag == "title" and open_.foreign()):
            if tag in ("title", "iframe") and not ends_later(tag):
                continue  # nothing that follows is meant to be in it
            end = re.compile(rf"</{tag}\s*+>", re.I).search(page, at)
            if tag == "textarea":
                open_.push(tag, hints, label)
                say(page[at : end.start() if end else len(page)])
                flush()
                open_.close(len(open_.stack) - 1)
            at = end.end() if end else len(page)
            tags.send(at)
            continue
        open_.push(tag, hints, label, tag in _SILENT and ends_later(tag))
    say(page[at:])
    flush()
    return out


def features(found: list[Block], first: int = 0, stop: int | None = None) -> list[list[int]]:
    """For each block (of those from first to stop) the numbers of the features that it has."""
    rows = []
    last = len(found) - 1
    for i, b in enumerate(found[first:stop], first):
        inner = b.inside
        row = set(inner.common) if inner else set()
        if (own := f"own-{inner.block if inner else 'body'}") in _INDEX:
            row.add(_INDEX[own])
        for e in (inner, inner.above) if inner else ():
            row.update(_INDEX[f"near-{h}"] for h in (e.hints if e else ()))
        text, n = b.text, len(b.text)
        share = b.linked / n
        words = text.count(" ") + 1
        flags = {
            "bias": True, "empty-links": share == 0, "links": 0 < share <= 0.5, "mostly-links": share > 0.5, "short": words < 4, "medium": 4 <= words < 15, "long": 15 <= words < 50, "very-long": words >= 50,
            "stop": text[-1] in ".!?…。", "comma": "," in text, "mark": text[0] in "#*|>»›→", "copyright": "©" in text or "(c)" in text.lower(), "digits": sum(map(str.isdigit, text)) > 0.3 * n, "upper": text.isupper(), "first": i == 0, "last": i == last,
        }
        row.update(_INDEX[k] for k, v in flags.items() if v)
        rows.append(sorted(row))
    return rows


@dataclass
class Field:
    """emission: feature x label; transition: label x label; start: label. Label 1 is main text."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    @classmethod
    def train(cls, pages: list[tuple[list[list[int]], list[int]]], rounds: int = 120, rate: float = 0.15, ridge: float = 1e-3) -> "Field":
        """Maximum likelihood of labelled sequences (forward-backward, Adam)."""
        pages = [p for p in pages if p[0]]
        emission, transition, start = np.zeros((WIDTH, 2)), np.zeros((2, 2)), np.zeros(2)
        if not pages:
            return cls(emission, transition, start)
        n, longest = len(pages), max(len(y) for _, y in pages)
        x = np.zeros((n, longest, WIDTH), np.float32)
        y = np.zeros((n, longest), np.int64)
        there = np.zeros((n, longest), bool)
        for k, (rows, labels) in enumerate(pages):
            for i, row in enumerate(rows):
                x[k, i, row] = 1
            y[k, : len(labels)] = labels
            there[k, : len(labels)] = True
        flat = x.reshape(-1, WIDTH)
        hot = np.eye(2)[y] * there[..., None]
        pair = np.einsum("nta,ntb->ab", hot[:, :-1], hot[:, 1:])
        parts = [emission, transition, start]
        speed, power = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        for step in range(1, rounds + 1):
            e = (flat @ emission).reshape(n, longest, 2)
            a = np.zeros((n, longest, 2))
            a[:, 0] = e[:, 0] + start
            for t in range(1, longest):
                a[:, t] = np.logaddexp.reduce(a[:, t - 1, :, None] + transition, axis=1) + e[:, t]
                a[:, t] = np.where(there[:, t, None], a[:, t], a[:, t - 1])
            whole = np.logaddexp.reduce(a[:, -1], axis=1)
            b = np.zeros((n, longest, 2))
            expected = np.zeros((2, 2))
            for t in range(longest - 2, -1, -1):
                after = transition + (e[:, t + 1] + b[:, t + 1])[:, None, :]
                b[:, t] = np.where(there[:, t + 1, None], np.logaddexp.reduce(after, axis=2), b[:, t + 1])
                p = np.exp(a[:, t, :, None] + after - whole[:, None, None])
                expected += p[there[:, t + 1]].sum(axis=0)
            node = np.exp(a + b - whole[:, None, None]) * there[..., None]
            delta = (hot - node).reshape(-1, 2).astype(np.float32)
            gradients = [flat.T @ delta / n - ridge * emission, (pair - expected) / n - ridge * transition, (hot[:, 0] - node[:, 0]).sum(axis=0) / n - ridge * start]
            for k, g in enumerate(gradients):
                speed[k] = 0.9 * speed[k] + 0.1 * g
                power[k] = 0.99 * power[k] + 0.01 * g * g
                parts[k] += rate * (speed[k] / (1 - 0.9**step)) / (np.sqrt(power[k] / (1 - 0.99**step)) + 1e-8)
        return cls(*parts)

    def emissions(self, rows: list[list[int]]) -> list[list[float]]:
        """For each row of features what it says for either label."""
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter((f for r in rows for f in r), np.int64, int(sizes.sum()))
        sums = np.vstack([np.zeros((1, 2)), np.cumsum(self.emission[flat], axis=0)])
        ends = np.cumsum(sizes)
        return (sums[ends] - sums[ends - sizes]).tolist()

    def decode(self, rows: list[list[int]]) -> list[int]:
        return self.decoded(self.emissions(rows))

    def decoded(self, e: list[list[float]]) -> list[int]:
        """The likeliest labels (Viterbi) for a page's emissions."""
        if not e:
            return []
        (t00, t01), (t10, t11) = self.transition.tolist()
        v0, v1 = e[0][0] + float(self.start[0]), e[0][1] + float(self.start[1])
        back = []
        for e0, e1 in e[1:]:
            from0, from1 = v0 + t00 < v1 + t10, v0 + t01 < v1 + t11
            v0, v1 = (v1 + t10 if from0 else v0 + t00) + e0, (v1 + t11 if from1 else v0 + t01) + e1
            back.append((from0, from1))
        y = int(v1 > v0)
        out = [y]
        for b in reversed(back):
            y = int(b[y])
            out.append(y)
        return out[::-1]


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 5) -> list[str]:
    """Composed pages whose elements carry data-main="1" or "0": the label of the blocks in them."""
    draw = np.random.default_rng(seed)
    letters = list("abcdefghijklmnopqrstuvwxyzéèäöüñ")
    vocabulary = ["".join(draw.choice(letters, draw.integers(1, 11))) for _ in range(800)]
    chance = lambda p: draw.random() < p
    pick = lambda xs: xs[int(draw.integers(len(xs)))]

    def words(low: int, high: int) -> str:
        ws = [pick(vocabulary) for _ in range(int(draw.integers(low, high)))]
        for k in range(6, len(ws), 9):
            ws[k] += ","
        return " ".join(ws).capitalize()

    def sentence(low: int = 1, high: int = 40) -> str:
        tail = pick([".", ".", ".", ".", "", "!", "?"])
        return words(low, high) + tail

    def para(low: int = 1, high: int = 5) -> str:
        return " ".join(sentence() for _ in range(int(draw.integers(low, high))))

    def wrap(tag: str, inner: str, name: str = "", main: int | None = None, closed: bool = True) -> str:
        attribute = f' {pick(["class", "id", "class"])}="{name}"' if name else ""
        label = "" if main is None else f' data-main="{main}"'
        return f"<{tag}{attribute}{label}>{inner}" + (f"</{tag}>" if closed else "")

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{pick(vocabulary)}">{words(1, 4)}</a></li>' for _ in range(k))

    def menu() -> str:
        inner = f"<ul>{links(int(draw.integers(2, 9)))}</ul>"
        return pick([wrap("nav", inner, "", 0), wrap("div", inner, pick(["menu", "navbar", "breadcrumbs", "main-menu", "top-nav"]), 0), wrap("nav", " | ".join(f"<a href=x>{words(1, 3)}</a>" for _ in range(4)), "", 0), wrap("ul", links(5), "menu", 0)])

    def advert() -> str:
        inner = pick([para(1, 3), f"<p>{para(1, 3)}</p>", f"<a href=x>{sentence()}</a>", sentence(1, 9)])
        return wrap(pick(["div", "div", "aside", "section"]), inner, pick(["ad", "ads", "advert", "sponsored", "ad-banner", "promo", "advertisement"]), 0)

    def side() -> str:
        inner = wrap("h3", words(1, 4)) + pick([f"<ul>{links(4)}</ul>", f"<p>{para(1, 3)}</p>", f"<p>{sentence()}</p><ul>{links(3)}</ul>"])
        return pick([wrap("aside", inner, "", 0), wrap("div", inner, pick(["sidebar", "side", "widget", "right-rail", "related", "recommended"]), 0), wrap("aside", inner, "sidebar", 0)])

    def notice() -> str:
        inner = f"<p>{para(1, 3)}</p>" + pick(["<button>Ok</button>", f"<a href=x>{words(1, 3)}</a>", ""])
        return pick([wrap("div", inner, pick(["cookie-notice", "consent", "notice", "alert", "newsletter", "gdpr-popup", "modal", "paywall"]), 0), wrap("dialog", inner, "", 0), wrap("div", sentence(), pick(["cookie-banner", "notice"]), 0)])

    def form() -> str:
        inner = f'<label>{words(1, 4)}</label><input type="text"><select><option>{words(1, 3)}<option>{words(1, 3)}</select><textarea>{words(1, 9)}</textarea><p>{sentence()}</p><button>{words(1, 3)}</button>'
        return wrap("form", inner, pick(["", "search", "login", "contact-form"]), 0)

    def remarks() -> str:
        kind = pick([0, 1, 2, 3])
        one = lambda: para(1, 4)
        k = int(draw.integers(1, 6))
        if kind == 0:
            return wrap("section", wrap("h2", words(1, 4)) + "".join(wrap("article", f"<p>{one()}</p>", pick(["comment", ""])) for _ in range(k)), pick(["comments", "comment-section", "discussion"]), 0)
        if kind == 1:
            return wrap("div", "".join(wrap("div", wrap("p", one()), "comment") for _ in range(k)), pick(["comments", "replies", "disqus_thread"]), 0)
        if kind == 2:
            return wrap("ol", "".join(wrap("li", wrap("p", one()), pick(["comment", "reply"])) for _ in range(k)), "commentlist", 0)
        return wrap("div", wrap("h3", words(1, 3)) + "".join(f"<p>{one()}</p>" for _ in range(k)), pick(["comments", "user-comments", "feedback"]), 0)

    def foot() -> str:
        inner = pick([f"&copy; {words(1, 3)} &middot; {para(1, 3)}", f"<p>{para(1, 3)}</p>", f"<ul>{links(4)}</ul><p>© {words(1, 4)}</p>", sentence()])
        return pick([wrap("footer", inner, "", 0), wrap("footer", inner, "", 0), wrap("div", inner, pick(["footer", "copyright", "legal", "site-footer"]), 0)])

    def head() -> str:
        inner = pick([words(1, 4), f"<h1>{words(1, 4)}</h1><p>{sentence()}</p>", f"<div>{words(1, 5)}</div>" + menu(), f"<p>{para(1, 2)}</p>"])
        return pick([wrap("header", inner, "", 0), wrap("div", inner, pick(["masthead", "header", "site-header"]), 0)])

    def piece() -> str:
        k = draw.random()
        if k < 0.72:
            inner = pick([para(), para(), sentence(1, 5), para(4, 12), sentence(1, 3), f"<b>{para()}", f'{sentence()} <a href="x">{words(1, 4)}</a> {sentence()}', f'<a href="x">{sentence()}</a>', para().upper(), f"{words(2, 6)} | {words(2, 9)} | {words(1, 4)}", f"{para()}<br>{para()}"])
            return wrap("p", inner, closed=chance(0.85))
        if k < 0.80:
            return wrap(pick(["h2", "h3", "h4"]), words(1, 8))
        if k < 0.85:
            return wrap(pick(["ul", "ol"]), "".join(wrap("li", sentence(1, 15), closed=chance(0.8)) for _ in range(3)))
        if k < 0.88:
            return wrap("blockquote", pick([para(), f"<p>{para()}</p>"]))
        if k < 0.91:
            return wrap("table", "".join(f"<tr><td>{words(1, 4)}</td><td>{draw.integers(1, 9999)}</td></tr>" for _ in range(3)))
        if k < 0.94:
            return wrap("pre", words(3, 20))
        if k < 0.97:
            return wrap("figure", f'<img src="x.png"><figcaption>{sentence()}</figcaption>')
        return wrap("div", pick([para(), f"<p>{para()}</p>"]))

    def article() -> str:
        title = wrap("h1", words(1, 12)) if chance(0.8) else ""
        if title and chance(0.2):
            title = wrap("header", title)
        body = [piece() for _ in range(int(draw.integers(0 if title else 1, 14)))]
        for inset, p in ((advert, 0.2), (form, 0.12), (notice, 0.15), (side, 0.15), (remarks, 0.12)):
            if chance(p):
                body.insert(int(draw.integers(len(body) + 1)), inset())
        inner = title + "".join(body)
        layout = pick([0, 0, 0, 0, 1, 2, 3, 4, 5, 5])
        if layout == 0:
            return wrap("article", inner, pick(["", "", "post", "story"]), 1)
        if layout == 1:
            return wrap("main", inner, "", 1)
        if layout == 2:
            return wrap("main", wrap("article", inner), "", 1)
        if layout == 3:
            return wrap("div", inner, pick(["content", "article-body", "post-content", "entry", "story-text"]), 1)
        if layout == 4:
            return wrap("section", wrap("div", inner, pick(["content", ""])), pick(["article", "post"]), 1)
        inner = wrap("div", inner, pick(["entry-content", "story-body", "text"])) if chance(0.4) else inner
        return wrap("main", wrap("article", inner, pick(["story", "post", "entry", ""])), pick(["content", "main", "page-content"]), 1)

    out = []
    for _ in range(n):
        before = [f() for f, p in ((notice, 0.3), (head, 0.4), (menu, 0.8), (advert, 0.5), (side, 0.2), (form, 0.15)) if chance(p)]
        after = [f() for f, p in ((remarks, 0.4), (side, 0.4), (advert, 0.3), (form, 0.2), (notice, 0.2), (foot, 0.85)) if chance(p)]
        alone = chance(0.12)  # nothing but the article
        before, after = [] if alone or chance(0.1) else before, [] if alone or chance(0.1) else after
        middle = article() if chance(0.97) else ""
        if chance(0.15):
            middle = wrap("div", middle, pick(["page", "wrapper", "container"]))
        out.append(f"<html><head><title>{words(1, 9)}</title><style>p{{margin:0}}</style></head><body>{''.join(before)}{middle}{''.join(after)}</body></html>")
    return out


def train(pages: list[str] | None = None) -> Field:
    """A field from labelled pages (elements with data-main="1" or "0"); that of composed pages is trained once per process."""
    return _composed() if pages is None else _trained(pages)


def _trained(pages: list[str]) -> Field:
    found = [blocks(p) for p in pages]
    return Field.train([(features(f), [int(b.main) for b in f]) for f in found])


@functools.cache
def _composed() -> Field:
    return _trained(labelled_pages())


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page or "")
    emissions = [e for at in range(0, len(found), BATCH) for e in field.emissions(features(found, at, at + BATCH))]
    return "\n".join(b.text for b, y in zip(found, field.decoded(emissions)) if y)


def extract(pages: DataFrame, field: Field, source: str = "html", out: str = "text") -> DataFrame:
    """Adds the main text of the whole page in column source. Null and empty pages, and pages without a main
    block, have an empty text. Rows stand alone; a column named out is replaced, all others pass."""
    shared = broadcast(pages.sparkSession, field)

    @F.arrow_udf("string")
    def text_of(rows: pa.Array) -> pa.Array:
        return pa.array([main_text(r.as_py(), shared.value) for r in rows], pa.string())

    return pages.withColumn(out, text_of(F.col(source)))
