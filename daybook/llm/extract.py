"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A leaf block is a run of text between the edges of block elements. Its features are its ancestors' tags and the words of
their classes and ids, and the shape of its text and links; neighbouring blocks' labels (main or other) depend on each
other. The weights are fitted to labelled pages by maximum likelihood (forward and backward sums), and the best labels
of a page are found by Viterbi. The fitted weights are a few dozen numbers; pages are read row by row, each by one task.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import ship, whole

_BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section
    select summary table tbody td tfoot th thead title tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
_HIDDEN = frozenset("script style noscript template svg math iframe object textarea select title head canvas audio video".split())
_RAW = frozenset("script style textarea title".split())
#: An opening tag ends an open element of the same group, unless a box between them begins anew.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",),
         "option": ("option",)}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>", re.S)
#: Where each raw element ends; up to there nothing is markup.
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_IS_HIDDEN = re.compile(r"(?:^|[\s/])hidden(?=[\s=/]|$)", re.I)
_TAGS = ("article", "main", "section", "nav", "header", "footer", "aside", "form", "ul", "ol", "li", "table", "p", "pre",
         "blockquote", "figure", "h1", "h2", "h3", "h4", "button", "dl", "div", "label")
#: Parts of names of classes and ids, by what they tell.
_HINTS = {
    "menu": "nav menu breadcrumb pagination pager toc skip",
    "top": "header masthead topbar banner brand logo",
    "bottom": "footer foot copyright legal colophon imprint",
    "side": "side sidebar aside widget rail column-right complementary",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsbygoogle",
    "comment": "comment comments reply replies respond discussion disqus reader readers",
    "notice": "cookie cookies consent notice alert popup modal overlay warning gdpr newsletter subscribe signup paywall",
    "around": "share sharing social related recommend recommended tags tag meta byline teaser more trending popular",
    "form": "form search login input field",
    "content": "content article post entry story text prose body main page-content",
}
_HINT_OF = {word: k for k, words in enumerate(_HINTS.values()) for word in words.split()}
_SHAPES = ("always", "1-2 words", "3-5 words", "6-12 words", "13-30 words", "over 30 words", "no link", "some link", "mostly link",
           "ends as a sentence", "has a comma", "has ©", "has |", "first block", "last block", "only ancestors without a hint")
N_FEATURES = len(_TAGS) + len(_HINTS) + len(_SHAPES)
_TAG_BIT = {t: 1 << k for k, t in enumerate(_TAGS)}
_SHAPE = len(_TAGS) + len(_HINTS)


@dataclass
class Block:
    text: str
    above: int  # the bits of all ancestors' tags and hints
    linked: int  # characters inside links


def _is_hidden(attributes: str) -> bool:
    """Whether there is an attribute called hidden; values are not looked at."""
    return "hidden" in attributes.lower() and _IS_HIDDEN.search(_VALUE.sub("= ", attributes)) is not None


def leaf_blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order; character references decoded, white space one space, ends trimmed."""
    blocks: list[Block] = []
    stack: list[tuple[str, int, bool]] = [("", 0, False)]
    places: dict[str, list[int]] = {}  # where each tag's open elements stand in the stack
    parts: list[str] = []
    at, links, linked = 0, 0, 0

    def flush():
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(Block(text, stack[-1][1], linked))
        parts, linked = [], 0

    def take(piece: str):
        nonlocal linked
        if not stack[-1][2]:
            piece = entities.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if links:
                linked += len(piece)

    def close(to: int):
        nonlocal links
        while len(stack) > to:
            name = stack.pop()[0]
            places[name].pop()
            links -= name == "a"

    def find(names, stop=frozenset()) -> int:
        nearest = max(places[n][-1] if places.get(n) else 0 for n in names)
        return nearest if all(not places.get(n) or places[n][-1] < nearest for n in stop) else 0

    # Behind the last ">" no tag ends, so none is looked for there, however many begin.
    marked = page.rfind(">") + 1
    while at < marked and (token := _TOKEN.search(page, at, marked)):
        name = (token[2] or token[5] or "").lower()
        ending = bool(token[1] or token[4])
        if token.start() > at:
            take(page[at:token.start()])
        at = token.end()
        if not name:
            if token[0].startswith("<!--") and not token[0].endswith("-->"):
                at = len(page)  # a comment that is never closed
            continue
        if ending:
            if name in _BLOCKS:
                flush()
            if k := find((name,)):
                close(k)
            continue
        if name in _BLOCKS:
            flush()
            if name in _ENDS and (k := find(_ENDS[name], {"ul", "ol", "dl", "table"})):
                close(k)
            elif k := find(("p",), {"td", "th", "li", "div", "button"}):
                close(k)
        elif name == "br":
            parts.append(" ")
        attributes = token[3] or token[6] or ""
        if name in _VOID or attributes.endswith("/") and name not in _BLOCKS:
            continue
        bits = stack[-1][1] | _TAG_BIT.get(name, 0)
        if attributes:
            for values in _NAMES.findall(attributes):
                words = "".join(values).lower()
                for word in {*words.split(), *re.split(r"[\s_-]+", words)}:
                    if word in _HINT_OF:
                        bits |= 1 << len(_TAGS) + _HINT_OF[word]
        if name in _HIDDEN and name in _BLOCKS:
            flush()
        hidden = stack[-1][2] or name in _HIDDEN or _is_hidden(attributes)
        places.setdefault(name, []).append(len(stack))
        stack.append((name, bits, hidden))
        links += name == "a"
        if name in _RAW:
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else len(page)
    comment = page.find("<!--", at)
    take(page[at:] if comment < 0 else page[at:comment])
    flush()
    return blocks


def features(blocks: list[Block]) -> list[list[int]]:
    """The numbers of each block's features."""
    out = []
    for i, b in enumerate(blocks):
        n = b.text.count(" ") + 1
        share = b.linked / max(1, len(b.text))
        shape = [0, 1 + (n > 2) + (n > 5) + (n > 12) + (n > 30), 6 + (share > 0.05) + (share > 0.5)]
        shape += [9] * (b.text[-1] in ".!?…:;\"”»") + [10] * ("," in b.text) + [11] * ("©" in b.text) + [12] * ("|" in b.text)
        shape += [13] * (i == 0) + [14] * (i == len(blocks) - 1) + [15] * (b.above >> len(_TAGS) == 0)
        above, own, k = b.above, [_SHAPE + s for s in shape], 0
        while above:
            if above & 1:
                own.append(k)
            above >>= 1
            k += 1
        out.append(own)
    return out


@dataclass
class Field:
    """Weights of features for "main" against "other", and of equal and unequal neighbours' labels."""

    weights: np.ndarray
    steps: np.ndarray  # [label before, label]

    def decode(self, rows: list[list[int]]) -> list[bool]:
        """The most probable labels, by Viterbi."""
        weights, steps = self.weights.tolist(), self.steps.tolist()
        best, back = [0.0, 0.0], []
        for k, row in enumerate(rows):
            gain = (0.0, sum(weights[f] for f in row))
            if k:
                came = [0 if best[0] + steps[0][y] >= best[1] + steps[1][y] else 1 for y in (0, 1)]
                best = [best[came[y]] + steps[came[y]][y] + gain[y] for y in (0, 1)]
                back.append(came)
            else:
                best = list(gain)
        y = int(best[1] > best[0])
        labels = [y]
        for came in reversed(back):
            y = came[y]
            labels.append(y)
        return [bool(v) for v in reversed(labels)] if rows else []


def fit(pages: list[tuple[list[list[int]], list[bool]]], ridge: float = 0.05, rounds: int = 300, rate: float = 0.1) -> Field:
    """Maximum likelihood with a ridge, by gradient steps of adapted size; all pages side by side."""
    pages = [p for p in pages if p[0]]
    longest = max(len(rows) for rows, _ in pages)
    x, y = np.zeros((len(pages), longest, N_FEATURES)), np.zeros((len(pages), longest), int)
    there = np.zeros((len(pages), longest), bool)
    for p, (rows, labels) in enumerate(pages):
        for i, row in enumerate(rows):
            x[p, i, row] = 1
        y[p, :len(rows)], there[p, :len(rows)] = labels, True
    both = there[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
    wanted = np.concatenate([np.einsum("pif,pi->f", x, y * there), seen.ravel()])
    v = np.zeros(N_FEATURES + 4)
    first, second = np.zeros_like(v), np.zeros_like(v)
    for t in range(1, rounds + 1):
        steps = v[N_FEATURES:].reshape(2, 2)
        gain = np.stack([np.zeros(y.shape), x @ v[:N_FEATURES]], axis=2)
        ahead, behind = gain.copy(), np.zeros_like(gain)
        for i in range(1, longest):  # beyond a page's end the sums stay as they are
            on = gain[:, i] + np.logaddexp(ahead[:, i - 1, :1] + steps[0], ahead[:, i - 1, 1:] + steps[1])
            ahead[:, i] = np.where(there[:, i, None], on, ahead[:, i - 1])
        for i in range(longest - 2, -1, -1):
            nxt = behind[:, i + 1] + gain[:, i + 1]
            on = np.logaddexp(steps[:, 0] + nxt[:, :1], steps[:, 1] + nxt[:, 1:])
            behind[:, i] = np.where(there[:, i + 1, None], on, 0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])[:, None]
        one = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total) * there
        pair = np.exp(ahead[:, :-1, :, None] + steps + (gain + behind)[:, 1:, None, :] - total[:, :, None, None])
        given = np.concatenate([np.einsum("pif,pi->f", x, one), (pair * both[:, :, None, None]).sum(axis=(0, 1)).ravel()])
        grad = wanted - given - ridge * v
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad ** 2
        v += rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    return Field(v[:N_FEATURES], v[N_FEATURES:].reshape(2, 2))


def labelled(pages: list[str], mark: str = "§") -> list[tuple[list[list[int]], list[bool]]]:
    """Features and labels of pages whose main blocks begin with ``mark``."""
    out = []
    for page in pages:
        blocks = leaf_blocks(page)
        labels = [b.text.startswith(mark) for b in blocks]
        for b in blocks:
            b.text = b.text.removeprefix(mark) or mark
        out.append((features(blocks), labels))
    return out


def trained() -> Field:
    """A field fitted to the labelled pages of ``labelled_pages``."""
    from daybook.llm.labelled_pages import pages

    return fit(labelled(pages()))


def main_text(page: str, field: Field) -> str:
    """The page's main blocks joined by empty lines; empty if there are none."""
    blocks = leaf_blocks(page)
    return "\n\n".join(b.text for b, main in zip(blocks, field.decode(features(blocks))) if main)


def extracted(html_col: str | Column, field: Field, spark) -> Column:
    """The main text of an html column; null counts as an empty page."""
    ship(spark)
    weights, steps = field.weights, field.steps

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from daybook.llm.extract import Field as Own, main_text as extract

        own = Own(weights, steps)
        for pages in parts:
            yield pages.map(lambda p: extract(p, own))

    return text(whole(html_col))


def with_main_text(pages: DataFrame, html_col: str = "html", field: Field | None = None) -> DataFrame:
    """``pages`` with ``main_text`` and its length ``main_chars`` in code points. An empty table stays empty."""
    found = pages.withColumn("main_text", extracted(html_col, field or trained(), pages.sparkSession))
    return found.withColumn("main_chars", F.char_length("main_text").cast("long"))
