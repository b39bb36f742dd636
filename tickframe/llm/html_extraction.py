"""Main text of web pages by line-block distribution.

Markup is stripped so that each block of text becomes a line: tags of blocks
end lines, tags within them leave no trace, scripts, styles, comments and what
stands in menus, headers, footers, sidebars, notices, adverts, forms and reader
comments leave empty lines. The text lengths of each window of ``window`` lines
are summed. Where the sum rises from zero is a surge, where it falls back to
zero a dive; the lines from a surge to its dive are a stretch of text.

Lines count their characters outside links; lists of links and, outside marked
parts, lines such as of copyright count nothing. Lines that count nothing belong to a stretch between
lines that count, as far as the window bridges them, and are cut off at its ends;
nothing else between a surge and its dive is left out, however short.

A page that marks articles or a main part has the stretches of all of these
kept, in page order; parts of links alone only if there are no others. Inside
them, an element whose class or id sounds like something else is set aside only
if its windowed sums stay under half of those of the part around it. In other
pages a stretch that reaches a threshold of at most 60 characters (lower on pages
of short lines) is text, and so is all between two of them. Shorter ones before
the first and after the last are text too, unless the characters in links from
there on outwards, over a window, are more than those outside.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickframe.llm.common import slices

WINDOW = 3
# Most that a stretch's highest windowed sum may have to reach, in characters.
SHORT = 60
# Closing one of these that holds blocks ends a stretch on pages without marked parts.
CONTAINERS = {"div", "section", "table"}
COPYRIGHT = re.compile(r"\W*(?:©|\(c\)\s|copyright\s+(?:©|\(c\)|\d{4}))|.*\ball rights reserved\W*$|\W*(?:we|this (?:web)?site) uses? cookies\b", re.I)
HREF = re.compile(r"\bhref\b", re.I)
# Fixed values of the HTML standard: elements by what they do to text.
RAW = ("script", "style", "iframe", "textarea", "title", "head")
# Set aside like menus, but without ending the stretch of text they stand in.
EMBEDDED = {"svg", "math", "object", "canvas", "noscript", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "label", "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr"}
ASIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset", "input"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar", "form"}
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
         "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "cookie", "cookies", "consent", "notice",
         "alert", "popup", "modal", "newsletter", "subscribe", "subscription", "comment", "comments", "disqus", "respond", "reply",
         "replies", "share", "sharing", "social", "related", "footer", "header", "masthead", "widget", "toolbar", "pagination",
         "login", "signup", "search"}
# Names that say the same as the last part of a longer one (site-footer), and first parts that turn them round.
HEADS = NAMES - {"ad", "alert", "comment", "header", "login", "notice", "promotion", "related", "reply", "respond", "search", "share",
                 "sharing", "social", "sponsor", "subscription"}
MODIFIERS = {"has", "have", "no", "not", "with", "without", "hide", "show", "is"}
# Of what is set aside, only these may turn out to wrap the page: a menu or a discussion can be longer than its article.
WRAPPERS = {"form", "fieldset"}
DISCUSSION = {"comment", "comments", "disqus", "respond", "reply", "replies"}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
PARTS = re.compile(r"[^a-z0-9]+")


def named(token: str) -> str:
    """The name that a class or id has for something other than the article, or nothing."""
    if token in NAMES:
        return token
    parts = PARTS.split(token)
    return parts[-1] if parts[-1] in HEADS and parts[0] not in MODIFIERS else ""


def set_aside(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element holds something other than the article, and whether that stands even if it holds most of the text."""
    if tag in ASIDE or tag in EMBEDDED:
        return True, tag not in WRAPPERS
    if not attributes or tag in ("html", "body", "main"):
        return False, False
    found = []
    for name, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        if name.lower() == "role":
            if value in ROLES:
                return True, True
        else:
            found += filter(None, map(named, value.split()))
    return bool(found), not DISCUSSION.isdisjoint(found)


class Lines:
    """Lines of a page: their texts, and the article each stands in (0 for none)."""

    def __init__(self, page: str, window: int = WINDOW):
        self.texts: list[str] = []
        self.parts: list[int] = []
        # Per line, the set-aside element it stands in or is a gap around (0 for none); per element, the one around it and whether it stands.
        self.asides: list[int] = []
        # Per line, characters in links, and whether it is a page's heading.
        self.linked: list[int] = []
        self.heads: list[bool] = []
        self.link, self.open_linked, self.blocks = -1, 0, 0
        begun: list[int] = []
        self.around, self.stands = [0], [True]
        # The part that an element stands in which only its name sets aside, else 0.
        self.named_in = [0]
        self.window, self.open_text = window, []
        # Open elements: name, number of the set-aside element (-1 if embedded), number of the article or main part.
        stack: list[tuple[str, int, int]] = []
        opened: Counter = Counter()
        self.aside, self.part, self.count = 0, 0, 0
        self.kind = {0: ""}
        at, end = 0, len(page)
        while at < end:
            found = TOKEN.search(page, at)
            if not found:
                self._text(page[at:])
                break
            self._text(page[at:found.start()])
            at = found.end()
            if raw := found["raw"]:
                self._break()
                close = RAW_END[raw.lower()].search(page, at)
                # A head that never ends is ended by the body.
                at = close.end() if close else self._unclosed(page, at, raw.lower())
                continue
            if not found["tag"]:
                if found[0].startswith("<![CDATA["):
                    self._text(html.escape(found[0][9:].removesuffix("]]>")))
                continue
            tag = found["tag"].lower()
            written = len(self.texts)
            if tag not in INLINE:
                self._break()
            if found["end"]:
                if tag == "h1" and self.texts[written:]:
                    self.heads[-1] = bool(self.texts[-1])
                if opened[tag]:
                    k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag)
                    opened.subtract(s[0] for s in stack[k:])
                    self._leave(stack[k:])
                    first = begun[k]
                    del stack[k:], begun[k:]
                    if self.link >= k:
                        self.link = -1
                    if tag in CONTAINERS and self.blocks > first and not self.part and self.aside >= 0:
                        self._gap(self.aside)
                    self._state(stack)
            elif tag not in VOID and not found["attributes"].endswith("/"):
                main = tag in ("article", "main")
                aside, stands = set_aside(tag, found["attributes"])
                if main and not aside:
                    # The article itself is never part of an element that was left open before it.
                    inner = self.kind[self.part] == "article" and not self.aside
                    part = self.part if inner else self._new_part(tag)
                    stack.append((tag, 0, part))
                elif aside and self.aside >= 0:
                    by_name = not stands and tag not in ASIDE
                    stack.append((tag, -1 if tag in EMBEDDED else self._new_aside(stands, self.part if by_name else 0), self.part))
                else:
                    stack.append((tag, self.aside, self.part))
                if tag not in INLINE:
                    self.blocks += 1
                begun.append(self.blocks)
                opened[tag] += 1
                if tag == "a" and HREF.search(found["attributes"]):
                    self.link = len(stack) - 1
                if stack[-1][2] != self.part:
                    self._gap(0)
                elif stack[-1][1] != self.aside and stack[-1][1] > 0 and not self.part:
                    self._gap(stack[-1][1])
                self._state(stack)
        self._break()
        self._release()

    def _unclosed(self, page: str, at: int, raw: str) -> int:
        body = re.compile("<body", re.I).search(page, at) if raw in ("head", "title") else None
        return body.start() if body else len(page)

    def _new_part(self, tag: str) -> int:
        self.count += 1
        self.kind[self.count] = tag
        return self.count

    def _new_aside(self, stands: bool, named_in: int) -> int:
        self.around.append(max(0, self.aside))
        self.stands.append(stands)
        self.named_in.append(named_in)
        return len(self.around) - 1

    def _state(self, stack: list[tuple[str, int, int]]) -> None:
        before = self.aside
        _, self.aside, self.part = stack[-1] if stack else ("", 0, 0)
        if before != self.aside:
            self._break(before)

    def _leave(self, closed: list[tuple[str, int, int]]) -> None:
        gaps = [0 if tag in ("article", "main") else aside for tag, aside, part in closed
                if tag in ("article", "main") or (aside > 0 and not part)]
        if gaps:
            self._break()
            self._gap(min(gaps))

    def _gap(self, aside: int) -> None:
        self.texts += [""] * self.window
        self.parts += [0] * self.window
        self.asides += [aside] * self.window
        self.linked += [0] * self.window
        self.heads += [False] * self.window

    def _release(self) -> None:
        """Drops what was set aside, but for elements that hold most of the page's text, as those wrap it, and for
        those inside an article that only their names set aside and whose sums are like those around them."""
        held = [0] * len(self.around)
        for text, aside in zip(self.texts, self.asides):
            held[aside] += len(text)
        total = sum(held)
        for k in range(len(held) - 1, 0, -1):
            held[self.around[k]] += held[k] if self.around[k] else 0
        tops = self._tops() if any(self.named_in) else {}
        free = [True] + [False] * (len(held) - 1)
        for k in range(1, len(held)):
            alike = self.named_in[k] and 2 * tops.get((self.named_in[k], k), 0) > tops.get((self.named_in[k], 0), 0)
            free[k] = free[self.around[k]] and not self.stands[k] and bool(alike or 2 * held[k] > total)
        # Gaps stay where the element stays aside, lines where it does not.
        kept = [k for k, (text, aside) in enumerate(zip(self.texts, self.asides)) if free[aside] == bool(text) or not aside]
        self.texts, self.parts, self.linked, self.heads = (
            [x[k] for k in kept] for x in (self.texts, self.parts, self.linked, self.heads))

    def _tops(self) -> dict[tuple[int, int], int]:
        """The highest windowed sum by part and set-aside element."""
        lengths: dict[tuple[int, int], list[int]] = {}
        for text, part, aside, linked, head in zip(self.texts, self.parts, self.asides, self.linked, self.heads):
            if text:
                lengths.setdefault((part, aside), []).append(weight(text, linked, head, part > 0))
        return {k: int(window_sums(np.array(n, np.int64), self.window).max()) for k, n in lengths.items()}

    def _text(self, text: str) -> None:
        if text and self.aside >= 0:
            self.open_text.append(text)
            if self.link >= 0:
                self.open_linked += len(" ".join(html.unescape(text).split()))

    def _break(self, aside: int | None = None) -> None:
        if self.open_text:
            line = " ".join(html.unescape("".join(self.open_text)).split())
            self.open_text, linked, self.open_linked = [], self.open_linked, 0
            if line:
                self.linked.append(min(linked, len(line)))
                self.heads.append(False)
                self.texts.append(line)
                self.parts.append(self.part)
                self.asides.append(max(0, self.aside if aside is None else aside))


def window_sums(lengths: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Sum of the window that ends at each line: zero once ``window`` empty lines have passed."""
    total = np.r_[0, np.cumsum(lengths)]
    at = np.arange(len(lengths))
    return total[at + 1] - total[np.maximum(at + 1 - window, 0)]


def stretches(lengths: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """From each surge of the windowed sums to its dive, as ranges of lines."""
    if not lengths.any():
        return []
    high = np.r_[False, window_sums(lengths, window) > 0, False]
    surges, dives = np.flatnonzero(~high[:-1] & high[1:]), np.flatnonzero(high[:-1] & ~high[1:])
    return list(zip(surges.tolist(), dives.tolist()))


def weight(text: str, linked: int, head: bool, marked: bool) -> int:
    """What a line counts in the sums: its characters outside links, for the heading at least SHORT.

    A line of copyright counts nothing, unless it stands in a marked part, whose author put it there.
    """
    if head:
        return max(len(text), SHORT)
    own = len(text) - linked
    if (2 * linked > len(text) and own < SHORT) or (not marked and len(text) < 3 * SHORT and COPYRIGHT.match(text)):
        return 0
    return own


def filled(lengths: np.ndarray, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges without the lines at their ends that count nothing."""
    counted = [np.flatnonzero(lengths[a:b]) + a for a, b in ranges]
    return [(int(at[0]), int(at[-1]) + 1) for at in counted if len(at)]


def texts_of(lengths: np.ndarray, linked: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """The stretches of text of a page without marked parts.

    All from the first to the last one whose windowed sums reach half of the
    page's highest one, or SHORT where that is less, and shorter ones beyond them
    unless, over the lines with text of one window from there outwards, more
    characters stand in links than count.
    """
    sums = window_sums(lengths, window)
    least = min(SHORT, sums.max(initial=0) / 2)
    found = stretches(lengths, window)
    high = [k for k, (a, b) in enumerate(found) if sums[a:b].max() >= least]
    if not high:
        return []
    shown = np.flatnonzero((lengths > 0) | (linked > 0))

    def outwards(a: int, b: int, step: int) -> bool:
        at = np.searchsorted(shown, a) if step > 0 else np.searchsorted(shown, b) - 1
        size = int((lengths[a:b] > 0).sum())
        rows = shown[at:at + window + size - 1] if step > 0 else shown[max(0, at - window - size + 2):at + 1]
        return lengths[rows].sum() >= linked[rows].sum()

    kept = [(a, b) for a, b in found[:high[0]] if outwards(a, b, -1)]
    kept += found[high[0]:high[-1] + 1]
    kept += [(a, b) for a, b in found[high[-1] + 1:] if outwards(a, b, 1)]
    return filled(lengths, kept)


def main_text(page: str, window: int = WINDOW) -> str:
    lines = Lines(page, window)
    lengths = np.array([weight(t, n, h, k > 0) for t, n, h, k in zip(lines.texts, lines.linked, lines.heads, lines.parts)], np.int64)
    parts = np.array(lines.parts, np.int64)
    if (parts > 0).any():
        shown = np.array([bool(t) for t in lines.texts]) & (parts > 0)
        if not lengths[shown].any():
            # Links alone, which are then the text.
            lengths = np.where(shown, 1, 0)
        rows = []
        for part in np.unique(parts[shown]):
            own = np.flatnonzero(shown & (parts == part))
            rows += [k for a, b in filled(lengths[own], stretches(lengths[own], window)) for k in own[a:b]]
        return " ".join(lines.texts[k] for k in sorted(rows))
    if not lengths.any():
        lengths = np.array([len(t) for t in lines.texts], np.int64)
    return " ".join(t for a, b in texts_of(lengths, np.array(lines.linked, np.int64), window) for t in lines.texts[a:b] if t)


def extract(pages: DataFrame, window: int = WINDOW, out: str = "text") -> DataFrame:
    """``pages`` without html, with the main text (empty if none) and n_chars, its code points.

    Null pages are empty. Pages are read whole, whatever their length; broken
    markup is read as far as it goes: elements that are never closed end with
    their parents, unfinished tags at the end are left out. Columns of the
    result's names are replaced.
    """
    rest = [c for c in pages.columns if c.lower() not in ("html", out.lower(), "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(p or "", window) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*rest, out, "n_chars"])
    return pages.select(*rest, "html").mapInArrow(run, pages.select(rest).schema.add(out, "string").add("n_chars", "long"))
