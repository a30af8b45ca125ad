"""Text lines of an HTML page with the region each stands in, and the common lines of two pages."""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from html.parser import HTMLParser

# Fixed values of the HTML standard and of common naming habits.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section",
    "summary", "table", "tbody", "tfoot", "thead", "title", "tr", "ul",
}
UNSEEN = {
    "head", "title", "script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "audio",
    "video", "select", "option", "datalist", "textarea", "button", "dialog",
}
ASIDE = {"nav", "footer", "aside", "form", "menu"}
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu",
    "menubar", "form",
}
NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "commentlist", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
    "paywall", "popup", "promo", "promotion", "related", "replies", "reply", "respond", "share", "sharing", "sidebar",
    "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget",
}
# An element that opens ends an open element of these names.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}, "body": {"head"},
}
LIST_LIKE = {"ul", "ol", "table", "dl", "tbody", "thead", "tfoot", "select", "menu"}
WORD = re.compile(r"[a-z0-9]+")
CASE = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


@dataclass
class Line:
    """One block of text: the text, whether it lies in the article, whether in a region that is never content."""

    text: str
    main: bool
    aside: bool


class PageLines(HTMLParser):
    """Splits a page into blocks; unclosed and stray tags are taken as browsers do, roughly."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parts: list[str] = []
        # Open elements: name, unseen, aside, article depth so far.
        self.open: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts.clear()
            _, unseen, aside, main = self.open[-1]
            if text and not unseen:
                self.lines.append(Line(text, main, aside))

    def close_until(self, names: set[str], borders: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in names:
                self.flush()
                del self.open[i:]
                return
            if self.open[i][0] in borders:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
            self.close_until({"p"}, BLOCKS - {"p"})
        elif tag in ("td", "th"):
            self.parts.append(" ")
        if tag in ENDS:
            self.close_until(ENDS[tag], LIST_LIKE | {"article", "main", "body"})
        if tag in VOID:
            return
        if tag in ("article", "main"):  # an unclosed menu does not swallow the article
            while len(self.open) > 1 and self.open[-1][0] in ("nav", "header", "form", "ul", "ol", "li", "menu", "a", "span"):
                self.open.pop()
        _, unseen, aside, main = self.open[-1]
        unseen = unseen or tag in UNSEEN
        named = False
        if not aside and not unseen and attrs:
            for key, value in attrs:
                if key == "hidden" or key == "aria-hidden" and value == "true":
                    unseen = True
                elif value and key == "role":
                    named |= value.strip().lower() in ROLES
                elif value and key in ("class", "id") and tag not in ("body", "html"):
                    words = set(WORD.findall(CASE.sub(" ", value).lower()))
                    named |= not NAMES.isdisjoint(words) or not main and tag != "article" and "header" in words
        aside = aside or named or tag in ASIDE or tag == "header" and not main
        main = main or tag in ("article", "main")
        self.open.append((tag, unseen, aside, main))

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        elif tag in ("td", "th"):
            self.parts.append(" ")
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.flush() if tag in UNSEEN else None
                del self.open[i:]
                return
            if self.open[i][0] in ("article", "main", "body") and tag not in ("html", "body", "article", "main"):
                return  # a stray end tag does not close the article

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def page_lines(html: str | None) -> list[Line]:
    """The lines of a page in order; null and empty pages have none."""

    parser = PageLines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.lines


def shared_lines(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Positions in ``a`` and in ``b`` of a longest common subsequence of two line sequences.

    Matching positions are scanned in order and chained by patience sorting, which takes
    time in proportion to the number of equal pairs. Of equal choices the earliest in ``b``.
    """

    begin = 0
    while begin < min(len(a), len(b)) and a[begin] == b[begin]:
        begin += 1
    end = 0
    while end < min(len(a), len(b)) - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    where: dict[int, list[int]] = {}
    for j in range(len(b) - end - 1, begin - 1, -1):
        where.setdefault(b[j], []).append(j)  # falling positions
    tails: list[int] = []
    chain: list[tuple[int, int, tuple | None]] = []
    for i in range(begin, len(a) - end):
        for j in where.get(a[i], ()):
            k = bisect_left(tails, j)
            link = (i, j, chain[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                chain.append(link)
            elif j < tails[k]:
                tails[k] = j
                chain[k] = link
    middle, link = [], chain[-1] if chain else None
    while link is not None:
        middle.append(link[:2])
        link = link[2]
    pairs = [(i, i) for i in range(begin)] + middle[::-1]
    pairs += [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]
    return [i for i, _ in pairs], [j for _, j in pairs]
