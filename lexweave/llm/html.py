"""Main-text extraction by line-block distribution.

Mark-up is stripped into lines, one per block of the page; what lies in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles or reader comments writes no line. Every line weighs its characters, lines of links and
statements of rights weigh nothing. Weights are summed over sliding windows of WINDOW lines, which do not reach over the edge of an
article or main element: a stretch surges where its window reaches SURGE characters and dives where WINDOW lines in
a row weigh nothing. The heaviest stretch is the main text, with all up to the first and last stretch in the
smallest box (BOXES) that holds it, since a link list or an advert ends a stretch but not the text; with the short lines next to
it; and, if the box is an article or in one, with that element's other lines and the heading and lead ahead of it in its main element.
Lines of links within stay, lists of links (menus) go.

A class or role is noise as a whole name (comments, comment-list, but not comments-open), an id only of elements that are no
heading or section; an article, or an element that also has a name of BODY, is left out for two such names only.

The page is scanned once, in time linear in its length whatever it holds: a tag that is not closed is text, quotes that are not
closed do not count, and closing tags look only for what is open.

Defined cases: a null, empty or text-free page gives an empty string; unclosed and stray tags are tolerated; a page whose
text lies in one form is read again with forms allowed; one that loses all but LEFT of its text to names, with no article
or main element left, is read again without the rules on names; if no window surges, all remaining lines are kept (nothing is
capped, very long pages and lines included); of equally heavy stretches the first counts; repeated rows give equal
results; extra columns pass through, also text and n_chars (ours are then _text and _n_chars).
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, fresh, table

WINDOW = 3
SURGE = 60
LINKED = 0.6
LEFT = 0.05

# Element and name lists of HTML pages.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option",
    "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
DROPPED = {"aside", "audio", "button", "canvas", "datalist", "dialog", "head", "menu", "nav", "search", "select", "svg", "video"}
FORMS = {"form", "fieldset", "label", "input", "option"}
CLOSES_P = BLOCK - {"br", "option", "html", "body", "head"}
NOISE = {
    "ad", "ads", "adv", "advert", "advertisement", "adverts", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "sidebar", "aside", "rail", "nav", "navbar",
    "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "pagination", "pager", "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal",
    "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "discussion", "share",
    "sharing", "social", "related", "recommended", "recommendations", "widget", "widgets", "toolbar", "skip", "form", "search", "outbrain", "taboola", "paywall",
}
FRAME = {"header", "footer", "masthead", "topbar", "head", "foot", "copyright", "colophon", "contentinfo", "complementary", "legal"}
BODY = {"article", "content", "main", "post", "story", "entry", "body", "text", "title"}
#: Words that leave a compound name what its other words make it (comment-list, sidebar-left, site-header).
BESIDE = {
    "area", "bar", "block", "bottom", "box", "button", "buttons", "col", "column", "container", "global", "group", "header", "inner", "item", "items", "left", "link", "links", "list",
    "page", "panel", "posts", "primary", "right", "secondary", "section", "site", "slot", "sticky", "the", "top", "unit", "wrap", "wrapper",
}
HOLDERS = {"article", "main"}
BOXES = {"article", "body", "center", "div", "main", "section", "td"}
LISTS = {"ul", "ol", "dl"}
#: Elements whose id may be a section's own anchor and says nothing about its role.
ANCHORED = {"article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "p", "a", "li", "dt", "dd", "figure", "table"}
#: What ends an open element of the same kind, and what such an end does not reach beyond.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "blockquote", "aside", "nav", "select"}
PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>\"'=<]*)\s*+/?>")
OPENS = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
BETWEEN = re.compile(r"[\s/]*+")
NAME = re.compile(r"[^\s/>][^\s/>=]*+")
EQUALS = re.compile(r"\s*+=\s*+")
VALUE = re.compile(r"[^\s>]*+")
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
STATEMENT = re.compile(r"\s*(?:©|\(c\)\s*\d|copyright\s*(?:©|\(c\)|\d{4})|all rights reserved\W*$)", re.I)
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def scan(page: str):
    """Yield ("text", text, None), ("open", tag, attributes) and ("close", tag, None) in page order; raw elements are passed over."""
    n, at, begun = len(page), 0, 0
    last = {c: page.rfind(c) for c in ">\"'"}
    #: Up to here a tag with quotes was followed and found open; tags that begin before end at the next >.
    lost = 0

    def tag_end(i: int):
        """Attributes and the position after >, from a tag's name on; None if the tag's quotes or the page end first."""
        found = {}
        while True:
            i = BETWEEN.match(page, i).end()
            if i >= n:
                return None, i
            if page[i] == ">":
                return found, i + 1
            name = NAME.match(page, i)
            i, value = name.end(), ""
            if equals := EQUALS.match(page, i):
                i = equals.end()
                if i < n and page[i] in "\"'":
                    end = page.find(page[i], i + 1) if last[page[i]] > i else -1
                    if end < 0:
                        return None, i
                    value, i = page[i + 1 : end], end + 1
                else:
                    got = VALUE.match(page, i)
                    value, i = got[0], got.end()
            found.setdefault(name[0].lower(), value)

    while True:
        at = page.find("<", at)
        if at < 0 or at > last[">"] and not page.startswith("<!--", at):
            break
        tag, closing, attributes, after = None, "", None, 0
        if m := PLAIN.match(page, at):
            closing, tag, after, attributes = m[1], m[2].lower(), m.end(), {}
        elif m := OPENS.match(page, at):
            closing, tag = m[1], m[2].lower()
            if at >= lost:
                attributes, after = tag_end(m.end())
            if attributes is None:
                lost, attributes = max(lost, after), {}
                after = page.find(">", m.end()) + 1
        elif page.startswith("<!--", at):
            after = page.find("-->", at + 2) + 3
            after = n if after < 3 else after
        elif page.startswith(("<!", "<?", "</"), at):
            after = page.find(">", at) + 1
        else:
            at += 1
            continue
        if begun < at:
            yield "text", page[begun:at], None
        if tag:
            yield ("close", tag, None) if closing else ("open", tag, attributes)
            if tag in RAW and not closing:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, after)
                after = page.find(">", end.end()) + 1 if end and end.end() <= last[">"] else n
        at = begun = after
    if begun < n:
        yield "text", page[begun:], None


def _is_noise(tag: str, attributes: dict[str, str], inside: bool, forms: bool) -> tuple[bool, bool]:
    """Whether an element and all below it are left out, and whether only for a class, id or role. inside: it lies in an
    article or main element."""
    if tag in DROPPED or tag == "footer" or (tag == "header" and not inside) or (tag in FORMS and not forms):
        return True, False
    if not attributes or tag in ("html", "body"):
        return False, False
    if tag not in HOLDERS and "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or UNSEEN.search(attributes.get("style", "")):
        return True, False
    if tag == "main":
        return False, False
    keys = ("class", "role", "data-role") if tag in ANCHORED else ("class", "id", "role", "data-role")
    parts = [{x.lower() for x in NAMES.findall(n) if not x.isdigit()} for n in {n for k in keys for n in attributes.get(k, "").split()}]
    body = any(x & BODY and x <= BODY | BESIDE for x in parts)
    noise = sum(bool(x & NOISE) and x <= NOISE | FRAME | BODY | BESIDE for x in parts)
    if noise > (body or tag == "article"):
        return True, True
    gone = any(x & FRAME and x <= FRAME | BESIDE for x in parts) and not inside and not body and tag != "article"
    return gone, gone


class Line:
    """A line of a page: text, characters in links, statement of rights or not, innermost article or main, box and list."""

    __slots__ = ("box", "holder", "linked", "list", "text", "weight")

    def __init__(self, text: str, linked: int, place: "_Open"):
        self.text, self.linked, self.holder, self.box, self.list = text, linked, place.holder, place.box, place.list
        statement = len(text) < 200 and STATEMENT.match(text)
        self.weight = 0 if linked > LINKED * len(text) or statement else len(text)


class _Open:
    """An open element: whether it is left out, whether for a name, and the article or main, box and list it stands in or is."""

    __slots__ = ("box", "holder", "list", "named", "out", "tag")

    def __init__(self, tag: str, out: bool, named: bool, holder: int, box: int, list_: int):
        self.tag, self.out, self.named, self.holder, self.box, self.list = tag, out, named, holder, box, list_


class Boxes:
    """Nested elements, numbered in page order: those inside one have numbers from its own to its last."""

    def __init__(self):
        self.around, self.last = [0], [0]

    def open(self, around: int) -> int:
        self.around.append(around)
        self.last.append(len(self.around) - 1)
        return len(self.around) - 1

    def close(self, box: int) -> None:
        self.last[box] = len(self.around) - 1

    def within(self, inner: int, box: int) -> bool:
        return not box or box <= inner <= self.last[box]

    def common(self, low: int, high: int) -> int:
        """The smallest one around the boxes numbered low to high."""
        while not self.within(high, low):
            low = self.around[low]
        return low


def lines_of(page: str, forms: bool = False, named: bool = True) -> tuple[list[Line], Boxes, Boxes, int]:
    """A page's lines, its article and main elements, its boxes, and the characters left out for a class or id; these
    rules hold if named."""
    lines: list[Line] = []
    holders, boxes = Boxes(), Boxes()
    top = _Open("", False, False, 0, 0, 0)
    stack: list[_Open] = [top]
    #: Open elements by tag; those since the last of LIMITS.
    known, scopes = Counter(), [Counter()]
    pieces: list[str] = []
    linked, lists, lost = 0, 0, 0

    def close_line() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                lines.append(Line(text, min(linked, len(text)), stack[-1]))
            pieces.clear()
        linked = 0

    def pop_to(tags: set[str]) -> None:
        """Close the elements down to the innermost of tags, which is open."""
        while True:
            x = stack[-1]
            if x.tag in BLOCK:
                close_line()
            stack.pop()
            known[x.tag] -= 1
            if x.tag in LIMITS:
                scopes.pop()
            scopes[-1][x.tag] -= 1
            if x.holder > stack[-1].holder:
                holders.close(x.holder)
            if x.box > stack[-1].box:
                boxes.close(x.box)
            if x.tag in tags:
                return

    for kind, what, attributes in scan(page):
        now = stack[-1]
        if kind == "text":
            if now.out:
                lost += len(what.strip()) * now.named
                continue
            what = entities.unescape(what) if "&" in what else what
            pieces.append(what)
            if known["a"]:
                linked += len(what)
            continue
        tag = what
        if kind == "close":
            if tag == "br" or tag == "p" and not known["p"]:
                close_line()
            elif known[tag]:
                pop_to({tag})
            continue
        if tag in CLOSES_P or tag in ENDS:
            ends = ENDS.get(tag, set()) | {"p"}
            if any(scopes[-1][x] for x in ends):
                pop_to(ends)
                now = stack[-1]
        if tag in BLOCK:
            close_line()
        if tag in RAW or tag in VOID:
            continue
        noise, name = (True, now.named) if now.out else _is_noise(tag, attributes, now.holder > 0, forms)
        out = noise and (named or not name)
        new = _Open(tag, out, out and name, now.holder, now.box, now.list)
        if tag in HOLDERS and not out:
            new.holder = holders.open(now.holder)
        if tag in BOXES and not out:
            new.box = boxes.open(now.box)
        if tag in LISTS:
            lists += 1
            new.list = lists
        stack.append(new)
        known[tag] += 1
        scopes[-1][tag] += 1
        if tag in LIMITS:
            scopes.append(Counter())
    close_line()
    while len(stack) > 1:
        pop_to({stack[-1].tag})
    return lines, holders, boxes, lost


def stretches(lengths: list[int]) -> list[tuple[int, int]]:
    """[first, last] of each stretch between a surge and the dive after it, by sums over WINDOW lines."""
    n = len(lengths)
    total = [0]
    for x in lengths:
        total.append(total[-1] + x)
    ahead = [total[min(n, i + WINDOW)] - total[i] for i in range(n)]
    found, i = [], 0
    while i < n:
        if ahead[i] < SURGE or not lengths[i]:
            i += 1
            continue
        first = i
        while i < n and ahead[i]:
            i += 1
        last = i - 1
        while not lengths[last]:
            last -= 1
        found.append((first, last))
    return found


def _without_menus(lines: list[Line]) -> list[Line]:
    """lines without lists that are mostly links."""
    linked, size = Counter(), Counter()
    for x in lines:
        linked[x.list] += x.linked
        size[x.list] += len(x.text)
    return [x for x in lines if not x.list or linked[x.list] <= LINKED * size[x.list]]


def main_text(page: str | None) -> str:
    for forms in (False, True):
        lines, holders, boxes, lost = lines_of(page or "", forms)
        weight = sum(x.weight for x in lines)
        if lost and weight < LEFT * (weight + lost) and not any(x.weight and x.holder for x in lines):
            lines, holders, boxes, _ = lines_of(page or "", forms, False)
        if any(x.weight for x in lines):
            break
    else:
        return ""
    lines = _without_menus(lines)
    found, at = [], 0
    for _, run in groupby(x.holder for x in lines):
        size = len(list(run))
        found += [(at + a, at + b) for a, b in stretches([x.weight for x in lines[at : at + size]])]
        at += size
    if not found:
        return "\n".join(x.text for x in lines if x.weight)
    totals = [0]
    for x in lines:
        totals.append(totals[-1] + x.weight)
    first, last = max(found, key=lambda x: (totals[x[1] + 1] - totals[x[0]], -x[0]))
    holder = lines[first].holder
    if holder:
        # All of the element belongs to the text, and what stands ahead of it in its main element, up to another article.
        inside = [i for i, x in enumerate(lines) if holders.within(x.holder, holder)]
        first, last = inside[0], inside[-1]
        around = holders.around[holder]
        while around and first and lines[first - 1].holder == around and lines[first - 1].weight:
            first -= 1
        return "\n".join(x.text for x in lines[first : last + 1])
    weighty = [x.box for x in lines[first : last + 1] if x.weight]
    box = boxes.common(min(weighty), max(weighty))
    shared = [i for a, b in found for i in (a, b) if not lines[i].holder and boxes.within(lines[i].box, box)]
    first, last = min(first, *shared), max(last, *shared)
    while first and lines[first - 1].weight and not lines[first - 1].holder:
        first -= 1
    while last + 1 < len(lines) and lines[last + 1].weight and not lines[last + 1].holder:
        last += 1
    return "\n".join(x.text for x in lines[first : last + 1])


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """pages with text (the main text) and n_chars (its code points)."""
    text, size = fresh(pages, "text", "n_chars")

    def run(found):
        got = [main_text(p) for p in found]
        return [got, [len(t) for t in got]]

    return add_columns(pages, [column], f"`{text}` string, `{size}` long", run)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", F.col("html"))).drop("html")
