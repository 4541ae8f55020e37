"""Main text of web pages, by wrappers inferred per host.

A page is read as a tree of elements and text slots. Pages of a host are aligned one after another into its wrapper, a
union-free regular expression over that tree: elements in the same place are merged, runs of equal siblings (or of
equal sequences of siblings) become repeated groups, elements that some pages lack become optional, and differing
texts become slots. Each task aligns the pages it reads; the wrappers of tasks are aligned in turn, in two rounds, so
that a host with a third of all pages is never in one task. What is fixed in a wrapper, or is made of links, is
furniture of the host; with the elements that are furniture by their kind it is left out of the text.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlake.llm.shared import stored

#: A text slot is fixed if all of so many pages or more have the same text there; a slot holds a menu if so many
#: pages or more have such a share of its characters in links.
MIN_PAGES, LINKS = 5, 0.8
#: Siblings of a wrapper's element beyond which their order is given up (one optional repeated node for each kind): it
#: bounds what a host of irregular pages makes a task hold.
MAX_KIDS = 2000
#: Text outside of article and main elements belongs to the page's text where it is more than so many times theirs.
OUTSIDE = 3
#: Bytes of verdicts that may be broadcast; more are joined by host.
MAX_BROADCAST = 32 << 20
#: Wrappers that a task of the first round holds before it gives them to the next round.
MAX_HELD = 20_000
#: Groups of wrappers that one host is dealt over in the first round of alignment.
PARTS = 32

# Kinds of elements.
RAW = {"script", "style", "textarea", "title", "noscript", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
FURNITURE = {
    "aside", "button", "canvas", "datalist", "dialog", "embed", "fieldset", "footer", "form", "head", "iframe", "input", "legend",
    "menu", "nav", "noscript", "object", "optgroup", "option", "script", "select", "style", "svg", "template",
    "textarea", "title",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar"}
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "adbox", "banner", "breadcrumb", "breadcrumbs", "byline", "comment",
    "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promoted",
    "related", "reply", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "tags", "toolbar", "topbar", "widget", "widgets",
}
#: Names of what has articles or long texts of its own, which aren't the page's.
OWN_TEXT = {
    "ad", "ads", "advert", "adverts", "advertisement", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus", "gdpr",
    "login", "modal", "newsletter", "popup", "promo", "promoted", "related", "reply", "replies", "respond", "sponsor", "sponsored",
}
#: Names that even a single paragraph of an article is left out for.
ADVERTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "adbox", "consent", "cookie", "cookies", "gdpr", "newsletter", "notice", "notices", "promo",
    "promoted", "sponsor", "sponsored", "subscribe", "signup",
}
CONTAINERS = {
    "article", "aside", "center", "details", "dir", "div", "dl", "figure", "footer", "form", "header", "hgroup", "main", "menu", "nav", "ol", "section", "table", "ul",
}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "select", "body", "html", "article", "div", "section", "main", "nav", "aside"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>|(?P<cut></?[a-zA-Z][^>]*\Z)|(?P<text>[^<]+|<)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
_GAP = re.compile(r"\s+")
_HEADING = re.compile(r"/(?:article|main)\b.*/h[1-6]\b[^/]*/#$")
_NO_DISPLAY = re.compile(r"\bdisplay\s*:\s*none\b", re.I)
_DIGITS = re.compile(r"\d{3,}")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """('open' | 'close' | 'text', name or text, attributes); comments, declarations and a cut-off last tag are left out."""
    pos = 0
    while m := _TOKEN.match(page, pos):
        pos = m.end()
        if m["text"] is not None:
            yield "text", m["text"], ""
            continue
        name = m["name"] or m["name2"]
        if not name:
            continue
        name, end, rest = name.lower(), m["end"] or m["end2"], m["rest"] or m["rest2"] or ""
        yield "close" if end else "open", name, rest
        if not end and name in RAW and not rest.endswith("/"):
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, pos)
            if name in ("title", "textarea"):
                yield "text", page[pos : close.start() if close else len(page)], ""
            yield "close", name, ""
            pos = close.end() if close else len(page)


# What an element is by itself: content, furniture by its name outside of articles, by its name, the same with text of
# its own, furniture by its kind.
CONTENT, SOFT, NAMED, OWNING, KIND = range(5)


def _kind(name: str, rest: str) -> tuple[str, int]:
    """The symbol of an element (name and classes; long numbers in them are all alike), and whether it is furniture by its kind or name."""
    marks, bad = [], KIND if name in FURNITURE else SOFT if name == "label" else CONTENT
    if rest and not rest.isspace():
        for key, value in _ATTR.findall(rest):
            key, value = key.lower(), value.strip("\"'")
            if key == "role":
                marks.append(value)
                bad = KIND if value.lower() in ROLES else bad
            elif key in ("class", "id"):
                if key == "class":
                    marks.append(_DIGITS.sub("0", value))
                if name not in ("html", "body"):
                    bad = max(bad, _by_name(name, {w.lower() for w in _WORD.findall(value)} & NAMES))
            elif key == "hidden" and value.lower() != "false" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _NO_DISPLAY.search(value):
                bad = KIND
    return name + ("." + ".".join(sorted(" ".join(marks).split())) if marks else ""), bad


def _by_name(name: str, words: set[str]) -> int:
    if not words:
        return CONTENT
    if words == {"header"} or name not in CONTAINERS and ADVERTS.isdisjoint(words):
        return SOFT
    return NAMED if OWN_TEXT.isdisjoint(words) else OWNING


class Visitor:
    """What walk() tells of a page."""

    def enter(self, sym: str, name: str, bad: int) -> None: ...

    def leave(self, name: str) -> None: ...

    def text(self, text: str, linked: bool) -> None: ...

    def brk(self) -> None: ...


def walk(page: str, to: Visitor) -> None:
    """Reads a page as a tree: missing end tags are put in, stray ones left out. Inline elements aren't entered, but
    furniture is, inline or not."""
    stack: list[tuple[str, bool]] = []  # name, entered
    links = 0

    def pop() -> None:
        nonlocal links
        name, entered = stack.pop()
        links -= name == "a"
        if entered:
            to.leave(name)

    for what, name, rest in tokens(page):
        if what == "text":
            to.text(name, links > 0)
        elif what == "open":
            if name in BLOCK:
                if any(n == "p" for n, _ in stack):
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == "p":
                            while len(stack) > i:
                                pop()
                            break
                        if stack[i][0] in BLOCK:
                            break
                if name in CLOSES:
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] in CLOSES[name]:
                            while len(stack) > i:
                                pop()
                            break
                        if stack[i][0] in SCOPE:
                            break
            if name in VOID or rest.endswith("/") and name not in BLOCK:
                if name in ("br", "hr", "wbr"):
                    to.brk()
                continue
            sym, bad = _kind(name, rest)
            entered = name in BLOCK or bad > CONTENT
            stack.append((name, entered))
            links += name == "a"
            if entered:
                to.enter(sym, name, bad)
        else:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    while len(stack) > i:
                        pop()
                    break
                if name not in BLOCK and stack[i][0] in BLOCK:
                    break
    while stack:
        pop()


# Wrappers: a node is [symbol, pages, repeated, kids, text, characters, characters in links, stories]; text slots have
# the symbol "#" and as text the one they always have, or None; an element has a hash of the text that it always has, or
# None. A node is optional if it has fewer pages than its parent.
# stories tells pages apart that aren't copies of one another: hashes of the longest texts of up to MIN_PAGES of them.
# A page's tree that is to be placed in a wrapper also has the places of the elements and slots that a node was made of.
S, N, REP, KIDS, TEXT, CHARS, LINK, STORIES, PLACES = range(9)


class _Tree(Visitor):
    def __init__(self, placed: bool) -> None:
        self.root = ["", 1, False, [], None, 0, 0, [], []]
        self.stack = [self.root]
        self.longest = ""
        self.placed, self.clock = placed, 0

    def enter(self, sym: str, name: str, bad: int) -> None:
        self.clock += 1
        node = [sym, 1, False, [], None, 0, 0, [], [self.clock] if self.placed else []]
        self.stack[-1][KIDS].append(node)
        self.stack.append(node)

    def leave(self, name: str) -> None:
        self.clock += 1
        node = self.stack.pop()
        node[TEXT] = hash_text("\n".join(kid[TEXT] for kid in node[KIDS])) if node[KIDS] else ""
        node[KIDS] = fold(node[KIDS])

    def text(self, text: str, linked: bool) -> None:
        text = _GAP.sub(" ", text).strip()
        if text:
            self.longest = max(self.longest, text, key=len)
            kids = self.stack[-1][KIDS]
            if kids and kids[-1][S] == "#":
                slot = kids[-1]
                slot[TEXT] = _short(slot[TEXT] + " " + text)
            else:
                slot = ["#", 1, False, [], _short(text), 0, 0, [], [~self.clock] if self.placed else []]
                kids.append(slot)
            slot[CHARS] += len(text)
            slot[LINK] += len(text) * linked


def _short(text: str) -> str:
    """The text, or a stand-in for a long one."""
    return text if len(text) <= 80 else f"{len(text)}:{hash_text(text)}"


def hash_text(text: str) -> str:
    import zlib

    raw = text.encode("utf-8", "surrogatepass")
    return f"{zlib.crc32(raw):08x}{zlib.adler32(raw):08x}"


def tree_of(page: str, placed: bool = False) -> list:
    """The page as a wrapper of its own. Places: elements are numbered by the tags before them, a slot by ~ of that."""
    t = _Tree(placed)
    walk(page, t)
    t.root[KIDS] = fold(t.root[KIDS])
    story, todo = [hash_text(t.longest)], [t.root]
    while todo:
        node = todo.pop()
        node[STORIES] = story
        todo += node[KIDS]
    return t.root


def _merge(a: list, b: list, again: bool = False) -> list:
    """Two nodes of a symbol in one. again: both stand in the same page, so pages aren't added up."""
    kids = _align(a[KIDS], b[KIDS], again)
    text = a[TEXT] if a[TEXT] == b[TEXT] else None
    stories = a[STORIES] if again or a[STORIES] == b[STORIES] else sorted({*a[STORIES], *b[STORIES]})[:MIN_PAGES]
    return [a[S], max(a[N], b[N]) if again else a[N] + b[N], a[REP] or b[REP] or again, kids, text, a[CHARS] + b[CHARS], a[LINK] + b[LINK], stories, a[PLACES] + b[PLACES]]


def fold(kids: list[list]) -> list[list]:
    """Repeated groups: runs of equal symbols become one node, then runs of equal sequences of 2 to 4 symbols."""
    out: list[list] = []
    for node in kids:
        if out and out[-1][S] == node[S]:
            out[-1] = _merge(out[-1], node, again=True)
        else:
            out.append(node)
    for width in (2, 3, 4):
        i = 0
        while i + 2 * width <= len(out):
            if all(out[i + j][S] == out[i + width + j][S] for j in range(width)):
                out[i : i + 2 * width] = [_merge(x, y, again=True) for x, y in zip(out[i : i + width], out[i + width : i + 2 * width], strict=True)]
            else:
                i += 1
    return _unordered(out) if len(out) > MAX_KIDS else out


def _unordered(kids: list[list]) -> list[list]:
    by: dict[str, list] = {}
    for node in kids:
        by[node[S]] = _merge(by[node[S]], node, again=True) if node[S] in by else node
    return list(by.values())


def matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The pairs of places of a longest common subsequence, in order; a row of its table is the bits of one number."""
    first, last = 0, 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    x, y = a[first : len(a) - last], b[first : len(b) - last]
    where: dict[str, int] = {}
    for j, sym in enumerate(y):
        where[sym] = where.get(sym, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows, row = [], full
    for sym in x:
        both = row & where.get(sym, 0)
        row = (row + both | row - both) & full
        rows.append(row)
    middle, i, j = [], len(x), len(y)
    while i and j:
        if rows[i - 1] >> j - 1 & 1:  # y[j - 1] adds nothing
            j -= 1
        elif i > 1 and not rows[i - 2] >> j - 1 & 1:  # nor does x[i - 1]
            i -= 1
        else:
            i, j = i - 1, j - 1
            middle.append((first + i, first + j))
    ends = [(len(a) - k, len(b) - k) for k in range(last, 0, -1)]
    return [(k, k) for k in range(first)] + middle[::-1] + ends


def _align(a: list[list], b: list[list], again: bool = False) -> list[list]:
    """Two sequences of siblings in one: a longest common subsequence of symbols is merged, the rest is optional."""
    out, i, j = [], 0, 0
    for k, m in matches([x[S] for x in a], [x[S] for x in b]):
        out += [*a[i:k], *b[j:m], _merge(a[k], b[m], again)]
        i, j = k + 1, m + 1
    if i == len(a) and j == len(b) and len(out) == len(a) == len(b):
        return out
    return fold(out + a[i:] + b[j:])


def align_pages(wrapper: list | None, other: list) -> list:
    """The wrapper that covers both."""
    return other if wrapper is None else _merge(wrapper, other)


def furniture(wrapper: list) -> tuple[list[str], str | None]:
    """Paths of the host's furniture: slots with the same text on all of MIN_PAGES or more pages while others differ,
    and elements that are made of links; within an article or main element only those with the same text on all pages
    (its own lists of links, such as references, stay). Pages with the same longest text count once. Headings of an
    article stay.

    Where siblings of one symbol share a path and some of them are content, the path is left out; pages of the host
    are to be placed in the second value then, the wrapper as JSON of nodes [symbol, furniture, kids].
    """
    found: dict[str, set[bool]] = {}
    varies = False

    def visit(node: list, path: str, inside: bool) -> tuple[int, int, list]:
        nonlocal varies
        inside = inside or node[S].split(".")[0] in ("article", "main")
        enough = len(node[STORIES]) >= MIN_PAGES
        chars, link, kids = node[CHARS], node[LINK], []
        for kid in node[KIDS]:
            c, k, place = visit(kid, f"{path}/{kid[S]}", inside)
            chars, link = chars + c, link + k
            kids.append(place)
        if node[S] == "#":
            varies = varies or node[TEXT] is None
            bad = node[TEXT] is not None and not node[REP] and enough and not _HEADING.search(path)
        else:
            menu = enough and chars and link >= LINKS * chars and node[S].split(".")[0] in ("ul", "ol", "div", "table", "dl")
            bad = bool(menu and (not inside or node[TEXT] is not None))
        return chars, link, [node[S], bad, kids]

    root = visit(wrapper, "", False)[2]

    def settle(node: list, path: str) -> bool:
        """Gathers the verdicts of each path; whether anything in the node is furniture."""
        node[1] = node[1] and (varies or node[0] != "#")
        found.setdefault(path, set()).add(node[1])
        inside = [settle(kid, f"{path}/{kid[0]}") for kid in node[2]]
        if node[1] or not any(inside):
            node[2] = []
        return node[1] or any(inside)

    settle(root, "")
    mixed = any(len(v) > 1 for v in found.values())
    return sorted(p for p, v in found.items() if v == {True}), json.dumps(root) if mixed else None


def places(kids: list[list], wrapper: list[list]) -> set[int]:
    """Places of furniture in a page's siblings, placed in a wrapper's. What a wrapper's group has taken in so that
    it can't be placed is furniture if it is so in all places for its symbol."""

    def of(kid: list, node: list) -> set[int]:
        return set(kid[PLACES]) if node[1] else places(kid[KIDS], node[2]) if node[2] else set()

    found = dict(matches([x[S] for x in kids], [x[S] for x in wrapper]))
    out: set[int] = set()
    for i, kid in enumerate(kids):
        if i in found:
            out |= of(kid, wrapper[found[i]])
        else:
            same = [of(kid, node) for node in wrapper if node[S] == kid[S]]
            out |= set.intersection(*same) if same else set()
    return out


class _Named:
    """An element that is furniture by its name: what it holds decides whether the name is right."""

    def __init__(self, owning: bool) -> None:
        self.owning = owning
        self.chars, self.blocks, self.main, self.article = 0, 0, False, False


class _Text(Visitor):
    """Collects blocks of (main region, elements that are furniture by their name, text)."""

    def __init__(self, out: set[str | int]) -> None:
        self.out, self.path, self.bad = out, [""], 0
        self.clock = 0
        self.marks: list[tuple[bool, tuple[_Named, ...]]] = []
        self.named: tuple[_Named, ...] = ()
        self.main, self.mains = 0, set()
        self.blocks: list[tuple[bool, list[tuple[tuple[_Named, ...], str, bool]]]] = []
        self.now: list[tuple[tuple[_Named, ...], str, bool]] = []
        self.chars, self.plain = 0, 0

    def _flush(self) -> None:
        if self.now:
            self.blocks.append((self.main > 0, self.now))
            self.now = []

    def enter(self, sym: str, name: str, bad: int) -> None:
        if name in BLOCK:
            self._flush()
        self.clock += 1
        path = f"{self.path[-1]}/{sym}"
        region = name in ("article", "main")
        if bad == SOFT:
            bad = CONTENT if self.main else NAMED
        outside = name == "header" and self.main == 0
        out = bad == KIND or outside or path in self.out or self.clock in self.out
        self.path.append(path)
        self.marks.append((out, self.named))
        self.bad += out
        for box in self.named:
            box.blocks += name in BLOCK and not self.bad
        if region and not self.bad:
            self.mains.add(self.named)
            for box in self.named if self.main == 0 else ():
                box.main = box.main or name == "main"
                box.article = box.article or name == "article" and bad == CONTENT
        elif bad in (NAMED, OWNING) and not self.bad:
            self.named = (*self.named, _Named(bad == OWNING))
        self.main += region

    def leave(self, name: str) -> None:
        if name in BLOCK:
            self._flush()
        self.clock += 1
        self.path.pop()
        out, self.named = self.marks.pop()
        self.bad -= out
        self.main -= name in ("article", "main")

    def text(self, text: str, linked: bool) -> None:
        if not self.bad and f"{self.path[-1]}/#" not in self.out and ~self.clock not in self.out:
            self.now.append((self.named, html.unescape(text), linked))
            if not linked:
                size = len(text.strip())
                self.chars += size
                self.plain += size * (not self.named)
                for box in self.named:
                    box.chars += size

    def brk(self) -> None:
        self.now.append(((), " ", True))

    def result(self) -> list[str]:
        """A name is set aside if its element holds a main element, or blocks with most of the page's text outside
        links, or, where no article or main element is outside of such elements, an article. Names of OWN_TEXT need a
        main element, or an article and more text than there is outside. What is in articles of an element that
        isn't most of the page doesn't rule out what is outside of them, nor do articles that are small beside that."""
        self._flush()
        plain = () in self.mains

        def layout(box: _Named) -> bool:
            return box.main or box.blocks > 0 and 2 * box.chars > self.chars and not box.owning

        def kept(named: tuple[_Named, ...]) -> bool:
            return all(layout(x) or x.article and not plain and (not x.owning or x.chars > self.plain) for x in named)

        exclusive = any(all(layout(x) or x.chars >= self.plain and not x.owning for x in m) and kept(m) for m in self.mains)
        size = [0, 0]  # characters outside links: not in, and in main regions
        for main, pieces in self.blocks:
            size[main] += sum(len(t.strip()) for named, t, linked in pieces if not linked and kept(named))
        exclusive = exclusive and size[0] <= OUTSIDE * size[1]
        out = []
        for main, pieces in self.blocks:
            text = _GAP.sub(" ", "".join(t for named, t, _ in pieces if kept(named))).strip() if main or not exclusive else ""
            if text:
                out.append(text)
        return out


def main_text(page: str, out: set[str | int]) -> str:
    """The blocks of the page outside furniture (paths and places), joined by \\n; those in an article or main element,
    if there is one that isn't small beside the rest."""
    t = _Text(out)
    walk(page, t)
    return "\n".join(t.result())


def host_of(col: str = "url") -> Column:
    """The lower-cased host; empty where there is none or the url is null."""
    return F.lower(F.coalesce(F.regexp_extract(col, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _combined(key: Callable, read: Callable, by_key: bool = False) -> Callable:
    """A streaming task that aligns what it reads, by host (and part), and gives a wrapper for each.

    In the first round more than MAX_HELD wrappers are given early, for a later round to align. by_key: rows come sorted
    by key, and a wrapper is given when the next key begins: one for each, however many there are.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}
        for batch in batches:
            done: dict[tuple, list] = {}
            for row in batch.itertuples(index=False):
                k = key(row)
                if by_key and k not in held:
                    done.update(held)
                    held.clear()
                held[k] = align_pages(held.get(k), read(row))
            if by_key:
                yield frame(done)
            elif len(held) > MAX_HELD:
                yield frame(held)
                held = {}
        yield frame(held)

    def frame(held: dict[tuple, list]) -> pd.DataFrame:
        return pd.DataFrame([(h, p, json.dumps(w)) for (h, p), w in held.items()], columns=["host", "part", "wrapper"])

    return run


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, part, wrapper): the wrapper of each host in ``pages`` (url, html), as JSON. A null html is an empty page.

    A host's pages are dealt over PARTS parts by a hash; what later rounds align comes in a fixed order, so a task that
    runs again finds the same wrapper.
    """
    schema = "host string, part int, wrapper string"
    part = F.pmod(F.xxhash64("url", "html"), F.lit(PARTS)).cast("int")
    rows = pages.select(host_of().alias("host"), F.coalesce("html", F.lit("")).alias("html"), part.alias("part"))
    mapped = rows.mapInPandas(_combined(lambda r: (r.host, r.part), lambda r: tree_of(r.html)), schema)
    few = mapped.repartition("host", "part").sortWithinPartitions("host", "part", "wrapper")
    few = few.mapInPandas(_combined(lambda r: (r.host, r.part), lambda r: json.loads(r.wrapper), by_key=True), schema)
    by_host = few.repartition("host").sortWithinPartitions("host", "part")
    return by_host.mapInPandas(_combined(lambda r: (r.host, 0), lambda r: json.loads(r.wrapper), by_key=True), schema)


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: (page_id, url, text, n_chars). A page without main text, or null, gives an empty text."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [furniture(json.loads(w)) for w in batch["wrapper"]]
            yield pd.DataFrame({"_host": batch["host"], "_out": [out for out, _ in found], "_tree": pd.Series([tree for _, tree in found], dtype=object)})

    verdicts = stored(infer_wrappers(pages).mapInPandas(judge, "_host string, _out array<string>, _tree string"), "wrappers")
    octets = F.octet_length("_host") + F.octet_length(F.array_join("_out", "|")) + F.coalesce(F.octet_length("_tree"), F.lit(0))
    size = verdicts.agg(F.sum(octets + 64)).head()[0] or 0
    if size <= MAX_BROADCAST:
        verdicts = F.broadcast(verdicts)

    @F.pandas_udf("string")
    def text_of(page: pd.Series, out: pd.Series, tree: pd.Series) -> pd.Series:
        trees: dict[str, list] = {}

        def text(p: str, o: list[str] | None, t: str | None) -> str:
            if t and t not in trees:
                trees[t] = json.loads(t)[2]
            found = places(tree_of(p, placed=True)[KIDS], trees[t]) if t else set()
            return main_text(p, found.union(o if o is not None else ()))

        return pd.Series([text(p or "", o, t) for p, o, t in zip(page, out, tree, strict=True)], dtype=object)

    rows = pages.select("page_id", "url", "html", host_of().alias("_host")).join(verdicts, "_host", "left")
    return rows.select("page_id", "url", text_of("html", "_out", "_tree").alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op7_html_text(spark, sf_dir):
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
