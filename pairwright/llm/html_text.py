"""Main text of HTML pages by wrappers inferred from pages of the same host.

A page is read as a stream of tags and texts, balanced into a tree. The trees of a
host are aligned one after the other to its wrapper, a union-free regular expression:
children that only some pages have become optional, runs of like children whose
number differs a repeated group, texts that differ a slot. Tasks align their own
pages, then the wrappers of one host are aligned in rounds of bounded groups, so all
pages count and no task holds a host.

Pages are then matched to their wrapper, which gives each text a position. A value
that most pages have at one position is the host's own; a position is a slot of main
text or not by where its other values lie, counted in characters over all pages.
Article and main elements and telling names are evidence for that. What a wrapper
doesn't know is judged by where it lies in the page.
"""

from __future__ import annotations

import heapq
import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import join_by_size, stage

COUNTS_HELD = 200_000  # counts a task holds before it gives them on
COUNTED = pa.schema([("host", pa.string()), *((n, pa.int64()) for n in "path digest pages low high main chars".split()),
                     ("kind", pa.int32())])
DEEPEST, MOST_RUNS = 200, 1_000  # pages nested deeper or with longer lists of unlike children are not aligned
OUTSIDE_CHARS, OUTSIDE_TIMES = 250, 4  # text outside longer than this, and so often a landmark's: not the article's
LEAST_SHARED, LEAST_SHARE = 3, 20  # pages that must share a text of the host's, and one in so many
IN_ARTICLE, IN_ARTICLE_TENTHS = 5, 9  # the same inside articles, in tenths of the pages
FIXED_RUN = 8  # like neighbours up to so many, the same on all pages, have positions of their own
FAN_IN, HOSTS_HELD = 16, 1_000  # wrappers merged by a task on average, and held by a task that infers
WRAPPER_PARTS = 20_000  # of larger wrappers the parts with fewest pages go; their texts are judged by the page
FIXED, REPEATED, ARTICLE = 0, 1, 2  # kinds of positions

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template svg math head title iframe object select textarea button canvas audio video".split())
RAW = ("script", "style", "textarea", "title")
INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr br img".split()
)
FURNITURE = set("nav footer aside form menu dialog fieldset".split())
BESIDE = {"aside", "footer"}  # an article inside is a teaser; other furniture may be an element left open
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                 "th": {"td", "th"}, "option": {"option"}}
SUBHEADINGS = set("h2 h3 h4 h5 h6".split())
HEADINGS = SUBHEADINGS | {"h1"}
PROSE = HEADINGS | set("p blockquote".split())
OWN = PROSE | set("li dt dd td th pre figcaption".split())  # an article's own, also where all pages share them
LISTS = set("ul ol dl table menu select".split())
# Names in class, id and role attributes that mark what is not the article.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs toolbar sidebar aside rail footer foot masthead topbar "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall newsletter subscribe "
    "subscription signup login register search share sharing social related recommended recommendations teaser widget "
    "pagination pager copyright legal disclaimer skip tags contentinfo complementary form dialog "
    "logo brand branding announcement privacy crumbs sitemap dropdown hamburger drawer subnav sidenav".split()
)
COMMENTS = set("comment comments commentlist disqus reply replies respond responses discussion feedback".split())
# Words that may stand beside them in one name.
BESIDES = set(
    "site page main top bottom left right global primary secondary block box wrapper wrap container inner outer content area "
    "section bar list item items link links unit slot zone group row col column inline sticky fixed mobile desktop small large "
    "post posts article articles story stories text header head body widget widgets icon icons button buttons btn title label "
    "user users reader readers view all js fb facebook twitter linkedin whatsapp social policy email more our us the".split()
)
HEADERS = set("header head banner masthead".split())  # of a page, unless they lie in its article
TITLES = set("post entry article story".split())  # an article's own header
STATES = set("with has no without".split())  # as in has-sidebar: not the thing itself
UNSEEN = re.compile(r"(?:\A|\s)hidden(?=\s|=|/|\Z)|display\s*:\s*none", re.I)

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"""
    r"""<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<""",
    re.S,
)
NAMED = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(slots=True)
class Node:
    """An element; children are Nodes and texts."""

    key: str  # name and marks, digits left out
    name: str
    mark: str = ""  # furniture, named (furniture by its name), comments, article, main, header or empty
    children: list = field(default_factory=list)
    chars: int = 0  # of texts outside of links and furniture elements


@lru_cache(maxsize=50_000)
def kind_of(name: str, attributes: str) -> tuple[str, str]:
    """Key and mark of an element."""
    found = [(a.lower(), html.unescape(v.strip("\"'"))) for a, v in NAMED.findall(attributes)]
    names = [{w.lower() for w in WORDS.findall(n)} for a, v in found for n in v.split()]
    words = set().union(*names)
    shown = ".".join(re.sub(r"\d+", "", v).strip() for a, v in found if a in ("class", "id") and v)
    plain = not words & STATES and name not in ("html", "body", "main")

    def named(kinds: set) -> bool:
        """Whether a whole name says so, not a part of another name."""
        return plain and any(n & kinds and all(w in kinds or w in BESIDES or len(w) == 1 for w in n) for n in names)

    if named(COMMENTS):
        mark = "comments"
    elif name in FURNITURE or UNSEEN.search(re.sub(r"class\s*=\s*(\"[^\"]*\"|'[^']*')", "", attributes)):
        mark = "furniture"
    elif named(MARKS):
        mark = "named"
    elif name == "article" or "articlebody" in {v.lower() for a, v in found if a == "itemprop"}:
        mark = "article"
    elif name == "main" or ("role", "main") in found:
        mark = "main"
    else:
        page_header = name == "header" or (named(HEADERS) and name not in ("h1", "h2"))
        mark = "header" if page_header and not words & TITLES else ""
    return f"{name}.{shown}" if shown else name, mark


def parse(page: str) -> Node:
    """The balanced tree of a page; open elements end with the page."""
    root = Node("", "")
    stack = [root]
    made: list[tuple[Node, Node]] = []  # nodes with their parents
    at = 0
    while found := TOKEN.match(page, at):
        at = found.end()
        text = found.group()
        close, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if name is None:
            if text.startswith("<![CDATA["):
                stack[-1].children.append(text[9:].removesuffix("]]>"))
            elif text == "<" or not text.startswith("<"):
                stack[-1].children.append(html.unescape(text))
            continue
        name = name.lower()
        if close:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
                if name in INLINE and stack[depth].name not in INLINE:
                    break  # formatting ends inside its block only
            continue
        if name in CLOSES_ITSELF or name not in INLINE:
            ends = CLOSES_ITSELF.get(name, set()) | (set() if name in INLINE or name in VOID else {"p"})
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in ends:
                    del stack[depth:]
                    break
                if stack[depth].name not in INLINE and stack[depth].name != "p":
                    if stack[depth].name in LISTS or stack[depth].name not in ("li", "dt", "dd", "td", "th"):
                        break
        key, mark = kind_of(name, attributes or "")
        node = Node(key, name, mark)
        stack[-1].children.append(node)
        made.append((node, stack[-1]))
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not (attributes or "").endswith("/"):
            stack.append(node)
    weigh(root, made)
    return root


def weigh(root: Node, made: list[tuple[Node, Node]]):
    """Sets ``chars``; a name alone makes no furniture of what holds most of a page without landmarks."""
    for node, parent in [*reversed(made), (root, None)]:
        node.chars += sum(len(c.strip()) for c in node.children if isinstance(c, str))
        if parent and node.name not in HIDDEN and node.name != "a" and node.mark not in ("furniture", "comments"):
            parent.chars += node.chars
    marked = any(n.mark in ("article", "main") for n, _ in made)
    for node, _ in made:
        if node.mark == "named":
            most = node.chars > OUTSIDE_CHARS and 4 * node.chars > 3 * root.chars
            node.mark = "" if most and not marked else "furniture"


@dataclass(slots=True)
class Piece:
    """A text of a page and where it lies."""

    path: int  # digest of its position in the wrapper, else of the keys above
    text: str
    block: int  # texts of one block are joined
    area: str  # article, main or empty
    furniture: bool
    linked: bool
    tag: str  # of the element of its block
    parent: int  # number of the element around that
    repeated: bool  # no position of its own
    rescued: bool = False  # a landmark inside furniture


def pieces_of(page: str, wrapper: Part | None = None) -> list[Piece]:
    """All texts of a page in order, with their block, place and position in the wrapper."""
    out: list[Piece] = []
    block = elements = 0
    root = parse(page)
    if wrapper is not None and not alignable(root):
        wrapper = None
    # (node, part, path, repeated, area, furniture, comments, linked, beside, rescued, (tag, own, parent));
    # a marker closes a block
    todo: list = [(root, wrapper, 0, wrapper is None, "", False, False, False, False, False, ("", 0, 0))]
    while todo:
        entry = todo.pop()
        if entry is None:
            block += 1
            continue
        node, part, path, repeated, area, furniture, comments, linked, beside, rescued, place = entry
        if isinstance(node, str):
            if node.strip():
                out.append(Piece(path, node, block, area, furniture or comments, linked, place[0], place[2], repeated, rescued))
            elif node and out and out[-1].block == block:
                out[-1].text += " "
            continue
        if node.name in HIDDEN:
            continue
        if node.name == "br":
            if out and out[-1].block == block:
                out[-1].text += " "
            continue
        comments = comments or node.mark == "comments"
        beside = beside or node.name in BESIDE
        if node.mark == "furniture" or (node.mark == "header" and not area):
            furniture = True
        elif node.mark in ("article", "main") and not comments and not beside:
            rescued = rescued or furniture
            furniture = False  # an element left open before the article ends there
            area = "article" if "article" in (area, node.mark) else "main"
        linked = linked or node.name == "a"
        inline = node.name in INLINE
        if not inline:
            elements += 1
            place = (node.name, elements, place[1])
        inner = [
            (child, found, where, repeated or again, area, furniture, comments, linked, beside, rescued, place)
            for child, (found, where, again) in zip(node.children, positions(node, part, path))
        ]
        inner.reverse()
        if inline:
            todo += inner
        else:
            block += 1
            todo += [None, *inner]
    return out


def positions(node: Node, part: Part | None, path: int) -> list[tuple]:
    """(part, position, whether it is repeated) of each child; without a part the path of keys."""
    if part is None:
        return [(None, path if isinstance(c, str) else xxhash.xxh64_intdigest(f"{path}/{c.key}") >> 1, True)
                for c in node.children]
    runs: list[str] = []
    at = []  # run of each child and place in it
    for child in node.children:
        key = "#" if isinstance(child, str) else child.key
        if not child.strip() if key == "#" else child.name in HIDDEN:
            at.append(None)
        elif runs and runs[-1] == key:
            place += 1
            at.append((len(runs) - 1, place))
        else:
            place = 0
            runs.append(key)
            at.append((len(runs) - 1, 0))
    keys = tuple(runs)
    if keys not in part.known:
        if len(part.known) > 1_000:
            part.known.clear()
        part.known[keys] = dict(common(runs, [p.key for p in part.parts]))
    found = part.known[keys]
    out = []
    for child, where in zip(node.children, at):
        if where is None:
            out.append((None, path, True))
            continue
        run, place = where
        if run not in found:
            out.append((None, xxhash.xxh64_intdigest(f"{path}?{keys[run]}") >> 1, True))
            continue
        own = part.parts[found[run]]
        if own.key == "#" or own.high == 1:
            out.append((own, own.position, False))
        elif own.low == own.high <= FIXED_RUN:
            out.append((own, xxhash.xxh64_intdigest(f"{own.position}+{place}") >> 1, False))
        else:
            out.append((own, own.position, True))
    return out


def area_of(pieces: list[Piece]) -> str:
    """The area that holds the article by the page's own evidence.

    Of article and main the one with more text, unless a much longer text lies
    outside both. A landmark inside furniture counts where nothing longer lies
    outside of it; else its pieces become furniture.
    """
    chars = {"article": 0, "main": 0, "": 0, "rescued": 0}
    for p in pieces:
        if not p.furniture and (p.area or not p.linked):
            chars["rescued" if p.rescued else p.area] += len(p.text.strip())
    if chars["rescued"]:
        if chars["article"] or chars["main"] or chars[""] > chars["rescued"]:
            for p in pieces:
                p.furniture = p.furniture or p.rescued
        else:
            for p in pieces:
                if p.rescued and not p.furniture:
                    chars[p.area] += len(p.text.strip())
    marked = max(chars["article"], chars["main"])
    if not marked or chars[""] > max(OUTSIDE_CHARS, OUTSIDE_TIMES * (chars["article"] + chars["main"])):
        return ""
    return "article" if chars["article"] == marked else "main"


# --- wrappers ---------------------------------------------------------------


@dataclass(slots=True)
class Part:
    """A child in a wrapper: a constant text, a slot, or an element with parts."""

    key: str  # "#" for texts
    text: str | None = None  # None: a slot
    optional: bool = False
    low: int = 1  # least and greatest number of like neighbours on a page
    high: int = 1
    parts: list = field(default_factory=list)
    pages: int = 1  # aligned on so many
    position: int = 0
    known: dict = field(default_factory=dict)  # matches of page children found before

    @property
    def repeated(self) -> bool:
        return self.low != self.high

    def __str__(self) -> str:
        if self.key == "#":
            inner = "#text" if self.text is None else self.text
        else:
            inner = f"<{self.key}>" + "".join(map(str, self.parts)) + "</>"
        mark = "*" if self.optional and self.repeated else "?" if self.optional else "+" if self.repeated else ""
        return f"({inner}){mark}" if mark else inner


def folded(children: list, texts: bool = True) -> list[Part]:
    """Parts of one page's children; like neighbours become one part with their number.

    Without ``texts`` all texts are slots.
    """
    out: list[Part] = []
    for child in children:
        if isinstance(child, str):
            if not child.strip():
                continue
            part = Part("#", " ".join(child.split()) if texts else None)
        elif child.name in HIDDEN:
            continue
        elif not texts and out and out[-1].key == child.key and only_text(child) and \
                len(out[-1].parts) == 1 and out[-1].parts[0].key == "#":
            out[-1].low = out[-1].high = out[-1].high + 1
            continue
        else:
            part = Part(child.key, None, parts=folded(child.children, texts))
        if out and out[-1].key == part.key and part.key != "#":
            number = out[-1].high + 1
            out[-1] = joined(out[-1], part)
            out[-1].low = out[-1].high = number
        elif out and out[-1].key == "#" == part.key:
            out[-1].text = f"{out[-1].text} {part.text}" if texts else None
        else:
            out.append(part)
    return out


def only_text(node: Node) -> bool:
    return len(node.children) == 1 and isinstance(node.children[0], str) and bool(node.children[0].strip())


def joined(a: Part, b: Part, across: bool = False) -> Part:
    """The least part that both match; ``across``: they come from different pages."""
    text = a.text if a.key == "#" and a.text == b.text else None
    parts = aligned(a.parts, b.parts, across)
    return Part(a.key, text, a.optional or b.optional, min(a.low, b.low), max(a.high, b.high), parts,
                a.pages + b.pages if across else max(a.pages, b.pages))


def common(a, b) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two lists of keys."""
    start, n, m = 0, len(a), len(b)
    if n == m and a == b:
        return [(k, k) for k in range(n)]
    while start < n and start < m and a[start] == b[start]:
        start += 1
    while n > start and m > start and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    best = [[0] * (m - start + 1) for _ in range(n - start + 1)]
    for i in range(n - start - 1, -1, -1):
        for j in range(m - start - 1, -1, -1):
            same = a[start + i] == b[start + j]
            best[i][j] = 1 + best[i + 1][j + 1] if same else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [(k, k) for k in range(start)], 0, 0
    while i < n - start and j < m - start:
        if a[start + i] == b[start + j]:
            out.append((start + i, start + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out + [(n + k, m + k) for k in range(len(a) - n)]


def aligned(a: list[Part], b: list[Part], across: bool = False) -> list[Part]:
    """Parts that match both lists: common keys in order, the others optional.

    Between common keys the parts of both keep their order and the lesser key goes
    first, so alternatives stand in one order however the pages came.
    """
    out: list[Part] = []
    i = j = 0
    for k, other in [*common([p.key for p in a], [p.key for p in b]), (len(a), len(b))]:
        out += map(as_optional, heapq.merge(a[i:k], b[j:other], key=lambda p: p.key))
        if k < len(a):
            out.append(joined(a[k], b[other], across))
        i, j = k + 1, other + 1
    merged: list[Part] = []
    for part in out:  # neighbours of one key are one repeated group
        if merged and merged[-1].key == part.key:
            before = merged[-1]
            merged[-1] = joined(before, part)
            merged[-1].optional = before.optional and part.optional
            if part.key != "#":
                merged[-1].high = before.high + part.high
        else:
            merged.append(part)
    return merged


def as_optional(part: Part) -> Part:
    return Part(part.key, part.text, True, part.low, part.high, part.parts, part.pages)


def alignable(root: Node) -> bool:
    """Whether a page is shallow and narrow enough to align."""
    todo = [(root, 0)]
    while todo:
        node, depth = todo.pop()
        kinds = [c.key for c in node.children if isinstance(c, Node)]
        if depth > DEEPEST or sum(a != b for a, b in zip(kinds, kinds[1:])) > MOST_RUNS:
            return False
        todo += [(c, depth + 1) for c in node.children if isinstance(c, Node)]
    return True


def infer_wrapper(pages: list[str]) -> Part:
    """The wrapper of some pages of one host."""
    wrapper = None
    for root in filter(alignable, map(parse, pages)):
        part = Part("", None, parts=folded(root.children))
        wrapper = part if wrapper is None else joined(wrapper, part, across=True)
    return wrapper or Part("")


def constants_of(wrapper: Part) -> set[int]:
    """Digests of (path, text) of the constant texts that two pages or more agree in."""
    found, todo = set(), [(wrapper, 0)]
    while todo:
        part, path = todo.pop()
        if part.key == "#":
            if part.text is not None and part.pages > 1:
                found.add(xxhash.xxh64_intdigest(f"{path}#{part.text}") >> 1)
            continue
        path = xxhash.xxh64_intdigest(f"{path}/{part.key}") >> 1
        todo += [(p, path) for p in part.parts]
    return found


def dumped(part: Part) -> list:
    """Keys, numbers and pages of a wrapper without its texts; of a large one the parts of most pages."""
    pages, todo = [], [part]
    while todo:
        one = todo.pop()
        pages.append(one.pages)
        todo += one.parts
    pages.sort(reverse=True)
    least = pages[WRAPPER_PARTS] + 1 if len(pages) > WRAPPER_PARTS else 0

    def plain(p: Part) -> list:
        return [p.key, int(p.optional), p.low, p.high, p.pages, [plain(c) for c in p.parts if c.pages >= least]]

    return plain(part)


def loaded(raw: list, position: int = 0) -> Part:
    """The wrapper of ``dumped``, with a position for each part: its parent's, its key, and which of that key."""
    key, optional, low, high, pages, parts = raw
    out = Part(key, None, bool(optional), low, high, pages=pages, position=position)
    seen: dict[str, int] = {}
    for p in parts:
        number = seen[p[0]] = seen.get(p[0], 0) + 1
        place = position if p[0] == "#" else xxhash.xxh64_intdigest(f"{position}/{p[0]}/{number}") >> 1
        out.parts.append(loaded(p, place))
    return out


def merge_trees(trees: list[str]) -> str:
    """One wrapper that matches the pages of several."""
    merged = loaded(json.loads(trees[0]))
    for raw in trees[1:]:
        merged = joined(merged, loaded(json.loads(raw)), across=True)
    return json.dumps(dumped(merged))


@lru_cache(maxsize=64)
def load_tree(raw: str | None) -> Part | None:
    return None if raw is None else loaded(json.loads(raw))


@dataclass
class Block:
    """A block of a page, or its part in one area."""

    path: int  # of its first piece
    text: str
    area: str
    furniture: bool
    chars: int
    linked: int  # characters in links
    tag: str
    parent: int
    kind: int  # of its position

    @property
    def digest(self) -> int:
        return xxhash.xxh64_intdigest(f"{self.path}#{self.text}") >> 1


def blocks_of(page: str, tree: Part | None = None) -> tuple[str, list[Block]]:
    """The area of the article by the page's own evidence, and all blocks in order."""
    pieces = pieces_of(page, tree)
    area = area_of(pieces)
    groups: dict[tuple, list[Piece]] = {}
    for p in pieces:
        groups.setdefault((p.block, p.area, p.furniture), []).append(p)
    out = []
    for (_, where, furniture), group in groups.items():
        if text := " ".join("".join(p.text for p in group).split()):
            first = group[0]
            linked = sum(len(p.text) for p in group if p.linked)
            kind = ARTICLE if where == "article" else REPEATED if first.repeated else FIXED
            out.append(Block(first.path, text, where, furniture, len(text), linked, first.tag, first.parent, kind))
    return area, out


def count_page(page: str, tree: Part | None, number: int, paths: dict, texts: dict, host: str = ""):
    """Add one page to the counts of its host.

    ``paths``: (host, path) to pages, least and greatest page number, and
    characters that are main text and all. ``texts``: the same by (host, path,
    digest) for what may be the host's own, and the kind of its position.
    """
    area, blocks = blocks_of(page, tree)
    seen = set()
    for b in blocks:
        if b.furniture and not b.area:
            continue  # never main text, on any page
        main = b.chars if not b.furniture and b.area == area else 0
        keys = [(paths, (host, b.path), ())]
        if not b.furniture and not (b.kind == ARTICLE and b.tag in OWN):
            keys.append((texts, (host, b.path, b.digest), (b.kind,)))
        for table, key, more in keys:
            row = table.setdefault(key, [0, number, number, 0, 0, *more])
            row[0] += key not in seen
            row[1], row[2] = min(row[1], number), max(row[2], number)
            row[3] += main
            row[4] += b.chars
            seen.add(key)


def is_shared(pages, of, kind, either=lambda a, b: a or b, both=lambda a, b: a and b):
    """Whether ``pages`` of the ``of`` pages with a position are enough for a text to be the host's own.

    At a position of its own a twentieth, if such texts are there on half of the
    pages; in a repeated group half of the pages; in articles nine of ten.
    """
    alone = both(both(kind == FIXED, pages >= LEAST_SHARED), pages * LEAST_SHARE >= of)
    among = both(both(kind == REPEATED, pages >= LEAST_SHARED), pages * 2 >= of)
    inside = both(both(kind == ARTICLE, pages >= IN_ARTICLE), pages * 10 >= of * IN_ARTICLE_TENTHS)
    return either(alone, either(among, inside))


def compile_wrapper(pages: list[str]) -> str:
    """What extraction needs of a host: its wrapper, constants, and main or not for each position.

    Constants are texts that different pages have at one position. Positions are
    judged by the texts there that are no constants. Equal pages are one page:
    nothing shows what varies. ``host_wrappers`` does the same over a table.
    """
    tree = dumped(infer_wrapper(pages))
    paths, texts = {}, {}
    for page in pages:
        count_page(page, loaded(tree), xxhash.xxh64_intdigest(page), paths, texts)
    shared, on = [], {}
    for (host, path, digest), (n, low, high, main, chars, kind) in texts.items():
        of = paths[host, path][0]
        if low < high and is_shared(n, of, kind):
            shared.append((path, digest, main, chars, kind, of))
            on[path] = on.get(path, 0) + (n if kind == FIXED else 0)
    constants = [row for row in shared if row[4] != FIXED or 2 * on[row[0]] >= row[5]]
    for path, _, main, chars, _, _ in constants:
        paths["", path][3] -= main
        paths["", path][4] -= chars
    slots = {str(path): int(2 * main > chars) for (_, path), (_, low, high, main, chars) in paths.items()
             if low < high and chars}
    return json.dumps({"tree": tree, "constants": sorted(row[1] for row in constants), "slots": slots})


@lru_cache(maxsize=64)
def load_wrapper(raw: str | None) -> tuple[set[int], dict[int, int], Part | None]:
    if raw is None:
        return set(), {}, None
    spec = json.loads(raw)
    tree = loaded(spec["tree"]) if "tree" in spec else None
    return set(spec["constants"] or ()), {int(k): int(v) for k, v in (spec["slots"] or {}).items()}, tree


def extract(page: str, wrapper: str | None = None, tree: Part | None = None) -> str:
    """Main text of one page: blocks in order, one line each.

    The wrapper decides; the page's own evidence where it is silent. In an article
    paragraphs, lists and tables are never constants, and other constants stay on a
    page that has little else there, a copy of another. A constant heading stays
    before text of its own element that stays.
    """
    constants, slots, own = load_wrapper(wrapper)
    area, blocks = blocks_of(page, tree or own)
    blocks = [b for b in blocks if not b.furniture and slots.get(b.path, b.area == area)]
    constant = [bool(constants) and not (b.kind == ARTICLE and b.tag in OWN) and b.digest in constants for b in blocks]
    inside = sum(b.chars for b in blocks if b.kind == ARTICLE)
    copied = 2 * sum(b.chars for b, c in zip(blocks, constant) if c and b.kind == ARTICLE) > inside
    around: dict[int, list[int]] = {}
    for b in blocks:
        row = around.setdefault(b.parent, [0, 0])
        row[0] += b.linked
        row[1] += b.chars

    def prose(b: Block) -> bool:
        """Whether a block is no list of links: a linked paragraph may be text."""
        linked, chars = around[b.parent]
        sentence = b.text.endswith((".", "!", "?")) and len(b.text.split()) >= 5
        return b.area != "" or 2 * b.linked <= b.chars or (b.tag in PROSE and (2 * linked <= chars or sentence))

    kept = [prose(b) and not (c and (b.kind != ARTICLE or not copied)) for b, c in zip(blocks, constant)]
    for i in range(len(blocks) - 2, -1, -1):
        if constant[i] and blocks[i].tag in SUBHEADINGS and blocks[i + 1].parent == blocks[i].parent:
            kept[i] = kept[i + 1]
    return "\n".join(b.text for b, k in zip(blocks, kept) if k)


# --- over a table -----------------------------------------------------------


def host_of(url):
    """Lower-cased host of a URL; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


TREES = pa.schema([("host", pa.string()), ("pages", pa.int64()), ("tree", pa.string())])


def infer_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wrappers of the hosts of one task from its (host, html)."""

    def inferred() -> pa.RecordBatch:
        rows = [(host, pages, json.dumps(dumped(tree))) for host, (pages, tree) in found.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), TREES)], schema=TREES)

    found: dict[str, list] = {}
    for batch in batches:
        for host, page in zip(*(c.to_pylist() for c in batch.columns)):
            own = found.setdefault(host, [0, None])
            own[0] += 1
            root = parse(page)
            if alignable(root):
                part = Part("", None, parts=folded(root.children, texts=False))
                own[1] = part if own[1] is None else joined(own[1], part, across=True)
            elif own[1] is None:
                own[1] = Part("")
            if len(found) > HOSTS_HELD:
                yield inferred()
                found = {}
    if found:
        yield inferred()


def host_trees(rows: DataFrame) -> DataFrame:
    """(host, pages, tree) from (host, html): tasks align their pages, then rounds of groups their wrappers.

    Equal wrappers are one row; groups have some FAN_IN of the others, so a host with any
    number of pages is never one task's. The order of alignment follows the files, so
    reruns agree.
    """
    def merged(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(["pages", "tree"], ascending=[False, True])
        return pd.DataFrame({"host": [key[0]], "pages": [int(found["pages"].sum())], "tree": [merge_trees(list(found["tree"]))]})

    trees = rows.select("host", "html").mapInArrow(infer_trees, "host string, pages long, tree string")
    while True:
        trees = stage(trees.groupBy("host", "tree").agg(F.sum("pages").alias("pages")), "trees")
        most = trees.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return trees
        block = F.pmod(F.xxhash64("tree"), F.lit(-(-most // FAN_IN)))
        trees = trees.withColumn("block", block).groupBy("host", "block").applyInPandas(
            merged, "host string, pages long, tree string")


def count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``count_page`` over (host, tree, page number, html) of one task, added up as far as memory allows."""

    def counted() -> pa.RecordBatch:
        rows = [(host, path, None, *row, None) for (host, path), row in paths.items()]
        rows += [(*key, *row) for key, row in texts.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), COUNTED)], schema=COUNTED)

    paths, texts = {}, {}
    for batch in batches:
        for host, tree, number, page in zip(*batch.columns):
            count_page(page.as_py(), load_tree(tree.as_py()), number.as_py(), paths, texts, host.as_py())
            if len(paths) + len(texts) > COUNTS_HELD:
                yield counted()
                paths, texts = {}, {}
    if paths:
        yield counted()


def with_hosts(pages: DataFrame, url: str, page_html: str) -> DataFrame:
    return pages.where(F.col(page_html).isNotNull()).select(
        host_of(F.col(url)).alias("host"), F.xxhash64(page_html).alias("number"), F.col(page_html).alias("html")
    ).where("host <> ''")


def host_wrappers(pages: DataFrame, url: str = "url", page_html: str = "html") -> DataFrame:
    """(host, pages, tree, wrapper) from all pages of each host; see ``compile_wrapper``.

    Counts are added up in tasks before they move, so a host of any size is spread out.
    """
    rows = with_hosts(pages, url, page_html)
    trees = host_trees(rows)
    everything = trees.agg(F.sum("pages")).first()[0] or 1
    added = [F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"),
             F.sum("main").alias("main"), F.sum("chars").alias("chars"), F.max("kind").alias("kind")]
    counts = stage(
        join_by_size(rows, trees, "host", "pages", everything).select("host", "tree", "number", "html")
        .mapInArrow(count_blocks, "host string, path long, digest long, pages long, low long, high long, "
                    "main long, chars long, kind int")
        .groupBy("host", "path", "digest").agg(*added).where("low < high")
        .withColumn("place", F.xxhash64("host", "path")),
        "block_counts",
    )
    paths = counts.where("digest is null")
    total = paths.agg(F.sum("pages")).first()[0] or 1
    sizes = paths.select("place", F.col("pages").alias("of")).groupBy("place").agg(F.max("of").alias("of"))
    texts = join_by_size(counts.where("digest is not null"), stage(sizes, "place_sizes"), "place", "of", total)
    columns = (texts["pages"], texts["of"], texts["kind"])
    # At most a few texts of one position have so large a share of its pages.
    on = F.sum(F.when(F.col("kind") == FIXED, F.col("pages"))).over(Window.partitionBy("place"))
    constants = stage(
        texts.where(is_shared(*columns, lambda a, b: a | b, lambda a, b: a & b))
        .withColumn("on", on).where((F.col("kind") != FIXED) | (F.col("on") * 2 >= F.col("of"))),
        "constants",
    )
    signed = [F.when(F.col("digest").isNull(), F.col(c)).otherwise(-F.col(c)).alias(c) for c in ("main", "chars")]
    votes = counts.where("digest is null").select("host", "path", "digest", "main", "chars").unionByName(
        constants.select("host", "path", "digest", "main", "chars")
    ).select("host", "path", *signed).groupBy("host", "path").agg(
        F.sum("main").alias("main"), F.sum("chars").alias("chars")
    ).where("chars > 0")
    slots = votes.select("host", F.lit(None).cast("long").alias("digest"), F.struct(
        F.col("path").cast("string").alias("key"), (F.col("main") * 2 > F.col("chars")).cast("int").alias("value")
    ).alias("slot"))
    both = slots.unionByName(constants.select("host", "digest"), allowMissingColumns=True)
    spec = F.struct(
        F.sort_array(F.collect_set("digest")).alias("constants"),
        F.map_from_entries(F.collect_list("slot")).alias("slots"),
    )
    found = both.groupBy("host").agg(F.to_json(spec).alias("wrapper"))
    return stage(trees.join(found, "host", "left"), "wrappers")


def extract_main_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", page_html: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null html is empty and gives an empty text. All pages of a host count for its
    wrapper, whatever their number and length. Pages without a host, and those of a
    host with one page only, are judged by their own structure.
    Repeated pages give repeated rows. Other columns are not looked at.
    """
    @F.pandas_udf("string")
    def main_text(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for found, wrappers, trees in batches:
            made = [extract(h or "", w, load_tree(t)) for h, w, t in zip(found, wrappers, trees)]
            yield pd.Series(made, dtype=object)

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page_html).alias("html"),
                        host_of(F.col(url)).alias("host"))
    wrappers = host_wrappers(pages, url, page_html)
    total = wrappers.agg(F.sum("pages")).first()[0] or 1
    own = F.col("html").isNotNull() & (F.col("host") != "")  # such hosts all have a wrapper
    nothing = F.lit(None).cast("string")
    known = join_by_size(rows.where(own), wrappers, "host", "pages", total).unionByName(
        rows.where(~own).withColumns({"tree": nothing, "wrapper": nothing}), allowMissingColumns=True)
    texts = known.select("page_id", "url", main_text("html", "wrapper", "tree").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
