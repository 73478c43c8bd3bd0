"""Main text of web pages by wrappers inferred for each host.

A page's tokens make a tree of elements and text slots. Brothers of one kind that follow each other
fold into a repeated element, sequences of brothers that follow each other (a heading and its
paragraphs, say) into a repeated group. The wrapper of a host is a union-free expression over such
trees: two trees are aligned list by list of brothers, what only one of them has becomes optional,
what one of them repeats becomes a repeated group in both, and text becomes a slot. Lists of more
than `MANY` different brothers become one repeated group of optional members, which bounds a wrapper
and the cost of aligning. Alignment is repeated over all pages of the host: each task folds its
pages into one wrapper a host, and those few are folded again by host, so no host's pages ever meet
in one task. Pages of a host with equal html count once, so copies do not outvote the rest. A slot
counts its pages, characters and characters in links, and keeps the text that most of its pages share.

Extraction aligns a page with its host's wrapper and takes the text of the slots that the wrapper's
elements leave: those inside menus, headers, footers, sidebars, notices, adverts, forms and reader
comments (by element, or by the whole name of a box) go; where the page has an article or main element, those
outside it go. On pages without one, text that most of the host's distinct pages, three at least, share in a
slot goes, and so do repeated groups that are nearly all links. Inside an article headings, quotations and
other text stay, shared or not; what goes are repeated groups of links that most pages have, and boxes (a
`div`, a list, a table) of which all text is shared. Shared text that makes up half of a page's article
or more stays: such pages are near copies, not a template. Text that the wrapper alone decides on stays
where nothing else would be left of a page. Elements that the wrapper lacks are judged like their parents; a
wrapper without any element gives no text.

Defined cases: a null page is empty, an empty page has the empty text; a tag of any length ends at its
first `>` outside quotes; if a tag's quotes never close, it ends at its first `>`, and quotes mean nothing in
the rest of that page; a null url or one without a host is a host of its own name ""; elements may nest to
any depth; repeated rows are extracted each.
Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import saved

HOSTS = 5000  # wrappers that a task holds before it passes them on
SHARES, SALTED = 1000, 1000  # hosts with more than one in SHARES pages are cut in parts of about SALTED
MANY, PERIOD = 64, 6  # different brothers of a list that is aligned in order; brothers of a repeated sequence
_NAME = re.compile(r"<(/?)([a-zA-Z][\w:-]*+)")
_STOP = re.compile(r"[>\"']")
_KIND = re.compile(r"(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "select", "canvas", "audio", "video"}
_VOID = {"br", "img", "hr", "meta", "link", "input", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
_INLINE = {"b", "i", "em", "strong", "span", "u", "small", "sub", "sup", "code", "mark", "font", "br", "img", "wbr", "abbr", "cite", "q", "s", "time", "var", "kbd", "samp", "del", "ins", "label", "tt", "big", "bdi", "bdo", "data", "dfn", "acronym", "strike"}
_CLOSES_P = {"p", "div", "ul", "ol", "dl", "table", "section", "article", "nav", "aside", "header", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "figure", "main", "hr", "address", "fieldset", "details"}
_OWN_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "main", "nav", "aside", "footer", "header", "form"}
#: Elements that hold no main text, and the boxes whose classes, ids and roles may say so.
_AWAY = {"nav", "aside", "footer", "form", "menu", "dialog", "button", "head"}
_BOXES = {"div", "section", "ul", "ol", "dl", "table", "header", "figure", "fieldset", "details", "center", "address"}
#: Words that a box without main text is called by, and words that only say where or what kind of box it is.
_AWAY_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adsense sponsor sponsors sponsored promo promos promotion banner banners cookie
    cookies consent gdpr notice notices alert alerts menu menus nav navigation navbar navigations sidebar sidebars side footer footers
    breadcrumb breadcrumbs comment comments commentlist disqus replies respond share sharing social related recommend recommended
    recommendations newsletter newsletters subscribe subscription signup login popup popups modal modals widget widgets pager pagers
    pagination copyright disclaimer toolbar masthead search complementary contentinfo""".split()
)
_HEADER_WORDS = frozenset(("header", "siteheader", "pageheader", "topbar"))
_MAIN_WORDS = frozenset(("main", "article", "articlebody"))
_PLACES = frozenset(
    """0 site page top bottom left right upper lower box boxes bar bars list lists item items link links button buttons icon icons wrapper wrap
    container area block blocks section slot unit panel panels group inner outer primary secondary global user reader thread form field input
    posts stories articles more count text body content title label heading post article main center middle column col row""".split()
)

# A node: [key, repeated, optional, children, slot, blocks of a page's own text]; a slot: [pages, chars,
# link chars, hash, votes]. The key of an element is its name and kinds, that of a repeated sequence its
# members' keys in brackets.
TEXT, ANY = "#", "(*)"


def _node(key: str) -> list:
    return [key, False, False, [], None, []]


def _called(word: str, names: frozenset[str]) -> bool:
    """Whether a class, id or role is one of the names, or a name with words of place alone: `site-footer` and
    `cookie-notice` are, `side-effects` and `social-policy` are not."""
    if word in names:
        return True
    parts = re.split(r"[-_]+", word)
    return any(x in names for x in parts) and all(x in names or x in _PLACES or x in _AWAY_WORDS for x in parts)


def _says(word: str) -> bool:
    return _called(word, _AWAY_WORDS) or _called(word, _HEADER_WORDS) or _called(word, _MAIN_WORDS)


def _key(name: str, attributes: str) -> str:
    """The name with its classes and roles, numbers in them left open; an id only where it names a kind
    of content, as ids are often a page's own."""
    kinds = set()
    for kind, *values in _KIND.findall(attributes):
        for w in "".join(values).lower().split():
            w = re.sub(r"[|().]", "_", re.sub(r"\d+", "0", w))
            if kind.lower() != "id" or _says(w):
                kinds.add(w)
    return ".".join([name, *sorted(kinds)])


def _plain(key: str) -> str:
    """A key without the kinds that tell nothing about content."""
    name, *kinds = key.split(".")
    return ".".join([name, *(k for k in kinds if _says(k))])


class Page:
    """A page's tree, and its texts by block."""

    def __init__(self, source: str) -> None:
        self.root = _node("")
        self.lines: dict[int, list[str]] = {}
        self.open_quote = False  # a tag has been met whose quotes never close
        stack, names = [self.root], [""]
        opened: dict[str, int] = {}  # elements in the stack by name
        block = links = at = done = 0
        last = source.rfind(">")
        while (at := source.find("<", at)) >= 0:
            tag = self._tag(source, at, last)
            if tag is None:
                at += 1
                continue
            if at > done:
                self._text(source[done:at], stack, block, links > 0)
            at, name, closing, attributes = tag
            done = at
            if not name:
                continue
            if name in _RAW:
                if not closing and not attributes.endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\b", re.IGNORECASE).search(source, at)
                    close = source.find(">", end.end()) if end else -1
                    at = done = close + 1 if close >= 0 else len(source)
                continue
            if name in _INLINE:
                if name == "br":
                    self._text(" ", stack, block, links > 0)
                continue
            if name == "a":
                links = max(0, links - 1) if closing else links + 1
                continue
            block += 1
            if name in _VOID:
                continue
            if closing:
                if opened.get(name):
                    k = len(names) - 1
                    while names[k] != name:
                        k -= 1
                    self._cut(stack, names, opened, k)
                    links = 0
                continue
            if name in _CLOSES_P:
                self._close(stack, names, opened, {"p"})
            if name in _OWN_KIND:
                self._close(stack, names, opened, _OWN_KIND[name])
            node = _node(_key(name, attributes))
            stack[-1][3].append(node)
            stack.append(node)
            names.append(name)
            opened[name] = opened.get(name, 0) + 1
        if done < len(source):
            self._text(source[done:], stack, block, links > 0)

    def _tag(self, source: str, at: int, last: int) -> tuple[int, str, bool, str] | None:
        """End, name, whether it closes, and attributes of the tag at a `<`; no name: a comment or
        declaration; None: text. `last` is the place of the last `>`."""
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            return (end + 3 if end >= 0 else len(source)), "", False, ""
        if at > last:
            return None
        if source[at + 1 : at + 2] in ("!", "?"):
            return source.find(">", at) + 1, "", False, ""
        m = _NAME.match(source, at)
        if m is None:
            return None
        end = -1 if self.open_quote else self._end(source, m.end())
        if end < 0:
            self.open_quote = True
            end = source.find(">", m.end())
        return None if end < 0 else (end + 1, m[2].lower(), bool(m[1]), source[m.end() : end])

    @staticmethod
    def _end(source: str, at: int) -> int:
        """Place of the first `>` outside quotes, -1 if a quote stays open."""
        while (m := _STOP.search(source, at)) is not None:
            if m[0] == ">":
                return m.start()
            at = source.find(m[0], m.end()) + 1
            if not at:
                break
        return -1

    @staticmethod
    def _cut(stack: list, names: list[str], opened: dict[str, int], k: int) -> None:
        for name in names[k:]:
            opened[name] -= 1
        del names[k:], stack[k:]

    @classmethod
    def _close(cls, stack: list, names: list[str], opened: dict[str, int], kinds: set[str]) -> None:
        if not any(opened.get(x) for x in kinds):
            return
        for k in range(len(names) - 1, 0, -1):
            if names[k] in kinds:
                cls._cut(stack, names, opened, k)
                return
            if names[k] in _SCOPE:
                return

    def _text(self, raw: str, stack: list, block: int, link: bool) -> None:
        text = entities.unescape(raw)
        self.lines.setdefault(block, []).append(text)
        bare = text.strip()
        if not bare:
            return
        top = stack[-1]
        if not top[3] or top[3][-1][0] != TEXT:
            top[3].append([TEXT, False, False, [], [1, 0, 0, 0, 1], []])
        slot, blocks = top[3][-1][4], top[3][-1][5]
        slot[1] += len(bare)
        slot[2] += len(bare) * link
        slot[3] = zlib.crc32(bare.encode("utf-8", "replace"), slot[3])
        if not blocks or blocks[-1] != block:
            blocks.append(block)

    def joined(self, blocks: list[int]) -> str:
        """Texts of the blocks in page order, each on a line of its own."""
        return "\n".join(t for t in (" ".join("".join(self.lines[b]).split()) for b in sorted(blocks)) if t)


def fold(node: list, own: bool = False) -> list:
    """A page's tree with its repeated elements and sequences folded; `own` keeps the numbers of the
    text blocks, as extraction needs them."""
    order, todo = [], [node]
    while todo:
        order.append(todo.pop())
        todo += order[-1][3]
    folded: dict[int, list] = {}
    for x in reversed(order):  # children before their parents
        out: list[list] = []
        for child in x[3]:
            _add(out, folded.pop(id(child)))
        out = _sequences(out)
        out = _anything(out) if len(out) > MANY else out
        folded[id(x)] = [x[0], x[1], x[2], out, list(x[4]) if x[4] else None, list(x[5]) if own else []]
    return folded[id(node)]


def _add(out: list[list], node: list) -> None:
    """Add a brother; one of the kind of the last becomes its repetition."""
    if out and out[-1][0] == node[0]:
        out[-1] = _merged(out[-1], node, same_page=True)
        out[-1][1] = True
    else:
        out.append(node)


def _sequences(nodes: list[list]) -> list[list]:
    """Sequences of up to PERIOD brothers that follow each other become repeated groups."""
    for p in range(2, PERIOD + 1):
        if len(nodes) < 2 * p:
            break
        keys = [x[0] for x in nodes]
        out, i = [], 0
        while i < len(nodes):
            members = keys[i : i + p]
            if keys[i + p : i + 2 * p] == members and not any(k[:1] == "(" for k in members):
                while keys[i : i + p] == members:
                    _add(out, [f"({'|'.join(members)})", False, False, nodes[i : i + p], None, []])
                    i += p
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def _grouped(nodes: list[list], key: str) -> list[list]:
    """Brothers with each stretch that a sequence's members make put in its group."""
    members = key[1:-1].split("|")
    p, out, i = len(members), [], 0
    while i < len(nodes):
        if nodes[i][0] == members[0] and [x[0] for x in nodes[i : i + p]] == members:
            _add(out, [key, False, False, nodes[i : i + p], None, []])
            i += p
        else:
            _add(out, nodes[i])
            i += 1
    return out


def _anything(nodes: list[list]) -> list[list]:
    """All brothers as one repeated group of optional members, those of a kind as one."""
    if len(nodes) == 1 and nodes[0][0] == ANY:
        return nodes
    members: dict[str, list] = {}
    todo = list(reversed(nodes))
    while todo:
        x = todo.pop()
        if x[0][:1] == "(":
            todo += reversed(x[3])
            continue
        one = [_plain(x[0]), True, True, x[3], x[4], x[5]]
        members[one[0]] = _merged(members[one[0]], one, same_page=True) if one[0] in members else one
    return [[ANY, True, False, list(members.values()), None, []]]


def _slots(a: list, b: list, same_page: bool) -> list:
    if same_page:  # a page has one vote, and none where the brothers differ
        return [a[0], a[1] + b[1], a[2] + b[2], a[3], min(a[4], b[4]) if a[3] == b[3] else 0]
    votes, kept = (a[4] + b[4], a[3]) if a[3] == b[3] else (a[4] - b[4], a[3]) if a[4] >= b[4] else (b[4] - a[4], b[3])
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], kept, votes]


def _align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence; -1 for what only one of them has."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if a[i] == b[j] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j >= len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append((i, -1))
            i += 1
        else:
            out.append((-1, j))
            j += 1
    return out


def _by_key(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal members, whatever their order."""
    there = {k: j for j, k in enumerate(b)}
    out = [(i, there.pop(k, -1)) for i, k in enumerate(a)]
    return out + [(-1, j) for j in sorted(there.values())]


def _brothers(key: str, a: list[list], b: list[list]) -> tuple[list[list], list[list], list[tuple[int, int]]]:
    """The children of two nodes of that key with the same groups in both, and their alignment."""
    if key == ANY:
        return a, b, _by_key([x[0] for x in a], [x[0] for x in b])
    keys = dict.fromkeys(x[0] for x in [*a, *b] if x[0][:1] == "(")
    for k in () if ANY in keys else keys:
        a, b = _grouped(a, k), _grouped(b, k)
    if ANY not in keys:
        pairs = _align([x[0] for x in a], [x[0] for x in b])
        if len(pairs) <= MANY:
            return a, b, pairs
    return (a := _anything(a) if a else a), (b := _anything(b) if b else b), _align([x[0] for x in a], [x[0] for x in b])


def _merged(a: list, b: list, same_page: bool = False) -> list:
    """The least union-free expression over both: unmatched children are optional."""

    def both(x: list, y: list) -> list:
        slot = _slots(x[4], y[4], same_page) if x[4] and y[4] else x[4] or y[4]
        return [x[0], x[1] or y[1], x[2] or y[2], [], slot, x[5] + y[5]]

    top = both(a, b)
    todo = [(a, b, top)]
    while todo:
        a, b, node = todo.pop()
        left, right, pairs = _brothers(a[0], a[3], b[3])
        for i, j in pairs:
            if i >= 0 and j >= 0:
                node[3].append(both(left[i], right[j]))
                if left[i][3] or right[j][3]:
                    todo.append((left[i], right[j], node[3][-1]))
            else:
                one = left[i] if i >= 0 else right[j]
                node[3].append([one[0], one[1], True, one[3], one[4], one[5]])
    return top


def merge(a: list | None, b: list) -> list:
    return b if a is None else _merged(a, b)


def packed(node: list) -> str:
    """A wrapper as JSON: its nodes from the top, each with the number of its children."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        out.append([x[0], int(x[1]), int(x[2]), len(x[3]), x[4]])
        todo += reversed(x[3])
    return json.dumps(out, separators=(",", ":"))


def unpacked(text: str) -> list:
    nodes = json.loads(text)
    top: list[list] = []
    todo = [(top, 1)]
    for key, repeated, optional, n, slot in nodes:
        while len(todo[-1][0]) == todo[-1][1]:
            todo.pop()
        node = [key, bool(repeated), bool(optional), [], slot, []]
        todo[-1][0].append(node)
        if n:
            todo.append((node[3], n))
    return top[0]


def expression(node: list) -> str:
    """The wrapper as a regular expression over tokens, for reading."""
    inner = "".join(map(expression, node[3]))
    element = node[0] and node[0][0] != "("
    body = "#text" if node[0] == TEXT else f"<{node[0]}>{inner}</{node[0].split('.')[0]}>" if element else inner
    mark = ("*" if node[2] else "+") if node[1] else ("?" if node[2] else "")
    return f"({body}){mark}" if mark else body


def _away(key: str, in_main: bool) -> bool:
    """Whether an element holds no main text by its name or by what it is called; within the main part the
    names of paragraphs, headings or quotations count only where they are such a word alone."""
    name, *kinds = key.split(".")
    if name in _AWAY:
        return True
    if name in ("html", "body", "article", "main"):
        return False
    if in_main and name not in _BOXES:
        return any(k in _AWAY_WORDS for k in kinds)
    if any(_called(k, _AWAY_WORDS) for k in kinds):
        return True
    return not in_main and (name == "header" or any(_called(k, _HEADER_WORDS) for k in kinds))


def _is_main(key: str) -> bool:
    name, *kinds = key.split(".")
    return name in ("article", "main") or (name in ("div", "section") and any(_called(k, _MAIN_WORDS) for k in kinds))


def _template(text: list, slot: list | None, pages: int) -> bool:
    """Whether a page's text is the one that most of the host's pages have in that slot."""
    return bool(slot and slot[4] and pages >= 3 and text[4][4] and slot[4][4] > 0.5 * pages and slot[4][3] == text[4][3])


def links(wrapper: list) -> dict[int, tuple[bool, int]]:
    """For each repeated node of a wrapper (by identity) whether it is nearly all links, and the most
    pages that one of its slots has."""
    order, todo = [], [wrapper]
    while todo:
        order.append(todo.pop())
        todo += order[-1][3]
    sums: dict[int, tuple[int, int, int]] = {}
    for x in reversed(order):
        below = [sums[id(c)] for c in x[3]]
        chars, linked, pages = (x[4][1], x[4][2], x[4][0]) if x[4] else (0, 0, 0)
        sums[id(x)] = chars + sum(b[0] for b in below), linked + sum(b[1] for b in below), max([pages, *(b[2] for b in below)])
    return {id(x): (n[0] > 0 and n[1] > 0.8 * n[0], n[2]) for x in order if x[1] for n in (sums[id(x)],)}


def main_text(source: str, wrapper: list, pages: int, linked: dict[int, tuple[bool, int]] | None = None) -> str:
    """The main text of a page of `wrapper`'s host, which has `pages` distinct pages; `linked` is what
    `links` says of the wrapper."""
    if not wrapper[3]:
        return ""
    linked = links(wrapper) if linked is None else linked
    page = Page(source)
    has_main = False
    found: list[tuple[list[int], int, bool, bool, bool, int]] = []  # blocks, chars, inside the main part, linkish, shared, box
    boxes: list[list] = [[-1, True]]  # of the main part: the box around, and whether most pages share all of its text
    todo: list[tuple[list, list | None, bool, bool, bool, int]] = [(fold(page.root, own=True), wrapper, False, False, False, 0)]
    while todo:
        node, like, away, in_main, linkish, box = todo.pop()
        if node[0] and node[0][0] != "(":
            name = node[0].split(".")[0]
            if in_main and name in _BOXES and not away:
                boxes.append([box, True])
                box = len(boxes) - 1
            in_main = in_main or (not away and _is_main(node[0]))
            away = away or _away(node[0], in_main)
        if like is not None and like[1] and not (away or linkish):
            nearly, having = linked.get(id(like), (False, 0))
            linkish = nearly and (not in_main or (pages >= 3 and having > 0.5 * pages))
        has_main = has_main or (in_main and not away)
        mine, theirs, pairs = _brothers(node[0], node[3], like[3] if like else [])
        for i, j in pairs:
            if i < 0:
                continue
            child, match = mine[i], theirs[j] if j >= 0 else None
            if child[0] != TEXT:
                todo.append((child, match, away, in_main, linkish, box))
            elif not away:
                shared = _template(child, match, pages)
                found.append((child[5], child[4][1], in_main, linkish, shared, box))
                boxes[box][1] = boxes[box][1] and shared
    for around, shared in reversed(boxes[1:]):  # boxes come after those around them
        boxes[around][1] = boxes[around][1] and shared
    gone = [False] * len(boxes)
    for k, (around, shared) in enumerate(boxes):
        gone[k] = k > 0 and (gone[around] or shared)
    texts = [x for x in found if x[2] or not has_main]
    texts = [x for x in texts if has_main or not x[3]]
    # In the main part a shared text goes only with a box that is shared as a whole.
    template = lambda x: gone[x[5]] if has_main else x[4]
    copied = has_main and 2 * sum(x[1] for x in texts if x[4]) >= sum(x[1] for x in texts)
    left = [x for x in texts if not x[3] and (copied or not template(x))]
    return page.joined([b for x in left for b in x[0]]) or page.joined([b for x in texts for b in x[0]])


def host_of(url: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def infer(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """(host, wrapper, pages, distinct): one row a host, the wrapper as JSON, over the distinct pages."""

    def from_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for b in batches:
            for host, source, n in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                one = held.setdefault(host, [None, 0, 0])
                one[:] = merge(one[0], fold(Page(source).root)), one[1] + n, one[2] + 1
            if len(held) > HOSTS:
                yield _rows(held)
                held = {}
        yield _rows(held)

    def from_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, [None, 0, 0]
        for b in batches:
            done: dict[str, list] = {}
            for host, wrapper, n, m in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if last is not None and host != last:
                    done[last] = one
                if host != last:
                    last, one = host, [None, 0, 0]
                one = [merge(one[0], unpacked(wrapper)), one[1] + n, one[2] + m]
            yield _rows(done)
        if last is not None:
            yield _rows({last: one})

    schema = "host string, wrapper string, pages bigint, distinct bigint"
    rows = pages.select(host_of(url).alias("host"), F.coalesce(F.col(body), F.lit("")).alias("html"))
    # Equal pages meet by their hash: copies within a task go before the shuffle.
    rows = rows.groupBy("host", F.xxhash64("html").alias("_hash")).agg(F.first("html").alias("html"), F.count("*").alias("copies"))
    rows = rows.select("host", "html", "copies")
    return rows.mapInArrow(from_pages, schema).repartition("host").sortWithinPartitions("host").mapInArrow(from_wrappers, schema)


def _rows(held: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([packed(x[0]) for x in held.values()], pa.string()), pa.array([x[1] for x in held.values()], pa.int64()), pa.array([x[2] for x in held.values()], pa.int64())], names=["host", "wrapper", "pages", "distinct"])


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every row. Pages meet their host's wrapper in an equi-join on host
    and salt: hosts with more than one in SHARES pages, at most SHARES of them, are dealt over a salt
    for every SALTED pages, with a copy of their wrapper each."""
    wrappers = saved(infer(pages, url, body), "wrappers")
    total = wrappers.agg(F.sum("pages")).first()[0] or 0
    salts = F.when(F.col("pages") > total / SHARES, F.ceil(F.col("pages") / SALTED)).otherwise(1).cast("int")
    copies = wrappers.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    large = wrappers.where(F.col("pages") > total / SHARES).select("host", salts.alias("_salts"))
    rows = pages.select(F.col(key), F.col(url).alias("url"), F.coalesce(F.col(body), F.lit("")).alias("html"), host_of(url).alias("host"))
    rows = rows.join(F.broadcast(large), "host", "left")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(key, "html"), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    met = rows.join(copies, ["host", "salt"]).select(key, "url", "html", "wrapper", "distinct")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[list, dict]] = {}
        for b in batches:
            texts = []
            for source, wrapper, n in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if wrapper not in known:
                    if len(known) > 200:
                        known = {}
                    like = unpacked(wrapper)
                    known[wrapper] = like, links(like)
                texts.append(main_text(source, known[wrapper][0], n, known[wrapper][1]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[key, "url", "text", "n_chars"])

    return met.mapInArrow(run, f"{key} {dict(pages.dtypes)[key]}, url string, text string, n_chars bigint")
