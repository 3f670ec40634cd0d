"""Main text of web pages by wrapper induction.

Pages of one host share a template. Some pages of each host (SEEDS, chosen by hash: the sample the wrapper is fitted on)
are parsed and their trees aligned by simple tree matching. What most of them share is the wrapper: nodes whose text is
the same are template, the lowest node that holds nearly all of the varying prose is the slot of the article, and parts
that come again under a name for comments, adverts and the like are slots of something else. Besides, the texts at each
path of labels are counted over all pages of the host: those that most pages of the host or of one layout have, and those
of paths whose texts mostly come again, are template too.

Every page of the host is aligned with the wrapper: the text is what stands in the article's slot and is no template. In the
slot, a heading that all pages have stays where it stands before text of the page's own, and no part goes by its class name
but lists of reader comments that the wrapper has, too. Outside a slot, class names decide only about parts that are short,
linked or forms, or of a name that can be nothing else, and never about a paragraph.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import counted, hot_keys, map_rows, salted_join, settle

#: Pages of a host that its wrapper is fitted on, at most; share of them that must agree, and their least number.
SEEDS, AGREE, LEAST = 8, 0.75, 3
#: Elements deeper than this become leaves side by side at this depth, in page order; pairs of children that are all compared:
#: longer lists are first cut at children that are the same, and alike once, in both. Both bound the time, and drop nothing.
DEPTH, PAIRS = 120, 60_000
#: Share of the varying prose that the article's slot holds, and of its letters that are the same on all pages where it is one
#: article on many of them.
SLOT, COPIED = 0.9, 0.8
#: Bytes of wrappers, and ids of seeds, that may be broadcast; beyond, they are joined by shuffle.
SENT_BYTES, SENT_IDS = 32 << 20, 1_000_000

# HTML elements by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg math canvas iframe object audio video map".split())
ASIDE = frozenset("nav footer aside form button select textarea option dialog menu fieldset label datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {
    "p": frozenset("p".split()),
    "li": frozenset("li".split()),
    "dt": frozenset("dt dd".split()),
    "dd": frozenset("dt dd".split()),
    "tr": frozenset("tr td th".split()),
    "td": frozenset("td th".split()),
    "th": frozenset("td th".split()),
    "option": frozenset("option".split()),
}
SCOPES = frozenset("html body div article section main table ul ol dl blockquote td th aside nav header footer form figure details".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
NOISE = re.compile(
    r"(?:^|[-_\s])(?:nav|navi|navbar|navigation|menu|topbar|masthead|site-?header|page-?header|site-?footer|footer|foot|sidebar|side|aside|ads?|adv|advert|adverts|advertisement|advertising|adsense|banner|promo|promos|promotion|"
    r"sponsor|sponsored|cookie|cookies|consent|gdpr|notice|notices|notification|popup|pop-?up|modal|overlay|newsletter|subscribe|subscription|signup|share|sharing|social|related|recommended|recommendations|"
    r"teaser|teasers|comments?|comment-?list|respond|replies|reply|disqus|discussion|breadcrumbs?|pagination|pager|paging|toolbar|widgets?|login|search|searchbox|skip|skip-?link|copyright|legal|disclaimer|"
    r"alert|hidden|sr-?only|screen-?reader-?text|print-?only|tag-?cloud|outbrain|taboola)(?:$|[-_\s0-9])",
    re.I,
)
#: Names that are only ever given to what is no article; of these, readers' comments.
SURE = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert|adverts|advertisement|advertising|adsense|sponsored|cookie|cookies|consent|gdpr|newsletter|comments?|comment-?list|respond|disqus|breadcrumbs?|pagination|outbrain|taboola|sr-?only|screen-?reader-?text)(?:$|[-_\s0-9])",
    re.I,
)
COMMENTS = re.compile(r"(?:^|[-_\s])(?:comments?|comment-?list|respond|disqus)(?:$|[-_\s0-9])", re.I)
#: Words, and share of letters in links, from which a part of another name stays, or goes, whatever its name.
SHORT, LINKED = 8, 0.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a name may take out; paragraphs, headings, items and cells it never does.
NAMED = frozenset("div section header table figure center details".split())
HOLDER = re.compile(r"(?:^|[-_\s])(?:article|article-?body|post|post-?body|post-?content|entry|entry-?content|story|content|main|main-?content|page-?content|text-?body)(?:$|[-_\s0-9])", re.I)


@dataclass(eq=False, slots=True)
class Node:
    tag: str
    name: str = ""
    hidden: bool = False
    role: str = ""
    #: strings and nodes in order
    items: list = field(default_factory=list)
    template: bool = False
    #: the article's slot; whether the wrapper has this part
    slot: bool = False
    known: bool = False
    digest: int = 0
    text: str | None = None

    @property
    def label(self) -> str:
        return f"{self.tag}.{self.name}"

    def children(self) -> list[Node]:
        return [i for i in self.items if isinstance(i, Node)]

    def own_text(self) -> str:
        """The node's own strings, white space as one space; kept, as it is asked for often: call it on finished trees."""
        if self.text is None:
            own = [i for i in self.items if isinstance(i, str)]
            self.text = " ".join(" ".join(own).split()) if own else ""
        return self.text


class _Builder(HTMLParser):
    """A forgiving tree: unknown ends are passed over, what HTML closes by itself is closed, text is kept whatever happens."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]
        #: open elements that lie too deep to be opened
        self.deep: list[Node] = []

    def updatepos(self, i, j):
        """Lines and columns of the page are asked for by nobody."""
        return j

    def handle_starttag(self, tag, attrs):
        closes = CLOSES.get(tag) or (None if tag in INLINE or tag in VOID else CLOSES["p"])
        if closes:
            for i in range(len(self.open) - 1, 0, -1):
                above = self.open[i].tag
                if above in closes and not self.deep:
                    del self.open[i:]
                    break
                if above in SCOPES and not (tag == "tr" and above in ("td", "th")):
                    break
        if attrs:
            at = dict(attrs)
            style = at.get("style")
            style = style.replace(" ", "").lower() if style else ""
            hidden = "hidden" in at or at.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
            node = Node(tag, " ".join(filter(None, (at.get("class"), at.get("id")))), hidden, (at.get("role") or "").lower())
        else:
            node = Node(tag)
        self.open[-1].items.append(node)
        if self.deep:
            above = self.deep[-1]
            node.hidden = node.hidden or above.hidden or above.tag in SILENT or above.tag in ASIDE
        if tag not in VOID:
            if len(self.open) < DEPTH:
                self.open.append(node)
            else:
                self.deep.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.deep) - 1, -1, -1):
            if self.deep[i].tag == tag:
                del self.deep[i:]
                if self.deep:
                    # what follows goes on with the element around, behind the one that ended
                    above = self.deep[-1]
                    self.deep[-1] = Node(above.tag, above.name, above.hidden, above.role)
                    self.open[-1].items.append(self.deep[-1])
                return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                self.deep.clear()
                return
            if self.open[i].tag in SCOPES and tag not in SCOPES:
                return

    def handle_data(self, data):
        (self.deep or self.open)[-1].items.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _named_noise(node: Node) -> bool:
    return node.tag in NAMED and bool(node.name) and bool(NOISE.search(node.name))


def _slight(node: Node) -> bool:
    """Whether a part has few words, mostly links, or what a form has: what a doubtful name may take out."""
    words, letters, linked, todo = 0, 0, 0, [(node, False)]
    while todo:
        n, in_link = todo.pop()
        if n.tag in ("input", "textarea", "select", "button", "form"):
            return True
        for item in n.items:
            if isinstance(item, str):
                own = item.split()
                size = sum(map(len, own))
                words, letters, linked = words + len(own), letters + size, linked + in_link * size
            elif item.tag not in SILENT and not item.hidden:
                todo.append((item, in_link or item.tag == "a"))
    return words < SHORT or linked >= LINKED * letters


def _is_noise(node: Node, inside: bool, slot: bool = False) -> bool:
    """Whether a part is no article text by what it is: its element, or its name. A header inside the article holds its
    heading. slot: below the slot that the alignment has found, where only comments that all pages have go by a name."""
    if node.hidden or node.tag in SILENT or node.tag in ASIDE or node.role in ROLES or node.tag == "header" and not inside:
        return True
    if not _named_noise(node):
        return False
    if slot:
        return node.known and bool(COMMENTS.search(node.name))
    return bool(SURE.search(node.name)) or _slight(node)


def _digests(root: Node) -> None:
    """Sets the digest of every node: equal where label, texts and children are."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        children = node.children()
        order.append((node, children))
        todo += children
    for node, children in reversed(order):
        node.digest = hash((node.tag, node.name, node.own_text(), *[c.digest for c in children]))


def _pairs_of(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of two equal trees."""
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        todo += zip(x.children(), y.children())
    return out


def _anchors(xs: list[Node], ys: list[Node]) -> list[tuple[int, int]]:
    """Places of children that are equal, and alike once on each side: the longest run of them in order on both."""
    once = lambda side: {d: i for i, d in enumerate(n.digest for n in side) if sum_[d] == 1}
    sum_ = Counter(n.digest for n in xs)
    mine = once(xs)
    sum_ = Counter(n.digest for n in ys)
    theirs = once(ys)
    both = [(i, theirs[d]) for d, i in mine.items() if d in theirs]
    tails, at, back = [], [], []
    for k, (_, j) in enumerate(both):
        place = bisect_left(tails, j)
        back.append(at[place - 1] if place else None)
        tails[place : place + 1], at[place : place + 1] = [j], [k]
    out, k = [], at[-1] if at else None
    while k is not None:
        out.append(both[k])
        k = back[k]
    return out[::-1]


def _aligned(xs: list[Node], ys: list[Node]) -> tuple[int, list[tuple[Node, Node]]]:
    """The best matching of two lists of children in order: its weight, and its pairs."""
    total, pairs, head, tail = 0, [], 0, 0
    # equal ends are matched in some best matching
    while head < min(len(xs), len(ys)) and xs[head].digest == ys[head].digest:
        head += 1
    while tail < min(len(xs), len(ys)) - head and xs[-1 - tail].digest == ys[-1 - tail].digest:
        tail += 1
    for x, y in [*zip(xs[:head], ys[:head]), *zip(xs[len(xs) - tail :], ys[len(ys) - tail :])]:
        same = _pairs_of(x, y)
        total, pairs = total + sum(1 + 2 * (n.own_text() != "") for n, _ in same), pairs + same
    xs, ys = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
    if not xs or not ys:
        return total, pairs
    if len(xs) * len(ys) > PAIRS:
        cuts = _anchors(xs, ys)
        if not cuts:
            # nothing to cut at: in order, each child meets the next one with its label
            cuts, places, j = [], {}, 0
            for k, y in enumerate(ys):
                places.setdefault(y.label, []).append(k)
            for i, x in enumerate(xs):
                of = places.get(x.label, [])
                k = bisect_left(of, j)
                if k < len(of):
                    cuts.append((i, of[k]))
                    j = of[k] + 1
            for i, j in cuts:
                n, more = match(xs[i], ys[j])
                total, pairs = total + n, pairs + more
            return total, pairs
        last = (-1, -1)
        for i, j in [*cuts, (len(xs), len(ys))]:
            n, more = _aligned(xs[last[0] + 1 : i], ys[last[1] + 1 : j])
            total, pairs = total + n, pairs + more
            if i < len(xs):
                n, more = match(xs[i], ys[j])
                total, pairs = total + n, pairs + more
            last = (i, j)
        return total, pairs
    won = [[match(x, y) for y in ys] for x in xs]
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i in range(len(xs)):
        for j in range(len(ys)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + won[i][j][0])
    i, j = len(xs), len(ys)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            total, pairs = total + won[i][j][0], pairs + won[i][j][1]
    return total, pairs


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching, when labels, parents and order must agree: the greatest weight, and its pairs. A pair weighs one,
    and two more if its text is the same, so that of like blocks the constant ones meet. Nodes need their digests."""
    if a.label != b.label:
        return 0, []
    if a.digest == b.digest:
        same = _pairs_of(a, b)
        return sum(1 + 2 * (n.own_text() != "") for n, _ in same), same
    n, pairs = _aligned(a.children(), b.children())
    return n + 1 + 2 * (a.own_text() == b.own_text() != ""), [(a, b), *pairs]


def _letters(node: Node) -> int:
    return len(node.own_text()) + sum(map(_letters, node.children()))


def _prose(node: Node, marked=None) -> int:
    """Letters of running text below a node that is no template: not in links, nor in parts that are never article."""
    if node.tag in SILENT or node.tag in ASIDE or node.tag == "a" or node.hidden or node.role in ROLES:
        return 0
    own = 0 if (marked(node) if marked else node.template) else len(node.own_text())
    return own + sum(_prose(c, marked) for c in node.children())


def induce(pages: list[str]) -> str | None:
    """The wrapper of a host as JSON: of the first page's tree, the nodes with a text that the pages agree on, the article's
    slot, and the parts that come again under a name that is no article's. None without any."""
    trees = [parse(p) for p in pages]
    if len(trees) < LEAST:
        return None
    for tree in trees:
        _digests(tree)
    agreed: Counter = Counter()
    met: Counter = Counter()
    for other in trees[1:]:
        for mine, theirs in match(trees[0], other)[1]:
            met[id(mine)] += 1
            agreed[id(mine)] += mine.own_text() == theirs.own_text() != ""
    enough = max(AGREE * (len(trees) - 1), LEAST - 1)

    def is_template(node: Node) -> bool:
        return agreed[id(node)] >= enough

    def same_letters(node: Node) -> int:
        return is_template(node) * len(node.own_text()) + sum(map(same_letters, node.children()))

    def slot_of(body: Node) -> Node | None:
        whole = _prose(body, is_template)
        if not whole:
            return None
        path = [body]
        while inner := next((c for c in path[-1].children() if met[id(c)] >= enough and c.tag not in INLINE and _prose(c, is_template) >= SLOT * whole), None):
            if inner.tag in ("p", "ul", "ol", "blockquote", "pre", "table"):
                break
            path.append(inner)
        # a heading of the page beside the text belongs to it
        slot = path.pop()
        while path and not any(n.tag == "h1" for n in _walk(slot)):
            if any(n.tag == "h1" and not is_template(n) for n in _walk(path[-1])):
                slot = path[-1]
                break
            path.pop()
        return None if slot is body else slot

    body = next((n for n in _walk(trees[0]) if n.tag == "body"), trees[0])
    slot = slot_of(body)

    def keep(node: Node, doubtful: bool):
        # an article of which most stays the same is one text on many pages, and not template
        if node is slot or slot is None and _holds(node):
            doubtful = same_letters(node) > (COPIED if node is slot else 0.5) * _letters(node)
        kids = [k for k in (keep(c, doubtful) for c in node.children()) if k]
        text = node.own_text() if is_template(node) and not doubtful else None
        known = met[id(node)] >= enough and (node is slot or _named_noise(node))
        return [node.tag, node.name, text, kids, int(node is slot)] if kids or text or known else None

    kept = keep(trees[0], same_letters(body) > 0.9 * _letters(body) and not any(_holds(n) for n in _walk(body)))
    return json.dumps(kept, ensure_ascii=False) if kept else None


def _walk(node: Node):
    yield node
    for child in node.children():
        yield from _walk(child)


def _holds(node: Node) -> bool:
    return node.tag in ("article", "main") or node.role in ("main", "article") or node.tag in ("div", "section", "td") and bool(node.name) and bool(HOLDER.search(node.name)) and not NOISE.search(node.name)


def _read(kept: list) -> Node:
    tag, name, text, kids, slot = kept
    return Node(tag, name, items=[*([text] if text else []), *map(_read, kids)], slot=bool(slot))


@lru_cache(100)
def _wrapper(kept: str) -> Node:
    root = _read(json.loads(kept))
    _digests(root)
    return root


def _mark(page: Node, wrapper: str) -> Node | None:
    """Marks what the wrapper says about the page's nodes, and gives the one in the article's slot."""
    found = None
    _digests(page)
    for ours, node in match(_wrapper(wrapper), page)[1]:
        node.known = True
        node.template = bool(ours.own_text()) and ours.own_text() == node.own_text()
        if ours.slot:
            found = node
    return found


def _own(node: Node) -> bool:
    """Whether a node has text of its page's own, that is no template."""
    return any(n.own_text() and not n.template and n.tag not in SILENT for n in _walk(node))


def _blocks(node: Node, inside: bool, slot: bool = False) -> list[tuple[str, int]]:
    """(text, letters in links) of each block below a node, in page order; texts with white space as it comes."""
    out: list[list] = [["", 0]]

    def heads(items: list, i: int) -> bool:
        """Whether the heading at place i, which all pages have, stands before text of the page's own."""
        for item in items[i + 1 :]:
            if isinstance(item, Node) and not _is_noise(item, inside, slot):
                if item.tag in HEADINGS:
                    return False
                if any(n.own_text() for n in _walk(item)):
                    return _own(item)
        return False

    def walk(n: Node, linked: bool, stays: bool = False) -> None:
        for i, item in enumerate(n.items):
            if isinstance(item, str):
                if not n.template or stays:
                    out[-1][0] += item
                    out[-1][1] += linked * len("".join(item.split()))
            elif item.tag in ("br", "wbr"):
                out[-1][0] += " " if item.tag == "br" else ""
            elif not _is_noise(item, inside, slot):
                block = item.tag not in INLINE
                if block:
                    out.append(["", 0])
                walk(item, linked or item.tag == "a", stays or inside and item.tag in HEADINGS and not _own(item) and heads(n.items, i))
                if block:
                    out.append(["", 0])

    walk(node, False)
    return [(text, links) for text, links in ((" ".join(t.split()), n) for t, n in out) if text]


def _hash(*parts: str) -> str:
    return f"{xxhash.xxh3_64_intdigest(chr(0).join(parts).encode('utf-8', 'replace')):016X}"


@lru_cache(1 << 14)
def _plain(label: str) -> str:
    """A label without what its digits tell."""
    return re.sub("[0-9]+", "#", label)


@lru_cache(1 << 14)
def _path(above: str, label: str) -> str:
    """The hash of a path of labels; pages of a host have the same ones."""
    return _hash(above, _plain(label))


def _texts(root: Node) -> list[tuple[Node, str, str]]:
    """(node, hash of its path of labels, hash of that and its text) of each node with text; digits in names don't tell."""
    out, todo = [], [(root, "")]
    while todo:
        node, above = todo.pop()
        path = _path(above, node.label)
        if text := node.own_text():
            out.append((node, path, _hash(path, text)))
        todo += [(c, path) for c in node.children() if not c.hidden and c.tag not in SILENT]
    return out


def _layout(root: Node) -> str:
    """The labels of a page's upper levels."""
    level, seen = [root], set()
    for _ in range(4):
        level = [c for n in level for c in n.children() if c.tag not in SILENT and c.tag not in INLINE]
        seen |= {_plain(n.label) for n in level}
    return _hash(*sorted(seen))


def _mark_common(root: Node, body: Node, common: set[str], slot: Node | None) -> None:
    """Mark nodes whose text at their path is common; an article (the slot, or what is named so), or a page without one, that
    is mostly so is one text on many pages, and stays."""
    found = {id(n) for n, _, key in _texts(root) if key in common and not n.template}
    if not found:
        return

    def share(top: Node) -> float:
        nodes = [(n, len(n.own_text())) for n in _walk(top)]
        return sum(k for n, k in nodes if id(n) in found or n.template) / max(1, sum(k for _, k in nodes))

    holding = [slot] if slot is not None else [n for n in _walk(body) if _holds(n)]
    for top in holding or [body]:
        if share(top) > (COPIED if slot is not None else 0.5 if holding else 0.9):
            found -= {id(n) for n in _walk(top)}
    for node in _walk(root):
        node.template = node.template or id(node) in found


def extract(html: str | None, wrapper: str | None = None, common: set[str] | None = None) -> str:
    """Blocks of the article joined by empty lines; empty if there are none. White space in a block becomes one space.

    With a wrapper whose slot is found and holds the better part of what the page has to say, the slot decides; else the
    page's articles, its main part, a part of such a name, or the lowest part with most of the running text."""
    root = parse(html)
    slot = _mark(root, wrapper) if wrapper else None
    body = next((n for n in root.children() if n.tag == "html"), root)
    if common:
        _mark_common(root, body, common, slot)
    if slot is not None and 2 * _prose(slot) > _prose(body) and (blocks := _blocks(slot, True, True)):
        return "\n\n".join(text for text, _ in blocks)
    found: list[Node] = []

    def holders(node: Node, tags) -> None:
        for child in node.children():
            if not _is_noise(child, False) or child.tag in ("article", "main") and not child.hidden:
                if tags(child):
                    found.append(child)
                else:
                    holders(child, tags)

    for tags in (lambda n: n.tag == "article" or n.role == "article", lambda n: n.tag == "main" or n.role == "main", _holds):
        holders(body, tags)
        found = [n for n in found if _blocks(n, True)]
        if found:
            break
    if found:
        blocks = [b for n in found for b in _blocks(n, True)]
    else:
        blocks = _largest(body)
        # without any name to go by, a block of links alone is a menu
        blocks = [b for b in blocks if b[1] < 0.8 * len("".join(b[0].split()))]
    return "\n\n".join(text for text, _ in blocks)


def _largest(body: Node) -> list[tuple[str, int]]:
    """Blocks of the lowest part that holds most of the running text: from the top, go down while one child has it."""
    prose = lambda bs: sum(len(t) - n for t, n in bs if len(t.split()) >= 8)
    node, blocks = body, _blocks(body, False)
    while True:
        kids = [k for k in node.children() if k.tag not in INLINE and k.tag not in VOID and not _is_noise(k, False)]
        best = max(((prose(b := _blocks(k, False)), i, k, b) for i, k in enumerate(kids)), default=None, key=lambda x: x[:2])
        if best is None or not best[0] or best[0] < 0.8 * prose(blocks) or best[2].tag in ("p", "ul", "ol", "blockquote", "pre", "table"):
            return blocks
        node, blocks = best[2], best[3]


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def common_texts(pages: DataFrame) -> DataFrame:
    """host, key: the hashes of the texts that are template by their support over all pages; stored.

    A text at a path counts if LEAST pages have it and it is on AGREE of the pages of its host or of one layout, or if
    AGREE of what stands at that path is on LEAST pages. A page that comes in several rows counts once."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html")).where("host <> '' and page_id is not null")
    again = settle(rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "html-again")
    # pages don't move for it, unless ever so many come twice
    rows = rows.join(F.broadcast(again) if again.count() <= SENT_IDS else again, "page_id", "left").select("host", "html", (1 / F.coalesce("rows", F.lit(1))).alias("weight"))

    def make():
        def work(b):
            out: dict[str, list] = {"host": [], "layout": [], "path": [], "key": [], "weight": []}
            for host, html, weight in zip(b["host"], b["html"], b["weight"]):
                root = parse(html)
                layout = _layout(root)
                # an empty key counts the pages
                for path, key in {("", ""), *((p, k) for _, p, k in _texts(root))}:
                    for name, value in zip(out, (host, layout, path, key, weight)):
                        out[name].append(value)
            return out

        return work

    seen = map_rows(rows, make, "host string, layout string, path string, key string, weight double").groupBy("host", "layout", "path", "key").agg(F.sum("weight").alias("n"))
    seen = settle(seen, "html-texts")
    sizes = settle(seen.where("key = ''").select("host", "layout", F.col("n").alias("in_layout")), "html-sizes")
    hosts = sizes.groupBy("host").agg(F.sum("in_layout").alias("in_host"))
    # what is on fewer than LEAST pages in all is only summed by its path
    texts = _sized(seen.where("key <> ''"), sizes, ["host", "layout"]).groupBy("host", "path", "key").agg(F.sum("n").alias("n"), F.max(F.when(F.col("n") > LEAST - 0.01, F.col("n") / F.col("in_layout"))).alias("share"))
    texts = settle(texts, "html-by-path")
    often = F.col("n") > LEAST - 0.01
    paths = texts.groupBy("host", "path").agg((F.sum(F.when(often, F.col("n")).otherwise(0)) / F.sum("n")).alias("repeated")).where(F.col("repeated") >= AGREE)
    few = _sized(_sized(texts.where(often), hosts, ["host"]), settle(paths, "html-paths"), ["host", "path"], "left")
    return settle(few.where(f"n >= {AGREE} * in_host or share >= {AGREE} or repeated >= {AGREE}").select("host", "key").distinct(), "html-common")


def _sized(rows: DataFrame, sizes: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows (with a text's `key`) joined with one row for each of `keys`: sent to every task while that is few, else salted."""
    if sizes.count() <= SENT_IDS:
        return rows.join(F.broadcast(sizes), keys, how)
    return salted_join(rows, sizes, keys, ["key"], hot_keys(counted(rows, *keys), keys, rows.count()), how)


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper, n (pages of the host), stored; hosts of fewer than LEAST pages, or without a wrapper, have none."""
    light = pages.select("page_id", host_of(F.col("url")).alias("host")).where("host <> '' and page_id is not null")
    counts = light.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST)
    place = F.dense_rank().over(Window.partitionBy("host").orderBy(F.xxhash64("page_id"), "page_id"))
    picked = light.withColumn("place", place).where(F.col("place") <= SEEDS).select("host", "page_id").distinct()
    seeds = settle(picked.join(counts, "host"), "html-seeds")
    ids = F.broadcast(seeds) if seeds.count() <= SENT_IDS else seeds
    texts = pages.select("page_id", "html", host_of(F.col("url")).alias("host")).join(ids, ["host", "page_id"]).select("host", "page_id", "n", F.coalesce("html", F.lit("")).alias("html"))

    def work(frame):
        frame = frame.sort_values("page_id").drop_duplicates("page_id")
        made = induce(list(frame["html"]))
        return frame.iloc[: 1 if made else 0][["host", "n"]].assign(wrapper=made)

    made = texts.groupBy("host").applyInPandas(work, "host string, n long, wrapper string").select("host", "wrapper")
    return settle(counts.join(made, "host"), "html-wrappers")


def _with_common(rows: DataFrame, common: DataFrame) -> DataFrame:
    """rows (__row, host, html) with `common`: of the host's common texts those that a page has. Where all of them are too many
    to be sent, a page's texts are looked up one by one, so that no row carries more than it has."""

    def make():
        def work(b):
            found = [(r, h, k) for r, h, html in zip(b["__row"], b["host"], b["html"]) if h for k in {k for _, _, k in _texts(parse(html))}]
            return dict(zip(("__row", "host", "key"), map(list, zip(*found)) if found else ([], [], [])))

        return work

    texts = settle(map_rows(rows.select("__row", "host", "html"), make, "__row long, host string, key string"), "html-page-texts")
    keyed = common.withColumn("__there", F.lit(True))
    own = salted_join(texts, keyed, ["host", "key"], ["__row"], hot_keys(counted(texts, "host", "key"), ["host", "key"], texts.count()), "inner")
    held = own.groupBy("__row").agg(F.array_join(F.collect_set("key"), "").alias("common"))
    return rows.join(held, "__row", "left")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page. Null and empty pages give an empty text; repeated rows are
    each returned; pages without a host, or of a host with few pages, go by the names of their parts alone."""
    made, common = wrappers(pages), common_texts(pages)
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    bytes_ = (made.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0) + 16 * common.count()
    if bytes_ <= SENT_BYTES:
        of_host = common.groupBy("host").agg(F.array_join(F.sort_array(F.collect_set("key")), "").alias("common"))
        joined = rows.join(F.broadcast(made.select("host", "wrapper").join(of_host, "host", "full")), "host", "left")
    else:
        numbered = settle(rows.withColumn("__row", F.monotonically_increasing_id()), "html-rows")
        joined = _with_common(salted_join(numbered, made.select("host", "wrapper"), ["host"], ["__row"], hot_keys(made.select("host", "n"), ["host"], pages.count())), common)

    def make():
        sets: dict[str, set[str]] = {}

        def common_of(joined: str | None) -> set[str] | None:
            if joined and joined not in sets:
                if len(sets) >= 100:
                    sets.clear()
                sets[joined] = {joined[i : i + 16] for i in range(0, len(joined), 16)}
            return sets[joined] if joined else None

        def work(b):
            texts = [extract(h, w, common_of(c)) for h, w, c in zip(b["html"], b["wrapper"], b["common"])]
            return {"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]}

        return work

    return map_rows(joined.select("page_id", "url", "html", "wrapper", "common"), make, "page_id long, url string, text string, n_chars long")
