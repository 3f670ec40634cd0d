"""HTML to text, XML and language hints: one struct-valued pandas UDF over whole pages.

The extractor is pluggable: anything with `text(tree)` and `xml(tree)`. The one here drops parts that are no running
text, chooses the main part by scores of its blocks, in passes that grow looser, and writes the XML vocabulary that xml2md
reads.
"""

from __future__ import annotations

import multiprocessing
import os
import re
import signal
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from html.parser import HTMLParser
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements by kind.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED = frozenset("script style noscript template head nav footer aside form button select iframe svg object header menu".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dt dd figcaption caption".split())
CLOSED_BY = {"p": frozenset("p div ul ol table h1 h2 h3 h4 h5 h6 blockquote pre article section footer nav".split()), "li": frozenset(("li",)), "tr": frozenset(("tr",)), "td": frozenset("td th tr".split()), "th": frozenset("td th tr".split())}
HIGHLIGHT = {"b": "#b", "strong": "#b", "i": "#i", "em": "#i", "u": "#u", "tt": "#t", "sup": "#sup", "sub": "#sub"}
#: Deepest nesting that is kept as such.
DEPTH = 150
# Marks of machine translation as (element, attribute, pattern), in the order in which they are looked for.
TRANSLATED = [
    ("div", "id", "mqtranslate"),
    ("div", "id", "wporg-translate"),
    ("div", "id", "wp-translate"),
    ("div", "id", "qtranslate"),
    ("link", "id", "wporg-translate-css"),
    ("link", "rel", "alternate machine-translated-from"),
    ("script", "src", "qtranslate-x"),
    ("a", "onclick", "doGTranslate"),
    ("meta", "name", "translation-stats"),
    ("a", "data-trp-gettext", "$^"),
    ("div", "id", "weglot"),
]


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.build = ET.TreeBuilder()
        self.build.start("document", {})
        self.open: list[str] = []

    def handle_starttag(self, tag, attrs):
        if self.open and tag in CLOSED_BY.get(self.open[-1], ()):
            self.handle_endtag(self.open[-1])
        self.build.start(tag, {k: v or "" for k, v in attrs})
        if tag in VOID or len(self.open) >= DEPTH:
            self.build.end(tag)
        else:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while (last := self.open.pop()) != tag:
                self.build.end(last)
            self.build.end(tag)

    def handle_data(self, data):
        self.build.data(re.sub(r"[^\t\n\r\x20-퟿-�\U00010000-\U0010ffff]", "", data))

    def done(self) -> ET.Element:
        for tag in reversed(self.open):
            self.build.end(tag)
        self.build.end("document")
        return self.build.close()


def load(html: str | None) -> ET.Element:
    """The page's tree; ValueError if it holds no element."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    root = tree.done()
    if not len(root):
        raise ValueError("Could not parse HTML")
    return root


def language_hints(root: ET.Element) -> dict[str, list[str]]:
    """metalang: contents of meta content-language, then og:locale; htmllang: lang of all html elements. Only what is there."""
    metas = [m for m in root.iter("meta") if "content" in m.attrib]
    meta = [m.get("content") for m in metas if m.get("http-equiv") == "content-language"] + [m.get("content") for m in metas if m.get("property") == "og:locale"]
    langs = [h.get("lang") for h in root.iter("html") if "lang" in h.attrib]
    return ({"metalang": meta} if meta else {}) | ({"htmllang": langs} if langs else {})


class TagFilter:
    """Finds elements whose attribute matches a rule; rules of one element and attribute are one pattern, first seen first."""

    def __init__(self, rules: list[tuple[str, str, str]] | None = None):
        grouped: dict[tuple[str, str], list[str]] = {}
        for tag, attribute, pattern in TRANSLATED if rules is None else rules:
            grouped.setdefault((tag, attribute), []).append(f"(?:{pattern})")
        self.patterns = [(key, re.compile("|".join(p), re.I)) for key, p in grouped.items()]

    @classmethod
    def from_lines(cls, lines: list[str]) -> TagFilter:
        """Rules as `tag <tab> attribute <tab> pattern`; # starts a comment line."""
        kept = [line.strip().split("\t") for line in lines if line.strip() and not line.strip().startswith("#")]
        return cls([(r[0], r[1], r[-1]) for r in kept])

    def match(self, root: ET.Element) -> list[str] | None:
        for (tag, attribute), pattern in self.patterns:
            for element in root.iter(tag):
                value = element.get(attribute)
                if value is not None and pattern.search(value):
                    return [tag, attribute, value]
        return None


class Extractor(Protocol):
    def text(self, root: ET.Element) -> str | None: ...

    def xml(self, root: ET.Element) -> str | None: ...


#: Names of parts that are no article, and of readers' comments.
ASIDE_NAMES = re.compile(r"(?i)(?:^|[-_\s])(?:ads?|advert\w*|banner|nav\w*|menu|side-?bar|footer|cookies?|share|social|related|promo\w*|newsletter|breadcrumbs?|teasers?)(?:$|[-_\s])")
COMMENT_NAMES = re.compile(r"(?i)(?:^|[-_\s])(?:comments?|comment-?(?:list|area|section|body)|respond|replies|disqus\w*)(?:$|[-_\s])")
#: Words that a block costs, and that a word in a link, or in a part of such a name, takes away, but no block more than WORST, so
#: that one alone cuts no article; letters that are too few where a looser pass finds LOOSER times as many.
COST, LINK, WORST, TOO_FEW, LOOSER = 5, 3, 8, 60, 3
#: Share of a run's score that may stand before its title and yet go.
BEFORE_TITLE = 0.2


def best_run(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the run of the greatest sum; of equal sums the first, of these the longest. Nothing where none is above
    zero."""
    best, place, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += score
        if total > best or total == best > 0 and place[0] == start:
            best, place = total, (start, i + 1)
    return place


class BlockExtractor:
    """Main text by blocks, in passes that grow looser where the one before leaves too little.

    precise: the article or main part whose blocks score best; balanced: the body's best run of blocks; loose: all blocks of
    the body that aren't mostly links. A block scores by its words; those in links, or in parts named like menus or adverts,
    count against it, and so does each block by itself. least: letters that a text must have more of, else there is none.
    comments: readers' comments, which otherwise go, follow the text. precision: passes begin with the precise one."""

    def __init__(self, least: int = 0, comments: bool = True, precision: bool = True):
        self.least, self.comments, self.precision = least, comments, precision
        #: words, words against it, and whether it stands in readers' comments, of each block in the making
        self.seen: dict[ET.Element, tuple[int, int, bool]] = {}

    def _main(self, root: ET.Element) -> ET.Element:
        self.seen = {}
        body = root.find(".//body")
        body = root if body is None else body
        passes = [self._precise, self._balanced, self._loose] if self.precision else [self._balanced, self._loose]
        found: list[ET.Element] = []
        for attempt in passes:
            blocks = attempt(root, body)
            if not found or self._letters(blocks) >= LOOSER * max(1, self._letters(found)):
                found = blocks
            if self._letters(found) >= TOO_FEW:
                break
        main = ET.Element("main")
        main.extend(found)
        if self.comments:
            said = {id(b) for b in found}
            main.extend(b for b in self._of(body, True) if self.seen[b][2] and id(b) not in said)
        return main

    @staticmethod
    def _letters(blocks: list[ET.Element]) -> int:
        return sum(len("".join("".join(b.itertext()).split())) for b in blocks)

    def _of(self, area: ET.Element, trusted: bool) -> list[ET.Element]:
        holder = ET.Element("main")
        self._blocks(area, holder, trusted, False, False)
        return list(holder)

    def _score(self, block: ET.Element) -> float:
        words, against, comment = self.seen[block]
        score = -WORST if comment else max(words - LINK * against - COST, -WORST)
        # a heading neither makes an article nor ends one
        return max(score, -1) if block.tag == "head" and not against else score

    def _chosen(self, blocks: list[ET.Element], whole: bool) -> tuple[float, list[ET.Element]]:
        """The sum of the best run and its blocks, without those that speak against it; whole: of all blocks that don't."""
        scores = [self._score(b) for b in blocks]
        start, end = best_run(scores)
        total = sum(scores[start:end])
        while start and blocks[start - 1].tag == "head" and not self.seen[blocks[start - 1]][1]:
            start -= 1
        # what little stands before the page's own title belongs to what is around it
        title = next((i for i in range(start, end) if blocks[i].get("rend") == "h1"), start)
        if sum(scores[start:title]) < BEFORE_TITLE * total:
            start = title
        kept = blocks if whole else blocks[start:end]
        return total, [b for b in kept if not self.seen[b][2] and 2 * self.seen[b][1] <= self.seen[b][0]]

    def _precise(self, root: ET.Element, body: ET.Element) -> list[ET.Element]:
        """All that is text in the best of the outermost articles and main parts; of equal ones, the first."""
        areas, todo = [], [body]
        while todo:
            node = todo.pop()
            if node.tag in ("article", "main") or node.get("role") in ("article", "main"):
                areas.append(node)
            else:
                todo += [c for c in reversed(list(node)) if c.tag not in DROPPED]
        inner = [n for a in areas if a.tag == "main" or a.get("role") == "main" for n in a.iter("article")]
        tried = [self._chosen(self._of(a, True), True) for a in [*inner, *areas]]
        return max(tried, key=lambda t: t[0])[1] if tried else []

    def _balanced(self, root: ET.Element, body: ET.Element) -> list[ET.Element]:
        return self._chosen(self._of(body, True), False)[1]

    def _loose(self, root: ET.Element, body: ET.Element) -> list[ET.Element]:
        return [b for b in self._of(body, False) if not self.seen[b][2]]

    def _note(self, block: ET.Element, text: str, linked: str, aside: bool, comment: bool) -> ET.Element:
        words = len(text.split())
        self.seen[block] = (words, words if aside else len(linked.split()), comment)
        return block

    def _blocks(self, source: ET.Element, target: ET.Element, trusted: bool, aside: bool, comment: bool) -> None:
        loose, linked = [source.text or ""], []

        def flush():
            text = " ".join("".join(loose).split())
            if text:
                made = ET.SubElement(target, "p")
                made.text = text
                self._note(made, text, " ".join(linked), aside, comment)
            loose.clear()
            linked.clear()

        for child in source:
            tag = child.tag
            name = f"{child.get('class') or ''} {child.get('id') or ''}" if isinstance(tag, str) else ""
            inner = (aside or bool(ASIDE_NAMES.search(name)), comment or bool(COMMENT_NAMES.search(name)))
            if tag in DROPPED or not isinstance(tag, str):
                pass
            elif tag in PARAGRAPHS:
                flush()
                self._paragraph(child, target, trusted, *inner)
            elif tag in ("ul", "ol", "dl"):
                flush()
                items = ET.Element("list", rend="ol" if tag == "ol" else "ul")
                self._blocks(child, items, trusted, *inner)
                for block in list(items):
                    block.tag = "item" if block.tag == "p" else block.tag
                if len(items):
                    target.append(items)
                    parts = [self.seen[i] for i in items]
                    self.seen[items] = (sum(p[0] for p in parts), sum(p[1] for p in parts), inner[1])
            elif tag == "table":
                flush()
                self._table(child, target)
                self._note(target[-1], " ".join(child.itertext()), " ".join("".join(a.itertext()) for a in child.iter("a")), *inner)
            elif tag == "br":
                loose.append("\n")
            elif child.find(".//p") is None and tag not in ("div", "section", "article", "main", "body", "html", "center", "figure", "details"):
                text = "".join(child.itertext())
                loose.append(text)
                linked += [text] if tag == "a" else ["".join(a.itertext()) for a in child.iter("a")]
            else:
                flush()
                self._blocks(child, target, trusted, *inner)
            loose.append(child.tail or "")
        flush()

    def _paragraph(self, source: ET.Element, target: ET.Element, trusted: bool, aside: bool, comment: bool) -> None:
        whole, links = "".join(source.itertext()), ["".join(a.itertext()) for a in source.iter("a")]
        if not whole.strip() or not trusted and 2 * sum(map(len, links)) > len(whole):
            return
        tag = source.tag
        if tag == "pre":
            made = ET.SubElement(target, "code")
            made.text = whole
            self._note(made, whole, " ".join(links), aside, comment)
            return
        made = ET.SubElement(target, "head" if re.fullmatch("h[1-6]", tag) else "quote" if tag == "blockquote" else "item" if tag in ("li", "dt", "dd") else "p")
        if made.tag == "head":
            made.set("rend", tag)
        self._note(made, whole, " ".join(links), aside, comment)
        self._inline(source, made)

    def _inline(self, source: ET.Element, target: ET.Element) -> None:
        def add(text: str | None) -> None:
            text = re.sub(r"\s+", " ", text or "")
            if len(target):
                target[-1].tail = (target[-1].tail or "") + text
            else:
                target.text = (target.text or "") + text

        add(source.text)
        for child in source:
            if child.tag in HIGHLIGHT and "".join(child.itertext()).strip() and not any(c.tag in PARAGRAPHS for c in child.iter()):
                self._inline(child, ET.SubElement(target, "hi", rend=HIGHLIGHT[child.tag]))
            elif child.tag == "a" and child.get("href"):
                self._inline(child, ET.SubElement(target, "ref", target=child.get("href")))
            elif child.tag in ("del", "s"):
                self._inline(child, ET.SubElement(target, "del"))
            elif child.tag == "code":
                ET.SubElement(target, "code").text = "".join(child.itertext())
            elif child.tag == "br":
                ET.SubElement(target, "lb")
            elif child.tag not in DROPPED:
                inner = ET.Element("x")
                self._inline(child, inner)
                add(inner.text)
                for part in list(inner):
                    target.append(part)
            add(child.tail)

    def _table(self, source: ET.Element, target: ET.Element) -> None:
        table = ET.SubElement(target, "table")
        for tr in source.iter("tr"):
            row = ET.SubElement(table, "row")
            for cell in tr:
                if cell.tag in ("td", "th"):
                    made = ET.SubElement(row, "cell", {"role": "head"} if cell.tag == "th" else {})
                    self._inline(cell, made)

    def text(self, root: ET.Element) -> str | None:
        lines = []
        for block in self._main(root).iter():
            if block.tag in ("p", "head", "item", "quote", "code"):
                line = "".join(block.itertext()) if block.tag == "code" else " ".join("".join(block.itertext()).split())
                if line:
                    lines.append(line)
        text = "\n".join(lines)
        return text if len(text) > self.least else None

    def xml(self, root: ET.Element) -> str | None:
        doc = ET.Element("doc")
        doc.append(self._main(root))
        return ET.tostring(doc, encoding="unicode")


class TimedOut(BaseException):
    """Not an Exception, so that no extractor swallows it."""


@contextmanager
def time_limit(seconds: float | None):
    def stop(*_):
        raise TimedOut

    if not seconds:
        yield
        return
    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def page_record(html: str | bytes | None, extractor: Extractor, tags: TagFilter | None, limit: float | None) -> dict:
    """t, x, htmllang, metalang, tagfilter, traferr of a page; what was done before a failure stays."""
    out: dict = {}
    errors: list[str] = []
    try:
        with time_limit(limit):
            if isinstance(html, bytes):
                try:
                    html = html.decode()
                except UnicodeDecodeError as e:
                    errors.append(str(e))
                    html = html.decode(errors="ignore")
            root = load(html)
            if tags and (hit := tags.match(root)):
                out["tagfilter"] = hit
            out |= language_hints(root)
            out["t"] = extractor.text(root)
            out["x"] = extractor.xml(root)
    except TimedOut:
        errors.append(f"Extraction timed out: {limit}s")
    except Exception as e:
        errors.append(f"{type(e).__name__}: {e}")
    return out | ({"traferr": errors} if errors else {})


_STRINGS = T.ArrayType(T.StringType())
PAGE = T.StructType([T.StructField("t", T.StringType()), T.StructField("x", T.StringType()), *(T.StructField(n, _STRINGS) for n in ("htmllang", "metalang", "tagfilter", "traferr"))])


#: Seconds beyond the limit after which a page's process is killed; pages that it is sent at a time.
GRACE, SENT = 1.0, 64
#: Pages, and their characters, whose records a worker gives out at a time.
GIVEN, GIVEN_SIZE = 256, 4 << 20


class Watched:
    """page_record() in a process of its own, which can be killed whatever it does.

    Within it, the limit is a signal, and what was done before stays. Code that lets no signal through is ended with its
    process, GRACE later; the page gets the error, and the next ones a new process. A process that ends by itself (a crash,
    or memory that the system takes back) is an error of its page as well. The process ends with the worker that has it."""

    def __init__(self, make: Callable[[], Extractor], tags: TagFilter | None, limit: float):
        self.make, self.tags, self.limit = make, tags, limit
        self.child, self.line = None, None

    def _serve(self, line) -> None:
        extractor = self.make()
        try:
            while True:
                for html in line.recv():
                    line.send(page_record(html, extractor, self.tags, self.limit))
        except (EOFError, OSError, KeyboardInterrupt):
            os._exit(0)

    def start(self) -> None:
        """Before pages are read, so that the process doesn't take those over that the worker holds."""
        fork = multiprocessing.get_context("fork")
        self.line, theirs = fork.Pipe()
        self.child = fork.Process(target=self._run, args=(self.line, theirs), daemon=True)
        self.child.start()
        theirs.close()

    def _run(self, ours, theirs) -> None:
        ours.close()
        signal.signal(signal.SIGTERM, signal.SIG_DFL)
        self._serve(theirs)

    def close(self) -> None:
        if self.child is not None:
            self.line.close()
            self.child.kill()
            self.child.join()
            self.child.close()
            self.child = None

    def __call__(self, pages: list[str | bytes | None]) -> list[dict]:
        out: list[dict] = []
        while len(out) < len(pages):
            if self.child is None:
                self.start()
            some = pages[len(out) : len(out) + SENT]
            try:
                self.line.send(some)
                for _ in some:
                    if not self.line.poll(self.limit + GRACE):
                        raise TimeoutError
                    out.append(self.line.recv())
            except TimeoutError:
                self.close()
                out.append({"traferr": [f"Extraction timed out: {self.limit}s"]})
            except (EOFError, OSError):
                self.child.join(GRACE)
                code = self.child.exitcode
                self.close()
                out.append({"traferr": [f"Extraction ended by itself: {code}"]})
        return out


def parts(html: pd.Series) -> Iterator[tuple[int, int]]:
    """Ranges of places of a batch's pages, each of at most GIVEN pages and of at most GIVEN_SIZE characters, but for one page
    that is longer; of an empty batch, an empty one."""
    at = size = 0
    for i, h in enumerate(html):
        n = len(h) if h is not None else 0
        if i > at and (i - at >= GIVEN or size + n > GIVEN_SIZE):
            yield at, i
            at, size = i, 0
        size += n
    yield at, len(html)


def html_records(make: Callable[[], Extractor] = BlockExtractor, tags: TagFilter | None = None, limit: float | None = 10.0):
    """A pandas UDF: HTML (string or binary) -> struct PAGE. One struct, so that several fields cost one pass. limit: seconds
    a page, held by a process beside the worker's; None: pages are done by the worker itself."""
    rules = TagFilter() if tags is None else tags

    @F.pandas_udf(PAGE)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        watched = Watched(make, rules, limit) if limit else None
        extractor = None if limit else make()
        if watched:
            watched.start()
        try:
            for html in batches:
                # what is made of a batch goes on in parts, so that a worker holds no more of it than of one part
                for at, end in parts(html):
                    some = list(html.iloc[at:end])
                    rows = watched(some) if watched else [page_record(h, extractor, rules, None) for h in some]
                    yield pd.DataFrame({f: [r.get(f) for r in rows] for f in PAGE.names}, dtype=object)
        finally:
            if watched:
                watched.close()

    return run


def extract_files(spark: SparkSession, paths: str | list[str], least: int = 250, limit: float = 10.0) -> DataFrame:
    """path, text of HTML files, each read whole: an empty text where extraction takes too long or gives less than `least`
    characters in all, with error telling which."""
    pages = spark.read.option("wholetext", True).text(paths if isinstance(paths, list) else [paths]).select(F.col("_metadata.file_path").alias("path"), html_records(lambda: BlockExtractor(least), limit=limit)("value").alias("r"))
    late = F.exists(F.coalesce("r.traferr", F.array().cast("array<string>")), lambda e: F.startswith(e, F.lit("Extraction timed out")))
    return pages.select("path", F.coalesce("r.t", F.lit("")).alias("text"), F.when(late, "TIMEOUT").alias("error"))
