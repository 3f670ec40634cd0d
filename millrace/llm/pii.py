"""Personal data, also in disguise, at offsets of the source text.

The base is four plain patterns on the text as it is. Transducers then rewrite disguises, each keeping a map from every
stretch of its output to the stretch of its input that it stands for: look-alike characters, invisible characters and
character references; at and dot disguises; spelled digits. The same detectors run on what comes out, and each span that
holds something rewritten is mapped back to source characters.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable

from pyspark.sql import DataFrame

from .common import map_rows

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_local = re.compile(r"[A-Za-z0-9._%+-]")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
# the same matches, as none starts inside a run of digits; faster only where runs are long
_ip_long, _long_run = re.compile(rf"(?<![0-9]){_ip.pattern}"), re.compile(r"[0-9]{300}")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_not_digit = re.compile(r"[^0-9]")


def _emails(text: str) -> list[Span]:
    """Leftmost matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from each @ outwards."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _local.match(text, start - 1):
            start -= 1
        m = _domain.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    return found


def _luhn(digits: str) -> bool:
    return sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 * (d > "4")) for i, d in enumerate(reversed(digits))) % 10 == 0


def detect(text: str) -> list[Span]:
    """(kind, start, end) by the plain patterns, by kind and then start; what fails a test is dropped, not tried again."""
    found = _emails(text) if "@" in text else []
    if "." in text:
        found += [("ip", m.start(), m.end()) for m in (_ip_long if _long_run.search(text) else _ip).finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in _card.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(digits := _not_digit.sub("", m[0])) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _phone.finditer(text) if 9 <= len(_not_digit.sub("", m[0])) <= 15]
    return found


class Mapped:
    """A text with a map of its stretches to those of the source: each is a copy, or stands as a whole for a source stretch."""

    def __init__(self, text: str, parts: list[tuple[int, int, int, bool]] | None = None):
        self.text = text
        #: (start here, start in the source, end in the source, rewritten)
        self.parts = parts if parts is not None else [(0, 0, len(text), False)]
        self.starts = [p[0] for p in self.parts]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """Source stretch of [start, end)."""
        i, j = bisect_right(self.starts, start) - 1, bisect_left(self.starts, end) - 1
        first, last = self.parts[i], self.parts[j]
        left = first[1] if first[3] else first[1] + start - first[0]
        right = last[2] if last[3] else last[1] + end - last[0]
        return left, right

    def rewrite(self, pattern: re.Pattern, new: Callable[[re.Match], str | tuple[int, str] | None]) -> Mapped:
        """Replace each match by new(match), or leave it where that is None; of (place, text), only what lies from that place
        on is replaced."""
        text, parts, size, done = [], [], 0, 0

        def copy(start: int, stop: int) -> None:
            nonlocal size
            i = bisect_right(self.starts, start) - 1
            while start < stop:
                here, source, source_end, changed = self.parts[i]
                end = min(stop, self.starts[i + 1] if i + 1 < len(self.parts) else len(self.text))
                if end > start:
                    parts.append((size, source, source_end, True) if changed else (size, source + start - here, source + end - here, False))
                    text.append(self.text[start:end])
                    size += end - start
                start, i = end, i + 1

        for m in pattern.finditer(self.text):
            out = new(m)
            if out is None or m.end() == m.start():
                continue
            begin, out = (m.start(), out) if isinstance(out, str) else out
            copy(done, begin)
            done = m.end()
            if out:
                left, right = self.source(begin, m.end())
                parts.append((size, left, right, True))
                text.append(out)
                size += len(out)
        if not text and not done:
            return self
        copy(done, len(self.text))
        return Mapped("".join(text), parts or [(0, 0, 0, False)])


# Letters of other scripts that look like Latin ones.
_ALIKE = dict(
    zip(
        "аеорсухіјѕһԁԛԝкмтвнАВЕКМНОРСТУХІЈЅοανικρτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧոսցհօɡıℓ",
        "aeopcyxijshdqwkmtbhABEKMHOPCTYXIJSoavikptuxABEZHIKMNOPTYXnughogil",
        strict=True,
    )
)
_ALIKE |= dict.fromkeys("‐‑‒–—―−﹣－", "-") | dict.fromkeys("․。｡﹒．", ".") | dict.fromkeys("＠﹫", "@") | dict.fromkeys("       　", " ") | dict.fromkeys("＋﹢", "+")
_INVISIBLE = "­᠎​‌‍‎‏⁠﻿"
_odd = re.compile(f"&(?:#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|commat|period|plus|nbsp|lowbar|hyphen);|[{re.escape(''.join(_ALIKE))}{_INVISIBLE}٠-٩۰-۹०-९⁰-₉²³¹①-⑨Ⓐ-⓪！-～\U0001d400-\U0001d7ff]")


def _plain(m: re.Match) -> str | None:
    c = m[0]
    if c[0] == "&":
        seen = html.unescape(c)
        return _ALIKE.get(seen, seen) if len(seen) == 1 else None
    if c in _INVISIBLE:
        return ""
    known = _ALIKE.get(c)
    if known is None:
        known = unicodedata.normalize("NFKC", c)
        known = str(unicodedata.decimal(c)) if unicodedata.decimal(c, None) is not None else known
    return known if len(known) == 1 and known.isascii() else None


# Endings of mail domains that a bare "at ... dot ..." must have; words and signs for at and dot.
_TLDS = "com org net edu gov mil int io co ai app dev info biz me tv de fr es eu uk us ca at ch it nl be pt pl se ru cn jp in br mx ar example test invalid"
_AT_WORDS, _DOT_WORDS = "at|arroba|chez|arobase|bei|ät", "dot|punkt|punto|point"
_OPEN, _SHUT = r"[\[({<]+", r"[\])}>]+"
_bracketed_at = re.compile(rf"(?i)(?<=[a-z0-9._%+-])\s{{0,3}}{_OPEN}\s{{0,3}}(?:{_AT_WORDS}|@|a)\s{{0,3}}{_SHUT}\s{{0,3}}(?=[a-z0-9])|(?i:(?<=[a-z0-9_%+])-(?:at)-(?=[a-z0-9]))")
_bracketed_dot = re.compile(rf"(?i)(?<=[a-z0-9])\s{{0,3}}{_OPEN}\s{{0,3}}(?:{_DOT_WORDS}|\.)\s{{0,3}}{_SHUT}\s{{0,3}}(?=[a-z0-9])|(?<=[a-z0-9])-dot-(?=[a-z0-9])")
_label = r"[a-z0-9](?:[a-z0-9-]{0,62}[a-z0-9])?"
_dot = rf"(?:\s{{1,3}}(?:{_DOT_WORDS})\s{{1,3}}|\s{{1,3}}\.\s{{1,3}}|\s?\.\s?)"
_host = rf"{_label}(?:{_dot}{_label}){{0,4}}{_dot}(?:{_TLDS.replace(' ', '|')})"
_bare = re.compile(
    rf"(?i)(?<![a-z0-9._%+-])(?P<user>[a-z0-9_%+-]+(?:{_dot}[a-z0-9_%+-]+){{0,3}}?)(?P<at>\s{{1,3}}(?:{_AT_WORDS})\s{{1,3}}|\s{{0,3}}@\s{{0,3}})(?P<host>{_host})(?![a-z0-9])"
)
_any_dot = re.compile(rf"(?i){_dot}")
# what every match of the pattern above ends with, so that nothing it finds is passed over
_bare_end = re.compile(rf"(?i)(?:\s(?:{_AT_WORDS})\s|@)\s{{0,3}}{_host}(?![a-z0-9])")
_bracket_hints = ("[", "(", "{", "<", "-at-", "-dot-")


_spoken_at = re.compile(rf"(?i)\s(?:{_AT_WORDS})\s")
_spoken_or_apart = re.compile(rf"(?i)\s(?:{_DOT_WORDS})\s|\s\.\s")
_apart_anywhere = re.compile(rf"(?i)\s(?:{_AT_WORDS}|{_DOT_WORDS})\s|\s@|@\s|\s\.|\.\s")
#: Words that an address follows, in the languages of the corpus, and those that are no one's name before "at".
_contact = re.compile(r"(?i)\b(?:e-?mails?|mails?|mailto|contact|write|reach|address|kontakt|schreib\w*|adresse|correo|escrib\w*|contacto|contacta\w*|courriel|contacte\w*|écri\w*)\b[^.!?\n]{0,24}$")
_nobody = {*"me us him her them you it we i he she they is was are be or and to look looking shop mir uns mich dir sie ist war nos me moi nous vous es et".split()}


def _joined(m: re.Match) -> tuple[int, str] | None:
    """What is disguised as an address, from its user part on, joined. An at-word beside a host with plain dots is a place
    ("the shop at example.com"): it takes a second sign, a spoken dot or one between spaces, or a word of contact before."""
    if not _apart_anywhere.search(m[0]):
        return None
    user, host, begin = m["user"], m["host"], m.start("user")
    # a full stop with white space behind ends the sentence before
    if cut := list(re.finditer(r"\.\s+", user)):
        user, begin = user[cut[-1].end() :], begin + cut[-1].end()
        if not user:
            return None
    if _spoken_at.search(m["at"]):
        if not _spoken_or_apart.search(host):
            plain = re.search(r"[a-z0-9]\.[a-z0-9]", host, re.I) and not re.search(r"\.\s", host)
            if not plain or user.lower() in _nobody or not _contact.search(m.string, max(0, begin - 48), begin):
                return None
    elif re.search(r"\S\.\s+[A-Z]", host) or (m["at"] != "@" and re.search(r"\S\.\s", host)):
        # a sentence that ends after "@ home" is no host
        return None
    return begin, _any_dot.sub(".", user) + "@" + _any_dot.sub(".", host)


# The digits as words in the four languages of the corpus.
_SPELLED = {
    w: str(d)
    for d, words in enumerate(("zero oh null cero zéro", "one eins uno un", "two zwei dos deux", "three drei tres trois", "four vier cuatro quatre", "five fünf fuenf cinco cinq", "six sechs seis", "seven sieben siete sept", "eight acht ocho huit", "nine neun nueve neuf"))
    for w in words.split()
}
_spelled = "|".join(sorted(_SPELLED, key=len, reverse=True))
_times = "double|triple"
_unit = rf"(?:(?:{_times})[\s-])?(?:{_spelled}|[0-9]+)"
_between = r"(?:\s?[,.-]\s?|\s{1,3})"
_point = rf"(?:\s{{1,3}}(?:{_DOT_WORDS}|period)\s{{1,3}})"
_run = re.compile(rf"(?i)(?<![\w+])(?P<plus>plus[\s-]{{1,3}}|\+\s?)?(?P<digits>{_unit}(?:(?:{_point}|{_between}){_unit}){{3,}})(?!\w)")
_spoken_ip = re.compile(rf"(?i)(?<![\w.])[0-9]{{1,3}}(?:\s{{1,3}}(?:{_DOT_WORDS})\s{{1,3}}[0-9]{{1,3}}){{3}}(?!\w)")
_spoken_dot = re.compile(rf"(?i)[0-9]\s{{1,3}}(?:{_DOT_WORDS})\s")
_piece = re.compile(rf"(?i)(?P<dot>{_point})|(?:(?P<times>{_times})[\s-])?(?P<digit>{_spelled}|[0-9]+)(?!\w)")


_apart = str.maketrans(",.-", "   ")
_linked = {*_times.split("|"), *_DOT_WORDS.split("|"), "period", *_SPELLED}


def _spells(low: str) -> bool:
    """Whether a spelled digit stands beside another one, a number, or a word that runs of them may hold."""
    words = low.translate(_apart).split() if not low.isascii() else low.replace(",", " ").replace(".", " ").replace("-", " ").split()
    if _SPELLED.keys().isdisjoint(words):
        return False
    return any(w in _SPELLED and (n in _linked or n.isdigit()) or n in _SPELLED and w.isdigit() for w, n in zip(words, words[1:]))


def _digits(m: re.Match) -> str | None:
    """A run of spelled digits as digits without separators, but for spoken dots."""
    out, words = [], 0
    for p in _piece.finditer(m["digits"]):
        if p["dot"]:
            out.append(".")
        else:
            d = p["digit"].lower()
            words += d in _SPELLED
            out.append(_SPELLED.get(d, d) * {"double": 2, "triple": 3}.get((p["times"] or "").lower(), 1))
    return None if words < 2 else ("+" if m["plus"] else "") + "".join(out)


_letters_in_digits = re.compile(r"(?<=[0-9])[OoIl|](?=[\x20().-]{0,2}[0-9OoIl|])|(?<=[0-9][\x20.-])[OoIl|](?=[0-9])")
_as_digit = {"O": "0", "o": "0", "I": "1", "l": "1", "|": "1"}
_long_number = re.compile(r"[0-9OoIl|](?:[\x20().-]{0,2}[0-9OoIl|]){8,}")


def _number(m: re.Match) -> str | None:
    return _as_digit[m[0]] if m[0] in _as_digit else None


def normalise(text: str) -> Mapped:
    """The text with its disguises rewritten."""
    mapped = Mapped(text)
    if not text.isascii() or "&" in text:
        mapped = mapped.rewrite(_odd, _plain)
    now = mapped.text
    low = now.lower().replace("\n", " ")
    if any(h in low for h in _bracket_hints):
        mapped = mapped.rewrite(_bracketed_at, lambda m: "@").rewrite(_bracketed_dot, lambda m: ".")
        low = mapped.text.lower().replace("\n", " ")
    if _bare_end.search(mapped.text):
        mapped = mapped.rewrite(_bare, _joined)
    if _spoken_dot.search(mapped.text):
        mapped = mapped.rewrite(_spoken_ip, lambda m: ".".join(re.findall("[0-9]+", m[0])))
    if _spells(low):
        mapped = mapped.rewrite(_run, _digits)
    now = mapped.text
    if any(any(c in _as_digit for c in m[0]) for m in _long_number.finditer(now)):
        for _ in range(3):
            mapped = mapped.rewrite(_letters_in_digits, _number)
    return mapped


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind and then start, in code points, ends exclusive. None is empty."""
    if not text:
        return [], []
    base = detect(text)
    mapped = normalise(text)
    if mapped.text == text:
        return base, base
    taken: dict[str, list[tuple[int, int]]] = {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
    more = []
    for kind, start, end in detect(mapped.text):
        left, right = mapped.source(start, end)
        if text[left:right] == mapped.text[start:end] or any(left < e and s < right for s, e in taken[kind]):
            continue
        if kind == "email" and not re.fullmatch(r"[A-Za-z]{2,24}", mapped.text[start:end].rsplit(".", 1)[1]):
            continue
        taken[kind].append((left, right))
        more.append((kind, left, right))
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span, spans that overlap together, as [KIND]."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def find_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, spans array<struct<kind, start, end, base>>) for each row; null and empty texts have no spans."""

    def make():
        def spans(text):
            base, every = find(text)
            plain = set(base)
            return [{"kind": k, "start": s, "end": e, "base": (k, s, e) in plain} for k, s, e in every]

        return lambda b: {id_col: b[id_col], "spans": [spans(t) for t in b[text_col]]}

    kind = df.schema[id_col].dataType.simpleString()
    return map_rows(df.select(id_col, text_col), make, f"{id_col} {kind}, spans array<struct<kind: string, start: int, `end`: int, base: boolean>>")


def digest_spans(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of base spans by kind, base_sha256 and all spans as text.

    Null and empty texts have no spans; repeated rows are each returned; of spans of one kind that overlap, a base one
    counts, else the first. An empty table stays empty; extra columns are not looked at."""

    def make():
        def work(b):
            out = {"doc_id": b["doc_id"]} | {f"n_{k}": [] for k in KINDS} | {"base_sha256": [], "spans": []}
            for text in b["text"]:
                base, every = find(text)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(every))
            return out

        return work

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """docs with every span masked by its kind, and the length column, if there is one, set to the code points that are
    left. Null texts stay null, empty ones empty; repeated rows are each returned; other columns pass unchanged."""
    columns = docs.columns
    keep = tuple(c for c in columns if c not in (text_col, length_col))

    def make():
        def work(b):
            texts = [t if t is None else mask(t, find(t)[1]) for t in b[text_col]]
            if length_col not in b:
                return {text_col: texts}
            return {text_col: texts, length_col: [n if t is None else len(t) for t, n in zip(texts, b[length_col])]}

        return work

    new = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns if c not in keep)
    return map_rows(docs, make, new, keep=keep).select(*(f"`{c}`" for c in columns))
