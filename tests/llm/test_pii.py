import hashlib
import random
import re

import pytest
from helpers import corpus, documents

from millrace.llm import pii


def brute(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]


def test_base_is_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(20000):
        text = "".join(rng.choices(rng.choice(["a@.1-", "0123456789 -", ".12 5", "+1 (2).-9", "a@b.c%x é"]), k=rng.randrange(40)))
        assert pii.detect(text) == brute(text), text
    assert pii.detect("9" * 400 + ".1.2.3") == brute("9" * 400 + ".1.2.3")


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
        ("reach me: jane at example dot org please", "email", "jane at example dot org"),
        ("bob (at) example.com", "email", "bob (at) example.com"),
        ("alice@example dot com", "email", "alice@example dot com"),
        ("j＠ex.com", "email", "j＠ex.com"),
        ("write to bob@exаmple.com", "email", "bob@exаmple.com"),
        ("john&#64;example&#46;com", "email", "john&#64;example&#46;com"),
        ("x jo​hn@exam‍ple.com", "email", "jo​hn@exam‍ple.com"),
        ("call plus one five five five one two three four five six seven ok", "phone", "plus one five five five one two three four five six seven"),
        ("+1 (55O) 555-l234", "phone", "+1 (55O) 555-l234"),
        ("+٤٩ ١٢٣ ٤٥٦ ٧٨٩", "phone", "+٤٩ ١٢٣ ٤٥٦ ٧٨٩"),
        ("card four one one one one one one one one one one one one one one one end", "card", "four one one one one one one one one one one one one one one one"),
        ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("ip one nine two dot one six eight dot one dot one.", "ip", "one nine two dot one six eight dot one dot one"),
        ("192[.]168[.]1[.]1", "ip", "192[.]168[.]1[.]1"),
        ("at 10 dot 0 dot 0 dot 1", "ip", "10 dot 0 dot 0 dot 1"),
    ],
)
def test_disguises(text, kind, found):
    base, every = pii.find(text)
    assert base == [] and [(k, text[s:e]) for k, s, e in every] == [(kind, found)]
    assert pii.mask(text, every) == text.replace(found, f"[{kind.upper()}]")


@pytest.mark.parametrize(
    "found, kind",
    [
        ("joe at example.com", "email"),
        ("joe\nat\nexample.com", "email"),
        ("joe arroba example.com", "email"),
        ("joe@example .com", "email"),
        ("joe@example. com", "email"),
        ("joe\t@example.com", "email"),
        ("jane\tat\texample\tdot\torg", "email"),
        ("jane\xa0at\u2003example\xa0dot\xa0org", "email"),
        ("10\tdot\t0\tdot\t0\tdot\t1", "ip"),
        ("10\r\ndot\r\n0\r\ndot\r\n0\r\ndot\r\n1", "ip"),
    ],
)
def test_no_hint_but_the_disguise_itself(found, kind):
    text = f"write: {found}; thanks"
    assert [(k, text[s:e]) for k, s, e in pii.find(text)[1]] == [(kind, found)]


def test_clean_texts_stay_clean():
    for text in ("look at the dot product of x", "I met him at work. Then at dot com", "one of the two or three at home", "a (at) b", "un deux trois", None, ""):
        assert pii.find(text) == ([], [])


def test_operator(spark):
    rows = corpus(seed=2) + [(9001, "a@b.co 1.2.3.4 x 4111 1111 1111 1111 +1 (310) 555-4510 bob (at) ex.org"), (9002, "a@b.co " * 3000)]
    texts = dict(rows)
    got = pii.digest_spans(documents(spark, [*rows, rows[0]])).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        base = brute(texts[r["doc_id"]] or "")
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(filter(None, written.split(","))) <= set(r["spans"].split(","))
    assert pii.digest_spans(documents(spark, [])).count() == 0
    masked = {r["doc_id"]: r for r in pii.mask_documents(documents(spark, rows)).collect()}
    assert masked[9001]["text"] == "[EMAIL] [IP] x [CARD] [PHONE] [EMAIL]" and masked[9001]["n_chars"] == len(masked[9001]["text"])
    spans = pii.find_spans(documents(spark, [(1, "a@b.co")])).first()["spans"]
    assert spans[0].asDict() == {"kind": "email", "start": 0, "end": 6, "base": True}


@pytest.mark.parametrize(
    "text, found",
    [
        ("The shop at amazon.com sells books. Look at example.de for more.", []),
        ("He was at home.com, and I am at work. It rained.", []),
        ("See you @ home. It was fun @ noon. In all.", []),
        ("Write to us at example.com or mail me at example.org.", []),
        ("See the shop. bob at example dot com", ["bob at example dot com"]),
        ("Thanks. joe@example .com", ["joe@example .com"]),
        ("Please contact joe at example.com today.", ["joe at example.com"]),
        ("Bye.  john dot smith at mail dot example dot org!", ["john dot smith at mail dot example dot org"]),
        ("x bei example punkt de, y @ example . com", ["x bei example punkt de", "y @ example . com"]),
        ("joe (at) example (dot) com", ["joe (at) example (dot) com"]),
    ],
)
def test_disguised_addresses_and_prose(text, found):
    """Spans begin at the user part; places that have a domain for a name are no addresses."""
    base, every = pii.find(text)
    assert [text[s:e] for k, s, e in every if k == "email"] == found and not base
    if not found:
        assert pii.mask(text, every) == text
