import random
import re
import zlib

import pytest

from millrace.llm import htmltext as H


def page(i, body=None):
    art = body or f"<p>Story number {i} tells of {i * 37} things &amp; more, in   many\n words.</p><p>Then {i} has another paragraph with some words {i}."
    return f'<html><head><title>x{i}</title><script>var a="</p>";</script></head><body><div class="q1"><a href="/">Home of the site</a> Welcome all</div><div class="q2"><h1>Title {i}</h1><div>{art}</div><div>Read our other stories every day</div></div><div class="q3">All rights reserved forever</div></body></html>'


def test_wrapper_drops_what_is_constant():
    wrapper = H.induce([page(i) for i in range(8)])
    assert H.extract(page(3), wrapper) == "Title 3\n\nStory number 3 tells of 111 things & more, in many words.\n\nThen 3 has another paragraph with some words 3."


def test_one_article_on_many_pages_is_no_template():
    same = [f"<html><body><nav>n{i}</nav><article><h1>Same</h1><p>The very same story on all pages.</p></article></body></html>" for i in range(8)]
    assert H.extract(same[0], H.induce(same)) == "Same\n\nThe very same story on all pages."


def test_named_parts():
    html = '<main><header><h1>T</h1></header><p>a &lt;b&gt;&nbsp;c<br>d<ul><li>x<li>y</ul><form>f</form><section id="comments"><p>no</p></section><div class="ad">no</div><p style="display: none">no</p></main><footer>no</footer>'
    assert H.extract(html) == "T\n\na <b> c d\n\nx\n\ny"
    assert H.extract("<div class=cookie-notice>no</div><p>yes, this is text</p><aside>no</aside>") == "yes, this is text"


def test_edges():
    assert H.extract(None) == H.extract("") == H.extract("<p></p>") == ""
    assert H.extract("plain text") == "plain text"
    assert H.extract("<div>" * 3000 + "deep text" + "</div>" * 3000) == "deep text"
    assert len(H.extract("<article>" + "<p>word</p>" * 20000 + "</article>").split("\n\n")) == 20000


def test_deep_elements_close_no_others():
    deep = "<div>" * 130 + "inner" + "</div>" * 130
    assert H.extract(f"<div id=page><article><h1>t</h1>{deep}<p>rest</p></article></div>") == "t\n\ninner\n\nrest"
    hidden = "<div>" * 130 + "a<script>var x</script>b<nav><div>menu</div></nav>c<p hidden>no<b>no</b></p>d" + "</div>" * 130
    assert H.extract(f"<article>{hidden}<p>rest</p></article>").replace("\n\n", " ") == "a b c d rest"


def told(i, inner):
    return f"<html><body><nav><a href=/>Home</a></nav><article><h1>Title {i}</h1><p>Story number {i} tells of {i * 37} things in many words, and of {i} more.</p>{inner}<p>The end of story {i} comes after {i * 11} words.</p></article><footer>All rights reserved</footer></body></html>"


def test_alignment_decides_in_the_slot(spark):
    """Paragraphs in boxes of any name stay where they differ from page to page; what all pages have goes, but for headings
    of what is the page's own; lists of comments go."""
    inner = lambda i: f"<div class='legal'><p>The court case {i} went on.</p></div><section class='related'>Third {i}.</section><h2>Background</h2><p>It began {i} years ago.</p><h2>Read on</h2><div class='box'>Our newsletter is out</div><div class='comments'><p>I liked number {i} a lot, says reader {i * 3}.</p></div>"
    rows = [(i, f"http://one.example.org/{i}", told(i, inner(i))) for i in range(20)]
    got = {r["page_id"]: r["text"].split("\n\n") for r in H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(20):
        assert got[i] == [f"Title {i}", f"Story number {i} tells of {i * 37} things in many words, and of {i} more.", f"The court case {i} went on.", f"Third {i}.", "Background", f"It began {i} years ago.", f"The end of story {i} comes after {i * 11} words."]


def test_names_without_a_wrapper():
    """Only what is short, linked or a form goes by a doubtful name; what can be nothing else always goes."""
    html = told(1, "<div class='notice'><p>Second paragraph is a real part of this story</p></div><div class='related'><a href=/1>One story of many that you may read next</a> and more</div><div class='legal'>Only <input> this form with its many, many words</div><div class=comments><p>A reader has written so many words that it is long</p></div><div class='notice'>Short one</div>")
    assert H.extract(html).split("\n\n")[2:] == ["Second paragraph is a real part of this story", "The end of story 1 comes after 11 words."]


def _plain_text(node, strict):
    """Texts of blocks by recursion, what is marked left out."""
    out = [""]
    for item in node.items:
        if isinstance(item, str):
            out[-1] += "" if id(node) in strict else item
        elif item.tag == "br":
            out[-1] += " "
        elif not (item.tag in H.SILENT or item.tag in H.ASIDE or item.hidden):
            inner = _plain_text(item, strict)
            if item.tag in H.INLINE:
                out[-1] += inner[0]
                out += inner[1:]
            else:
                out += [*inner, ""]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_whole_hosts_against_a_plain_wrapper(spark, seed):
    """Pages of made-up templates: the operator's text is what is left when every node whose text at its place all pages of
    the host share is taken out of the part that all the varying text lies in."""
    rng = random.Random(seed)
    names = ["legal", "box", "side", "x1", "notice", "story", ""]
    boxes = [(rng.choice(names), rng.random() < 0.5) for _ in range(6)]
    fixed = [f"Fixed words {k} of this very site {rng.random()}" for k in range(6)]

    def make(i):
        parts = "".join(f"<div class='{n}'><p>{f'Own words {k} of page {i} number {i * 13 + k} and so on' if own else fixed[k]}</p></div>" for k, (n, own) in enumerate(boxes))
        return f"<html><body><div class='top'>Welcome to this site</div><div class='mid'><h1>Heading {i}</h1><p>Long prose of page {i} that differs from all of the {i * 7} other ones in it.</p>{parts}</div><div class='end'>All rights reserved here</div></body></html>"

    pages = {i: make(i) for i in range(10)}
    trees_ = {i: H.parse(h) for i, h in pages.items()}
    flat = {i: list(H._walk(t)) for i, t in trees_.items()}
    wanted = {}
    for i, nodes in flat.items():
        strict = {id(n) for k, n in enumerate(nodes) if n.own_text() and all(flat[j][k].own_text() == n.own_text() for j in flat)}
        slot = next(n for n in nodes if n.name == "mid")
        wanted[i] = [" ".join(t.split()) for t in _plain_text(slot, strict) if t.split()]
    got = {r["page_id"]: r["text"].split("\n\n") for r in H.extract_pages(spark.createDataFrame([(i, f"http://h{seed}.example.org/{i}", h) for i, h in pages.items()], "page_id long, url string, html string")).collect()}
    assert got == wanted


def test_no_paragraph_goes_for_its_name():
    html = "<article><p class='legal'>The legal history of X.</p><p class='side'>Body two.</p><h2 class='notice'>A notice</h2><div class='comments'>me too</div></article>"
    assert H.extract(html) == "The legal history of X.\n\nBody two.\n\nA notice"


def plain(a, b):
    """Simple tree matching by its definition: every child against every child."""
    if a.label != b.label:
        return 0
    xs, ys = a.children(), b.children()
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + plain(x, y))
    return best[-1][-1] + 1 + 2 * (a.own_text() == b.own_text() != "")


def trees(n):
    rng = random.Random(n)

    def grow(depth):
        return H.Node(rng.choice("abc"), items=[*([rng.choice("xyz")] if rng.random() < 0.5 else []), *(grow(depth - 1) for _ in range(rng.randrange(4) if depth else 0))])

    return [H.Node("r", items=[grow(3) for _ in range(4)]) for _ in range(2)]


@pytest.mark.parametrize("n", range(60))
def test_tree_matching_against_brute_force(n):
    one, two = trees(n)
    for t in (one, two):
        H._digests(t)
    weight, pairs = H.match(one, two)
    assert weight == plain(one, two) == sum(1 + 2 * (x.own_text() == y.own_text() != "") for x, y in pairs)
    assert all(x.label == y.label for x, y in pairs) and len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)


def test_long_lists_are_aligned_whole():
    """Constant parts in the middle of many differing children are found, with and without children to cut at."""
    def long(k):
        return "<html><body>" + "".join(f"<p>{k}-{i} own words here</p>" + ("<div>Buy our things today</div>" if i == 150 else "") for i in range(300)) + "</body></html>"

    assert H.induce([long(k) for k in range(4)]).count("Buy our things") == 1
    assert "Buy" not in H.extract(long(9), H.induce([long(k) for k in range(4)])) and "9-299 own" in H.extract(long(9), H.induce([long(k) for k in range(4)]))
    plain_ = lambda k: "<ul>" + "".join(f"<li>{k * 1000 + i}</li>" for i in range(400)) + "</ul>"
    one, two = H.parse(plain_(1)), H.parse(plain_(2))
    for t in (one, two):
        H._digests(t)
    assert len(H.match(one, two)[1]) == 402


def test_wrapper_decides_whatever_parts_are_called(spark, data):
    """Pages of the table with elements and names that tell nothing: with their hosts' wrappers the text is that of the pages
    as they were, on nine of ten; without, on fewer."""
    pages = spark.read.parquet(f"{data}/pages.parquet")
    blind = lambda html, host: re.sub(r"<(/?)(nav|article|footer)>", lambda m: "</div>" if m[1] else f'<div class="k{zlib.crc32((host + m[2]).encode()) % 999}">', re.sub(r'class="ad"', f'class="k{zlib.crc32(host.encode()) % 999}"', html))
    rows = [(r["page_id"] * 10 + k, f"http://one.example.org/{r['page_id']}", blind(r["html"], "one"), H.extract(r["html"])) for r in pages.collect() for k in (0,)]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in H.extract_pages(df).collect()}
    by_wrapper = sum(got[i] == want for i, _, _, want in rows) / len(rows)
    alone = sum(H.extract(html) == want for _, _, html, want in rows) / len(rows)
    print("share with a wrapper", by_wrapper, "without", alone)
    assert by_wrapper >= 0.9 and alone < by_wrapper


def test_operator(spark):
    rows = [(i, f"http://User@Site.example.org:80/{i}", page(i)) for i in range(12)]
    rows += [(100, None, "<p>no host here at all</p>"), (101, "http://lone.example.org/", "<p>alone on its host</p>"), (102, "http://lone.example.org/x", None), (3, "http://site.example.org/3", page(3)), (None, "http://site.example.org/z", page(5))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS host", "1 AS n", "'w' AS wrapper", "'t' AS text")
    got = H.extract_pages(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["n_chars"] == len(r["text"])
        if r["page_id"] is not None and r["page_id"] < 100:
            assert r["text"].startswith(f"Title {r['page_id']}\n\nStory number {r['page_id']} ") and "reserved" not in r["text"]
    by = {r["page_id"]: r["text"] for r in got}
    assert by[100] == "no host here at all" and by[101] == "alone on its host" and by[102] == ""
    assert H.extract_pages(df.limit(0)).count() == 0


def test_template_of_a_part_of_the_pages(spark):
    def layout(i):
        extra = '<div class="k1"><span>Moved to a new house this year</span></div>' if i % 5 == 0 else ""
        return f'<html><body><div class="m"><b>Section {"ABC"[i % 3]} of the site</b></div><article>{extra}<p>Story number {i} tells of {i * 37} things in many words.</p></article></body></html>'

    rows = [(i, f"http://a.example.org/{i}", layout(i)) for i in range(60)] + [(i, f"http://b{j}.example.org/{i}", page(i)) for j in range(20) for i in range(100 + 3 * j, 103 + 3 * j)]
    got = {r["page_id"]: r["text"] for r in H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(60):
        assert got[i] == f"Story number {i} tells of {i * 37} things in many words."
    for i in range(100, 160):
        assert "reserved" not in got[i] and f"Story number {i} " in got[i]


def test_wrappers_too_large_to_be_sent(spark, data, monkeypatch):
    """Where wrappers and common texts are looked up by joins, with hot hosts, the texts are the same."""
    from millrace.llm import common

    rows = [(i, f"http://{'hot' if i % 3 else 'h' + str(i % 7)}.example.org/{i}", page(i)) for i in range(90)] + [(1000, None, "<p>no host</p>"), (3, "http://hot.example.org/3", page(3)), (None, "http://hot.example.org/n", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").unionByName(spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html"))
    wanted = sorted(map(tuple, H.extract_pages(df).collect()), key=str)
    monkeypatch.setattr(H, "SENT_BYTES", 0)
    monkeypatch.setattr(H, "SENT_IDS", 0)
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    assert sorted(map(tuple, H.extract_pages(df).collect()), key=str) == wanted


def test_paths_are_hashed_once_for_like_pages():
    """Pages of a host share their paths: only the first one's are hashed; digits in names don't tell."""
    html = "<html><body><div class='item7'><p>one</p></div><div class='item8'><p>two</p></div></body></html>"
    first = [(path, key) for _, path, key in H._texts(H.parse(html))]
    before = H._path.cache_info().misses
    again = [(path, key) for _, path, key in H._texts(H.parse(html.replace("two", "other")))]
    assert H._path.cache_info().misses == before
    assert len({path for path, _ in first}) == 1 and {path for path, _ in again} == {path for path, _ in first} and len(set(first) & set(again)) == 1
