import math
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions import lid
from millrace.functions import text as X
from millrace.functions.ids import document_id
from millrace.functions.lid import LinearModel, fit_linear, with_language
from millrace.functions.xml2md import CRITICAL, HIGH, LOW, MEDIUM, convert


def doc(inner):
    return f"<doc><main>{inner}</main></doc>"


@pytest.mark.parametrize(
    "xml, md",
    [
        ('<head rend="h1">Main Heading</head><p>Paragraph text here.</p>', "# Main Heading\n\nParagraph text here."),
        ('<head rend="h2">Subheading</head><head rend="h3">Sub-subheading</head>', "## Subheading\n\n### Sub-subheading"),
        ("<code>def function():\n    return True</code>", "```\ndef function():\n    return True\n```"),
        ("<quote>Multiline\nblockquote\nhere</quote>", "> Multiline\n> blockquote\n> here"),
        ('<list rend="ol"><item>First</item><item/><item>Third</item></list>', "1. First\n2. Third"),
        ("<list><item>Parent<list><item>Nested 1</item><item>Nested 2</item></list></item></list>", "- Parent\n    - Nested 1\n    - Nested 2"),
        ('<hi rend="#b">Bold text</hi> and <hi rend="#i">italic text</hi>', "**Bold text**\nand\n*italic text*"),
        ('<hi rend="#sup">a</hi>', "<sup>a</sup>"),
        ("<del>gone</del>", "~~gone~~"),
        ('<p>Auto link: <ref target="https://example.com"></ref></p>', "Auto link: [https://example.com](https://example.com)"),
        ('<table><row><cell role="head">H|1</cell><cell>H2</cell></row><row><cell>D1</cell></row></table>', "| H\\|1 | H2 |\n|---|---|\n| D1 |  |"),
        ('<p>Complex: <hi rend="#b">bold with *asterisk*</hi> and _underscore_</p>', "Complex: **bold with \\*asterisk\\*** and \\_underscore\\_"),
        ('<list><item>Item with <hi rend="#i">italic</hi></item></list>', "- Item with\n  *italic*"),
        ('<p>Mixed <hi rend="#b">formatting <hi rend="#i">nested</hi> text</hi> here</p>', "Mixed **formatting *nested* text** here"),
        ("<p>This *wo_rd* sh_ould be escaped</p>", "This \\*wo\\_rd\\* sh\\_ould be escaped"),
        ("<p>This * word* should not be escaped</p>", "This * word* should not be escaped"),
        ("<p>This ** and __ and ~~ and &lt;&gt; are empty</p>", "This \\*\\* and \\_\\_ and \\~\\~ and \\<\\> are empty"),
        ("<p>This *spans\nmultiple\nlines* text</p>", "This *spans\nmultiple\nlines* text"),
        ("<p>+ Plus at start\n- Minus at start\n1. Number dot</p>", "\\+ Plus at start\n\\- Minus at start\n1\\. Number dot"),
        ("<p>a<lb/>b</p>", "ab"),
    ],
)
def test_markdown(xml, md):
    assert convert(doc(xml)) == (md, None, None)


@pytest.mark.parametrize(
    "xml, md, severity",
    [
        (None, None, MEDIUM),
        ("<doc/>", None, HIGH),
        ("<doc><main/></doc>", None, LOW),
        ("<doc><main> </main></doc>", "", CRITICAL),
        (doc("<th/>"), None, HIGH),
        ("<doc><main>", None, HIGH),
        ("<main><p>x</p></main>", None, HIGH),
        (doc("<table><row><cell>x</cell></row></table>"), None, LOW),
        (doc('<table><row span="2"><cell role="head">x</cell></row></table>'), None, LOW),
        (doc("<p><ref>x</ref></p>"), None, MEDIUM),
        (doc("<list><item>" * 6 + "x" + "</item></list>" * 6), None, MEDIUM),
        (doc("<div>" * 3000 + "x" + "</div>" * 3000), None, HIGH),
    ],
)
def test_markdown_problems(xml, md, severity):
    assert convert(xml)[::2] == (md, severity)


def test_markdown_of_deep_elements_by_any_limit_of_calls():
    usual = sys.getrecursionlimit()
    try:
        for limit in (1000, 10_000):
            sys.setrecursionlimit(limit)
            for levels, md in ((400, "x"), (600, None), (3000, None)):
                assert convert(doc("<div>" * levels + "x" + "</div>" * levels))[::2] == (md, None if md else HIGH)
    finally:
        sys.setrecursionlimit(usual)


def test_text_functions(spark):
    rows = spark.createDataFrame([(1, "  Hello,  World 42!\nÉté "), (2, ""), (3, None), (4, "a")], "i int, t string")
    got = {r["i"]: r for r in rows.select("i", X.lid_normalise(F.col("t")).alias("n"), X.length_class(F.col("t")).alias("c"), X.line_count(F.col("t")).alias("l"), X.has_text(F.col("t")).alias("h")).collect()}
    assert got[1]["n"] == "hello world  été" and got[1]["l"] == 2
    assert [got[i]["c"] for i in (1, 2, 3, 4)] == [">1", "0", "0", "1"]
    assert [got[i]["h"] for i in (1, 2, 3, 4)] == [True, False, False, True]
    assert got[3]["n"] is None and got[3]["l"] == 1


def test_scalars(spark):
    row = spark.range(1).select(
        X.rounded_probability(F.lit("0.00005").cast("decimal(9,5)")).cast("double").alias("p"),
        X.bare_label(F.lit("__label__eng_Latn")).alias("b"),
        X.language_of(F.lit("eng_Latn")).alias("l"),
        X.wds_bin(F.lit(1.0)).alias("w"),
        X.file_stem(F.lit("/a/b/c.zst")).alias("f"),
        document_id(F.lit("a"), F.lit("b"), F.lit("c")).alias("id"),
        F.array(*(X.crawl_infix(F.lit(c).cast("string")) for c in ("archivebot", "wide00016", None, "CC-MAIN-2025-05"))).alias("i"),
    ).first()
    assert (row["p"], row["b"], row["l"], row["w"], row["f"]) == (0.0, "eng_Latn", "eng", 10, "c")
    assert row["id"] == "06b05ab6733a618578af5f94892f3950" and row["i"] == ["ab", "ia", "cc", "cc"]


def test_html_records(spark):
    page = '<html lang="en"><head><meta http-equiv="content-language" content="fr"><meta property="og:locale" content="de_DE"></head><body><nav>menu</nav><article><h1>T</h1><p>One <b>two</b> <a href="/x">three</a><p>Four</article><div id="my-WP-Translate"></div></body></html>'
    got = spark.createDataFrame([(1, page), (2, ""), (3, None)], "i int, h string").select("i", H.html_records()("h").alias("r")).select("i", "r.*").orderBy("i").collect()
    assert got[0]["t"] == "T\nOne two three\nFour" and got[0]["metalang"] == ["fr", "de_DE"] and got[0]["htmllang"] == ["en"]
    assert got[0]["tagfilter"] == ["div", "id", "my-WP-Translate"] and got[0]["traferr"] is None
    assert convert(got[0]["x"])[0] == "# T\n\nOne **two** [three](/x)\n\nFour"
    assert got[1]["t"] is None and got[1]["traferr"] and got[2]["traferr"]


def test_tag_filter():
    tags = H.TagFilter()
    assert tags.match(H.load('<a data-trp-gettext="">x</a>')) == ["a", "data-trp-gettext", ""]
    assert tags.match(H.load('<a data-trp-gettext="x">x</a>')) is None
    assert H.TagFilter.from_lines(["# c", "p\tid\tab+", ""]).match(H.load('<p id="xABB">')) == ["p", "id", "xABB"]


class _Slow:
    def text(self, root):
        while True:
            pass

    def xml(self, root):
        return "x"


def test_time_limit():
    got = H.page_record("<p lang=x>a</p>", _Slow(), None, 0.2)
    assert got["traferr"] == ["Extraction timed out: 0.2s"] and "x" not in got
    assert H.page_record(b"<p>a\xff</p>", H.BlockExtractor(), None, None)["t"] == "a"


def test_time_limit_holds_in_c_code(spark):
    """The page ends with the error, its neighbours are there, and what was done before a mere slowness stays."""

    class Stuck(H.BlockExtractor):
        """Hangs in C, where no signal is seen; dies; or is only slow."""

        def text(self, root):
            whole = "".join(root.itertext())
            if "stuck" in whole:
                sum(iter(int, 1))
            if "dies" in whole:
                os.kill(os.getpid(), 9)
            while "slow" in whole:
                pass
            return super().text(root)

    pages = ["one", "stuck", "two", "slow", "dies", "three", "stuck", None]
    html = [p and f'<html lang="en"><p>{p}</p></html>' for p in pages]
    rows = spark.createDataFrame(list(enumerate(html)), "i int, h string").coalesce(1)
    got = {r["i"]: r["r"] for r in rows.select("i", H.html_records(Stuck, limit=0.5)("h").alias("r")).collect()}
    assert [got[i]["t"] for i in (0, 2, 5)] == ["one", "two", "three"] and all(got[i]["traferr"] is None for i in (0, 2, 5))
    assert [got[i]["traferr"] for i in (1, 3, 6)] == [["Extraction timed out: 0.5s"]] * 3
    assert got[3]["htmllang"] == ["en"] and got[1]["htmllang"] is None
    assert got[4]["traferr"] == ["Extraction ended by itself: -9"] and got[7]["traferr"]


def test_language(spark):
    rows = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 3, "text string, lang string")
    model = fit_linear(rows)
    assert isinstance(model, LinearModel)
    out = with_language(rows.union(spark.createDataFrame([("", None), (None, None)], "text string, lang string")), lambda: model, "openlid-v3").collect()
    assert all(r["openlid_v3"]["lang"][0] == r["lang"] for r in out if r["text"])
    assert all(r["openlid_v3"]["lang"] is None for r in out if not r["text"])


def _place(gram):
    mixed = 0
    for n, c in enumerate(gram, 1):
        mixed = (mixed + ord(c) + n) * 0x9E3779B97F4A7C15 % 2**64
    return (mixed >> 40) % lid.BUCKETS


def test_linear_model_against_plain_sums(monkeypatch):
    """All texts' n-grams looked up at once give what adding them up one by one gives, however they are cut."""
    rng = random.Random(3)
    counts = np.array([[rng.randrange(50) * (rng.random() < 0.3) for _ in range(3)] for _ in range(lid.BUCKETS)])
    model = LinearModel(counts, ["a", "b", "c"])
    texts = ["".join(rng.choice("xyZ é\U0001f600") for _ in range(rng.randrange(0, 80))) for _ in range(50)]
    wanted = []
    for text in texts:
        padded = f" {text.lower()} "
        places = [_place(padded[i : i + n]) for i in range(len(padded)) for n in range(lid.LEAST, lid.MOST + 1) if i + n <= len(padded)]
        mean = [sum(float(model.weights[p, k]) for p in places) / max(1, len(places)) for k in range(3)]
        weights = [math.exp(lid.SHARP * (m - max(mean))) for m in mean]
        wanted.append(sorted(((-w / sum(weights), f"__label__{x}") for w, x in zip(weights, "abc"))))
    for together, added in ((1 << 20, 1 << 18), (100, 7), (1, 1)):
        monkeypatch.setattr(lid, "TOGETHER", together)
        monkeypatch.setattr(lid, "ADDED", added)
        for (names, probs), want in zip(model.predict_all(texts, 3), wanted):
            assert probs == pytest.approx([-p for p, _ in want], abs=1e-6)
            assert names == [x for _, x in want] or probs[0] == pytest.approx(probs[-1], abs=1e-6)
    assert LinearModel(np.zeros((lid.BUCKETS, 0)), []).predict("text", 3) == ([], [])


def test_labelled_rows_are_drawn_one_by_one(spark):
    same = spark.range(5_000).selectExpr("'der gleiche Satz' AS text", "'de' AS lang")
    docs = same.unionByName(spark.createDataFrame([(f"the same {i}", "en") for i in range(20)] + [("", "fr"), (None, "fr"), ("x", None)], "text string, lang string"))
    assert {r["lang"]: r["count"] for r in lid.sampled(docs, "text", "lang", 50).groupBy("lang").count().collect()} == {"de": 50, "en": 20}
    assert fit_linear(docs, sample=50).langs == ["de", "en"] and fit_linear(docs.limit(0)).langs == []


def test_labelled_rows_are_not_brought_together_before_they_are_drawn(spark):
    """The counts of languages are sent to the rows, whatever Spark thinks of their size: else a task gets all texts of one."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.range(500).selectExpr("concat('text ', id) AS text", "if(id % 2 = 0, 'de', 'en') AS lang")
        plan = lid.sampled(docs, "text", "lang", 50)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_ids_by_a_second_implementation(spark):
    """128-bit xxHash of the parts as they are; the value for abc was worked out apart."""
    from millrace.functions.ids import document_id

    rows = spark.createDataFrame([("a", "b", "c"), ("ab", "c", ""), ("é", "/x", "2"), ("a", None, "c")], "f string, u string, t string")
    got = [r[0] for r in rows.select(document_id(F.col("f"), F.col("u"), F.col("t"))).collect()]
    state = xxhash.xxh3_128()
    for part in ("é", "/x", "2"):
        state.update(part.encode())
    assert got == ["06b05ab6733a618578af5f94892f3950"] * 2 + [state.hexdigest(), None]


def test_labelled_language(spark):
    from millrace.functions.lid import labelled_language

    rows = spark.createDataFrame([(x,) for x in ('{"openlid-v3": {"lang": ["eng_Latn", "x"]}}', '{"openlid-v3":{"lang":["eng_Latn"]}}', "{}", None)], "v string")
    assert [r[0] for r in rows.select(labelled_language(F.col("v"))).collect()] == ["eng_Latn", None, None, None]


def test_markdown_lines_and_raw(spark):
    from millrace.functions.xml2md import markdown_lines, raw_markdown

    rows = spark.createDataFrame([(x,) for x in ('{"a":[1],"x":"<doc><main><p>t</p></main></doc>"}', ' {"a":null} ', "", "broken {", "[1]", None)], "v string")
    assert [r[0] for r in rows.select(markdown_lines(F.col("v"))).collect()] == ['{"a":[1],"x":"<doc><main><p>t</p></main></doc>","md":"t"}', '{"a":null,"md":null}', "", "broken {", "[1]", None]
    assert [r[0] for r in rows.select(markdown_lines(F.col("v"), md_only=True)).collect()][:2] == ['{"md":"t"}', '{"md":null}']
    xml = spark.createDataFrame([("<doc><main><p>t</p></main></doc>",), ("",), (None,), ("<doc/>",)], "x string")
    assert [r[0] for r in xml.select(raw_markdown("x")).collect()] == ["t", None, None, None]


@given(st.lists(st.integers(-9, 9), max_size=14))
def test_best_run_against_all_runs(scores):
    sums = {(i, j): sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)}
    start, end = H.best_run(scores)
    if max(sums.values(), default=0) <= 0:
        assert start == end
    else:
        assert sums[start, end] == max(sums.values())


def _read(html, **options):
    return H.BlockExtractor(**options).text(H.load(html))


LONG = "This is a long paragraph of running text that says what the page is about, in some detail."


def test_main_text_without_an_article():
    menu = "<div class=menu>" + "".join(f"<div><a href=/{i}>Section {i} of the site</a></div>" for i in range(8)) + "</div>"
    page = f"<body>{menu}<div><h1>Title</h1><p>{LONG}</p><p><a href=/x>Read more of these stories here</a></p><p>Short one.</p><p>{LONG} Again.</p></div><div class='related'><p>Something else that many words are said about, but not here at all.</p></div><p>(c) 2020</p></body>"
    assert _read(page).split("\n") == ["Title", LONG, "Short one.", LONG + " Again."]


def test_passes_grow_looser():
    """A main part that leaves too little gives way; one that is short because the page is doesn't."""
    teaser = f"<body><article><p>Teaser.</p></article><div><p>{LONG}</p><p>{LONG}</p></div></body>"
    assert _read(teaser).split("\n") == ["Teaser.", LONG, LONG] or _read(teaser).split("\n") == [LONG, LONG]
    assert _read("<body><p>Few words</p></body>") == "Few words"
    assert _read("<body><article><p>Few words</p></article><p>And these</p></body>") == "Few words"
    several = f"<body><article><p>One.</p></article><article><p>{LONG}</p></article><article><p>Two.</p></article></body>"
    assert _read(several) == LONG
    assert _read(several, precision=False) == LONG
    assert _read("<body><a href=/>only</a> <a href=/b>links</a></body>", least=250) is None


def test_comments_follow_or_go():
    page = f"<body><article><p>{LONG}</p><div id=comments><p>A reader says that this is very good indeed.</p></div></article><p>{LONG} Outside.</p></body>"
    assert _read(page).split("\n") == [LONG, "A reader says that this is very good indeed."]
    assert _read(page, comments=False) == LONG


def test_precision_and_recall_on_pages_without_article(data):
    """The table's pages with all telling elements and names taken away: words found, and words of the pages as they were."""
    import duckdb

    right = found = wanted = 0
    for (html,) in duckdb.sql(f"SELECT html FROM '{data}/pages.parquet'").fetchall():
        truth = Counter((_read(html) or "").split())
        for tag in ("nav", "article", "footer"):
            html = re.sub(f"<(/?){tag}>", r"<\1div>", html)
        got = Counter((_read(html.replace('class="ad"', "")) or "").split())
        right, found, wanted = right + sum((got & truth).values()), found + sum(got.values()), wanted + sum(truth.values())
    print("precision", right / found, "recall", right / wanted)
    assert right / found > 0.95 and right / wanted > 0.97


@pytest.mark.parametrize("limit", [None, 10.0])
def test_pages_go_on_in_parts(limit):
    """Records of a batch are given out some at a time, all pages in order; long pages are a part each."""
    from millrace.functions import html

    texts = ["<p>" + "long " * (html.GIVEN_SIZE // 4) + "</p>", *(f'<html lang="l{i}"><p>text' for i in range(600)), None]
    got = list(html.html_records(limit=limit).func(iter([pd.Series(texts, dtype=object), pd.Series([], dtype=object)])))
    assert [len(g) for g in got] == [1, 256, 256, 89, 0]
    assert [r for g in got for r in g["htmllang"]][1:-1] == [[f"l{i}"] for i in range(600)]
