import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from helpers import documents

from millrace.llm import langid

TEXTS = {
    "en": "the house of the man and the dog is in the garden with all the children who play there every day of the week",
    "de": "das haus und der hund sind mit den kindern im garten und spielen dort an jedem tag der woche mit dem ball",
    "fr": "la maison et le chien sont dans le jardin avec les enfants qui jouent chaque jour de la semaine avec la balle",
}


def rows(n=240, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(TEXTS))
        words = TEXTS[lang].split()
        out.append((i, " ".join(rng.choice(words) for _ in range(rng.randrange(8, 30))), lang))
    return out


def test_held_out_accuracy(spark):
    data = rows()
    edge = [(1001, None, "en"), (1002, "", "en"), (1003, "123 !! ²", None), (1004, "unseenword", None), (1005, "the " * 5000, None), (None, "der hund", None)]
    got = langid.identify(documents(spark, [*data, *edge, data[0]])).collect()
    assert len(got) == len(data) + len(edge) + 1
    truth = {i: lang for i, _, lang in data}
    held = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert len(held) > 30 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    by = {r["doc_id"]: r for r in got}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1001, 1002, 1003))
    assert by[1005]["lang_pred"] == "en" and by[None]["lang_pred"] == "de" and by[1004]["lang_pred"] in TEXTS
    assert all(0 <= r["score"] <= 1 for r in got)


def test_held_out_is_by_checksum(spark):
    import zlib

    got = langid.identify(documents(spark, rows(60))).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_labels_of_held_out_rows_teach_nothing(spark):
    import zlib

    data = rows(120)
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in data]
    one, two = (sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(documents(spark, x)).collect()) for x in (data, wrong))
    assert one == two


def test_rare_language_is_learnt(spark):
    data = [(i, f"{t} number{'abcdefghij'[i % 10]} {chr(97 + i // 10 % 26) * 3} {chr(97 + i // 260) * 4}", lang) for i, (t, lang) in enumerate((TEXTS[k], k) for k in ("en", "de") for _ in range(400))]
    data += [(5000 + i, f"{TEXTS['fr']} {'abc'[i]}", "fr") for i in range(3)]
    model = langid.fit(documents(spark, data), sample=20)
    assert model.langs == ("de", "en", "fr") and langid.Scorer(model).predict("la maison et le jardin")[0] == "fr"


def model_of(langs, words, grams):
    """words: {word: {language: n}}; grams: the same for n-grams of any length."""
    tables = [(0, words), *((len(g), {g: by}) for g, by in grams.items())]
    rows = [(langs.index(k), size, langid.key_of(u, size), n) for size, table in tables for u, by in table.items() for k, n in by.items()]
    lang, size, key, n = zip(*rows)
    return langid.model(langs, np.array(lang, int), np.array(size, int), np.array(key, np.uint64), np.array(n, int))


def plain(langs, words, grams, text):
    """Word-first backoff by its definition, one unit at a time: mean log frequency of each language."""
    def logs(table, unit):
        return [math.log((table[unit].get(k, 0) + 0.1) / (sum(by.get(k, 0) for by in table.values()) + 0.1 * len(table))) for k in langs]

    cache, total, found = {}, [0.0] * len(langs), re.findall(r"[^\W\d_]+", text.lower())
    for w in found:
        if w not in cache:
            if w in words:
                cache[w] = logs(words, w)
            else:
                padded, sums = f"_{w}_", [0.0] * len(langs)
                for i in range(len(padded)):
                    gram = next((padded[i : i + n] for n in range(4, 0, -1) if len(padded[i : i + n]) == n and padded[i : i + n] in grams), None)
                    if ("g", gram) not in cache:
                        cache["g", gram] = [-12.0] * len(langs) if gram is None else logs({g: by for g, by in grams.items() if len(g) == len(gram)}, gram)
                    sums = [a + b for a, b in zip(sums, cache["g", gram])]
                cache[w] = [x / len(padded) for x in sums]
        total = [a + b for a, b in zip(total, cache[w])]
    return [t / len(found) for t in total]


def test_backoff():
    scorer = langid.Scorer(model_of(("a", "b"), {"known": {"a": 9, "b": 1}, "other": {"b": 9}}, {"_": {"a": 5, "b": 5}, "xyz": {"b": 8}, "x": {"a": 8}, "zz": {"a": 1}}))
    assert scorer.predict("known")[0] == "a"
    # the longest n-gram counts: xyz speaks for b though x speaks for a
    assert scorer.predict("xyz")[0] == "b" and scorer.predict("x")[0] == "a"


@pytest.mark.parametrize("n_langs", [3, 200])
def test_against_brute_force(n_langs):
    rng = random.Random(n_langs)
    langs = tuple(f"l{i:03}" for i in range(n_langs))
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    some = lambda: {k: rng.randrange(1, 50) for k in rng.sample(langs, min(3, n_langs))}
    words = {word(): some() for _ in range(150)}
    grams = {"".join(rng.choice("_abcdeé") for _ in range(n)): some() for n in (1, 2, 3, 4) for _ in range(40)}
    scorer, other = (langid.Scorer(model_of(langs, words, grams)) for _ in range(2))
    other.index = None
    texts = [" ".join(rng.choice([*words, word(), "7"]) for _ in range(40)) for _ in range(25)] + ["".join(rng.choice("abcdeé") for _ in range(100_000)), "a" * 250 + " " + "b" * 5000 + " known"]
    for text in texts:
        mean = plain(langs, words, grams, text)
        lang, score = scorer.predict(text)
        assert other.predict(text) == (lang, score)
        n = len(re.findall(r"[^\W\d_]+", text.lower()))
        assert mean[langs.index(lang)] >= max(mean) - 1e-5
        assert abs(score - 1 / sum(math.exp((m - max(mean)) * min(n, langid.CERTAIN)) for m in mean)) < 1e-4


def test_memory_for_many_languages():
    """200 languages of 20,000 words, no word in more than three of them: under 150 MB, where a dense table took over 3 GB."""
    rng = np.random.default_rng(1)
    lang, key = np.repeat(np.arange(200), 20_000), rng.integers(0, 2**63, 4_000_000).astype(np.uint64)
    made = langid.model(tuple(map(str, range(200))), lang, np.zeros(len(key), int), key, rng.integers(1, 1000, len(key)))
    assert sum(x.nbytes for x in (made.keys, made.sizes, made.starts, made.langs_of, made.gains, made.base)) < 150e6
    assert langid.Scorer(made).index is None and langid.Scorer(made).find("no word", 0) == -1


def test_one_text_many_times_is_sampled_by_row(spark):
    data = [(i, TEXTS["en"], "en") for i in range(3000)] + [(5000 + i, f"{TEXTS['de']} {chr(97 + i % 26)}", "de") for i in range(400)]
    rows = langid.sampled(documents(spark, data), "text", "lang", 100)
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    assert counts == {"en": 100, "de": 100}


def test_all_of_a_long_word_counts():
    scorer = langid.Scorer(model_of(("a", "b"), {}, {"x": {"a": 900, "b": 1}, "y": {"a": 1, "b": 900}}))
    assert scorer.predict("x" * 300 + "y" * 400)[0] == "b" and scorer.predict("x" * 9000 + "y" * 8000)[0] == "a"
    assert scorer.predict("x" * 150 + "y" * 40)[0] == "a" and all(len(w) <= langid.LONG for w in scorer.words)


def test_the_end_of_a_long_word_is_learnt(spark):
    model = langid.fit(documents(spark, [(1, "x" * 300, "a"), (2, "x" * 300 + "y" * 300, "b")]))
    assert langid.Scorer(model).predict("yyyy")[0] == "b"


def test_no_labels(spark):
    got = langid.identify(documents(spark, [(1, "some text", None), (2, None, None)])).collect()
    assert {r["lang_pred"] for r in got} == {"und"}
    assert langid.identify(documents(spark, [])).count() == 0


@pytest.mark.parametrize("doc_id", [1, 5, 7, None])
def test_rows_that_repeat_are_drawn_one_by_one(spark, doc_id):
    """No language goes because all its rows are alike."""
    same = spark.range(30_000).select(F.lit(doc_id).cast("long").alias("doc_id"), F.lit("der gleiche Satz").alias("text"), F.lit("de").alias("lang"))
    docs = same.unionByName(spark.createDataFrame([(i, f"the same {i}", "en") for i in range(50)], "doc_id long, text string, lang string"))
    counts = {r["lang"]: r["count"] for r in langid.sampled(docs, "text", "lang", 400).groupBy("lang").count().collect()}
    assert counts == {"de": 400, "en": 50}
    assert langid.fit(docs, sample=400).langs == ("de", "en")
