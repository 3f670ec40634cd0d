"""Small documents with every edge case, and tables with columns that clash with inner names."""

import random

WORDS = "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do".split()
CLASH = {"hash": "'x'", "digest": "'y'", "n": "1", "size": "2", "key": "'k'", "label": "'l'", "bucket": "3", "rep": "4", "piece": "5", "length": "6", "ids": "'i'", "spans": "'s'", "row": "7", "host": "'h'", "v": "'v'", "lang_pred": "'p'", "score": "8", "positions": "9", "h": "10"}


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(spark, rows, clash=True):
    """rows: (doc_id, text[, lang])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *(f"{e} AS `{c}`" for c, e in CLASH.items())) if clash else df


def corpus(seed=1, n=60):
    """Texts with copies, near copies, shared passages, nulls, empty and very long ones, and ties."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.choice([3, 20, 80, 200, 400])) for _ in range(n // 2)]
    passage = sentence(rng, 70)
    texts = list(base)
    for _ in range(n // 2):
        t = rng.choice(base)
        kind = rng.randrange(4)
        words = t.split()
        if kind == 0:
            t = t.upper() if rng.random() < 0.5 else t
        elif kind == 1:
            words[rng.randrange(len(words))] = "changed"
            t = " ".join(words)
        elif kind == 2:
            at = rng.randrange(len(words) + 1)
            t = " ".join(words[:at] + passage.split() + words[at:])
        else:
            t = sentence(rng, 30) + "\n" + passage
        texts.append(t)
    texts += [None, "", " \t\n", "É é ß one", "short", "short", sentence(rng, 5000), "a " * 3000, "x" * 5000]
    rng.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]
