"""Small tables with the awkward cases every operator must take."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, size long, node long, "
          "cell long, component_id long, `class` string, label string, copies string, position double")


def docs(spark, rows):
    """``rows``: (doc_id, text[, lang[, source]]); the columns after n_chars
    carry names that the operators use themselves."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, *[None] * (4 - len(r)))
        full.append((doc_id, text, lang, source, len(text) if text is not None else None, 9.5, -1, -2, -3, -4, "x", "y", "z", 1.5))
    return spark.createDataFrame(full, SCHEMA)


def words(seed, n, stock="alpha beta gamma delta river stone cloud window garden seven paper silver bright"):
    rng = random.Random(seed)
    stock = [a + b for a in stock.split() for b in ("", "ing", "ed", "ly", "er", "s")]
    return [rng.choice(stock) for _ in range(n)]


def awkward():
    """Null, empty, blank, one word, marks only, very long, repeated rows,
    null id, other scripts."""
    long = " ".join(words(1, 20000))
    return [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "!!! ... ---"), (6, long), (6, long), (7, long + " tail"),
            (8, "Ünïcode ﬁne   İstanbul é \x0b x"), (None, "a row without an id but with words in it"), (9, "one"), (9, "two")]
