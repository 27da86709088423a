"""Small document tables that hold the awkward cases, and text makers."""

import random

SYLLABLES = ["an", "the", "er", "ou", "tion", "st", "ble", "ha", "re", "in", "é", "ß"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def documents(spark, rows, extra=True):
    """rows: (doc_id, text[, lang]); other columns have names that operators use inside."""
    full = [(d, t, (x[0] if x else "en"), None, -1, "x", 7) for d, t, *x in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, part string, fingerprint long"
    df = spark.createDataFrame(full, schema)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def awkward(seed=1, long_words=20_000):
    rng = random.Random(seed)
    a = prose(rng, 300)
    return [
        (0, None), (1, ""), (2, "   \n\t "), (3, "one"), (4, "two words"), (5, a), (6, a), (7, a.replace("the", "THE", 1)),
        (8, "x" * 5000), (9, prose(rng, long_words)), (10, "A b c  d\n\n\ne \x1c f"), (11, "Ünïcödé \U0001f600 ### $$$"), (12, None), (5_000_000_000, prose(rng, 60)),
    ]
