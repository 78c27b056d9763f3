"""Small tables and brute-force versions that several tests share."""

import random

WORDS = {
    "en": "the of and to river stone light window garden morning people under between walking quiet letter".split(),
    "fr": "le la des une rivière pierre lumière fenêtre jardin matin gens sous entre marchant calme lettre".split(),
    "de": "der die das und fluss stein licht fenster garten morgen leute unter zwischen gehend ruhig brief".split(),
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    words = [rng.choice(WORDS[lang]) for _ in range(n)]
    return " ".join(w.capitalize() if k % 9 == 0 else w + ("." if k % 9 == 8 else "") for k, w in enumerate(words))


def junk(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS["en"]).upper() + "!!" for _ in range(n))


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def doc(i, text, lang="en"):
    return (i, text, lang, "s", None if text is None else len(text))
