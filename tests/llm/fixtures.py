"""Small documents with the awkward cases every operator must stand."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, score string, k string, place string, block int, row string, line int, g string, words string")


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    lines, left = [], words
    while left > 0:
        n = min(left, rng.randint(6, 14))
        lines.append(" ".join(word() for _ in range(n)))
        left -= n
    return "\n".join(lines)


def awkward(spark, extra: bool = True):
    """Nulls, empty, blank, tiny, long, repeated, tied and near-equal texts; columns with
    names that operators use inside."""
    base = prose(1, 60)
    changed = base.split("\n")
    changed[2] = changed[2].rsplit(" ", 1)[0] + " zzz"
    texts = [
        (1, base), (2, base), (3, "\n".join(changed)), (4, prose(2, 80)), (4, prose(2, 80)), (5, None), (6, ""),
        (7, " \t\n\x0b "), (8, "one"), (9, "One two  three"), (10, prose(3, 6000)), (None, prose(4, 30)),
        (None, None), (11, "é😀 ÀÉ x\x1cy a@b.co 4111 1111 1111 1111 +1 (886) 555-7964 10.0.0.300 10.0.0.3"),
        (12, "word " * 400), (13, "| # $ " * 30), (-5, prose(5, 40) + "\r\n" + prose(5, 40)),
    ]
    rows = []
    for i, (doc, text) in enumerate(texts):
        source = [None, "a", "b", "ü"][i % 4]
        lang = [None, "en", "de"][i % 3]
        rows.append((doc, text, lang, source, None if text is None else len(text),
                     7, "s", "k", "p", 3, "r", 1, "g", "w"))
    df = spark.createDataFrame(rows, SCHEMA)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
