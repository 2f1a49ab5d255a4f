"""A small documents table with everything that tends to break operators."""

from __future__ import annotations

import random

# More columns than operators expect, with names that they use inside.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n long, node long, size long, text_key long, _tail double"


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    parts = ["the", "of", "and", "an", "sto", "re", "lin", "ka", "ba", "mor", "über", "né", "to"]
    return " ".join("".join(pick.choices(parts, k=pick.randint(1, 3))) for _ in range(words))


def rows() -> list[tuple]:
    base, shared = prose(1, 120), prose(2, 70)
    texts = [
        None,
        "",
        " \t\n",
        "one",
        "One  TWO",
        base,
        base,
        base + " tail",
        base.upper(),
        shared,
        "lead " + shared + " " + prose(3, 60),
        prose(4, 60) + " " + shared,
        prose(5, 9000),
        "ab" * 400,
        "x" * 1000,
        "Ünïcödé 🙂 " * 30,
        "12345 67890 !!!",
    ]
    texts += [prose(100 + k, 40 + k) for k in range(30)]
    listed = [
        (k, text, (None, "en", "de")[k % 3], (None, "a", "b")[k % 3 if k % 7 else 1], len(text or ""), 1, 2, 3, 4, 0.5)
        for k, text in enumerate(texts)
    ]
    listed += [listed[5], listed[9], (None, base, None, None, None, 1, 2, 3, 4, None)]
    return listed


def documents(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, COLUMNS)
