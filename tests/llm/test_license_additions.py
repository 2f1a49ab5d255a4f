"""License notices with words added or out of order, longer grams, templates from a table."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from millrace.llm import licenses, text


def found(docs, wordings, **options):
    rows = licenses.scan_licenses(docs, wordings, **options).collect()
    return {r.doc_id: [(s.label, s.first_word, s.last_word, s.share) for s in r.spans if not s.base] for r in rows}


def test_an_added_word_near_an_end(spark):
    said = [
        (1, "Licensed under the CC BY-NC 4.0"),
        (2, "This work is now licensed under the GNU General Public License, version 2"),
        (3, "licensed under the terms of CC"),
    ]
    docs = spark.createDataFrame(said, "doc_id long, text string")
    got = {
        r.doc_id: {(s.label, s.first_word, s.last_word) for s in r.spans if not s.base}
        for r in licenses.scan_licenses(docs, licenses.templates(spark)).collect()
    }
    assert got[1] == {("cc-by-nc-4.0", 0, 7)}
    assert {label for label, _, _ in got[2]} == {"gpl-notice"}
    assert got[3] == set()


def test_a_short_notice_may_lose_a_gram(spark):
    said = [
        (1, "released, under the well known mit license"),
        (2, "released under the bsd license"),
        (3, "the mit license under the stars"),
    ]
    docs = spark.createDataFrame(said, "doc_id long, text string")
    assert found(docs, licenses.templates(spark)) == {1: [("mit", 0, 6, 0.75)], 2: [], 3: []}


def test_grams_must_stand_in_order(spark):
    notice = "a b c d e f g h i j"
    said = [
        (1, notice),
        (2, "a b c x d e f g h i j"),  # one gram lost to an added word
        (3, "i j h i g h f g e f d e c d b c a b"),  # all grams, in the wrong order
        (4, "a b " * 50 + notice + " i j" * 50),  # its own grams before and after it
        (5, "a b c d e g h i j"),  # a word left out: two grams lost
    ]
    docs = spark.createDataFrame(said, "doc_id long, text string")
    wordings = licenses.templates(spark, {}, {"n": [notice]})
    got = found(docs, wordings)
    assert got[1] == [("n", 0, 9, 1.0)]
    assert got[2] == [("n", 0, 10, 8 / 9)]
    assert got[3] == []
    assert [(label, share) for label, _, _, share in got[4]] == [("n", 1.0)]
    assert got[5] == []  # 7 of 9 grams are left


@pytest.mark.parametrize("k", [2, 3, 5])
@pytest.mark.parametrize("most", [text.BROADCAST_ROWS, 0])
def test_any_gram_and_templates_from_a_table(spark, monkeypatch, k, most):
    """Whole bodies of many words, broadcast or shuffled, against a search by words."""
    monkeypatch.setattr(licenses, "small", lambda df: text.small(df, most=most))
    bodies = [(f"body-{n}", True, " ".join(f"w{(n * 7 + i * i) % 31}" for i in range(40 + n))) for n in range(5)]
    table = spark.createDataFrame([*bodies, bodies[0]], "label string, base boolean, text string")
    said = [(n, f"before {body.upper()}, after. {body}") for n, (_, _, body) in enumerate(bodies)]
    said += [(10, bodies[1][2].rsplit(" ", 1)[0]), (11, None), (12, ""), (13, "w1")]
    docs = spark.createDataFrame(said, "doc_id long, text string")
    rows = licenses.scan_licenses(docs, licenses.template_grams(table, k), k).collect()
    got = {r.doc_id: [(s.label, s.first_word, s.last_word) for s in r.spans] for r in rows}
    for doc_id, said_text in said:
        parts = (said_text or "").lower().replace(",", "").replace(".", "").split()
        expected = sorted(
            (at, at + len(words) - 1, label)
            for label, _, body in bodies
            for words in [body.split()]
            for at in range(len(parts) - len(words) + 1)
            if parts[at : at + len(words)] == words
        )
        assert got[doc_id] == [(label, first, last) for first, last, label in expected]


def test_templates_that_are_too_short(spark):
    with pytest.raises(ValueError, match="3 words"):
        licenses.templates(spark, {"x": "two words"}, {}, k=3)
    table = spark.createDataFrame([("x", False, "one")], "label string, base boolean, text string")
    with pytest.raises(PySparkException, match="2 words"):
        licenses.template_grams(table).collect()
