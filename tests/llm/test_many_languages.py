"""Documents in more than three languages."""

from __future__ import annotations

from millrace.llm import langid

SAID = {
    "de": "der hund und die katze sind im garten ",
    "en": "the dog with that thing was there yesterday ",
    "fi": "koira ja kissa ovat puutarhassa tänään ",
    "fr": "le chien avec cette chose était là hier ",
    "hu": "kutya és macska volt tegnap kertben ",
}


def test_a_document_in_all_languages(spark):
    docs = spark.createDataFrame(
        [(k, text * 20, name) for k, (name, text) in enumerate(SAID.items())], "doc_id long, text string, lang string"
    )
    model = langid.train(docs)
    every = list(SAID)
    asked = [(n, "".join(SAID[name] * 30 for name in every[:n])) for n in range(1, 6)]
    got = {
        r.doc_id: r.languages
        for r in langid.identify(spark.createDataFrame(asked, "doc_id long, text string"), *model).collect()
    }
    for n, _ in asked:
        words = [len(SAID[name].split()) for name in every[:n]]
        assert set(got[n]) == set(every[:n])
        assert all(abs(got[n][name] - w / sum(words)) < 0.05 for name, w in zip(every, words))
