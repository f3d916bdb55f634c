"""Language identification: Viterbi against all paths, spans, and held-out accuracy."""

import itertools
import os

import numpy as np
import pytest

from searchtide.llm import language
from searchtide.llm.common import read
from tests.helpers import tuples
from tests.llm.conftest import documents

EN = "the house of the old man and the thing that was there when they went with him"
FR = "une maison que les autres ont vue pour la chose qui était dans cette école avec nous"
RU = "это большой дом который они видели когда он был там и не знал что делать"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, lang) for i in range(5) for lang, t in (("en", EN), ("fr", FR), ("ru", RU))]
    rows += [(90, None, "en"), (91, "x", None)]
    return language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_finds_the_best_path(seed):
    rng = np.random.default_rng(seed)
    lengths, penalty = [5, 1, 7, 3], 1.5
    doc = np.repeat(np.arange(4), lengths)
    scores = rng.normal(size=(len(doc), 3)) * 2

    def value(path, own):
        switches = sum(a != b for a, b in zip(path, path[1:], strict=False))
        return sum(own[i, x] for i, x in enumerate(path)) - penalty * switches

    label = language.viterbi(doc, scores, penalty)
    for d, n in enumerate(lengths):
        own = scores[doc == d]
        best = max(value(p, own) for p in itertools.product(range(3), repeat=n))
        assert value(label[doc == d].tolist(), own) == pytest.approx(best)


def test_spans_of_mixed_text(spark, model):
    text = f"{EN}. {FR}. 123 {RU}!"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = language.identify(docs, model, penalty=4.0).collect()
    found = [(s["lang"], text[s["start"] : s["end"]]) for s in row["spans"]]
    assert found == [("en", EN), ("fr", FR), ("ru", RU)]
    assert row["lang_pred"] == "fr" and 0 < row["score"] < 1


def test_a_script_narrows_the_languages(spark, model):
    docs = spark.createDataFrame([(1, "слово"), (2, "日本語")], "doc_id long, text string")
    one, two = sorted(tuples(language.identify(docs, model), "doc_id", "lang_pred"))
    assert one == (1, "ru") and two[1] in model.langs


def test_odd_rows(clashing_docs, model):
    found = language.identify(clashing_docs, model)
    assert sorted(found.columns) == sorted(clashing_docs.columns)
    rows = tuples(found, "text", "lang_pred", "score", "spans")
    assert len(rows) == len(documents())
    for text, lang, score, spans in rows:
        known = any(c.isalpha() for c in text or "")
        assert (lang != "und") == known and (score > 0) == known and bool(spans) == known
    kept = language.known_language(clashing_docs)
    assert kept.columns == clashing_docs.columns
    assert sorted(repr(r[0]) for r in tuples(kept, "text")) == sorted(
        repr(r[1]) for r in documents() if any(c.isalpha() for c in r[1] or "")
    )


def test_nothing_learned(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language.train(nothing)
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert tuples(language.identify(docs, model), "lang_pred", "score") == [("und", 0.0)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.1", "documents")
    found = language.predicted(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    rows = tuples(found, "lang", "lang_pred")
    assert sum(a == b for a, b in rows) / len(rows) > 0.99
