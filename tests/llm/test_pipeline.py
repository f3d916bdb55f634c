"""The pipeline's stages, each against plain Python on its own input."""

import importlib.util
import os
from collections import Counter

import pytest

import corpus_pipeline
from tests.helpers import tuples
from tests.llm.test_jaccard import brute_force, gram_set
from tests.llm.test_secrets import expected

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What goes into each stage, and what comes out of the last."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], SF_DIR).write.parquet(f"{folder}/{name}")
        tables.append(spark.read.parquet(f"{folder}/{name}"))
    return tables


def test_columns_stay(kept):
    assert all(t.columns == kept[0].columns for t in kept[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "ngram_jaccard", "secret_scan", "source_mix", "packing",
    ]


def test_language_keeps_what_has_letters(kept):
    wanted = [r for r in tuples(kept[0]) if any(c.isalpha() for c in r[1] or "")]
    assert sorted(tuples(kept[1])) == sorted(wanted)


def test_one_of_each_group(kept):
    rows = tuples(kept[1], "doc_id", "text")
    first = {c for d, _, c in brute_force(rows)}
    assert sorted(r[0] for r in tuples(kept[2], "doc_id")) == sorted(first)
    assert all(gram_set(t) for _, t in rows)


def test_secrets_are_masked_and_all_stay(kept):
    before = {r[0]: r for r in tuples(kept[2], "doc_id", "text")}
    after = tuples(kept[3], "doc_id", "text", "n_chars")
    assert sorted(before) == sorted(r[0] for r in after)
    assert any(expected(t) for _, t in before.values())
    for doc_id, text, n_chars in after:
        assert not expected(text) and n_chars == len(text)
        assert ("[SECRET]" in text) == bool(expected(before[doc_id][1]))


def test_mix_repeats_small_sources(kept):
    copies = Counter(r[0] for r in tuples(kept[4], "doc_id"))
    assert set(copies) == {r[0] for r in tuples(kept[3], "doc_id")} and max(copies.values()) <= 2


def test_every_copy_is_packed(kept):
    copies = Counter(r[0] for r in tuples(kept[4], "doc_id"))
    pieces = tuples(kept[5], "doc_id", "start", "length", "doc_tokens")
    total = Counter()
    size = {}
    for doc_id, _, length, tokens in pieces:
        total[doc_id] += length
        size[doc_id] = tokens
    assert total == Counter({d: n * size[d] for d, n in copies.items()})


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    assert importlib.util.find_spec("searchtide.llm")
