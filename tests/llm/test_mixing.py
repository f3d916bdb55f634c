"""Weights by temperature, and the uses that realise them."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from searchtide.llm import mixing
from tests.helpers import bag, plan, tuples
from tests.llm.conftest import documents

TOKENS = {"a": 900, "b": 90, "c": 9, "d": 1}


@pytest.fixture(scope="module")
def sources(spark):
    rows = [(f"s:{k}", v) for k, v in TOKENS.items()] + [("n", 0)]
    return spark.createDataFrame(rows, "key string, tokens long")


def weights_of(sources, **wanted):
    rows = tuples(mixing.source_weights(sources, **wanted), "key", "power", "weight", "quota", "epochs", "rest")
    return {r[0]: r[1:] for r in rows}


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w)


@pytest.mark.parametrize("share", [0.4, 0.8, 0.99])
def test_entropy_is_met(sources, share):
    found = weights_of(sources, target_entropy=share)
    got = entropy([v[1] for v in found.values()]) / math.log(4)
    assert share - 1e-6 <= got <= share + 1e-4
    assert sum(v[1] for v in found.values()) == pytest.approx(1)


def test_plain_shares_have_power_one(sources):
    assert {v[0] for k, v in weights_of(sources, target_entropy=0.01).items() if k != "n"} == {1.0}
    assert weights_of(sources)["s:a"][1] == pytest.approx(0.9)


@pytest.mark.parametrize("cover", [False, True])
def test_repetition_limit(sources, cover):
    found = weights_of(sources, max_repetition=3.0, cover=cover)
    epochs = {k: v[2] / TOKENS[k[2:]] for k, v in found.items() if k != "n"}
    assert max(epochs.values()) <= 3.01 and max(epochs.values()) > 2.5
    assert not cover or min(epochs.values()) >= 0.999
    assert found["n"][1:] == (0.0, 0, 1, 0)


def test_the_limit_comes_before_the_entropy(sources):
    free = weights_of(sources, target_entropy=0.99)
    wide = weights_of(sources, target_entropy=0.99, max_repetition=1e6)
    assert wide == free
    tight = weights_of(sources, target_entropy=0.99, max_repetition=3.0)
    assert tight == weights_of(sources, max_repetition=3.0) != free


def test_a_tiny_source_does_not_fill_the_mix(spark):
    """A misspelt source of one word is repeated up to the limit and no more."""
    rows = [(i, "a word " * 20, "one") for i in range(1500)] + [(i, "some words " * 5, "two") for i in range(1500, 2000)]
    rows.append((2000, "alone", "onee"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixed_digest(docs).groupBy("source").count().collect()
    uses = {r["source"]: r["count"] for r in found}
    assert uses["onee"] <= 17 and sum(uses.values()) < 17 * len(rows)


def test_quotas_and_permutations(spark):
    rows = [(i, "big" if i % 10 else "small", 1 + i % 7) for i in range(3000)] + [(1, "big", 2)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, source string, n long").repartition(4)
    mix = mixing.plan_mix(docs, F.col("n"), block_tokens=200, target_entropy=0.999, seed=5)
    plan = {r["key"]: r for r in mix.weights.collect()}
    used = defaultdict(list)
    for doc_id, source, n, epoch, block, rank in tuples(
        mixing.apply_mix(docs, mix), "doc_id", "source", "n", "epoch", "block", "block_rank"
    ):
        used[source].append((epoch, rank, block, doc_id, n))
    for source, own in used.items():
        row = plan[f"s:{source}"]
        total = sum(n for *_, n in own)
        assert row["quota"] - 60 <= total <= row["quota"]
        for epoch in range(row["epochs"]):
            assert Counter(d for e, _, _, d, _ in own if e == epoch) == Counter(d for d, s, _ in rows if s == source)
        order = [tuple(b for _, b in sorted({(r, b) for e, r, b, *_ in own if e == x})) for x in range(row["epochs"] + 1)]
        assert len(set(order)) == len(order)
    assert plan["s:small"]["epochs"] >= 3 and plan["s:big"]["epochs"] == 0


def test_odd_rows(clashing_docs):
    found = mixing.mixed_sources(clashing_docs)
    assert found.columns == clashing_docs.columns
    copies = Counter(repr(r) for r in tuples(found, "doc_id", "text"))
    once = Counter(repr((d, t)) for d, t, *_ in documents())
    assert all(once[k] <= n <= 2 * once[k] for k, n in copies.items()) and set(copies) == set(once)


def test_digest_is_of_whole_mixed_documents(odd_docs, monkeypatch):
    written, real = {}, mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, name: written.setdefault(name, real(df, name)))
    found = mixing.mixed_digest(odd_docs)
    mixed = written["mixed"]
    assert set(odd_docs.columns) < set(mixed.columns)
    assert set(tuples(mixed, *odd_docs.columns)) <= set(tuples(odd_docs))
    digest = mixed.withColumn("n_tokens", mixing.word_count(F.col("text")))
    columns = ("doc_id", "source", "n_tokens", "epoch", "block", "block_rank")
    assert bag(found, *columns) == bag(digest, *columns)


def test_no_python_in_the_plan(odd_docs):
    for df in (mixing.mixed_digest(odd_docs), mixing.mixed_sources(odd_docs)):
        assert not any(word in plan(df) for word in ("Python", "InPandas", "InArrow", "CartesianProduct"))
