"""Ranked search against plain Python, and what the bounds leave out."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from searchtide.llm import lexical
from tests.helpers import bag, tuples

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(documents, items, k=10):
    docs = []
    for doc_id, text in documents:
        terms = TERM.findall((text or "").translate(CAPITALS))
        if terms:
            docs.append((doc_id, len(terms), Counter(terms)))
    n_docs, n_all = len(docs), sum(n for _, n, _ in docs)
    df = Counter(t for _, _, found in docs for t in found)
    result = []
    for item_id, text in items:
        asked = set(TERM.findall((text or "").translate(CAPITALS)))
        scores = []
        for doc_id, n, found in docs:
            m = 10 + (90 * n * n_docs) // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * found[t]) // (1000 * found[t] + 8 * m))
                for t in asked & set(found)
            )
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        for rank, (minus, _, _, doc_id) in enumerate(sorted(scores)[:k], 1):
            result.append((item_id, rank, doc_id, -minus))
    return sorted(result, key=repr)


def corpus(n=700, seed=5):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)] + ["Éa", "naïve", "日本", "x1", "Z"]
    share = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(n):
        size = int(rng.integers(1, 80))
        picked = rng.choice(words, size, p=share / share.sum())
        rows.append((i, ", ".join(picked) + "."))
    rows += [(i, rows[3][1]) for i in range(n, n + 150)]  # many copies
    rows += [(2, "w299 w299 Z"), (None, "w299 Z"), (None, None), (n + 500, ""), (n + 501, " ,. ")]
    items = [(i, rows[i * 7][1]) for i in range(30)]
    items += [(30, "w299 z W299"), (31, None), (32, "nowhere"), (33, ""), (0, "日本 éA Éa"), (None, "w5 w6")]
    return rows, items


@pytest.mark.parametrize("bucket,seed", [(4096, 64), (16, 4)])
def test_ranked(spark, monkeypatch, bucket, seed):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "SEED", seed)
    monkeypatch.setattr(lexical, "RANGE", 100)
    rows, items = corpus()
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = lexical.ranked(documents, spark.createDataFrame(items, "item_id long, text string"))
    assert bag(found, "item_id", "rank", "doc_id", "score") == brute(rows, items)


def test_blocks_of_queries(spark, monkeypatch):
    """Few terms a block: more passes, the same rows."""
    monkeypatch.setattr(lexical, "TERMS", 60)
    rows, items = corpus(200)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = lexical.ranked(documents, spark.createDataFrame(items, "item_id long, text string"), k=3)
    assert bag(found, "item_id", "rank", "doc_id", "score") == brute(rows, items, 3)


def test_long_texts_and_terms(monkeypatch):
    """Stretches end between terms, and a term longer than a stretch stays one."""
    monkeypatch.setattr(lexical, "STRETCH", 10)
    text = "Ab cdé " * 50 + "x" * 200 + " y" * 9 + " ß"
    found = [t for part in lexical.terms_of(text.encode()) for t in part]
    wanted = TERM.findall(text.translate(CAPITALS))
    assert len(found) == len(wanted)
    assert [f.decode() for f in found if len(f) <= 20] == [w for w in wanted if len(w) < 100]
    assert len({f for f in found if f.startswith(b" ")}) == 1


def test_bounds_leave_out_and_lose_nothing():
    rng = np.random.default_rng(6)
    n, n_terms = 500, 60
    sizes = rng.integers(1, 12, n)
    terms = np.concatenate([rng.choice(n_terms, s, replace=False) for s in sizes])
    impacts = rng.integers(1, 10**9, len(terms)) * rng.integers(1, 50, len(terms))
    weight = (10_000 / np.arange(1, n_terms + 1)).astype(int)
    impacts = impacts // 1000 * weight[terms]
    dense = np.zeros((n, n_terms), np.int64)
    dense[np.repeat(np.arange(n), sizes), terms] = impacts
    queries = lexical._queries({q: list(rng.choice(n_terms, 8, replace=False)) for q in range(20)}, weight)
    bucket = lexical._bucket(np.arange(n), sizes, terms, impacts, n_terms)
    scores = np.stack([dense[:, t].sum(axis=1) for t in queries.terms])
    kth = np.sort(scores, axis=1)[:, -10]
    seen = lexical.Counter()
    for q, places, found in lexical.search_bucket(bucket, queries, kth, seen):
        wanted = np.flatnonzero(scores[q] >= kth[q])
        assert places.tolist() == wanted.tolist() and found.tolist() == scores[q][wanted].tolist()
    assert seen["scored"] < 20 * n / 2
    none = lexical.Counter()
    assert not list(lexical.search_bucket(bucket, queries, kth * 1000, none)) and not none["buckets"]


def test_clashing_columns_and_no_rows(spark):
    rows, items = corpus(60)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    extra = ["1 AS n", "2 AS terms", "3 AS length", "4 AS item", "5 AS score", "6 AS row"]
    found = lexical.ranked(documents.selectExpr("*", *extra), asked.selectExpr("*", *extra, "7 AS doc_id"))
    assert bag(found) == bag(lexical.ranked(documents, asked))
    assert not tuples(lexical.ranked(documents.limit(0), asked))
    assert not tuples(lexical.ranked(documents, asked.limit(0)))
