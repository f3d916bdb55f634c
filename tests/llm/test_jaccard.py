"""The n-gram Jaccard join against brute force, with small tiles and few common n-grams."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from searchtide.llm import jaccard
from searchtide.llm.components import components
from tests.helpers import bag
from tests.llm.conftest import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def gram_set(text):
    words = WORD.findall((text or "").translate(UPPER))
    size = min(5, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def brute_force(rows):
    """(doc_id, size, least doc_id that links reach) of each row."""
    sets = [gram_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(known, default=None)
    return sorted(
        [(d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))],
        key=repr,
    )


def corpus(seed):
    """Random texts with families of near copies, a passage in half of them, and chains."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(40)]
    texts = []
    for _ in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(text))
            text = text[:at] + passage + text[at:]
        texts.append(text)
    for base in range(8):
        for _ in range((30 if base == 0 else 6)):
            copy = list(texts[base])
            for _ in range(rng.randint(0, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    chain = [rng.choice(words) for _ in range(80)]
    for _ in range(25):
        chain = chain[2:] + [rng.choice(words), rng.choice(words)]
        texts.append(chain)
    texts += [passage, passage + ["x"], [], ["one"], ["ONE"], ["one", "two"]]
    ids = rng.sample(range(1000), len(texts))
    return [(i, " ".join(t)) for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "TILE", 5)
    monkeypatch.setattr(jaccard, "COMMON", 4)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert bag(jaccard.digest(docs), "doc_id", "n_shingles", "component_id") == brute_force(rows)


def test_short_texts_around_a_common_passage(spark):
    passage = [f"p{i}" for i in range(14)]
    texts = [[*passage, *[f"t{i}x{j}" for j in range(20)]] for i in range(jaccard.COMMON + 8)]
    for common in range(5, 15):
        for tail in range(6):
            own = passage[:common] + [f"c{common}x{tail}x{j}" for j in range(tail)]
            texts += [own, [*own, "x"], [*own, "y"], [*own[:-1], "z"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = bag(jaccard.digest(docs), "doc_id", "n_shingles", "component_id")
    assert found == brute_force(rows)


@pytest.mark.parametrize("size", range(3, 13))
def test_linked_sets_share_enough_signatures(size):
    rng = random.Random(size)
    common = np.zeros(1 << jaccard.FILTER_BITS, bool)
    for _ in range(300):
        both = [rng.getrandbits(64) for _ in range(rng.randint(-(-3 * size // 4), size))]
        sets = [np.unique(np.array(both + [rng.getrandbits(64) for _ in range(n - len(both))], np.uint64))
                for n in (size, rng.randint(len(both), size))]
        if not jaccard.linked(*sets, 75):
            continue
        cells = jaccard._cells(np.array(rng.sample(both, rng.randint(0, len(both))), np.uint64))
        common[cells] = True
        a, b = (jaccard.signatures(s, common, 75) for s in sets)
        common[cells] = False
        assert len(np.intersect1d(a, b)) >= min(jaccard.SHARED, -(-3 * size // 4))


def test_odd_rows(odd_docs):
    rows = [(r[0], r[1]) for r in documents()]
    found = bag(jaccard.digest(odd_docs), "doc_id", "n_shingles", "component_id")
    assert found == brute_force(rows)


def test_first_of_each(spark, clashing_docs):
    kept = jaccard.first_of_each(clashing_docs)
    assert kept.columns == clashing_docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(ids, key=repr) == sorted([1, 4, 5, 6, 7, 8, 9, None, None, 10, 11, 13, -14], key=repr)


def test_first_of_each_goes_by_row(spark):
    """Shared ids, rows without ids and repeated rows: one row of each group, no other is lost."""
    prose = [" ".join(f"t{j}w{i}" for i in range(60)) for j in range(6)]
    near = prose[0] + " one more"
    rows = [
        (1, prose[0], "a"), (3, near, "b"), (3, prose[1], "c"),  # one id, a copy and a text of its own
        (None, prose[2], "d"), (None, prose[2], "e"), (None, prose[3], "f"), (9, prose[3], "g"),
        (4, prose[4], "h"), (4, prose[4], "i"), (4, prose[4], "j"), (5, prose[4] + " x", "k"),
        (6, prose[5], "l"), (6, prose[5] + " y", "m"),
        (None, None, "n"), (None, None, "o"), (7, "", "p"), (7, "", "q"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    kept = {r["mark"] for r in jaccard.first_of_each(docs.repartition(5)).collect()}
    assert {"a", "c", "g", "n", "o", "p", "q"} <= kept and not kept & {"b", "f", "k"}
    for group in ("de", "hij", "lm"):
        assert len(kept & set(group)) == 1
    assert len(kept) == 10


def test_sets_do_not_depend_on_parts(monkeypatch):
    texts = [" ".join(f"word{i * j % 97}" for i in range(200)) for j in range(1, 5)] + ["", None, "a b"]
    whole = [s.tolist() for s in jaccard.gram_sets(texts)]
    monkeypatch.setattr(jaccard, "PART", 300)
    monkeypatch.setattr(jaccard, "_POWERS", [])
    assert [s.tolist() for s in jaccard.gram_sets(texts)] == whole
    assert [len(s) for s in whole] == [len(gram_set(t)) for t in texts]


def test_words_longer_than_a_part(monkeypatch):
    prose = " ".join(f"w{i}" for i in range(150))
    texts = [f"{prose} {'Ab+/' * n} {prose}" for n in (74, 75, 150, 500)] + ["x" * 2000, "x" * 1999 + "y", "y " + "x" * 2000]
    texts += [prose[:n] + " " + prose for n in range(290, 310)]
    whole = [s.tolist() for s in jaccard.gram_sets(texts)]
    monkeypatch.setattr(jaccard, "PART", 300)
    monkeypatch.setattr(jaccard, "_POWERS", [])
    cut = [s.tolist() for s in jaccard.gram_sets(texts)]
    assert cut == whole and [len(s) for s in cut] == [len(gram_set(t)) for t in texts]
    assert not set(cut[4]) & set(cut[5])


def test_tree_loses_no_partner():
    rng = np.random.default_rng(0)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64)
        for _ in range(3):
            sets.append(np.unique(np.where(rng.random(len(base)) < 0.05, rng.integers(0, 2**63, len(base)).astype(np.uint64), base)))
    points, sizes = jaccard.group_counts(sets), np.array([len(s) for s in sets])
    tree = jaccard.RTree(points, sizes, fanout=4)
    pruned = 0
    for i, own in enumerate(sets):
        near = set(tree.partners(points[i], int(sizes[i]), 75).tolist())
        pruned += len(sets) - len(near)
        for j, other in enumerate(sets):
            assert j in near or not jaccard.linked(own, other, 75)
    assert pruned > 0.7 * len(sets) ** 2


def test_components(spark):
    rng = random.Random(0)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    wanted = sorted((x, root(x)) for x in parent if root(x) != x)
    found = components(spark.createDataFrame(links, "a long, b long").repartition(4))
    assert sorted(tuple(r) for r in found.collect()) == wanted
