"""Typos, run-together words and lost accents against all pairs, splits and chains."""

import itertools
import math
import os
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from searchtide.functions import text
from searchtide.operators import accents, segments, typos
from tests.helpers import bag, plan, tuples

COUNTS = "keyword string, search_count long"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def all_pairs(rows, ratio):
    """Corrections by comparing every keyword with every other."""
    counts = {}
    for keyword, n in rows:
        if keyword is not None and len(keyword) >= 4:
            counts[keyword] = counts.get(keyword, 0) + n
    found = []
    for v, n in counts.items():
        best = None
        for c, m in counts.items():
            short = min(len(v), len(c))
            if m > ratio * n:
                d = edit_distance(v, c)
                if 0 < d <= (1 if short < 8 else 2) and m > n * ratio**d:
                    best = min(filter(None, [best, (-m * ratio ** (2 - d), d, c, m)]))
        if best:
            found.append((v, n, best[2], best[3], best[1]))
    return sorted(found, key=repr)


def mistyped(rng, word):
    letters = list(word)
    for _ in range(rng.randint(1, 3)):
        at = rng.randrange(len(letters))
        kind = rng.randrange(3)
        if kind == 0 and len(letters) > 1:
            del letters[at]
        elif kind == 1:
            letters.insert(at, rng.choice("abcé "))
        else:
            letters[at] = rng.choice("abcé ")
    return "".join(letters)


@pytest.mark.parametrize("head", [64, 9])
def test_corrections_are_those_of_all_pairs(spark, monkeypatch, head):
    monkeypatch.setattr(typos, "HEAD", head)
    rng = random.Random(head)
    right = ["".join(rng.choices("abcdé ", k=rng.randint(3, 14))) for _ in range(25)] + ["x" * 70 + "abc", "x" * 70]
    rows = [(w, rng.randint(100, 5000)) for w in right]
    rows += [(mistyped(rng, rng.choice(right)), rng.randint(1, 60)) for _ in range(300)]
    rows += [(None, 9), ("", 3), (right[0], 5)]
    found = typos.corrections(spark.createDataFrame(rows, COUNTS), 4)
    wanted = all_pairs(rows, 4)
    assert bag(found) == wanted and len(wanted) > 50


def test_rare_spellings_do_not_pair_with_each_other(spark):
    """A thousand spellings around one keyword make a thousand pairs, not their square."""
    rows = [("television set", 1_000_000)] + [(f"television {a}{b}t", 1) for a in map(chr, range(97, 123)) for b in "abcdefgh"]
    counts = spark.createDataFrame(rows, COUNTS)
    found = typos.corrections(counts)
    assert {r["corrected"] for r in found.collect()} == {"television set"}
    # Only what is searched more than the ratio is on the side that others are paired with.
    assert "search_count" in plan(found) and "(search_count" in plan(found)


def test_corrections_of_corrections(spark):
    rows = [("abcdefgh", 100_000), ("abcdefgx", 2_000), ("abcdefyx", 30), ("abcdeuyx", 1), (None, 2)]
    counts = spark.createDataFrame(rows, COUNTS)
    assert bag(typos.merge_typos(counts)) == sorted([("abcdefgh", 102_031), (None, 2)], key=repr)
    assert not tuples(typos.corrections(counts.limit(0))) and not tuples(typos.merge_typos(counts.limit(0)))
    with pytest.raises(ValueError, match="ratio"):
        typos.corrections(counts, 0)


def all_splits(rows, least):
    """The cheapest way to cut each word, by trying all of them."""
    words = {}
    for keyword, n in rows:
        for word in (keyword or "").split(" "):
            if word:
                words[word] = words.get(word, 0) + n
    total = float(sum(words.values()))
    cost = {w: math.floor(1_000_000 * math.log(total / n)) for w, n in words.items() if n >= least and len(w) >= 2}
    found = {}
    for word in (w for w in words if len(w) < 20):
        best = None
        for cuts in itertools.product([False, True], repeat=len(word) - 1):
            at = [0, *[i + 1 for i, cut in enumerate(cuts) if cut], len(word)]
            parts = [word[a:b] for a, b in itertools.pairwise(at)]
            if all(p in cost for p in parts):
                best = min(filter(None, [best, (sum(cost[p] for p in parts), len(parts), parts)]))
        if best and best[1] > 1:
            found[word] = best[2]
    return found


def test_splits_are_those_of_all_cuts(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(14)]
    rows = [(" ".join(rng.choices(words, k=rng.randint(1, 3))), rng.randint(1, 50)) for _ in range(40)]
    rows += [("".join(rng.choices(words, k=rng.randint(2, 3))), 1) for _ in range(40)]
    rows += [(None, 3), ("", 2), ("a", 1), ("z" * 80, 1)]
    counts = spark.createDataFrame(rows, COUNTS)
    found = {r["word"]: list(r["parts"]) for r in segments.word_splits(counts).collect()}
    assert found == all_splits(rows, 2) and len(found) > 10
    again = {r["keyword"]: r["split"] for r in segments.split_keywords(counts).collect()}
    assert again[None] is None and again[""] == "" and again["z" * 80] == "z" * 80
    for keyword, split in again.items():
        if keyword:
            assert split == " ".join(" ".join(found.get(w, [w])) for w in keyword.split(" "))


def test_part_names_come_back_without_their_blanks(spark):
    names = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    right = names.groupBy(F.col("p_name").alias("keyword")).agg(F.count("*").alias("search_count"))
    joined = right.withColumn("keyword", F.replace("keyword", F.lit(" "), F.lit(""))).withColumn("search_count", F.lit(1))
    found = segments.split_keywords(right.unionByName(joined.withColumn("search_count", F.lit(1).cast("long"))))
    wanted = {r["keyword"] for r in right.collect()}
    assert {r["split"] for r in found.collect()} == wanted
    merged = segments.merge_run_together(right.unionByName(joined.withColumn("search_count", F.lit(1).cast("long"))))
    assert all(r["spellings"] == 2 for r in merged.collect())


@pytest.mark.parametrize("raw", ["été À la cité", "Đại Chiến đâu", "éte", "ÅÆßœñ", "ǖ Ṩ", "", "日本 привет й"])
def test_unaccent(spark, raw):
    found = spark.createDataFrame([(raw,)], "t string").select(text.unaccent(F.col("t"))).first()[0]
    wanted = "".join(c for c in raw if not unicodedata.combining(c))
    wanted = "".join(unicodedata.normalize("NFD", c)[0] if "À" <= c <= "ỿ" and c < "ɐ" or "Ḁ" <= c < "ἀ" else c for c in wanted)
    assert found == wanted.replace("Đ", "D").replace("đ", "d")


def test_accents_are_those_of_the_best_of_all_chains(spark):
    rng = random.Random(5)
    words = ["da", "dà", "dá", "ba", "bà", "mo", "mò", "xu"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(1, 4))), rng.randint(1, 9)) for _ in range(60)]
    rows = list(dict(rows).items())
    plain = {unicodedata.normalize("NFD", k) for k, _ in rows}
    plain = {"".join(c for c in k if not unicodedata.combining(c)) for k in plain} - {k for k, _ in rows}
    rows += [(k, 1) for k in sorted(plain)] + [("dà zzz da", 1), ("zzz da", 1), (None, 2), ("", 1), ("da  mo", 1)]
    bare = str.maketrans("àáò", "aao")
    known, pairs, begins = {}, {}, 0
    for k, n in rows:
        if k and k != k.translate(bare):
            own = k.split()
            begins += n
            for before, word in zip(["", *own], own, strict=False):
                known[word] = known.get(word, 0) + n
                pairs[before, word] = pairs.get((before, word), 0) + n
    total = float(sum(known.values()))

    def cost(a, b):
        share = float(known.get(b, 0)) / total
        first = begins if a == "" else known.get(a, 0)
        likely = (pairs.get((a, b), 0) + 2 * share) / (first + 2)
        return math.floor(-1_000_000 * math.log(likely)) if likely > 0 else 0

    wanted = {}
    for k, _ in rows:
        own = (k or "").split()
        choices = [
            [c for c in known if c.translate(bare) == w] or [w] if w == w.translate(bare) else [w] for w in own
        ]
        chains = [
            (sum(cost(a, b) for a, b in zip(["", *chain], chain, strict=False)), list(chain))
            for chain in itertools.product(*choices)
        ]
        wanted[k] = " ".join(min(chains)[1]) if own else k
    found = accents.restore_accents(spark.createDataFrame(rows, COUNTS))
    assert {r["keyword"]: r["restored"] for r in found.collect()} == wanted
    assert wanted["zzz da"].startswith("zzz ")


def test_accents_shuffle_words_without_their_keywords(spark, monkeypatch):
    """The counts are worked out once, words travel by a hash, and keywords may share one."""
    rng = random.Random(6)
    words = ["da", "dà", "dá", "ba", "bà", "mo", "xu", "ø", "ǿ"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(1, 5))), rng.randint(1, 9)) for _ in range(80)]
    counts = spark.createDataFrame([*rows, ("da ba da ba", 1), (None, 2), ("  ", 1), (" da  ba", 3)], COUNTS)
    found = accents.restore_accents(counts)
    shown = plan(found)
    assert "Window" not in shown and "Scan ExistingRDD" not in shown
    monkeypatch.setattr(accents, "KEYS", 1)
    assert bag(accents.restore_accents(counts)) == bag(found)
    assert bag(found.where("keyword IS NULL OR trim(keyword) = ''")) == sorted([("  ", 1, "  "), (None, 2, None)], key=repr)


def test_accents_ask_for_words_that_change_and_their_neighbours_only(spark, monkeypatch):
    """Other words are neither shuffled nor in a chain; each job reads what the one before stored."""
    stored, real = {}, accents._stored
    monkeypatch.setattr(accents, "_stored", lambda s, t, name: stored.setdefault(name, real(s, t, name)))
    plain = [(f"w{i} v{i % 7} u{i} t{i}", 1) for i in range(300)]
    rows = [("mò da", 4), ("mo dà", 3), ("xu ré", 2), ("mo w1 re v1  da", 1), ("\u0301 dà", 1), ("re", 1)]
    found = accents.restore_accents(spark.createDataFrame(plain + rows, COUNTS))
    # A choice is asked for with the word before it and in the one behind it, other changes alone.
    asked = [("", "da"), ("", "mo"), ("", "re"), ("mo", "da"), ("mo", "w1"), ("da", "w1"), ("v1", "da"), ("mò", "da"), ("mo", "dà")]
    spots = set(tuples(stored["spots"].select("before", "word")))
    assert spots <= set(asked) and len(spots) >= 6
    assert stored["spots"].count() < 20
    right = {r["keyword"]: r["restored"] for r in found.collect()}
    assert right["re"] == "ré" and right["mo w1 re v1  da"] == "mò w1 ré v1 da"
    assert all(right[k] == k for k, _ in plain) and len(right) == len(plain) + len(rows)


@pytest.mark.parametrize("raw", ["a \t b", "\u3000a\x1c\x1f b.\u2028. c\x85", "Été  -  là\u00a0!", " . ", "", "x - y", "ẞ İ \U0001d400 e\u0301"])
def test_normalize_letter_by_letter(spark, raw):
    """One blank between words, whatever parted them."""
    kept = "".join(" " if c.isspace() else c for c in raw.lower())
    kept = " ".join("".join(c for c in kept if c == " " or unicodedata.category(c)[0] in "LMN").split())
    found = spark.createDataFrame([(raw,)], "t string").select(text.normalize(F.col("t"))).first()[0]
    assert found == kept


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_lost_accents_come_back(spark):
    """Runs of six words of a third of the texts, learned from the others and from them."""
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL AND lang <> 'en'")
    words = F.split(text.normalize(F.col("text")), " ")
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(words) - 1) / 6).cast("int")),
        lambda i: F.array_join(F.slice(words, i * 6 + 1, 6), " "),
    )
    right = texts.select("doc_id", F.explode(runs).alias("right")).where("right <> ''").cache()
    typed = right.where("doc_id % 3 = 0").select(text.unaccent(F.col("right")).alias("keyword"), "right")
    known = right.select(F.col("right").alias("keyword")).unionByName(typed.select("keyword"))
    found = accents.restore_accents(known.groupBy("keyword").agg(F.count("*").alias("search_count")))
    pairs = typed.distinct().join(found, "keyword").select(
        F.explode(F.arrays_zip(*[F.split(c, " ").alias(c) for c in ("keyword", "right", "restored")])).alias("w")
    )
    lost = pairs.where("w.keyword <> w.right").agg(F.count("*"), F.avg((F.expr("w.right = w.restored")).cast("int"))).first()
    assert lost[0] > 1_000 and lost[1] > 0.95
    kept = pairs.where("w.keyword = w.right").agg(F.avg((F.expr("w.right = w.restored")).cast("int"))).first()
    assert kept[0] > 0.95


@pytest.mark.parametrize("name", ["typo_corrections", "split_run_together", "restore_accents"])
def test_no_pairs_without_a_key(spark, name):
    found = plan(contract.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in found and "BroadcastNestedLoopJoin" not in found
    assert "Python" not in found and "InPandas" not in found
