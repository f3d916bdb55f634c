"""Ranked lexical search in buckets of documents of like length.

A document is a vector of impacts, one for each term that some query has; a query is
a vector of ones, so a score is an inner product. Documents are dealt into ranges of
falling length, and a range is searched in buckets. With the k-th score so far, a
bucket is left out where length times the query's length cannot reach it
(Cauchy-Schwarz). Inside a bucket the impacts of the query's heaviest terms are added
up, and what the other terms could add is bounded by the rest of the length and by
their largest impacts in the bucket; only documents that may still reach the k-th score
are scored, in whole numbers.
"""

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchtide.llm.common import ship_package, stored

# The bytes that no term has, and the capitals that are made small.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(
    32 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)

#: Bytes of a text that are cut into terms at a time.
STRETCH = 1_000_000

#: A longer term is known by its digest, after a byte that no term has.
LONGEST = 64

#: Distinct terms of the queries that one pass over the documents looks for.
TERMS = 200_000

#: Documents of a bucket.
BUCKET = 4_096

#: Rows of a range of lengths, about.
RANGE = 65_536

#: One document in so many, the longest ones, gives the first k-th scores.
SEED = 64

FOUND = "item long, doc_id long, score long"

#: Stands for a null doc_id inside a task; it comes before all others, as null does.
NO_ID = -(2**63)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists for a stretch of it each."""
    start = 0
    while start < len(text):
        stop = start + STRETCH
        if stop < len(text):
            # On to the end of a term that the stretch would cut.
            while stop < len(text) and _FOLD[text[stop]] != 32:
                stop += 1
        words = text[start:stop].translate(_FOLD).split()
        yield [w if len(w) <= LONGEST else b" " + hashlib.sha256(w).digest() for w in words]
        start = stop


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column(batch.schema.get_field_index("text")):
        yield value.as_py() or b""


def _scanned(documents: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): length of each text and how often it has the known terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, terms, tfs = [], [0], [], []
            for text in _texts(batch):
                size, found = 0, Counter()
                for words in terms_of(text):
                    size += len(words)
                    found.update(filter(numbers.__contains__, words))
                sizes.append(size)
                known = sorted((numbers[w], tf) for w, tf in found.items())
                terms += [t for t, _ in known]
                tfs += [tf for _, tf in known]
                ends.append(len(terms))
            cuts = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(cuts, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(cuts, pa.array(tfs, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return documents.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def _item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term): the distinct terms of every row of ``items``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(_texts(batch)):
                found = sorted({w for words in terms_of(text) for w in words})
                at = pa.array(np.full(len(found), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(found, pa.binary())],
                    ["item", "item_id", "term"],
                )

    return items.mapInArrow(run, "item long, item_id long, term binary")


@dataclass
class Queries:
    """The queries of one block: numbers of their terms, the heaviest first."""

    items: list[int]
    terms: list[np.ndarray]


def _queries(listed: dict[int, list[int]], weight: np.ndarray) -> Queries:
    items, terms = [], []
    for item, found in sorted(listed.items()):
        own = np.array(found, np.int64)
        own = own[weight[own] > 0]
        if len(own):
            own = own[np.lexsort((own, -weight[own]))]
            items.append(item)
            terms.append(own)
    return Queries(items, terms)


@dataclass
class Bucket:
    """Documents by falling length, and who has which term with what impact."""

    doc_ids: np.ndarray
    length: np.ndarray
    docs: np.ndarray  # by term
    impacts: np.ndarray
    first: np.ndarray  # of each term's documents, one more at the end
    most: np.ndarray  # the largest impact of each term

    def postings(self, terms: np.ndarray) -> np.ndarray:
        """Places of all documents that have one of the terms."""
        starts, stops = self.first[terms], self.first[terms + 1]
        sizes = stops - starts
        shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return np.arange(int(sizes.sum())) + shift


def _bucket(doc_ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int) -> Bucket:
    docs = np.repeat(np.arange(len(doc_ids)), sizes)
    squares = np.bincount(docs, impacts.astype(float) ** 2, len(doc_ids))
    order = np.argsort(terms, kind="stable")
    first = np.searchsorted(terms[order], np.arange(n_terms + 1))
    most = np.zeros(n_terms)
    np.maximum.at(most, terms, impacts.astype(float))
    return Bucket(doc_ids, np.sqrt(squares), docs[order], impacts[order], first, most)


#: Bounds in floating point are raised by this share, and what is left of a squared
#: length by 1e-12 of it, so that rounding loses nothing.
SLACK = 1 + 1e-9


def search_bucket(
    bucket: Bucket, queries: Queries, kth: np.ndarray, visited: Counter | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the query, places in the bucket, scores) of all that may reach the k-th score."""
    n = len(bucket.doc_ids)
    longest = float(bucket.length.max(initial=0.0))
    for q, terms in enumerate(queries.terms):
        least = max(int(kth[q]), 1)
        if min(np.sqrt(len(terms)) * longest, bucket.most[terms].sum()) * SLACK < least:
            continue
        # What the lighter terms can add at most, from each term on; those that cannot
        # bring half of the k-th score together are left for later.
        tail = np.cumsum(bucket.most[terms][::-1])[::-1]
        focus = max(int(np.searchsorted(-tail, -least / 2)), 1)
        heavy, light = terms[:focus], terms[focus:]
        at = bucket.postings(heavy)
        docs, impacts = bucket.docs[at], bucket.impacts[at].astype(float)
        summed = np.bincount(docs, impacts, n)
        left = np.maximum(bucket.length**2 - np.bincount(docs, impacts**2, n), 0.0)
        rest = np.sqrt(left + 1e-12 * bucket.length**2)
        more = np.minimum(np.sqrt(len(light)) * rest, bucket.most[light].sum())
        near = np.flatnonzero((summed + more) * SLACK >= least)
        if visited is not None:
            visited["buckets"] += 1
            visited["scored"] += len(near)
        if not len(near):
            continue
        place = np.full(n, -1)
        place[near] = np.arange(len(near))
        scores = np.zeros(len(near), np.int64)
        for part in (at, bucket.postings(light)):
            to = place[bucket.docs[part]]
            np.add.at(scores, to[to >= 0], bucket.impacts[part[to >= 0]])
        good = scores >= least
        if good.any():
            yield q, near[good], scores[good]


def _searched(vectors: DataFrame, queries: Queries, kth: np.ndarray, k: int, n_terms: int) -> DataFrame:
    """The k best of each task for every query that can still reach ``kth``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = kth.copy()
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                lists = part.column(1)
                bucket = _bucket(
                    part.column(0).fill_null(NO_ID).to_numpy(),
                    np.asarray(lists.value_lengths()),
                    lists.flatten().to_numpy().astype(np.int64),
                    part.column(2).flatten().to_numpy(),
                    n_terms,
                )
                for q, places, scores in search_bucket(bucket, queries, least):
                    ids = bucket.doc_ids[places]
                    if q in best:
                        ids = np.concatenate([best[q][0], ids])
                        scores = np.concatenate([best[q][1], scores])
                    order = np.lexsort((ids, -scores))[:k]
                    best[q] = ids[order], scores[order]
                    if len(order) == k:
                        least[q] = max(int(least[q]), int(scores[order[-1]]))
        for q, (ids, scores) in best.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), queries.items[q]), pa.int64()),
                    pa.array(ids, pa.int64(), mask=ids == NO_ID),
                    pa.array(scores, pa.int64()),
                ],
                ["item", "doc_id", "score"],
            )

    return vectors.mapInArrow(run, FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _impacts(scanned: DataFrame, weight: np.ndarray, n_docs: int, n_all: int) -> DataFrame:
    """(doc_id, terms, impacts, length) of documents that have a known term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, tfs = batch.column(2), batch.column(3)
            sizes = np.asarray(terms.value_lengths()).astype(np.int64)
            tf = tfs.flatten().to_numpy()
            m = 10 + (90 * n_docs * batch.column(1).to_numpy()) // n_all
            value = weight[terms.flatten().to_numpy()] * (
                (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes))
            )
            squares = np.bincount(np.repeat(np.arange(len(sizes)), sizes), value.astype(float) ** 2, len(sizes))
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(ends, terms.flatten()),
                    pa.ListArray.from_arrays(ends, pa.array(value, pa.int64())),
                    pa.array(np.sqrt(squares), pa.float64()),
                ],
                ["doc_id", "terms", "impacts", "length"],
            )

    known = scanned.where(F.size("terms") > 0).select("doc_id", "n", "terms", "tfs")
    return known.mapInArrow(run, "doc_id long, terms array<int>, impacts array<long>, length double")


def _search_block(documents: DataFrame, listed: dict[int, list[bytes]], k: int) -> DataFrame | None:
    """(item, rank, doc_id, score) for the queries of one block, None without documents."""
    spark = documents.sparkSession
    numbers = {t: i for i, t in enumerate(sorted({t for terms in listed.values() for t in terms}))}
    scanned = stored(_scanned(documents, numbers).where("n > 0"), "scanned")
    n_docs, n_all = scanned.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    # One count per known term; there are TERMS of them at most, by expectation.
    counted = scanned.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weigh = F.floor(1000.0 * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0)))
    weight = np.zeros(len(numbers), np.int64)
    for term, value in counted.select("term", weigh).collect():
        weight[term] = value
    queries = _queries({i: [numbers[t] for t in terms] for i, terms in listed.items()}, weight)
    vectors = stored(_impacts(scanned, weight, n_docs, n_all), "impacts")

    at_first = np.zeros(len(queries.items), np.int64)
    total, longest = vectors.agg(
        F.count("*"), F.percentile_approx("length", 1 - 1 / SEED, 10_000)
    ).first()
    columns = ["doc_id", "terms", "impacts"]
    if not total:
        return None
    seed = _searched(vectors.where(F.col("length") >= longest).select(columns), queries, at_first, k, len(numbers))
    number = {item: q for q, item in enumerate(queries.items)}
    for item, score in _first(seed, k).where(F.col("rank") == k).select("item", "score").collect():
        at_first[number[item]] = score

    n_ranges = max(1, -(-total // RANGE), spark.sparkContext.defaultParallelism)
    ranged = vectors.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(
        n_ranges, F.desc("length"), "doc_id", "row"
    )
    ordered = ranged.sortWithinPartitions(F.desc("length"), "doc_id", "row").select(columns)
    return _first(_searched(ordered, queries, at_first, k, len(numbers)), k)


def ranked(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item.

    Terms are runs of letters and digits, and of anything beyond ASCII, with A-Z made
    small, from whole texts of any length. Every row of both tables counts, also
    repeated ones and those that share an id; equal scores go by doc_id, null first.
    A null or empty text has no term: such an item has no rows, such a document is
    not counted. Scores above 0 only, so an empty table gives no rows. Columns beside
    ids and texts do not matter.

    Queries are taken in blocks by the number of their distinct terms, TERMS about; the
    documents are read once for each block.
    """
    spark = documents.sparkSession
    ship_package(spark)
    binary = F.col("text").cast("binary").alias("text")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), binary)
    asked = items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), binary
    )
    terms = stored(_item_terms(asked), "item_terms")
    n_blocks = max(1, -(-terms.count() // TERMS))
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks))
    found = None
    for number in range(n_blocks):
        listed: dict[int, list[bytes]] = {}
        for item, term in terms.where(block == number).select("item", "term").collect():
            listed.setdefault(item, []).append(bytes(term))
        part = _search_block(texts, listed, k) if listed else None
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    ids = terms.select("item", "item_id").distinct()
    return found.join(ids, "item").select("item_id", "rank", "doc_id", "score")
