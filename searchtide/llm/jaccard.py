"""Similarity join of whole texts by the Jaccard measure of their word n-grams.

The method is a count-vector R-tree: n-grams are hashed into groups, the counts of
a document's groups are a point, and the overlap of two documents is at most the
sum of the smaller counts over all groups. An R-tree over the points bounds the
overlap of a document with a whole box in the same way; what survives is verified
on the sets themselves.

Boxes of points with many coordinates tell little, so a tree over all documents
would compare nearly every pair. The trees are therefore built in shards which
together hold every linked pair. A shard is a connected group of documents that
share signatures: the first hashes of a document in a seeded order. In a random
order, documents that share three quarters of their n-grams share some of the first
ones but for one pair in 10**12. N-grams of many documents (a common passage) come
last in the order; only documents that consist mostly of such use them.

Documents with equal sets are one class, and classes are what is compared. A shard
is cut into tiles of bounded size. All classes of a tile are compared, and each
with the shard's first class; what is then not in the shard's largest component
visits all of its tiles. So no task holds a whole group of copies, and no pair is
left out unless it is connected already.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.llm.common import give_back, ship_package, spare_prefix, stored, text_groups, whole
from searchtide.llm.components import components

#: Bytes of text that are hashed at once, and characters of texts that a task holds.
PART, CHARS = 400_000, 1_500_000
#: Signatures of a document without common n-grams; and those by the plain order.
LOWEST, PLAIN = 48, 40
#: Signatures that two linked documents share at least, if they have as many.
SHARED = 4
#: Classes that may have an n-gram before it is common, and that are paired at once.
COMMON = 32
#: Bits of the number of a cell in a filter, and of its place in a part of it.
FILTER_BITS, PART_BITS = 24, 12
TILE = 256

_BASE = 0x9E3779B97F4A7C15 | 1


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    inverse = pow(_BASE, -1, 1 << 64)
    made = []
    for base in (_BASE, inverse):
        steps = np.full(PART + 1, base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps))
    return made[0], made[1]


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _blanks() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


_BLANK, _LOWER = _blanks(), _lower()


def _word_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Polynomial sum, start and length of every word in a stretch of at most PART bytes."""
    if not _POWERS:
        _POWERS.append(_powers())
    power, inverse = _POWERS[0]
    inside = ~_BLANK[raw]
    edges = np.diff(inside.view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    terms = (_LOWER[raw].astype(np.uint64) + np.uint64(1)) * power[: len(raw)]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    return (sums[end] - sums[start]) * inverse[start], start, (end - start).astype(np.uint64)


def _word_hashes(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return _mixed(sums + lengths * np.uint64(0xD6E8FEB86659FD93))


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes, ascending, of a document's word n-grams."""
    if not len(words):
        return words
    size = min(n, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        total = _mixed(total + words[j : len(words) - size + 1 + j] * np.uint64(2 * j + 3))
    return np.unique(total)


def gram_sets(texts: list[str | None], n: int = 5) -> Iterator[np.ndarray]:
    """The set of every text, as ascending hashes; without words it is empty."""
    waiting, size = [], 0

    def hashed() -> Iterator[np.ndarray]:
        raw = np.frombuffer(b"\n".join(waiting), np.uint8)
        sums, start, sizes = _word_sums(raw)
        words = _word_hashes(sums, sizes)
        lengths = np.fromiter(map(len, waiting), np.int64, len(waiting)) + 1
        cuts = np.searchsorted(start, np.cumsum(lengths)).tolist()
        first = 0
        for last in cuts:
            yield _grams(words[first:last], n)
            first = last

    for text in texts:
        data = (text or "").encode("utf-8", "replace")
        if size + len(data) + 1 > PART and waiting:
            yield from hashed()
            waiting, size = [], 0
        if len(data) >= PART:
            yield _grams(_long(data), n)
        else:
            waiting.append(data)
            size += len(data) + 1
    if waiting:
        yield from hashed()


def _long(data: bytes) -> np.ndarray:
    """Word hashes of a text that is hashed in several stretches.

    A word that a stretch ends in is carried on, so it has one hash at any length.
    """
    raw = np.frombuffer(data, np.uint8)
    found = []
    carried, size = 0, 0
    for at in range(0, len(raw), PART):
        stretch = raw[at : at + PART]
        sums, start, sizes = _word_sums(stretch)
        if size and _BLANK[stretch[0]]:
            sums = np.append(np.array([carried], np.uint64), sums)
            sizes = np.append(np.array([size], np.uint64), sizes)
        elif size:
            joined = (carried + pow(_BASE, size, 1 << 64) * int(sums[0])) % (1 << 64)
            sums[0], sizes[0] = joined, size + int(sizes[0])
        carried, size = 0, 0
        if at + PART < len(raw) and not _BLANK[stretch[-1]]:
            carried, size = int(sums[-1]), int(sizes[-1])
            sums, sizes = sums[:-1], sizes[:-1]
        found.append(_word_hashes(sums, sizes))
    return np.concatenate(found)


def _fingerprint(grams: np.ndarray) -> int:
    """One number for a set; 0 is kept for the empty one."""
    if not len(grams):
        return 0
    parts = np.array([np.bitwise_xor.reduce(_mixed(grams)), len(grams)], np.uint64)
    total = _mixed(parts[:1] + np.add.reduce(grams, keepdims=True) + parts[1:])
    return int(total.view(np.int64)[0]) or 1


def least_overlap(size_a, size_b, percent: int = 75):
    """Least common n-grams of sets of these sizes for ``percent`` of similarity."""
    return -(-(percent * (size_a + size_b)) // (100 + percent))


# --- signatures ----------------------------------------------------------------


def signatures(grams: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The hashes by which a document finds its partners.

    ``common`` is True for the filter cells of common n-grams. The share of others
    bounds how many of them two linked documents may not have in common, and so
    how many are needed. No more than the exact prefix are ever taken: a set has
    at most ``100 - percent`` percent that a partner lacks. Fewer others than that
    may all be lacking, so the prefix of all n-grams in plain order is added. Where
    one of two linked sets has enough others, both have the first that they share;
    where neither has, both have the plain prefix.
    """
    exact = len(grams) * (100 - percent) // 100 + SHARED
    rare = grams[~common[_cells(grams)]]
    share = len(rare) / max(len(grams), 1)
    needed = math.ceil(37.6 / math.log(3 * max(share, 0.5)))
    chosen = rare[: min(exact, max(LOWEST, needed))]
    if share < 0.5 or len(rare) < exact:
        chosen = np.union1d(chosen, grams[: min(exact, PLAIN)])
    return chosen


def _filter(hashes: DataFrame) -> np.ndarray:
    """Packed bits of a filter of fixed size over the first bits of (hash).

    Others may share a cell with what is in it, so it can only save work. The bits
    are set where the cells are; what comes to the driver has the filter's size.
    """
    n_bits = 1 << PART_BITS
    cells = (
        hashes.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("cell"))
        .groupBy(F.shiftright("cell", PART_BITS).alias("part"))
        .agg(F.collect_set((F.col("cell") % n_bits).cast("int")).alias("cells"))
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for own in batch.column(1):
                table = np.zeros(n_bits, bool)
                table[own.values.to_numpy()] = True
                bits.append(np.packbits(table).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["part", "bits"])

    table = np.zeros((1 << FILTER_BITS) // 8, np.uint8).reshape(-1, n_bits // 8)
    for row in cells.mapInArrow(packed, "part long, bits binary").collect():
        table[row["part"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return table.ravel()


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    kinds = {"doc_id": "long", "text": "string"}
    return docs.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()])


def _digests(text: str) -> list[Column]:
    """Two numbers that stand for a whole text; a null text counts as empty."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [F.xxhash64(F.lit(seed), whole) for seed in (1, 2)]


def _signed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, a, b, size, class, keys) of every document; keys of the empty set are none.

    ``a`` and ``b`` stand for the text itself, ``class`` for its set.
    """

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_groups(batches, 1, CHARS):
            seen, some = set(), []
            for grams in gram_sets(texts, n):
                own = _fingerprint(grams)
                if own not in seen:
                    seen.add(own)
                    some.append(grams[:LOWEST])
            hashes, counts = np.unique(np.concatenate(some), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(counts, pa.int64())], ["hash", "n"]
            )
        give_back()

    # N-grams that share a cell of the filter are both common, in every document alike.
    packed = _filter(
        _texts(docs)
        .mapInArrow(lowest, "hash long, n long")
        .groupBy("hash")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > COMMON)
    )

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.unpackbits(packed).view(bool)
        for part, texts in text_groups(batches, 1, CHARS):
            sizes, classes, keys = [], [], []
            for grams in gram_sets(texts, n):
                sizes.append(len(grams))
                classes.append(_fingerprint(grams))
                keys.append(signatures(grams, common, percent).view(np.int64))
            columns = [
                part.column(0),
                part.column(2),
                part.column(3),
                pa.array(sizes, pa.int64()),
                pa.array(classes, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a", "b", "size", "class", "keys"])
        give_back()

    kinds = "doc_id long, a long, b long, size long, class long, keys array<long>"
    a, b = _digests("text")
    return stored(_texts(docs).withColumn("a", a).withColumn("b", b).mapInArrow(signed, kinds), "signed")


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes that make up the shards.

    Classes that share a rare key are paired, and a pair needs enough of them. A
    key of more classes links each to the least one, without making pairs.
    """
    entries = classes.select(F.explode("keys").alias("key"), "class", "size")
    blocks = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("least"))
    shared = entries.join(blocks.where("n > 1"), "key")
    few = (
        shared.where(F.col("n") <= COMMON)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("class", "size"))).alias("all"))
    )

    def partners(a: Column, i: Column) -> Column:
        later = F.slice("all", i + 2, F.size("all"))
        alike = F.filter(
            later,
            lambda b: 100 * F.least(a["size"], b["size"]) >= percent * F.greatest(a["size"], b["size"]),
        )
        return F.transform(
            alike,
            lambda b: F.struct(
                a["class"].alias("a"), b["class"].alias("b"), F.greatest(a["size"], b["size"]).alias("size")
            ),
        )

    pairs = few.select(F.explode(F.flatten(F.transform("all", partners))).alias("pair")).select("pair.*")
    enough = F.least(F.lit(SHARED), F.ceil(F.col("size") * percent / 100))
    rare = (
        pairs.groupBy("a", "b", "size").agg(F.count("*").alias("shared")).where(F.col("shared") >= enough)
    )
    many = shared.where((F.col("n") > COMMON) & (F.col("class") != F.col("least")))
    return rare.select("a", "b").unionByName(
        many.select(F.col("least").alias("a"), F.col("class").alias("b")).distinct()
    )


# --- the R-tree ------------------------------------------------------------------


def group_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Counts of the sets' n-grams in groups by hash, about eight to a group."""
    median = int(np.median([len(s) for s in sets])) if sets else 1
    bits = min(10, max(4, (max(median, 1) // 8).bit_length()))
    counts = np.empty((len(sets), 1 << bits), np.int32)
    for i, grams in enumerate(sets):
        # Other bits than those that order the hashes.
        groups = (grams & np.uint64((1 << bits) - 1)).astype(np.int64)
        counts[i] = np.bincount(groups, minlength=1 << bits)
    return counts


class RTree:
    """An R-tree packed over points in the order of their size; leaves of ``fanout``."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, fanout: int = 16):
        self.points, self.sizes, self.fanout = points, sizes, fanout
        # Sizes first, then the direction in which the points differ most.
        spread = points @ points.var(axis=0) if len(points) else sizes
        self.order = np.lexsort((spread, sizes))
        high = points[self.order]
        least = most = sizes[self.order]
        self.levels = []
        while len(high) > 1:
            cuts = np.arange(0, len(high), fanout)
            high = np.maximum.reduceat(high, cuts, axis=0)
            least = np.minimum.reduceat(least, cuts)
            most = np.maximum.reduceat(most, cuts)
            self.levels.append((high, least, most))

    def partners(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Points whose overlap with a point may be enough, by the sums of the smaller counts."""
        if not len(self.points):
            return np.zeros(0, np.int64)
        alive = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least, most = self.levels[depth]
            alive = alive[alive < len(high)]
            most_common = np.minimum(high[alive], point).sum(axis=1)
            fits = (100 * most[alive] >= percent * size) & (100 * size >= percent * least[alive])
            fits &= most_common >= least_overlap(size, least[alive], percent)
            alive = (alive[fits][:, None] * self.fanout + np.arange(self.fanout)).ravel()
        alive = self.order[alive[alive < len(self.points)]]
        fits = np.minimum(self.points[alive], point).sum(axis=1) >= least_overlap(
            size, self.sizes[alive], percent
        )
        return alive[fits]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """True if ``percent`` of the union of two ascending sets is common."""
    if len(b) < len(a):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def tile_links(
    classes: np.ndarray, sets: list[np.ndarray], known: np.ndarray, guests: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links that connect what is similar in a tile, none within what is connected.

    ``known`` names the component that a class is in already. Guests belong to
    other tiles; two guests are not compared.
    """
    parent = {int(c): int(c) for c in known}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in sets])
    points = group_counts(sets)
    members = np.flatnonzero(~guests)
    tree = RTree(points[members], sizes[members])
    found = []
    for i in range(len(sets)):
        own = int(known[i])
        for j in members[tree.partners(points[i], int(sizes[i]), percent)]:
            if (j >= i and not guests[i]) or root(own) == root(int(known[j])):
                continue
            if linked(sets[i], sets[j], percent):
                found.append((int(classes[i]), int(classes[j])))
                parent[root(own)] = root(int(known[j]))
    return found


def _compared(tiles: DataFrame, percent: int) -> DataFrame:
    """Links found in each tile of (shard, tile, class, known, guest, grams)."""

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = frame.iloc[-1] if len(frame) else None
            if last is None:
                continue
            open_ = (frame["shard"] == last["shard"]) & (frame["tile"] == last["tile"])
            rest = frame[open_]
            yield of_tiles(frame[~open_])
        if rest is not None:
            yield of_tiles(rest)
        give_back()

    def of_tiles(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, tile in frame.groupby(["shard", "tile"], sort=False):
            links += tile_links(
                tile["class"].to_numpy(),
                [np.frombuffer(g, np.uint64) for g in tile["grams"]],
                tile["known"].to_numpy(),
                tile["guest"].to_numpy(),
                percent,
            )
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return (
        tiles.repartition("shard", "tile")
        .sortWithinPartitions("shard", "tile", "guest", "class")
        .mapInPandas(compare, "a long, b long")
    )


def _with_roots(classes: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """Each class with its root, itself where it has no link."""
    found = roots.select(F.col("node").alias("class"), F.col("root").alias(name))
    return classes.drop(name).join(found, "class", "left").withColumn(name, F.coalesce(name, "class"))


def similar(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, class, component_id) of every row of documents.

    Documents are linked when their sets of word n-grams have at least ``percent``
    percent of their union in common; ``component_id`` is the least doc_id that
    can be reached by links, the own one included. ``percent`` is 75 to 100: the
    numbers of signatures are worked out for that. Words are parted by blanks, A-Z
    in lower case. With fewer than ``n`` words the whole sequence is one n-gram.
    Null texts and texts without words have an empty set, class 0, and are linked
    with nothing. Rows of one set are linked; a null doc_id takes part, but names
    no component. Repeated rows stay. Columns other than doc_id and text are not
    read.
    """
    signed, grouped = _grouped(docs, n, percent)
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = grouped.join(least, "root").select("class", "component_id")
    return signed.join(named, "class", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        "class",
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def _grouped(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """What ``_signed`` gives, and (class, first, root): the component of every class."""
    if not 75 <= percent <= 100:
        raise ValueError("percent must be from 75 to 100")
    ship_package(docs.sparkSession)
    signed = _signed(docs, n, percent)
    classes = (
        signed.where("class <> 0")
        .groupBy("class")
        .agg(F.min("doc_id").alias("first"), F.first("size").alias("size"), F.first("keys").alias("keys"))
    )
    shards = components(_candidates(classes, percent))
    sharded = (
        shards.select(F.col("node").alias("class"), F.col("root").alias("shard"))
        .unionByName(shards.select(F.col("root").alias("class"), F.col("root").alias("shard")))
        .distinct()
    )
    tiles_of = sharded.groupBy("shard").agg(F.ceil(F.count("*") / TILE).alias("n_tiles"))
    members = stored(_sets(docs, sharded.join(tiles_of, "shard"), n), "sets")
    home = members.withColumn(
        "tile", F.pmod(F.xxhash64("class"), F.col("n_tiles")).cast("int")
    ).withColumn("guest", F.lit(False)).withColumn("known", F.col("class"))
    columns = ["shard", "tile", "class", "known", "guest", "grams"]
    every_tile = F.explode(F.sequence(F.lit(0), (F.col("n_tiles") - 1).cast("int")))

    def visiting(some: DataFrame) -> DataFrame:
        """Classes as guests in the other tiles of their shards."""
        return (
            some.withColumnRenamed("tile", "home")
            .withColumn("guest", F.lit(True))
            .withColumn("tile", every_tile)
            .where("tile <> home")
        )

    first = home.where((F.col("n_tiles") > 1) & (F.col("class") == F.col("shard")))
    links = stored(
        _compared(home.select(*columns).unionByName(visiting(first).select(*columns)), percent), "links"
    )
    roots = components(links)
    large = home.where("n_tiles > 1")
    if not large.isEmpty():
        placed = stored(_with_roots(large, roots, "known"), "placed")
        sizes = placed.groupBy("shard", "known").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("shard").agg(F.max_by("known", F.struct("n", "known")).alias("largest"))
        apart = placed.join(largest, "shard").where(F.col("known") != F.col("largest")).drop("largest")
        # Only shards that have such classes are gone through again.
        again = placed.join(apart.select("shard").distinct(), "shard", "left_semi")
        guests = visiting(apart).select(*columns)
        more = stored(_compared(again.select(*columns).unionByName(guests), percent), "more")
        if not more.isEmpty():
            roots = components(links.unionByName(more))
    return signed, stored(_with_roots(classes.select("class", "first"), roots, "root"), "grouped")


def _sets(docs: DataFrame, picked: DataFrame, n: int) -> DataFrame:
    """(class, shard, n_tiles, grams) of each picked class (class, shard, n_tiles).

    Sets are made where the texts are; a filter keeps nearly all others from being
    shuffled. Copies within a batch give one set.
    """
    picked = stored(picked, "picked")
    packed = _filter(picked.select(F.col("class").alias("hash")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(packed).view(bool)
        for _, texts in text_groups(batches, 1, CHARS):
            found: dict[int, bytes] = {}
            for grams in gram_sets(texts, n):
                own = _fingerprint(grams)
                if own and own not in found and wanted[_cells(np.array([own]).view(np.uint64))[0]]:
                    found[own] = grams.tobytes()
            columns = [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["class", "grams"])
        give_back()

    sets = _texts(docs).mapInArrow(hashed, "class long, grams binary")
    return sets.join(picked, "class").dropDuplicates(["class"])


def digest(docs: DataFrame) -> DataFrame:
    return similar(docs).select("doc_id", "n_shingles", "component_id")


def first_of_each(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """One row of each group of similar documents: the one of the least doc_id.

    A group is decided by row: of rows that share the least doc_id one with the least
    digest of its text stays, of repeated rows any one, and a row without doc_id only
    if the whole group has none. Rows that share a doc_id but not their words are in
    groups of their own. Documents without words are in no group and all stay.
    """
    signed, grouped = _grouped(docs.select("doc_id", "text"), n, percent)
    own = [F.col(c) for c in ("doc_id", "a", "b")]
    rows = signed.where("class <> 0").join(grouped.select("class", "root"), "class")
    per_row = rows.groupBy("root", *own).agg(F.count("*").alias("n"))
    # Null ids come last.
    order = F.struct(F.col("doc_id").isNull().alias("none"), *own)
    least = per_row.groupBy("root").agg(F.min(order).alias("least"))
    marked = stored(
        per_row.join(least, "root").select(
            F.col("doc_id").alias("its_id"),
            F.col("a").alias("its_a"),
            F.col("b").alias("its_b"),
            "n",
            (order == F.col("least")).alias("stays"),
        ),
        "marked",
    )
    prefix = spare_prefix(docs)
    a, b = _digests(f"{prefix}row.text")
    every = whole(docs, f"{prefix}row").select(
        f"{prefix}row", F.col(f"{prefix}row.doc_id").cast("long").alias("its_id"), a.alias("its_a"), b.alias("its_b")
    )

    def picked(some: DataFrame, how: str) -> DataFrame:
        keys = some.toDF("id_", "a_", "b_")
        same = F.col("its_id").eqNullSafe(F.col("id_")) & (F.col("its_a") == F.col("a_")) & (F.col("its_b") == F.col("b_"))
        return every.join(keys, same, how)

    keys = ["its_id", "its_a", "its_b"]
    kept = picked(marked.where("NOT stays OR n > 1").select(*keys), "left_anti")
    repeated = marked.where("stays AND n > 1").select(*keys)
    if not repeated.isEmpty():
        kept = kept.unionByName(picked(repeated, "left_semi").dropDuplicates(keys))
    return kept.select(*[F.col(f"{prefix}row")[c].alias(c) for c in docs.columns])
