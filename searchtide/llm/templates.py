"""Main text of web pages, by the template that pages of one host share.

A page is a sequence of tokens, tags with their path and pieces of text. Tokens whose
counts are the same on every page of a host (one occurrence vector) are a class. A
class is valid if its tokens come in one order on nearly all pages, and it is nested
by the token of another class that it comes after. The valid classes of a host are its
template; what is left between their tokens are slots. The article's slots are those
below its element, or else below the deepest tag of the template that holds most of
the text that is no link. Vectors are kept as sums of hashes of (page, count), so that
pages add up in Spark in any order and no task holds the pages of a host.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.llm.common import ship_package, spare_prefix, stored, text_groups, whole
from searchtide.llm.markup import Block, Page, parse
from searchtide.llm.url_filter import host_of

#: Different pages that a host needs for a template of its own.
LEAST_PAGES = 8

#: Share of a host's pages that the tokens of a class are on.
SUPPORT = 0.5

#: Share of the pages with a class on which it comes in the same order and place.
STEADY = 0.9

#: Share of a host's pages on which a text of a class has to be to count as fixed.
FIXED = 0.9

#: Share of the text without links that the main part of a page holds.
MAIN = 0.6

#: Numbers in all templates together up to which they are broadcast (16 MB), and in how
#: many parts the pages of a host are joined with a template beyond.
BROADCAST = 2_000_000
SPREAD = 64

_SEQUENCES = (
    "host string, page long, again long, numbers array<long>, counts array<int>, "
    "firsts array<int>, lasts array<int>, depths array<int>, plain array<long>"
)


def _host(url: Column) -> Column:
    """Pages without a host share the empty one."""
    return F.coalesce(host_of(url), F.lit(""))


def _usable(block: Block, level: int) -> bool:
    """At level 0 neither element nor class may say that a block is beside the article.

    Level 1 leaves classes out of account, level 2 also elements, but for those that
    never hold text: a form or a box may be around a whole page.
    """
    last = block.path[-1]
    return not (last.hard or (last.beside and level < 2) or (last.marked and level < 1))


def _weights(page: Page) -> Counter[int]:
    """Text without links below every tag, by its number."""
    plain: Counter[int] = Counter()
    for block in page.blocks:
        if _usable(block, 0):
            size = sum(map(len, block.parts)) - 2 * block.linked
            for number in {e.number for e in block.path}:
                plain[number] += size
    return plain


def _sequences(pages: DataFrame) -> DataFrame:
    """Every different page of a host once: its tokens, their counts and places."""
    kinds = [pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 4, pa.list_(pa.int64())]
    names = ["numbers", "counts", "firsts", "lasts", "depths", "plain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, texts in text_groups(batches, 3, 1_000_000):
            rows: list[list] = [[] for _ in names]
            for text in texts:
                page = parse(text)
                places: dict[int, list[int]] = {}
                for at, number in enumerate(page.tokens):
                    seen = places.setdefault(number, [0, at, at])
                    seen[0] += 1
                    seen[2] = at
                plain = _weights(page)
                values = list(places.values())
                for row, found in zip(
                    rows,
                    [
                        list(places),
                        [v[0] for v in values],
                        [v[1] for v in values],
                        [v[2] for v in values],
                        [page.tags.get(n, 0) for n in places],
                        [plain[n] for n in places],
                    ],
                    strict=True,
                ):
                    row.append(found)
            arrays = [pa.array(row, kind) for row, kind in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*own.columns[:3], *arrays], ["host", "page", "again", *names])

    hashed = pages.select(
        "host", F.xxhash64(F.lit(1), "html").alias("page"), F.xxhash64(F.lit(2), "html").alias("again"), "html"
    )
    one = F.first(F.struct(*names))
    every = hashed.mapInArrow(run, _SEQUENCES).groupBy("host", "page", "again").agg(one.alias("own"))
    return stored(every.select("host", "page", "again", "own.*"), "sequences")


def _classes(sequences: DataFrame) -> DataFrame:
    """(host, n_pages, class, share, numbers): tokens of one occurrence vector."""
    totals = sequences.groupBy("host").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= LEAST_PAGES)
    each = sequences.select("host", "page", "again", F.inline(F.arrays_zip("numbers", "counts")))
    digest = F.xxhash64("page", "again", "counts")
    low = F.lit(0xFFFFFFFF)
    vectors = (
        each.withColumn("digest", digest)
        .groupBy("host", "numbers")
        .agg(
            F.count("*").alias("support"),
            F.sum(F.col("digest").bitwiseAND(low)).alias("low"),
            F.sum(F.shiftrightunsigned("digest", 32)).alias("high"),
        )
        .where(F.col("support") >= LEAST_PAGES * SUPPORT)
    )
    frequent = vectors.join(totals, "host").where(F.col("support") >= SUPPORT * F.col("n_pages"))
    return (
        frequent.groupBy("host", "n_pages", "support", "low", "high")
        .agg(F.sort_array(F.collect_list("numbers")).alias("numbers"))
        .where(F.size("numbers") > 1)
        .select(
            "host",
            "n_pages",
            F.xxhash64("support", "low", "high").alias("class"),
            (F.col("support") / F.col("n_pages")).alias("share"),
            "numbers",
        )
    )


def _with_host(rows: DataFrame, hosts: DataFrame, size: Column) -> DataFrame:
    """Rows joined to what is known of their host, null where nothing is.

    ``hosts`` is stored and has one row per host. It is broadcast up to a stated size;
    beyond, the rows of a host are dealt into parts, each with a copy of its own.
    """
    total = hosts.agg(F.sum(size)).first()[0] or 0
    if total <= BROADCAST:
        return rows.join(F.broadcast(hosts), "host", "left")
    copies = hosts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD)).cast("int")
    return rows.withColumn("part", part).join(copies, ["host", "part"], "left").drop("part")


def _placed(places: dict[int, tuple[int, int, int]], classes: list[tuple[int, float, list[int]]]) -> list:
    """(class, digest of its order, class and token that it comes after) on one page."""
    owner = {n: c for c, _, numbers in classes for n in numbers}
    on_page = sorted((places[n][1], n) for n in owner if n in places)
    order: dict[int, list[int]] = defaultdict(list)
    for _, number in on_page:
        order[owner[number]].append(number)
    share = {c: s for c, s, _ in classes}
    found = []
    for name, numbers in order.items():
        start = places[numbers[0]][1]
        counts = {places[n][0] for n in numbers}
        lasts = [places[n][2] for n in numbers]
        # Later occurrences have to come in the order of the first ones, all after them.
        ordered = len(counts) == 1 and lasts == sorted(lasts)
        if counts != {1}:
            ordered = ordered and places[numbers[-1]][1] < min(lasts)
        parent, gap = 0, 0
        for at, number in on_page:
            if at >= start:
                break
            if owner[number] != name and (share[owner[number]], owner[number]) > (share[name], name):
                parent, gap = owner[number], number
        found.append((name, hash(tuple(numbers)) if ordered else None, parent, gap))
    return found


def host_templates(sequences: DataFrame) -> DataFrame:
    """(host, n_pages, class, share, parent, gap, numbers): the valid classes of every host.

    ``parent`` and ``gap`` are the class, of a larger share, and its token that a class
    comes after; both are 0 for the outermost.
    """
    classes = stored(_classes(sequences), "classes")
    listed = stored(
        classes.groupBy("host").agg(F.collect_list(F.struct("class", "share", "numbers")).alias("classes")),
        "host_classes",
    )
    size = F.aggregate("classes", F.lit(0), lambda a, c: a + F.size(c["numbers"])).cast("long")
    known = _with_host(sequences.select("host", "numbers", "counts", "firsts", "lasts"), listed, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = batch.column("host").to_pylist()
            last, found = None, None
            seen: Counter[tuple] = Counter()
            columns = [batch.column(c) for c in ("numbers", "counts", "firsts", "lasts")]
            for i, host in enumerate(hosts):
                if host != last or found is None:
                    last = host
                    found = [
                        (c["class"], c["share"], c["numbers"]) for c in batch.column("classes")[i].as_py() or ()
                    ]
                if found:
                    values = [c[i].values.to_numpy(zero_copy_only=False).tolist() for c in columns]
                    places = dict(zip(values[0], zip(*values[1:], strict=True), strict=True))
                    seen.update((host, *row) for row in _placed(places, found))
            rows = [(*key, n) for key, n in seen.items()]
            cells = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cells, kinds, strict=True)],
                ["host", "class", "ordered", "parent", "gap", "n"],
            )

    seen = (
        known.where(F.col("classes").isNotNull())
        .mapInArrow(run, "host string, class long, ordered long, parent long, gap long, n long")
        .groupBy("host", "class", "ordered", "parent", "gap")
        .agg(F.sum("n").alias("n"))
    )
    steady = seen.groupBy("host", "class").agg(
        F.sum("n").alias("all"),
        F.max_by(F.struct("ordered", "parent", "gap", "n"), F.struct("n", "ordered", "parent", "gap")).alias("most"),
    )
    valid = steady.where(F.col("most")["ordered"].isNotNull() & (F.col("most")["n"] >= STEADY * F.col("all")))
    kept = valid.select("host", "class", "most.parent", "most.gap")
    return classes.join(kept, ["host", "class"]).select(
        "host", "n_pages", "class", "share", "parent", "gap", "numbers"
    )


def _learned(sequences: DataFrame, templates: DataFrame) -> DataFrame:
    """(host, fixed, main): the host's fixed texts, and the tag that its articles are below."""
    texts = F.filter("numbers", lambda n: n.bitwiseAND(F.lit(1)) == 1)
    fixed = templates.groupBy("host").agg(
        F.flatten(F.collect_list(F.when(F.col("share") >= FIXED, texts).otherwise(F.array().cast("array<long>")))).alias(
            "fixed"
        )
    )
    tags = templates.select("host", F.explode("numbers").alias("numbers")).where("numbers & 1 = 0")
    below = (
        sequences.select("host", F.inline(F.arrays_zip("numbers", "depths", "plain")))
        .where("depths > 0")
        .groupBy("host", "numbers")
        .agg(F.max("depths").alias("depth"), F.sum("plain").alias("plain"))
        .join(tags, ["host", "numbers"])
    )
    most = below.groupBy("host").agg(F.max("plain").alias("most"))
    main = (
        below.join(most, "host")
        .where((F.col("plain") > 0) & (F.col("plain") >= MAIN * F.col("most")))
        .groupBy("host")
        .agg(F.max_by("numbers", F.struct("depth", "plain", "numbers")).alias("main"))
    )
    return fixed.join(main, "host", "left")


def _own_main(page: Page) -> int:
    """The main tag of a page whose host has no template: by the page's own text."""
    plain = _weights(page)
    most = max(plain.values(), default=0)
    good = [(page.tags.get(n, 0), size, n) for n, size in plain.items() if size > 0 and size >= MAIN * most]
    return max(good, default=(0, 0, 0))[2]


def main_text(markup: str, fixed: set[int], main: int | None) -> str:
    """The article of a page, one line per block; ``fixed`` and ``main`` are its host's."""
    page = parse(markup)
    for level in range(3):
        blocks = [b for b in page.blocks if _usable(b, level)]
        inside = [b for b in blocks if b.path[-1].article]
        if not inside:
            top = main if main in page.tags else _own_main(page)
            inside = [b for b in blocks if not top or _below(b, top)]
            if top and not any(_is_title(b) for b in inside):
                # A title above the main part belongs to it.
                inside = [b for b in blocks if _is_title(b)][:1] + inside
        slots = [b.text for b in inside if not fixed.issuperset(b.tokens)]
        kept = [text for text in slots if text]
        if kept:
            return "\n".join(kept)
    return ""


def _below(block: Block, number: int) -> bool:
    return any(e.number == number for e in block.path)


def _is_title(block: Block) -> bool:
    return any(e.name == "h1" for e in block.path)


def extracted(pages: DataFrame) -> DataFrame:
    """The columns of ``pages``, with ``text`` and ``n_chars`` put in.

    Every row gives one row, also repeated ones; null or empty html gives an empty
    text. Pages whose URL is null or has no host share one. Equal pages of a host count
    once for its template, so copies do not make an article part of it; a host of fewer
    than LEAST_PAGES different pages has none, and each of its pages is judged by
    itself. Texts of any length are read whole. Other columns, also those that have
    names of working columns, pass through; ``text`` and ``n_chars`` are replaced.
    """
    ship_package(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit(""))
    sequences = _sequences(pages.select(_host(F.col("url")).alias("host"), html.alias("html")))
    learned = stored(_learned(sequences, stored(host_templates(sequences), "templates")), "learned")
    prefix = spare_prefix(pages)
    own = whole(pages, f"{prefix}row").select(
        F.col(f"{prefix}row"),
        _host(F.col(f"{prefix}row")["url"]).alias("host"),
        F.coalesce(F.col(f"{prefix}row")["html"], F.lit("")).alias("html"),
    )
    known = _with_host(own, learned, F.size("fixed").cast("long"))
    names = [c for c in pages.columns if c not in ("text", "n_chars")]
    flat = known.select(
        *[F.col(f"{prefix}row")[c].alias(f"{prefix}{i}") for i, c in enumerate(names)],
        F.col("html").alias(f"{prefix}html"),
        F.col("host").alias(f"{prefix}host"),
        F.col("fixed").alias(f"{prefix}fixed"),
        F.col("main").alias(f"{prefix}main"),
    )
    n = len(names)
    schema = ", ".join(f"{prefix}{i} {flat.schema[i].dataType.simpleString()}" for i in range(n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed_of: dict[str, set[int]] = {}
        for part, texts in text_groups(batches, n, 1_000_000):
            hosts, mains = part.column(n + 1).to_pylist(), part.column(n + 3).to_pylist()
            found = []
            for i, text in enumerate(texts):
                if hosts[i] not in fixed_of:
                    if len(fixed_of) > 1_000:
                        fixed_of.clear()
                    fixed_of[hosts[i]] = set(part.column(n + 2)[i].as_py() or ())
                found.append(main_text(text, fixed_of[hosts[i]], mains[i]))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:n], pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())],
                [f"{prefix}{i}" for i in range(n)] + [f"{prefix}text", f"{prefix}n_chars"],
            )

    done = flat.mapInArrow(run, f"{schema}, {prefix}text string, {prefix}n_chars long")
    return done.toDF(*names, "text", "n_chars")


def digest(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    return extracted(pages.select("page_id", "url", "html")).drop("html")
