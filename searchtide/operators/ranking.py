"""Row numbers without a bound, for groups of any size."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: One row in so many, picked by a hash, is looked at for the borders of a group ...
SAMPLE = 4096
#: ... and of this many picked rows at most every STEPth is a border, of more a smaller share.
MOST = 2**20
#: Picked rows of a group from one border to the next at least, and most borders in one array.
STEP, WIDTH = 32, 256


def number_rows(
    df: DataFrame,
    keys: Sequence[Column],
    by: Sequence[str] = (),
    name: str = "rank",
    sample: int = SAMPLE,
) -> DataFrame:
    """Number the rows of each group from 1 by ascending ``keys``; no task holds a heavy group.

    A heavy group is cut at borders: every STEPth of its own rows that a hash picks.
    Which part a row is in follows from its keys, so the rows are shuffled once, by
    group and part, and numbered there; a part's numbers start after the sizes of the
    parts before it. Groups that are not heavy have one part and no border. Rows
    must be distinct, and keys that leave ties are better avoided.

    A part has about STEP * ``sample`` rows, or STEP / MOST of a table that is longer
    than MOST * ``sample``. So every group beyond that is split, into as many parts as
    its share of the rows asks for, and borders and sizes, which are broadcast, are
    MOST / STEP rows at most. A row meets its group's borders in two arrays of WIDTH
    or fewer: the first border of each block of borders, then the rest of one block.

    Borders and sizes are worked out from ``df`` too. They ask for all of its columns,
    so where it ends in a shuffle, as counts do, that shuffle is read again and the
    work before it is not repeated. Picked rows are sorted, not collected.
    """
    digest = F.xxhash64(*df.columns)
    # Without groups, all rows are one; a plain constant would make a join without a key.
    rows = df if by else df.withColumn("_all", F.pmod(digest, F.lit(1)))
    groups = list(by) or ["_all"]
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])

    picked = rows.where(F.pmod(digest, F.lit(sample)) == 0).select(
        *groups, key.alias("_key"), F.row_number().over(Window.partitionBy(*groups).orderBy(key)).alias("_place")
    )
    # Asks for all columns, so that it reads the shuffle that the borders read.
    n_picked = picked.agg(F.sum(F.pmod(F.xxhash64(*picked.columns), F.lit(1)) + 1)).scalar()
    step = F.greatest(F.lit(1).cast("long"), F.ceil(n_picked / MOST)) * STEP
    borders = (
        picked.where(F.col("_place") % step == 0)
        .withColumn("_block", F.floor((F.col("_place") / step - 1) / WIDTH).cast("int"))
        .groupBy(*groups, "_block")
        .agg(F.array_sort(F.collect_list("_key")).alias("_borders"))
    )
    blocks = borders.select(*[F.col(c).alias(f"_of_{c}") for c in groups], "_block", "_borders")
    heads = borders.groupBy(*[F.col(c).alias(f"_has_{c}") for c in groups]).agg(
        F.array_sort(F.collect_list(F.element_at("_borders", 1))).alias("_heads")
    )
    located = rows.join(F.broadcast(heads), _same(groups, "_has_"), "left").select(
        *rows.columns, (_passed("_heads", key) - 1).alias("_in_block")
    )
    near = _same(groups, "_of_") & (F.col("_in_block") == F.col("_block"))
    # A heavy group's rows before its first border are in block -1, which has none.
    part = F.when(F.col("_in_block") < 0, 0).otherwise(F.col("_in_block") * WIDTH + _passed("_borders", key))
    placed = located.join(F.broadcast(blocks), near, "left").select(
        *rows.columns, F.coalesce(part, F.lit(-1)).alias("_part")
    )

    local = placed.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*groups, "_part").orderBy(*keys))
    )
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each part of a heavy group.
    starts = (
        placed.where("_part >= 0")
        .groupBy(*groups, "_part")
        .agg(F.count("*").alias("_size"))
        .withColumn("_start", F.sum("_size").over(earlier))
        .select(*[F.col(c).alias(f"_in_{c}") for c in groups], F.col("_part").alias("_in_part"), "_start")
    )
    same = _same(groups, "_in_") & (F.col("_part") == F.col("_in_part"))
    number = F.col("_local") + F.coalesce("_start", F.lit(0))
    return local.join(F.broadcast(starts), same, "left").select(*df.columns, number.cast("long").alias(name))


def _passed(borders: str, key: Column) -> Column:
    """How many of up to WIDTH ascending ``borders`` are not after ``key``, by halving; null for none."""
    steps = [1 << i for i in reversed(range(WIDTH.bit_length()))]
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(borders, at + step - 1) <= key, at + step).otherwise(at),
    )
    return F.when(F.col(borders).isNotNull(), found)


def _same(groups: Sequence[str], prefix: str) -> Column:
    """Equal groups, null like any other value."""
    equal = F.lit(True)
    for c in groups:
        equal = equal & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return equal
