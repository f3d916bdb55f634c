"""A global shuffle of a table into shards, in two passes over external storage.

Pass one scatters the rows by seeded hashes into buckets that fit in memory and
writes the result. Pass two reads one bucket at a time, puts it into the order of
a Fisher-Yates shuffle (Spark's ``shuffle``), and numbers the rows; a bucket's
first number is the sum of the sizes of the buckets before it.

Shards follow the law ``key``: key and shard count decide (the highest of one
seeded hash per shard wins), and one more shard takes rows only into itself.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.llm.common import plus, stored, whole


def shard_of(key: Column, n_shards: int, seed: int = 0) -> Column:
    """Shard by the highest seeded hash; a null key is a key like any other."""
    hashes = [F.xxhash64(F.lit(seed), F.lit(s), key) for s in range(n_shards)]
    if n_shards == 1:
        return F.lit(0)
    best = F.array_position(F.array(*hashes), F.greatest(*hashes)) - 1
    return best.cast("int")


def shuffled_shards(
    rows: DataFrame,
    key: str,
    n_shards: int,
    weight: str | None = None,
    bucket_weight: int = 4_000_000,
    seed: int = 0,
) -> DataFrame:
    """All rows with ``shard``, ``grown_shard`` (with one more shard) and ``slot``.

    ``weight`` names a column that says how much memory a row takes (one each, if
    left out), ``bucket_weight`` how much a bucket may hold; rows fall into the
    buckets of a shard by chance, so a key with many rows fills many buckets.
    Slots run from 0 in each shard without gaps. Repeated rows stay repeated, a
    null weight counts as 0, an empty table stays empty, and input columns named
    like the three new ones are replaced.
    """
    own = F.coalesce(F.col(f"row.{weight}"), F.lit(0)) if weight else F.lit(1)
    counted = rows.agg(
        F.sum(F.coalesce(F.col(weight), F.lit(0)) if weight else F.lit(1)).alias("total")
    )
    total = counted.first()["total"] or 0
    n_buckets = max(1, -(-total // (n_shards * bucket_weight)))
    key_of_row = F.col("row")[key]
    scattered = stored(
        whole(rows)
        .withColumn("place", F.monotonically_increasing_id())
        .select(
            "row",
            "place",
            own.alias("weight"),
            shard_of(key_of_row, n_shards, seed).alias("shard"),
            shard_of(key_of_row, n_shards + 1, seed).alias("grown_shard"),
            F.pmod(F.xxhash64(F.lit(~seed), key_of_row, "place"), F.lit(n_buckets)).alias("bucket"),
        ),
        "scattered",
    )
    earlier = (
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    first_slot = (
        scattered.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    )
    in_order = F.array_sort(
        F.collect_list(F.struct("place", "row", "grown_shard")),
        lambda a, b: F.when(a["place"] < b["place"], -1).otherwise(1),
    )
    dealt = (
        scattered.groupBy("shard", "bucket")
        .agg(in_order.alias("rows"))
        .join(first_slot, ["shard", "bucket"])
        .select("shard", "first", F.posexplode(F.shuffle("rows", seed)).alias("at", "dealt"))
        .select(
            F.col("dealt.row").alias("row"),
            "shard",
            F.col("dealt.grown_shard").alias("grown_shard"),
            (F.col("first") + F.col("at")).alias("slot"),
        )
    )
    return dealt.select(*plus(dealt, "shard", "grown_shard", "slot"))


def write_shards(shards: DataFrame, path: str) -> None:
    """One folder per shard, files cut by slot and rows in their order."""
    shards.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode(
        "overwrite"
    ).partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """Where every document goes; its size and checksum are those of the sharded text.

    A null text has size 1 and the checksum of nothing, as the empty text. The whole
    rows are sharded, the text among them.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.withColumn("size", (F.octet_length(text) + 1).cast("long"))
    return shuffled_shards(sized, "doc_id", n_shards, weight="size").select(
        "doc_id",
        "size",
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
