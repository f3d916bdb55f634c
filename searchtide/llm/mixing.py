"""Mixing sources to target weights by temperature.

A source with share p of all tokens gets a weight in proportion to p ** a. The
exponent a is found by bisection: the largest one whose weights still have the
wanted entropy, or the smallest one that repeats no source beyond a limit. The
budget times the weight is a source's quota. It is met by whole epochs and part
of one more; an epoch is a seeded permutation of the source's blocks, a block a
set of documents given by a hash.

DataFrame operations only. The table of sources, one row each, is the one thing
that is brought together in a row.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.llm.common import hex_number, plus, stored, whole

STEPS = 30


def word_count(text: Column) -> Column:
    """Words between blanks; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A source's name as a key that is never null; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("s:"), source.cast("string")), F.lit("n"))


def _log_weights(logs: Column, power: Column) -> Column:
    """Unnormalised weights; shares are at most 1, so nothing overflows."""
    return F.transform(logs, lambda x: F.exp(power * x))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _entropy(logs: Column, power: Column) -> Column:
    """Entropy of the weights at an exponent, in nats."""
    parts = _log_weights(logs, power)
    total = _sum(parts)
    weighted = _sum(F.zip_with(parts, logs, lambda w, x: w * x))
    return F.ln(total) - power * weighted / total


def _repetition(logs: Column, power: Column, budget: Column) -> Column:
    """Most epochs of any source; budget is in units of all tokens."""
    total = _sum(_log_weights(logs, power))
    smallest = F.array_min(logs)
    return budget * F.exp((power - 1) * smallest) / total


def _bisected(logs: Column, holds_low, entropy: bool) -> Column:
    """Exponent between 0 and 1 at the border of a test that holds on one side.

    Entropy falls as the exponent rises, so the largest exponent that keeps it is
    wanted; repetition falls too, so there the smallest one is.
    """
    first = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = (state["low"] + state["high"]) / 2
        ok = holds_low(middle)
        up = ok if entropy else ~ok
        return F.struct(
            F.when(up, middle).otherwise(state["low"]).alias("low"),
            F.when(up, state["high"]).otherwise(middle).alias("high"),
        )

    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), first, halve)
    if entropy:
        return F.when(holds_low(F.lit(1.0)), F.lit(1.0)).otherwise(found["low"])
    return F.when(holds_low(F.lit(0.0)), F.lit(0.0)).otherwise(found["high"])


def source_weights(
    sources: DataFrame,
    target_entropy: float | None = None,
    max_repetition: float | None = None,
    budget: int | None = None,
    cover: bool = False,
) -> DataFrame:
    """Weight, quota and epochs of every source, out of (``key``, ``tokens``).

    ``target_entropy`` is a share of the largest possible entropy, the logarithm
    of the number of sources; ``max_repetition`` a number of epochs. With both the
    limit comes first: where the entropy asks for more epochs of some source, the
    exponent is the least that keeps the limit. With none the weights are the plain
    shares. ``budget`` is in tokens, all tokens by
    default; ``cover`` raises it until every source is used once in full. Sources
    without tokens have weight 0 and are used once.
    """
    real = sources.where("tokens > 0")
    one = real.agg(
        F.sum("tokens").cast("double").alias("all_tokens"),
        F.sort_array(F.collect_list(F.col("tokens").cast("double"))).alias("sizes"),
    ).withColumn(
        "logs", F.transform("sizes", lambda t: F.ln(t / F.col("all_tokens")))
    )
    logs = F.col("logs")
    wanted = F.lit(float(budget)) if budget is not None else F.col("all_tokens")
    powers = []
    if target_entropy is not None:
        goal = F.lit(target_entropy) * F.ln(F.size(logs).cast("double"))
        powers.append(_bisected(logs, lambda a: _entropy(logs, a) >= goal - 1e-12, True))
    if max_repetition is not None:
        units = wanted / F.col("all_tokens")

        def rarely(power: Column) -> Column:
            # Where the largest source is used once, only the spread of sizes counts.
            least = F.exp((1 - power) * (F.array_max(logs) - F.array_min(logs)))
            most = _repetition(logs, power, units)
            return (F.greatest(least, most) if cover else most) <= max_repetition + 1e-12

        powers.append(_bisected(logs, rarely, False))
    power = F.greatest(*powers) if len(powers) > 1 else powers[0] if powers else F.lit(1.0)
    one = one.withColumn("power", power)
    one = one.withColumn("total", _sum(_log_weights(logs, F.col("power"))))
    if cover:
        # The largest source has the fewest epochs.
        top = F.array_max(logs)
        least = F.col("all_tokens") * F.exp((1 - F.col("power")) * top) * F.col("total")
        wanted = F.greatest(wanted, least)
    one = one.select("all_tokens", "power", "total", wanted.alias("budget"))
    tokens = F.col("tokens").cast("double")
    weight = F.exp(F.col("power") * F.ln(tokens / F.col("all_tokens"))) / F.col("total")
    # One row joined to one row per source, both far below any bound.
    weighted = real.join(F.broadcast(one)).select(
        "key",
        "tokens",
        F.round("power", 6).alias("power"),
        F.round(weight, 9).alias("weight"),
        # Rounded, so that one token more or less is not a matter of the last bit.
        F.floor(weight * F.col("budget") + 0.001).cast("long").alias("quota"),
    )
    spare = sources.where("tokens = 0").select(
        "key",
        "tokens",
        F.lit(None).cast("double").alias("power"),
        F.lit(0.0).alias("weight"),
        F.lit(0).cast("long").alias("quota"),
    )
    every = weighted.unionByName(spare)
    return every.select(
        "*",
        F.when(F.col("tokens") == 0, 1)
        .otherwise(F.floor(F.col("quota") / F.greatest("tokens", F.lit(1))))
        .cast("long")
        .alias("epochs"),
        F.when(F.col("tokens") == 0, 0)
        .otherwise(F.col("quota") % F.greatest("tokens", F.lit(1)))
        .cast("long")
        .alias("rest"),
    )


@dataclass
class Mix:
    """What decides how often each document is used, without any text."""

    weights: DataFrame  # key, tokens, power, weight, quota, epochs, rest, n_blocks
    uses: DataFrame  # key, block, epoch, block_rank, cut
    kept: DataFrame  # key, digest: documents of cut blocks that are used
    seed: int


def _digest(seed: int, doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(doc_id.cast("string"), F.lit("-"))).cast("binary"))


def _in_blocks(slim: DataFrame, weights: DataFrame) -> DataFrame:
    sizes = weights.select("key", "n_blocks")
    return slim.join(sizes, "key").withColumn("block", hex_number(F.col("digest")) % F.col("n_blocks"))


def plan_mix(
    docs: DataFrame, tokens: Column, block_tokens: int = 100_000, seed: int = 0, **wanted
) -> Mix:
    """Weights and block permutations for ``docs`` (doc_id, source).

    Blocks have about ``block_tokens`` tokens. In each epoch a source's blocks
    are taken in an order of their own; in the last one, as long as the quota
    lasts. The block in which it ends is cut between documents, in the order of
    their digests; equal doc_ids go together, so the quota is met but for less
    than one such group.
    """
    slim = stored(
        docs.select(
            source_key(F.col("source")).alias("key"),
            _digest(seed, F.col("doc_id")).alias("digest"),
            tokens.alias("tokens"),
        ),
        "tokens",
    )
    sources = slim.groupBy("key").agg(F.sum("tokens").alias("tokens"))
    weights = stored(
        source_weights(sources, **wanted).withColumn(
            "n_blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long")
        ),
        "weights",
    )
    placed = _in_blocks(slim, weights)
    blocks = placed.groupBy("key", "block").agg(F.sum("tokens").alias("block_tokens"))
    per_epoch = (
        blocks.join(weights.select("key", "tokens", "epochs", "rest"), "key")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), "epochs")))
        .withColumn("last", (F.col("epoch") == F.col("epochs")))
        .withColumn(
            "turn",
            F.md5(F.concat_ws("/", F.lit(str(seed)), "epoch", "key", "block").cast("binary")),
        )
    )
    order = Window.partitionBy("key", "epoch").orderBy("turn", "block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.coalesce(F.sum("block_tokens").over(before), F.lit(0))
    ranked = per_epoch.select(
        "key",
        "block",
        "epoch",
        "last",
        "block_tokens",
        F.row_number().over(order).alias("block_rank"),
        left.alias("left"),
    )
    uses = stored(
        ranked.where("NOT last OR left > 0").select(
            "key",
            "block",
            "epoch",
            "block_rank",
            F.when(F.col("last") & (F.col("block_tokens") > F.col("left")), F.col("left")).alias("cut"),
        ),
        "uses",
    )
    by_digest = Window.partitionBy("key", "block").orderBy("digest")
    cut = uses.where("cut IS NOT NULL").select("key", "block", "cut")
    kept = (
        placed.join(cut, ["key", "block"])
        .groupBy("key", "block", "cut", "digest")
        .agg(F.sum("tokens").alias("tokens"))
        .withColumn("used", F.sum("tokens").over(by_digest))
        .where("used <= cut")
        .select("key", "digest")
    )
    return Mix(weights, uses, stored(kept, "kept"), seed)


def apply_mix(docs: DataFrame, mix: Mix) -> DataFrame:
    """Every use of every document: its columns, ``epoch``, ``block`` and ``block_rank``.

    The rows in the order of epoch and block rank are the mix of a source.
    Whether the small tables of the plan are broadcast is left to their size; a
    heavy source is spread over its blocks. Input columns named like the new ones
    are replaced.
    """
    rows = whole(docs)
    rows = rows.select(
        "row",
        source_key(F.col("row.source")).alias("key"),
        _digest(mix.seed, F.col("row.doc_id")).alias("digest"),
    )
    used = _in_blocks(rows, mix.weights).join(mix.uses, ["key", "block"])
    kept = mix.kept.withColumn("is_kept", F.lit(True))
    uses = used.join(kept, ["key", "digest"], "left").where("cut IS NULL OR is_kept")
    return uses.select(*plus(uses, "epoch", "block", "block_rank"))


def mixed_digest(docs: DataFrame, target_entropy: float = 0.999, max_repetition: float = 16.0) -> DataFrame:
    """Every use of every document in a mix of as many tokens as there are.

    The limit on epochs keeps a tiny source, such as a misspelt name, from filling the mix.
    The mix of whole documents is written, and the digest taken from its rows.
    """
    tokens = word_count(F.col("text"))
    mix = plan_mix(docs, tokens, target_entropy=target_entropy, max_repetition=max_repetition)
    weights = mix.weights.select("key", "weight")
    mixed = stored(apply_mix(docs, mix), "mixed")
    return (
        mixed.select(
            "doc_id",
            "source",
            tokens.alias("n_tokens"),
            "epoch",
            "block",
            "block_rank",
            source_key(F.col("source")).alias("key"),
        )
        .join(weights, "key")
        .select("doc_id", "source", "n_tokens", "weight", "epoch", "block", "block_rank")
    )


def mixed_sources(docs: DataFrame, max_repetition: float = 2.0) -> DataFrame:
    """Documents as often as their source's weight asks: all once, small sources more often.

    Weights are as even as they can be while no source is used more often than
    ``max_repetition`` times; the largest is used once.
    """
    tokens = word_count(F.col("text"))
    mix = plan_mix(docs, tokens, max_repetition=max_repetition, cover=True)
    return apply_mix(docs, mix).select(*docs.columns)
