"""Secrets in texts: patterns, and strings that look random.

Patterns give the base spans. Further spans are found by two character Markov
models, one of random strings and one of ordinary identifiers, both trained from
labelled samples: a string is added where the log-likelihood ratio of the two is
high enough.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.llm.common import sampled, ship_package, spare_prefix, with_text_columns

# The patterns of the three base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST_VALUE = 6
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]"
MASK = "[SECRET]"
#: Weight of the single characters in the models, in pairs of characters.
BACKOFF = 5.0
ADDED = (
    "spans array<struct<kind:string,start:int,end:int,value_start:int>>, redacted string"
)


@dataclass
class Model:
    ratio: np.ndarray  # character before (0: start) x character, log ratio
    threshold: float
    shortest: int


def _codes() -> np.ndarray:
    table = np.zeros(128, np.int64)
    for i, c in enumerate(ALPHABET, 1):
        table[ord(c)] = i
    return table


_CODE = _codes()
_SIZE = len(ALPHABET) + 1


def _transitions(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters before and after each step of the strings, and where each string starts."""
    raw = np.frombuffer("".join(strings).encode("ascii"), np.uint8)
    after = _CODE[raw]
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    first = np.cumsum(lengths) - lengths
    before = np.concatenate([[0], after[:-1]])
    before[first] = 0
    return before, after, first


def ratios(strings: list[str], model: Model) -> np.ndarray:
    """Log-likelihood ratio of every string, random against ordinary."""
    if not strings:
        return np.zeros(0)
    before, after, first = _transitions(strings)
    return np.add.reduceat(model.ratio[before, after], first)


def train(samples: DataFrame, threshold: float = 12.0, shortest: int = 16) -> Model:
    """Both models from samples (sample, label): 1 random, 0 ordinary.

    Strings with other characters than the alphabet's, empty and null ones are
    skipped. What comes to the driver is one number per pair of characters and
    label. Without samples of both labels nothing is ever added.
    """
    ship_package(samples.sparkSession)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for label, own in frame.groupby("label"):
                before, after, _ = _transitions(own["sample"].tolist())
                total = np.bincount(before * _SIZE + after, minlength=_SIZE**2)
                cells = np.flatnonzero(total)
                yield pd.DataFrame({"label": label, "cell": cells, "n": total[cells]})

    fit = samples.where(F.col("sample").rlike(rf"^{CANDIDATE}+$") & F.col("label").isin(0, 1))
    counts = (
        fit.select(F.col("label").cast("int").alias("label"), "sample")
        .mapInPandas(counted, "label int, cell int, n long")
        .groupBy("label", "cell")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    table = np.zeros((2, _SIZE**2))
    for row in counts:
        table[row["label"], row["cell"]] = row["n"]
    if not table.sum(axis=1).all():
        return Model(np.zeros((_SIZE, _SIZE)), np.inf, shortest)
    pairs = table.reshape(2, _SIZE, _SIZE)
    # What follows a character is backed off to what occurs at all.
    alone = pairs.sum(axis=1, keepdims=True) + 0.5
    alone /= alone.sum(axis=2, keepdims=True)
    chance = (pairs + BACKOFF * alone) / (pairs.sum(axis=2, keepdims=True) + BACKOFF)
    logs = np.log(chance)
    return Model(logs[1] - logs[0], threshold, shortest)


def labelled_samples(docs: DataFrame, sample_docs: int = 20_000) -> DataFrame:
    """Labelled strings out of about ``sample_docs`` documents, picked by a hash.

    Ordinary ones are the longer words of the texts; random ones are digests of
    the ids in hexadecimal, base 64 and base 36, and what the base patterns find.
    """
    some = sampled(docs.select("doc_id", "text", F.lit(1).alias("every")), "every", sample_docs)
    words = F.regexp_extract_all("text", F.lit(rf"{CANDIDATE}{{6,}}"), F.lit(0))
    secret = r"[0-9a-f]{24,}|AKIA[A-Z0-9]{16,}"
    ordinary = (
        some.select(F.explode(words).alias("sample"))
        .where(~F.col("sample").rlike(secret))
        .withColumn("label", F.lit(0))
    )
    digest = F.sha2(F.concat(F.lit("sample/"), F.col("doc_id").cast("string")).cast("binary"), 256)
    found = F.regexp_extract_all("text", F.lit(secret), F.lit(0))
    made = F.array(
        F.substring(digest, 1, 40),
        F.regexp_replace(F.base64(F.unhex(digest)), "[\\r\\n=]", ""),
        F.concat(*[F.conv(F.substring(digest, 1 + 12 * i, 12), 16, 36) for i in range(3)]),
    )
    random = some.select(F.explode(F.concat(made, F.coalesce(found, F.array()))).alias("sample"))
    return ordinary.unionByName(random.withColumn("label", F.lit(1)))


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the three patterns, in order."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= SHORTEST_VALUE:
                found.append((m.start(), 0, m.end(), m.start(2)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def scanned(texts: list[str], model: Model) -> list[list]:
    """Spans of every text, and the text without the values of its secrets."""
    candidate = re.compile(rf"(?<!{CANDIDATE}){CANDIDATE}{{{model.shortest},}}")
    spans = [base_spans(text) for text in texts]
    where, strings = [], []
    if np.isfinite(model.threshold):
        for i, text in enumerate(texts):
            for m in candidate.finditer(text):
                where.append((i, m.start(), m.end()))
                strings.append(m[0])
    for j in np.flatnonzero(ratios(strings, model) >= model.threshold).tolist():
        i, start, end = where[j]
        if all(end <= s or e <= start for s, _, e, _ in spans[i]):
            spans[i].append((start, 3, end, start))
    listed, redacted = [], []
    for text, own in zip(texts, spans, strict=True):
        own.sort()
        listed.append(
            [{"kind": KINDS[k], "start": s, "end": e, "value_start": v} for s, k, e, v in own]
        )
        redacted.append(_without(text, own) if own else None)
    return [listed, redacted]


def _without(text: str, spans: list[tuple[int, int, int, int]]) -> str:
    """The text with a mask in place of each value; values that overlap are one."""
    parts, at = [], 0
    merged: list[list[int]] = []
    for start, end in sorted((v, e) for _, _, e, v in spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        parts += [text[at:start], MASK]
        at = end
    return "".join([*parts, text[at:]])


def scan(docs: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """The documents with ``spans`` and ``redacted``, the text without secret values.

    Spans (code points, end open) come by start, then kind. ``redacted`` is null
    where nothing was found; null and empty texts have no spans. Input columns
    named like the new ones, which begin with ``prefix``, are replaced.
    """

    def compute(texts: list[str]) -> list[list]:
        return scanned(texts, model)

    return with_text_columns(docs, compute, ADDED, prefix=prefix)


def learned(docs: DataFrame) -> Model:
    return train(labelled_samples(docs))


def digest(docs: DataFrame) -> DataFrame:
    """Counts and spans of every document, in one string each."""
    found = scan(docs.select("doc_id", "text"), learned(docs))
    base = F.filter("spans", lambda s: s["kind"] != "markov")

    def written(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str) -> Column:
        own = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(own).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def without_secrets(docs: DataFrame) -> DataFrame:
    """All documents, secret values replaced by a mask and ``n_chars`` counted anew."""
    prefix = spare_prefix(docs)
    found = scan(docs, learned(docs), prefix)
    redacted = F.col(f"{prefix}redacted")
    columns = {
        "text": F.coalesce(redacted, "text"),
        "n_chars": F.when(redacted.isNotNull(), F.length(redacted).cast("long")).otherwise(F.col("n_chars")),
    }
    return found.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])
