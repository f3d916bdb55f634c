"""Language of whole texts and of the spans within them.

A word's script narrows the languages it can be in. Each of those scores the word
by the trigrams of its letters, hashed into a table of log ratios that is learned
from labelled documents. Viterbi then finds the best sequence of languages, where
each switch costs a penalty; runs of one language are spans, and the language with
most letters is the text's.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchtide.llm.common import (
    held_out,
    sampled,
    ship_package,
    spare_prefix,
    with_text_columns,
)
from searchtide.llm.letters import N_SCRIPTS, letters, scripts, words_of

UNKNOWN = "und"
BUCKETS = 1 << 17
#: Texts are turned into scores this many characters at a time.
PART = 500_000
ADDED = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # bucket x language, log ratios
    allowed: np.ndarray  # script x language


def _trigrams(codes: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around each letter; neighbours that are none count as 0."""
    own = np.where(inside, codes, 0).astype(np.uint64)
    before = np.concatenate([own[:1] * 0, own[:-1]])
    after = np.concatenate([own[1:], own[:1] * 0])
    mixed = (before * np.uint64(0x9E3779B97F4A7C15) + own) * np.uint64(0xC2B2AE3D27D4EB4F) + after
    mixed *= np.uint64(0x165667B19E3779F9)
    return (mixed[inside] >> np.uint64(64 - 17)).astype(np.int64)


def train(
    docs: DataFrame, sample_per_lang: int = 5_000, script_share: float = 0.01
) -> Model:
    """A model from documents with text and lang.

    Counts come from about ``sample_per_lang`` documents of each language, picked
    by a hash. A script is open to the languages that have at least
    ``script_share`` of their letters in it. What comes to the driver is at most
    BUCKETS rows per language.
    """
    ship_package(docs.sparkSession)
    known = sampled(docs.where(F.col("text").isNotNull()), "lang", sample_per_lang)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, own in frame.groupby("lang"):
                total = np.zeros(BUCKETS + N_SCRIPTS, np.int64)
                for texts in _parts(own["text"].tolist()):
                    words = words_of(texts, letters())
                    total[:BUCKETS] += np.bincount(
                        _trigrams(words.codes, words.inside), minlength=BUCKETS
                    )
                    total[BUCKETS:] += np.bincount(
                        scripts()[words.codes[words.inside]], minlength=N_SCRIPTS
                    )
                cells = np.flatnonzero(total)
                yield pd.DataFrame({"lang": lang, "cell": cells, "n": total[cells]})

    counts = (
        known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
        .mapInPandas(counted, "lang string, cell int, n long")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    langs = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    which = counts["lang"].map({lang: i for i, lang in enumerate(langs)}).to_numpy(np.int64)
    table[counts["cell"].to_numpy(np.int64), which] = counts["n"].to_numpy(float)
    in_script, grams = table[BUCKETS:], table[:BUCKETS]
    allowed = in_script >= script_share * np.maximum(in_script.sum(axis=0), 1)
    smooth = np.log((grams + 0.1) / (grams.sum(axis=0) + 0.1 * BUCKETS))
    mean = np.log(np.exp(smooth).mean(axis=1, keepdims=True)) if langs else 0.0
    return Model(langs, (smooth - mean).astype(np.float32), allowed)


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of about PART characters; a longer text is cut at a non-letter."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= PART:
            yield part
            part, size = [], 0
    if part:
        yield part


def word_scores(texts: list[str], model: Model) -> tuple[np.ndarray, ...]:
    """Per word: text, start, end, letters, and a score for each language."""
    found = []
    base = 0
    for part in _parts(texts):
        words = words_of(part, letters())
        if len(words.start):
            grams = model.table[_trigrams(words.codes, words.inside)]
            length = words.end - words.start
            scores = np.add.reduceat(grams, np.cumsum(length) - length, axis=0)
            open_to = model.allowed[scripts()[words.codes[words.start]]]
            nobody = ~open_to.any(axis=1)
            scores = np.where(open_to, scores, np.float32(-50.0))
            scores[nobody] = 0.0
            place = words.start - words.first[words.doc]
            narrow = (words.doc + base, place, place + length, length)
            found.append((*[column.astype(np.int32) for column in narrow], scores))
        base += len(part)
    if not found:
        none = np.zeros(0, np.int32)
        return none, none, none, none, np.zeros((0, len(model.langs)), np.float32)
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def viterbi(doc: np.ndarray, scores: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word; the texts go ahead word by word together."""
    n_words, n_langs = scores.shape
    _, first, counts = np.unique(doc, return_index=True, return_counts=True)
    by_length = np.argsort(-counts, kind="stable")
    rank = np.empty(len(counts), np.int32)
    rank[by_length] = np.arange(len(counts))
    step = np.arange(n_words, dtype=np.int32) - np.repeat(first.astype(np.int32), counts)
    order = np.lexsort((np.repeat(rank, counts), step)).astype(np.int32)
    in_order = scores[order]
    alive = np.bincount(step)  # texts that have a word of this number
    begin = np.cumsum(alive) - alive
    stay = np.ones((n_words, n_langs), bool)
    source = np.zeros(n_words, np.int16)
    value = in_order[: alive[0]].astype(np.float64)
    finals = np.zeros(len(counts), np.int64)
    for t in range(1, len(alive)):
        now, at = alive[t], begin[t]
        if now < len(value):
            finals[now : len(value)] = value[now:].argmax(axis=1)
            value = value[:now]
        best = value.argmax(axis=1)
        change = value[np.arange(now), best][:, None] - penalty
        stay[at : at + now] = value >= change
        source[at : at + now] = best
        value = np.maximum(value, change) + in_order[at : at + now]
    finals[: len(value)] = value.argmax(axis=1)
    label = np.empty(n_words, np.int16)
    current = finals.copy()
    for t in range(len(alive) - 1, -1, -1):
        now, at = alive[t], begin[t]
        label[at : at + now] = current[:now]
        if t:
            kept = stay[np.arange(at, at + now), current[:now]]
            current[:now] = np.where(kept, current[:now], source[at : at + now])
    back = np.empty(n_words, np.int16)
    back[order] = label
    return back


def labelled(texts: list[str], model: Model, penalty: float) -> list[list]:
    n, n_langs = len(texts), len(model.langs)
    langs, shares, spans = [UNKNOWN] * n, [0.0] * n, [[] for _ in range(n)]
    if n_langs:
        doc, start, end, length, scores = word_scores(texts, model)
        if len(doc):
            label = viterbi(doc, scores, penalty)
            cell = doc.astype(np.int64) * n_langs + label
            mass = np.bincount(cell, length, n * n_langs).reshape(n, n_langs)
            total = mass.sum(axis=1)
            best = mass.argmax(axis=1)
            for i in np.flatnonzero(total).tolist():
                langs[i] = model.langs[best[i]]
                shares[i] = float(mass[i, best[i]] / total[i])
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])
            cuts = np.flatnonzero(new)
            last = np.append(cuts[1:], len(doc)) - 1
            for i, a, b, x in zip(
                doc[cuts].tolist(), start[cuts].tolist(), end[last].tolist(), label[cuts].tolist(), strict=True
            ):
                spans[i].append({"start": a, "end": b, "lang": model.langs[x]})
    return [langs, shares, spans]


def identify(docs: DataFrame, model: Model, penalty: float = 12.0, prefix: str = "") -> DataFrame:
    """The documents with ``lang_pred``, ``score`` and ``spans`` (code points, end open).

    The score is the share of a text's letters that lie in spans of its language;
    ties go to the name that sorts first. A null or empty text, one without
    letters, and any text under a model that has learned nothing are ``und`` with
    score 0 and no spans. Input columns named like the new ones, which begin with
    ``prefix``, are replaced.
    """

    def compute(texts: list[str]) -> list[list]:
        return labelled(texts, model, penalty)

    return with_text_columns(docs, compute, ADDED, chars=1_500_000, prefix=prefix)


def learned(docs: DataFrame) -> Model:
    """The model of a table's own labels, without the held-out third."""
    return train(docs.where(~held_out()).select("doc_id", "text", "lang"))


def predicted(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", "text")
    return identify(texts, learned(docs)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


def known_language(docs: DataFrame) -> DataFrame:
    """The documents that are in some language; those that are ``und`` go."""
    prefix = spare_prefix(docs)
    found = identify(docs, learned(docs), prefix=prefix)
    return found.where(F.col(f"{prefix}lang_pred") != UNKNOWN).select(*docs.columns)
