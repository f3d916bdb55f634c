"""Toxicity of whole texts by a learned lexicon, misspellings and context.

The lexicon holds words, and beginnings of words, that labelled toxic documents
have far more often than others. It is kept as a trie. A Levenshtein automaton
runs over the trie, so that a word is matched against all terms at once with a
bounded number of edits; its states are made as words need them. Around each match
a window of words tells quotation from abuse: quotation marks on both sides, or a
word of reporting just before. A logistic model weighs exact, misspelled and
quoted matches.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.llm.common import held_out, sampled, ship_package, stored, with_text_columns
from searchtide.llm.jaccard import FILTER_BITS, _filter
from searchtide.llm.letters import Words, word_marks, words_of

THRESHOLD = 0.7
ADDED = "score double, n_exact int, n_misspelled int, n_quoted int"

# The signs that may close a quotation, by the one that opens it, and
# words that report speech.
CLOSING = {
    '"': '"', "'": "'’", "`": "`'", "«": "»", "»": "«", "‘": "’'", "‚": "‘'", "“": "”\"", "„": "“”\"", "‹": "›", "›": "‹",
}
APOSTROPHES = "'’‘`"
REPORTING = (
    "said says say called calls call wrote writes quoted quote word term told "
    "dit disait appelle mot sagte sagt nannte wort dijo dice llama palabra"
).split()
#: Words before and after a match that are looked at.
WINDOW = 8
#: States of an automaton that are kept; beyond, they are worked out anew as needed.
STATES = 100_000


@dataclass
class Term:
    text: str
    weight: float
    beginning: bool = False  # any word that starts like this
    edits: int = 0


def edits_for(text: str) -> int:
    """Edits allowed in a word: none in short ones, one or two in longer ones."""
    return 0 if len(text) < 5 else 1 if len(text) < 10 else 2


@dataclass
class Automaton:
    """Levenshtein automata of all terms, intersected with the trie that they form.

    A state is a set of (trie node, edits so far); state 0 is the empty one, from
    which nothing is reached.
    """

    terms: list[Term]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ending: dict[int, list[int]] = field(default_factory=dict)
    budget: list[int] = field(default_factory=lambda: [0])
    states: dict[frozenset, int] = field(default_factory=dict)
    sets: list[frozenset] = field(default_factory=list)

    def __post_init__(self):
        for number, term in enumerate(self.terms):
            node = 0
            self.budget[0] = max(self.budget[0], term.edits)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.budget.append(0)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], term.edits)
            self.ending.setdefault(node, []).append(number)
        self.alphabet = sorted({c for t in self.terms for c in t.text})
        self.classes = np.zeros(0x110000, np.uint16)
        for i, c in enumerate(self.alphabet, 1):
            self.classes[ord(c)] = i
        self._forget()

    def _forget(self) -> None:
        """Start again with the first two states."""
        self.states, self.sets = {}, []
        self.steps = np.full((64, len(self.alphabet) + 1), -1, np.int32)
        self.accepts = np.full((64, 2), -1, np.int32)  # term at the end of a word, beginning passed
        self.distance = np.zeros(64, np.int32)
        self._state(frozenset())
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, places: set) -> frozenset:
        """With the places reached by leaving out letters of a term."""
        open_, found = list(places), set(places)
        while open_:
            node, edits = open_.pop()
            for child in self.children[node].values():
                place = (child, edits + 1)
                if edits + 1 <= self.budget[child] and place not in found:
                    found.add(place)
                    open_.append(place)
        return frozenset(found)

    def _state(self, places: frozenset) -> int:
        if places in self.states:
            return self.states[places]
        number = len(self.sets)
        if number == len(self.steps):
            self.steps = np.concatenate([self.steps, np.full_like(self.steps, -1)])
            self.accepts = np.concatenate([self.accepts, np.full_like(self.accepts, -1)])
            self.distance = np.concatenate([self.distance, np.zeros_like(self.distance)])
        self.states[places] = number
        self.sets.append(places)
        ends, starts = [], []
        for node, edits in places:
            for t in self.ending.get(node, ()):
                if edits <= self.terms[t].edits:
                    kind = starts if self.terms[t].beginning else ends
                    kind.append((edits, -self.terms[t].weight, t))
        if ends:
            self.distance[number], _, self.accepts[number, 0] = min(ends)
        if starts:
            self.accepts[number, 1] = min(starts)[2]
        return number

    def _step(self, state: int, letter: int) -> int:
        c = self.alphabet[letter - 1] if letter else None
        found = set()
        for node, edits in self.sets[state]:
            for key, child in self.children[node].items():
                if key == c:
                    found.add((child, edits))
                elif edits + 1 <= self.budget[child]:
                    found.add((child, edits + 1))
            if edits + 1 <= self.budget[node]:
                found.add((node, edits + 1))
        return self._state(self._closed(found))

    def run(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words that match, the term of each, and its distance; all words in step."""
        if len(self.sets) > STATES:
            self._forget()
        length = words.end - words.start
        alive = np.arange(len(length))
        state = np.full(len(length), self.start, np.int32)
        term = np.full(len(length), -1, np.int32)
        far = np.zeros(len(length), np.int32)
        at = 0
        while len(alive):
            letter = self.classes[words.codes[words.start[alive] + at]]
            after = self.steps[state, letter]
            if (after < 0).any():
                for s, c in {*zip(state[after < 0].tolist(), letter[after < 0].tolist(), strict=True)}:
                    target = self._step(s, c)
                    self.steps[s, c] = target
                after = self.steps[state, letter]
            at += 1
            begun = self.accepts[after, 1]
            new = (begun >= 0) & (term[alive] < 0)
            term[alive[new]] = begun[new]
            over = length[alive] == at
            done, last = alive[over], after[over]
            hit = self.accepts[last, 0] >= 0
            term[done[hit]] = self.accepts[last[hit], 0]
            far[done[hit]] = self.distance[last[hit]]
            going = ~over & (after > 0)
            alive, state = alive[going], after[going]
        found = np.flatnonzero(term >= 0)
        return found, term[found], far[found]


@dataclass
class Model:
    terms: list[Term]
    weights: np.ndarray  # of the features, the last for the constant


N_FEATURES = 5


def _quoted(text_words: Words, at: int) -> bool:
    """True if a match stands between quotation marks that pair, or after reported speech."""
    doc = text_words.doc[at]
    low, high = at, at
    while low > 0 and at - low < WINDOW and text_words.doc[low - 1] == doc:
        low -= 1
    last = len(text_words.doc) - 1
    while high < last and high - at < WINDOW and text_words.doc[high + 1] == doc:
        high += 1
    codes = text_words.codes
    # With the signs before the first word and after the last one.
    begin = text_words.end[low - 1] if low and text_words.doc[low - 1] == doc else text_words.first[doc]
    stop = text_words.start[high + 1] if high < last else len(codes)
    if doc + 1 < len(text_words.first):
        stop = min(stop, text_words.first[doc + 1] - 1)
    before = _text(codes[begin : text_words.start[at]])
    after = _text(codes[text_words.end[at] : stop])
    closing = _opened(before)
    if closing and any(c in closing for _, c in _marks(after, True)):
        return True
    for i in range(max(low, at - 3), at):
        word = _text(codes[text_words.start[i] : text_words.end[i]])
        since = _text(codes[text_words.end[i] : text_words.start[at]])
        # Who reports somebody's words says so by a colon or a mark.
        if word in _REPORTING and (":" in since or any(c in CLOSING for _, c in _marks(since, False))):
            return True
    return False


def _marks(text: str, at_end: bool) -> list[tuple[int, str]]:
    """The quotation marks of a text; an apostrophe between letters is none.

    One at the border of the text is judged by its other side, as a word of the match
    is there: with ``at_end`` the text follows the match, else it comes before.
    """
    found = []
    for i, c in enumerate(text):
        if c in _QUOTES:
            left = text[i - 1].isalnum() if i else at_end
            right = text[i + 1].isalnum() if i + 1 < len(text) else not at_end
            if not (c in APOSTROPHES and left and right):
                found.append((i, c))
    return found


def _opened(before: str) -> str:
    """The marks that would close the quotation which a text leaves open; empty if none is.

    An apostrophe opens one only before a letter and after none, as in 'so'; after a
    letter it ends a word or closes what an apostrophe has opened.
    """
    closing = ""
    for i, c in _marks(before, False):
        after_letter = i > 0 and before[i - 1].isalnum()
        before_letter = i + 1 == len(before) or before[i + 1].isalnum()
        if closing:
            closing = "" if c in closing else closing
        elif c in CLOSING and (c not in APOSTROPHES or (before_letter and not after_letter)):
            closing = CLOSING[c]
    return closing


_REPORTING = frozenset(REPORTING)
_QUOTES = frozenset(CLOSING) | frozenset("".join(CLOSING.values()))


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "replace")


def words_in(text: str) -> list[str]:
    words = words_of([text], word_marks())
    low = _text(words.codes)
    return [low[a:b] for a, b in zip(words.start.tolist(), words.end.tolist(), strict=True)]


def features(texts: list[str], automaton: Automaton) -> np.ndarray:
    """Per text: matches by weight (exact, misspelled, quoted), distinct terms, 1.

    Then the plain counts of the three kinds of matches.
    """
    out = np.zeros((len(texts), N_FEATURES + 3))
    out[:, N_FEATURES - 1] = 1.0
    if not automaton.terms:
        return out
    words = words_of(texts, word_marks())
    found, term, far = automaton.run(words)
    seen: set[tuple[int, int]] = set()
    for at, t, d in zip(found.tolist(), term.tolist(), far.tolist(), strict=True):
        doc = int(words.doc[at])
        weight = automaton.terms[t].weight
        kind = 2 if _quoted(words, at) else int(d > 0)
        out[doc, kind] += weight
        out[doc, N_FEATURES + kind] += 1
        if kind == 0 and (doc, t) not in seen:
            seen.add((doc, t))
            out[doc, 3] += 1
    out[:, :4] = np.log1p(out[:, :4])
    return out


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method; no match speaks for a clean text.

    The ridge keeps the weights finite where a feature separates the labels. A
    match whose weight would be negative is left out, and the rest fitted again.
    """
    used = list(range(x.shape[1]))
    while True:
        z, w = x[:, used], np.zeros(len(used))
        strength = np.where(np.array(used) == x.shape[1] - 1, 1e-6, ridge)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (p - y) + strength * w
            curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(strength)
            step = np.linalg.solve(curve, slope)
            # Far from the goal a full step may go too far.
            w = w - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
            if np.abs(step).max() < 1e-8:
                break
        wrong = [i for i, weight in zip(used[:-1], w[:-1], strict=True) if weight < 0]
        if not wrong:
            full = np.zeros(x.shape[1])
            full[used] = w
            return full
        used = [i for i in used if i not in wrong]


def _log_ratio(toxic, clean, totals: np.ndarray):
    """How much more often toxic documents have something; half a document is added."""
    return np.log((toxic + 0.5) / (totals[1] + 1)) - np.log((clean + 0.5) / (totals[0] + 1))


#: Least log ratio of a term, and of its misspellings for edits to be allowed in it.
STRONG = 3.0
#: Least evidence for a term: minus the logarithm of the chance that so many of the
#: documents that have it are toxic by accident. Some ten million terms are tried.
EVIDENCE = 16.0


def _telling(counts: DataFrame, totals: np.ndarray) -> DataFrame:
    """The terms of (term, clean, toxic) that are strong and have the evidence, with both."""
    toxic, n = F.col("toxic"), F.col("toxic") + F.col("clean")
    share, usual = toxic / n, float(totals[1] / totals.sum())
    # Chernoff's bound.
    rest = F.greatest(1 - share, F.lit(1e-12))
    evidence = n * (share * F.log(share / usual) + rest * F.log(rest / (1 - usual)))
    return (
        counts.where("toxic > 0")
        .withColumn("weight", _likelier(totals))
        .withColumn("evidence", evidence)
        .where((F.col("weight") >= STRONG) & (F.col("evidence") >= EVIDENCE))
    )


def _likelier(totals: np.ndarray) -> Column:
    """The log ratio of columns ``toxic`` and ``clean``."""
    toxic = (F.col("toxic") + 0.5) / float(totals[1] + 1)
    return F.log(toxic) - F.log((F.col("clean") + 0.5) / float(totals[0] + 1))


def _lexicon(found: pd.DataFrame) -> list[Term]:
    """The words and beginnings that tell toxic documents, strongest first."""
    terms = []
    some = found.sort_values(["evidence", "term"], ascending=[False, True])
    for term, own in some[["term", "weight"]].itertuples(index=False):
        text = term.removesuffix("*")
        terms.append(Term(text, float(own), text != term, 0 if text != term else edits_for(term)))
    return terms


def _confirmed(terms: list[Term], misspelled: np.ndarray, totals: np.ndarray) -> list[Term]:
    """Terms without edits where their misspellings are as common in clean documents.

    ``misspelled`` has the clean and the toxic documents of each term's misspellings.
    """
    kept = []
    for term, (clean, toxic) in zip(terms, misspelled, strict=True):
        fair = clean == 0 or _log_ratio(toxic, clean, totals) >= STRONG
        kept.append(Term(term.text, term.weight, term.beginning, term.edits if fair else 0))
    return kept


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample_per_label: int = 8_000,
    shortest: int = 4,
    beginnings: tuple[int, ...] = (5, 6, 7),
) -> Model:
    """Lexicon and weights from documents (doc_id, text) and labels (doc_id, toxic).

    Fitted on about ``sample_per_label`` documents of each label, picked by a hash;
    only their ids are broadcast, and only their texts and terms are stored. To the
    driver come all terms with the evidence, whose number the sample bounds, and one
    row of features for each document of the sample. A doc_id that is labelled repeatedly
    is toxic if any label says so. Rows without id, text or label are skipped;
    without rows of both labels every text gets the share of toxic rows, or 0.
    """
    ship_package(docs.sparkSession)
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    picked = F.broadcast(sampled(one, "toxic", sample_per_label))
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    known = stored(texts.join(picked, "doc_id").select("toxic", "text"), "labelled")

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            total: dict[str, list[int]] = {}
            for toxic, text in zip(frame["toxic"], frame["text"], strict=True):
                own = {w for w in words_in(text) if len(w) >= shortest}
                own |= {w[:n] + "*" for n in beginnings for w in own if len(w) > n and w[-1] != "*"}
                for term in own:
                    total.setdefault(term, [0, 0])[toxic] += 1
            yield pd.DataFrame(
                [(t, clean, toxic) for t, (clean, toxic) in total.items()],
                columns=["term", "clean", "toxic"],
            )

    totals = np.zeros(2)
    for row in known.groupBy("toxic").count().collect():
        totals[row["toxic"]] = row["count"]
    if not totals.all():
        share = totals[1] / totals.sum() if totals.sum() else 0.0
        constant = np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -20, 20)
        return Model([], np.array([0.0] * (N_FEATURES - 1) + [constant]))
    strong = stored(
        known.mapInPandas(counted, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") > 1) & (_likelier(totals) >= STRONG)),
        "strong",
    )
    packed = _filter(strong.select(F.shiftleft(F.crc32(F.col("term").cast("binary")), 32).alias("hash")))

    def in_context(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = np.unpackbits(packed).view(bool)
        for frame in frames:
            found = set()
            for toxic, text in zip(frame["toxic"], frame["text"], strict=True):
                words = ["", *words_in(text), ""]
                terms = {
                    word: [
                        term
                        for term in {word, *[word[:n] + "*" for n in beginnings]}
                        if wanted[zlib.crc32(term.encode()) >> (32 - FILTER_BITS)]
                    ]
                    for word in set(words)
                }
                for i in range(1, len(words) - 1):
                    for term in terms[words[i]]:
                        found.add((term, toxic, f"{words[i - 1]} {words[i + 1]}"))
            yield pd.DataFrame(sorted(found), columns=["term", "toxic", "context"])

    # Copies of a toxic document say the same thing once, so contexts are counted;
    # a passage in many clean documents clears its words as often as it occurs.
    # The filter lets some terms by that are not strong; the join does not.
    contexts = (
        known.mapInPandas(in_context, "term string, toxic int, context string")
        .distinct()
        .groupBy("term")
        .agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic"))
        .join(strong.select("term", F.col("clean").alias("documents")), "term")
        .withColumn("clean", F.greatest("clean", "documents"))
    )
    terms = _lexicon(_telling(contexts, totals).select("term", "weight", "evidence").toPandas())

    def misspelled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(terms)
        for frame in frames:
            words = words_of(frame["text"].tolist(), word_marks())
            found, term, far = automaton.run(words)
            label = frame["toxic"].to_numpy()[words.doc[found]]
            hits = pd.DataFrame({"term": term, "doc": words.doc[found], "toxic": label})[far > 0]
            once = hits.drop_duplicates()
            yield once.groupby(["term", "toxic"]).size().reset_index(name="n")

    if terms:
        found = known.mapInPandas(misspelled, "term int, toxic int, n long")
        confused = np.zeros((len(terms), 2))
        for row in found.groupBy("term", "toxic").agg(F.sum("n").alias("n")).collect():
            confused[row["term"], row["toxic"]] = row["n"]
        terms = _confirmed(terms, confused, totals)

    def described(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(terms)
        for frame in frames:
            x = features(frame["text"].tolist(), automaton)[:, :N_FEATURES]
            yield pd.DataFrame({"toxic": frame["toxic"], "x": list(x)})

    rows = known.mapInPandas(described, "toxic int, x array<double>").toPandas()
    x = np.array(rows["x"].tolist())
    return Model(terms, _fit(x, rows["toxic"].to_numpy(float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``score`` and their matches: exact, misspelled, quoted.

    A null or empty text, and one without any match, gets the model's constant,
    the share of toxic documents among such. Input columns named like the new ones
    are replaced.
    """
    terms, weights = model.terms, model.weights
    made: list[Automaton] = []

    def compute(texts: list[str]) -> list[list]:
        if not made:
            made.append(Automaton(terms))
        x = features(texts, made[0])
        p = 1 / (1 + np.exp(-np.clip(x[:, :N_FEATURES] @ weights, -30, 30)))
        counts = x[:, N_FEATURES:].astype(np.int64)
        return [p.tolist(), *[counts[:, i].tolist() for i in range(3)]]

    return with_text_columns(docs, compute, ADDED, chars=1_500_000)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's score, learned from labels outside the held-out third."""
    known = labels.where(~held_out()).select("doc_id", "toxic")
    model = train(docs, known)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_exact",
        "n_misspelled",
        "n_quoted",
    )
