"""Operator 7: toxicity by a learned lexicon, Levenshtein automata and context windows.

Words and word beginnings that stand in toxic training documents far more often
than in others make a lexicon.  A trie of the lexicon is intersected with
Levenshtein automata: one automaton, made deterministic as words ask for it, finds
every word within the allowed distance of a term.  Hits are counted apart by
whether they are exact and whether their context window looks like a quotation,
and a small logistic model weighs the counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import Workspace, slices, texts_of

STRIP = ".,;:!?\"'()[]{}<>«»“”„‘’…*#$%&|"
OPENING, CLOSING = "\"“„«‘'([", "\"”“»’')]"
#: Words that report what somebody else said.
REPORTING = frozenset(
    "said says wrote writes called calls quoted quotes quoting quote reported cited citing "
    "sagte schrieb nannte zitierte dit écrit appelé cité dijo escribió llamó citó".split()
)
WINDOW = 6


@dataclass(frozen=True)
class Term:
    """A word, or the beginning of words; ``weight`` is its log odds in training."""

    text: str
    beginning: bool
    weight: float

    @property
    def allowed(self) -> int:
        n = len(self.text)
        return (1 if n >= 4 else 0) if self.beginning else 0 if n < 4 else 1 if n <= 7 else 2

    @property
    def short(self) -> bool:
        """So short that ordinary words lie within one edit, too: such hits count under stricter terms."""
        return len(self.text) < (6 if self.beginning else 5)


class TrieAutomaton:
    """All words within the allowed distance of a term, as a lazily determinised automaton.

    The trie's nodes with the edits spent so far are the states of the
    nondeterministic automaton; sets of them are memoised as states of the
    deterministic one.  Edits are insertions, deletions and substitutions.
    """

    DEAD = 0

    def __init__(self, terms: tuple[Term, ...]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.most: list[int] = [0]
        for k, term in enumerate(terms):
            node = 0
            self.most[0] = max(self.most[0], term.allowed)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], term.allowed)
            self.ends[node] = k
        self.states: list[tuple] = [((), ())]
        self.numbers: dict[tuple, int] = {((), ()): 0}
        self.moves: list[dict[str, int]] = [{}]
        self.start = self._state({0: 0}, {})

    def _state(self, nodes: dict[int, int], done: dict[int, int]) -> int:
        todo = sorted(nodes.items(), key=lambda x: x[1])
        for node, spent in todo:  # a missing character: on to the children, one edit more
            if nodes.get(node, 99) < spent:
                continue
            for child in self.children[node].values():
                if spent + 1 <= self.most[child] and nodes.get(child, 99) > spent + 1:
                    nodes[child] = spent + 1
                    todo.append((child, spent + 1))
        done = dict(done)
        for node, spent in nodes.items():
            k = self.ends[node]
            if k >= 0 and self.terms[k].beginning and spent <= self.terms[k].allowed:
                done[k] = min(spent, done.get(k, 99))
        key = (tuple(sorted(nodes.items())), tuple(sorted(done.items())))
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return self.numbers[key]

    def _move(self, state: int, char: str) -> int:
        nodes, done = self.states[state]
        following: dict[int, int] = {}

        def reach(node: int, spent: int) -> None:
            if spent <= self.most[node] and following.get(node, 99) > spent:
                following[node] = spent

        for node, spent in nodes:
            reach(node, spent + 1)
            for c, child in self.children[node].items():
                reach(child, spent + (c != char))
        to = self._state(following, dict(done))
        self.moves[state][char] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term, the heaviest of equally near ones; None if there is none."""
        state, moves = self.start, self.moves
        for char in word:
            to = moves[state].get(char)
            state = self._move(state, char) if to is None else to
            if state == self.DEAD:
                return None
        nodes, done = self.states[state]
        found = [(spent, k) for k, spent in done]
        found += [(spent, self.ends[n]) for n, spent in nodes if self.ends[n] >= 0 and spent <= self.terms[self.ends[n]].allowed]
        if not found:
            return None
        spent, k = min(found, key=lambda x: (x[0], -self.terms[x[1]].weight, x[1]))
        return k, spent


@lru_cache(maxsize=4)
def automaton(terms: tuple[Term, ...]) -> TrieAutomaton:
    return TrieAutomaton(terms)


FEATURES = ("exact", "near", "quoted", "heaviest", "total", "density")
#: What the weights shrink to where training has nothing to say.
PRIOR = np.array([1.0, 0.2, 0.1, 0.3, 0.3, 0.5, -4.0])
#: The memory of a task's word table, in words.
REMEMBERED = 400_000


def quotation(words: list[str], at: int) -> bool:
    """Whether the window around a hit looks like a quotation: the hit stands between
    quotation marks, or a reporting word stands in the window and a mark before it."""
    before, behind = words[max(0, at - WINDOW) : at + 1], words[at : at + WINDOW + 1]
    opened = any(w[:1] in OPENING for w in before)
    closed = any(w.rstrip(".,;:!?")[-1:] in CLOSING for w in behind)
    if opened and closed:
        return True
    near = {w.strip(STRIP) for w in words[max(0, at - WINDOW) : at + WINDOW + 1]}
    return not near.isdisjoint(REPORTING) and (opened or closed)


def variant(word: str, term: Term, spared: frozenset[str]) -> bool:
    """Whether a word within one edit of a short term counts: the first letter and the length
    agree, and training texts don't show the word as an ordinary one."""
    return word[0] == term.text[0] and (term.beginning or len(word) == len(term.text)) and word not in spared


def features(
    text: str, matcher: TrieAutomaton, memo: dict[str, tuple[int, int] | None], spared: frozenset[str] = frozenset()
) -> list[float]:
    words = text.lower().split()
    hits: dict[str, tuple[int, int]] = {}
    for word in set(words):
        if word in memo:
            found = memo[word]
        else:
            if len(memo) >= REMEMBERED:
                memo.clear()
            bare = word.strip(STRIP)
            found = matcher.match(bare)
            if found is not None and found[1] and matcher.terms[found[0]].short and not variant(bare, matcher.terms[found[0]], spared):
                found = None
            memo[word] = found
        if found is not None:
            hits[word] = found
    if not hits:
        return [0.0] * len(FEATURES)
    exact = near = quoted = 0
    weights: dict[int, float] = {}
    for at, word in enumerate(words):
        if word in hits:
            k, spent = hits[word]
            if quotation(words, at):
                quoted += 1
                continue
            exact, near = exact + (spent == 0), near + (spent > 0)
            weights[k] = max(weights.get(k, 0.0), matcher.terms[k].weight / (1 + spent * (2 if matcher.terms[k].short else 1)))
    heaviest = max(weights.values(), default=0.0)
    density = (exact + near) / len(words)
    return [math.log1p(exact), math.log1p(near), math.log1p(quoted), heaviest, math.log1p(sum(weights.values())), 10 * density]


@dataclass(frozen=True)
class Model:
    terms: tuple[Term, ...]
    weights: tuple[float, ...]
    spared: frozenset[str] = frozenset()

    def score(self, rows: np.ndarray) -> np.ndarray:
        w = np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(rows @ w[:-1] + w[-1], -50, 50)))


def with_features(docs: DataFrame, terms: tuple[Term, ...], spared: frozenset[str] = frozenset()) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``features`` (array of double)."""
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join([*(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept), "features array<double>"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, memo = automaton(terms), {}
        for batch in slices(batches, "text", 8 << 20):
            rows = [features(t, matcher, memo, spared) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(rows, pa.list_(pa.float64()))], [*kept, "features"])

    return docs.mapInArrow(emit, schema)


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, n_toxic, n_clean): documents of the sample with the word."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(texts_of(batch.column("text")), batch.column("toxic").to_pylist()):
                for word in {w.strip(STRIP) for w in set(text.lower().split())}:
                    if 3 <= len(word) <= 40:
                        counts.setdefault(word, [0, 0])[0 if toxic else 1] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts, pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))],
                ["word", "n_toxic", "n_clean"],
            )

    counted = sample.select("text", "toxic").mapInArrow(emit, "word string, n_toxic long, n_clean long")
    return counted.groupBy("word").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


#: Shingles of so many words; texts that agree in all ROWS least hashes of one of BANDS bands are near copies.
SHINGLE, BANDS, ROWS = 3, 4, 3


def bands_of(text: str) -> list[int]:
    words = text.lower().split()
    hashes = np.array(
        [zlib.crc32(" ".join(words[i : i + SHINGLE]).encode("utf-8", "surrogatepass")) for i in range(max(1, len(words) - SHINGLE + 1))],
        dtype=np.uint64,
    )
    # Multiplied by fixed odd numbers; the upper 32 bits are the hashes.
    mixed = [int((hashes * np.uint64((0x9E3779B97F4A7C15 + 0x5851F42D4C957F2E * k) % (1 << 64)) >> np.uint64(32)).min()) for k in range(BANDS * ROWS)]
    return [hash(tuple(mixed[b * ROWS : (b + 1) * ROWS])) for b in range(BANDS)]


def without_near_copies(sample: DataFrame) -> DataFrame:
    """One text of each group of near copies (text, toxic), toxic if one of them is."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            rows = [bands_of(t) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.list_(pa.int64()))], [*batch.schema.names, "bands"])

    left = sample.select("text", "toxic").mapInArrow(emit, "text string, toxic int, bands array<long>")
    for band in range(BANDS):
        left = (
            left.groupBy(F.col("bands")[band].alias("band"))
            .agg(F.max("toxic").alias("toxic"), F.min(F.struct("text", "bands")).alias("one"))
            .select("one.text", "toxic", "one.bands")
        )
    return left.select("text", "toxic")


def evidence(t: Column, c: Column, share: float) -> Column:
    """How much likelier (log) t toxic and c clean texts are at their own share than at the general one:
    e to the minus this bounds the chance of so many toxic ones."""
    part = lambda n, p: F.when(n > 0, n * F.log(n / ((t + c) * F.lit(p)))).otherwise(0.0)
    return part(t, share) + part(c, 1 - share)


def learn_terms(words: DataFrame, toxic: int, clean: int, min_docs: int, min_odds: float) -> tuple[Term, ...]:
    """The lexicon: toxic words, and beginnings that many toxic words share.

    A trie node counts if its words have ``min_docs`` toxic documents, log odds of
    ``min_odds``, and so much evidence that of all nodes with as many toxic documents
    less than one would come that far by chance.  Below each topmost such node the longest beginning that holds 95 %
    of its documents is the term; it is a whole word where that word has 80 % of them.
    """
    odds = lambda t, c: F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    nodes = words.select(
        F.explode(F.transform(F.sequence(F.lit(3), F.length("word")), lambda n: F.substring("word", F.lit(1), n))).alias("node"),
        "n_toxic", "n_clean",
    )
    summed = nodes.groupBy("node").agg(F.sum("n_toxic").alias("t"), F.sum("n_clean").alias("c"))
    tried = summed.filter(F.col("t") >= min_docs)
    least = math.log(max(1, tried.count()))
    strong = tried.withColumn("odds", odds(F.col("t"), F.col("c"))).filter(
        (F.col("odds") >= min_odds) & (evidence(F.col("t"), F.col("c"), toxic / (toxic + clean)) >= least)
    )
    whole = words.withColumnsRenamed({"word": "node", "n_toxic": "w"}).select("node", "w")
    found = {r["node"]: (r["t"], r["w"] or 0, r["odds"]) for r in strong.join(whole, "node", "left").collect()}
    by_parent: dict[str, list[str]] = {}
    for node in found:
        by_parent.setdefault(node[:-1], []).append(node)
    terms = []
    for top in sorted(n for n in found if n[:-1] not in found):
        node = top
        while True:
            below = [n for n in by_parent.get(node, []) if found[n][0] >= 0.95 * found[top][0]]
            if not below:
                break
            node = below[0]
        docs, own, weight = found[node]
        terms.append(Term(node, own < 0.8 * docs, float(weight)))
    return tuple(terms)


def ordinary_words(words: DataFrame, terms: tuple[Term, ...]) -> frozenset[str]:
    """The words of clean training texts that lie within one edit of a short term."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = automaton(terms)
        for batch in batches:
            found = [(w, matcher.match(w)) for w in batch.column("word").to_pylist()]
            near = [w for w, f in found if f is not None and f[1] and terms[f[0]].short and variant(w, terms[f[0]], frozenset())]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], ["word"])

    return frozenset(r["word"] for r in words.filter("n_clean > 0").select("word").mapInArrow(emit, "word string").collect())


def fit_weights(rows: np.ndarray, labels: np.ndarray, strength: float = 0.05) -> tuple[float, ...]:
    """Logistic weights by Newton steps, shrunk towards PRIOR."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (p - labels) + strength * (w - PRIOR)
        curvature = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w -= step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-6:
            break
    return tuple(map(float, w))


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def train(
    docs: DataFrame, labels: DataFrame, work: Workspace, max_train: int = 30_000, min_docs: int = 4, min_odds: float = 3.0
) -> Model:
    """Learn lexicon and weights from labelled rows whose crc32(doc_id) mod 5 is not 0.

    At most about ``max_train`` labelled rows are used, chosen by a hash of their ids;
    this bounds what comes to the driver.  Several labels of an id count as toxic if
    one is.  Equal texts and near copies are one document for the counts, so that words
    of a few copied documents are no terms.  Without toxic or without clean rows the lexicon is empty and the model
    says clean.
    """
    usable = labels.filter(F.col("toxic").isNotNull() & (remainder(F.col("doc_id")) != 0))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    count = usable.count()
    if count > max_train:
        usable = usable.filter(F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < int((1 << 20) * max_train / count))
    sample = work.write(
        docs.select(F.col("doc_id").cast("long"), "text").join(usable, F.col("doc_id") == F.col("label_id"))
        .groupBy(F.col("text")).agg(F.max("toxic").alias("toxic")),
        "sample",
    )
    apart = work.write(without_near_copies(sample), "apart")
    sizes = {r["toxic"]: r["n"] for r in apart.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model((), tuple(map(float, PRIOR)))
    words = work.write(word_counts(apart), "words")
    terms = learn_terms(words, toxic, clean, min_docs, min_odds)
    spared = ordinary_words(words, terms)
    rows = with_features(sample, terms, spared).collect()
    x = np.array([r["features"] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    return Model(terms, fit_weights(x, np.array([float(r["toxic"]) for r in rows])), spared)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Every text is read whole.  Null and empty texts, and texts without hits, get the
    model's score of no hits.  Null ids are not held out.  Repeated rows come each,
    an empty table gives an empty one, other columns are not read.  No shuffle.
    """
    rows = with_features(docs.select(F.col("doc_id").cast("long"), "text"), model.terms, model.spared)
    logit = F.lit(model.weights[-1])
    for i, w in enumerate(model.weights[:-1]):
        logit = logit + F.lit(w) * F.col("features")[i]
    scored = rows.withColumn("score", 1 / (1 + F.exp(-logit)))
    return scored.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, all columns: for the pipeline."""
    terms, weights = model.terms, model

    @F.pandas_udf("boolean")
    def clean(text):
        import pandas as pd

        matcher, memo = automaton(terms), {}
        rows = np.array([features(t or "", matcher, memo, weights.spared) for t in text], dtype=float).reshape(-1, len(FEATURES))
        return pd.Series(weights.score(rows) < 0.5)

    return docs.filter(clean(F.col("text")))
