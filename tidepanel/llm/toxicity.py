"""Toxicity: Levenshtein automata met with a trie of learned terms, and context windows that tell quotation from abuse.

The terms are words, and stems of words, that labelled toxic documents hold and clean ones do not. They stand in a trie; a document's word is
looked up by walking the trie with the word's Levenshtein automaton, so every term within one edit of a word of
FUZZY_LENGTH letters or more is found without comparing the word to each term. Each hit is scored in a window of words:
inside quotation marks, near words of reporting, or close to other hits. Misspellings of terms that few toxic documents
hold are summed apart, for they are chance likenesses more often. A small logistic model combines the sums.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, held_out, labels, text_of
from .simhash import simhash
from .training import sample

TERM = re.compile(r"[^\W_]+")
#: Labelled rows of each class that terms are learned from.
FIT_TOXIC, FIT_CLEAN = 2500, 5000
#: A term is in this many toxic documents at least, is this much likelier there, and the list holds so many at most.
SUPPORT, ODDS, TERMS = 4, 30.0, 5000
#: Stems (beginnings of words) have these lengths, and are learned where so many different words share one.
STEMS, STEM_WORDS = (4, 5, 6), 3
#: Documents of the sample whose SimHashes differ in so many bits at most are near copies.
COPY_BITS = 8
#: Words shorter than this are not taken for misspelled terms; misspellings of terms that fewer toxic documents hold have features of their own.
FUZZY_LENGTH, EDITS, FUZZY_SUPPORT = 5, 1, 8
WINDOW, THRESHOLD = 8, 0.5
MEMORY_WORDS = 600_000
QUOTES = "\"“”„«»‹›「」"
REPORTING = frozenset("said says wrote called calls quote quoted word term dijo dice escribió llamó sagte schrieb nannte dit écrit appelé".split())


class Automaton:
    """The Levenshtein automaton of a word: states are rows of edit distances, cut at EDITS + 1."""

    def __init__(self, word: str, edits: int):
        self.word, self.edits = word, edits

    def start(self) -> tuple[int, ...]:
        return tuple(min(i, self.edits + 1) for i in range(len(self.word) + 1))

    def step(self, state: tuple[int, ...], letter: str) -> tuple[int, ...]:
        over, row = self.edits + 1, [min(state[0] + 1, self.edits + 1)]
        for i, own in enumerate(self.word):
            row.append(min(state[i] + (own != letter), state[i + 1] + 1, row[i] + 1, over))
        return tuple(row)

    def alive(self, state: tuple[int, ...]) -> bool:
        return min(state) <= self.edits

    def distance(self, state: tuple[int, ...]) -> int:
        return state[-1]


class Trie:
    """Terms by letters, with weights at their ends: a trie for each half of terms, as any word within one edit shares a half, and length."""

    def __init__(self, weights: dict[str, float], stems: dict[str, float], common: set[str]):
        self.weights, self.stems, self.common = weights, stems, common
        self.heads, self.tails = {}, {}
        for term in weights:
            if len(term) >= FUZZY_LENGTH - EDITS:
                half = len(term) // 2
                for n in range(len(term) - EDITS, len(term) + EDITS + 1):
                    for halves, key in ((self.heads, term[:half]), (self.tails, term[half:])):
                        node = halves.setdefault((key, n), {})
                        for letter in term:
                            node = node.setdefault(letter, {})
                        node[""] = term
        self.head_sizes, self.tail_sizes = sorted({len(h) for h, _ in self.heads}), sorted({len(t) for t, _ in self.tails})

    def roots(self, word: str) -> list[dict]:
        """Tries that hold every term within one edit: one edit leaves one half of the term where it was."""
        size = len(word)
        found = [self.heads.get((word[:n], size)) for n in self.head_sizes] + [self.tails.get((word[-n:], size)) for n in self.tail_sizes]
        return [root for root in found if root]

    def find(self, word: str) -> tuple[float, int]:
        """The weight of the word's term and 0; 1 if it is misspelled, 2 if the misspelled term is not a common one; (0, 0) without one."""
        if (weight := self.weights.get(word)) is not None:
            return weight, 0
        if weight := max(self.stems.get(word[:n], 0.0) for n in STEMS):
            return weight, 0
        if len(word) < FUZZY_LENGTH or not (roots := self.roots(word)):
            return 0.0, 0
        automaton, common, rare = Automaton(word, EDITS), 0.0, 0.0
        stack = [(root, automaton.start()) for root in roots]
        while stack:
            node, state = stack.pop()
            for letter, child in node.items():
                if letter == "":
                    if automaton.distance(state) <= EDITS:
                        if child in self.common:
                            common = max(common, self.weights[child])
                        else:
                            rare = max(rare, self.weights[child])
                elif automaton.alive(after := automaton.step(state, letter)):
                    stack.append((child, after))
        return (common, 1) if common else (rare, 2 * (rare > 0))


FEATURES = 8


@dataclass
class Model:
    weights: dict[str, float]
    stems: dict[str, float]
    common: set[str]
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))

    def __post_init__(self):
        self.trie, self.known = Trie(self.weights, self.stems, self.common), {}

    def features(self, text: str) -> np.ndarray:
        """Sums over the hits: exact and misspelled ones as abuse, the same as quotation, the densest window, hits a word.

        The last two are the misspellings of rare terms, as abuse and as quotation; the others leave those out.
        """
        low = text.lower()
        words, known = TERM.findall(low), self.known
        if len(known) > MEMORY_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.trie.find(w)
        hits = [(i, *known[w]) for i, w in enumerate(words) if known[w][0] > 0]
        out = np.zeros(FEATURES)
        if not hits:
            return out
        spans = None
        at = np.array([i for i, _, kind in hits if kind < 2])
        densest = (np.searchsorted(at, at + WINDOW, "right") - np.arange(len(at))).max(initial=0)
        if any(q in low for q in QUOTES):
            spans = [m.span() for m in TERM.finditer(low)]
        for i, weight, kind in hits:
            quoted = bool(REPORTING.intersection(words[max(0, i - WINDOW) : i]))
            if spans:
                left = low[spans[max(0, i - WINDOW)][0] : spans[i][0]].rpartition("\n")[2]
                right = low[spans[i][1] : spans[min(len(spans) - 1, i + WINDOW)][1]].partition("\n")[0]
                quoted = quoted or (any(q in left for q in QUOTES) and any(q in right for q in QUOTES))
            out[6 + quoted if kind == 2 else 2 * quoted + kind] += weight
        out[:4], out[6:] = np.log1p(out[:4]), np.log1p(out[6:])
        out[4], out[5] = np.log1p(densest), 100 * len(at) / len(words)
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ self.coefficients[1:] + self.coefficients[0], -30, 30)))


def learn_terms(texts: list[str], y: np.ndarray) -> tuple[dict[str, float], dict[str, float], set[str]]:
    """Terms and stems with their weights, logarithms of how much likelier they are in toxic documents; the common terms.

    Documents of a class whose whole texts agree but for case and spaces are copies; terms are learned from one. Of a
    near copy by SimHash, also a fingerprint of the whole text, only words that the first such document lacks count.
    """
    counts, words_of, n, seen = [Counter(), Counter()], {}, [1, 1], set()
    prints, first = np.zeros((2, len(texts)), np.uint64), [[], []]
    for text, mark in zip(texts, y):
        whole = (int(mark), hashlib.sha256(" ".join(text.lower().split()).encode()).digest())
        if whole in seen:
            continue
        seen.add(whole)
        words, own, met = set(TERM.findall(text.lower())), np.uint64(simhash(text)), first[int(mark)]
        near = np.flatnonzero(np.bitwise_count(prints[int(mark), : len(met)] ^ own) <= COPY_BITS)
        if len(near):
            words = words - met[near[0]]
        else:
            prints[int(mark), len(met)] = own
            met.append(words)
        n[int(mark)] += 1
        stems = {(w[:k],) for w in words for k in STEMS if len(w) >= k}
        counts[int(mark)].update(words | stems)
        if mark:
            for w in words:
                for k in STEMS:
                    if len(w) >= k:
                        words_of.setdefault(w[:k], set()).add(w)
    found: list[list[tuple[float, str, float]]] = [[], []]
    for term, c in counts[1].items():
        stem = isinstance(term, tuple)
        odds = ((c + 0.5) / n[1]) / ((counts[0][term] + 0.5) / n[0])
        text = term[0] if stem else term
        if c >= SUPPORT and odds >= ODDS and len(text) > 2 and (not stem or len(words_of[text]) >= STEM_WORDS):
            found[stem].append((c * np.log(odds), text, float(np.log(odds))))
    terms, stems = ({text: weight for _, text, weight in sorted(f, reverse=True)[:TERMS]} for f in found)
    return terms, stems, {t for t in terms if counts[1][t] >= FUZZY_SUPPORT}


def fit(texts: list[str], y: np.ndarray) -> Model:
    """Terms from two thirds of the sample, the logistic model on the rest, whose rare terms are strangers as elsewhere."""
    if len(texts) == 0 or y.max() == 0:
        model = Model({}, {}, set())
        model.coefficients[0] = -5.0
        return model
    third = np.arange(len(y)) % 3 == 0
    model = Model(*learn_terms([t for t, z in zip(texts, third) if not z], y[~third]))
    x = np.array([model.features(t) for t, z in zip(texts, third) if z]).reshape(-1, FEATURES)
    x, z, b = np.c_[np.ones(len(x)), x], y[third], np.zeros(FEATURES + 1)
    b[0] = -2.0
    for _ in range(50):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        ridge = np.diag([1e-6, *[0.1] * FEATURES])
        change = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge, x.T @ (z - p) - ridge @ b)
        b += np.clip(change, -2, 2)
    final = Model(*learn_terms(texts, y))
    final.coefficients = b
    return final


def train(docs: DataFrame, marks: DataFrame) -> Model:
    rows = sample(docs, marks, "toxic", FIT_CLEAN, FIT_TOXIC)
    return fit(rows["text"].tolist(), rows["y"].to_numpy())


def toxicity_scores(docs: DataFrame, marks: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs (doc_id, text; more columns are ignored).

    marks: doc_id, toxic. Null texts are empty; an empty text has no hits and the score of none. Without toxic labels
    every text scores next to 0. Repeated rows are scored each.
    """
    model, kind = train(docs, marks), docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score([t.as_py() for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", text_of().alias("text")).mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op10(spark, sf_dir: str) -> DataFrame:
    return toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir))
