"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

A text is lower-cased and cut into units at ASCII white space, digits and marks, long units into windows of WINDOW bytes.
A gated recurrent layer reads each unit's bytes from the left, another from the right; from both states every position gets
a probability for each language, and a document's probabilities are the mean over the positions of its units that hold a
letter. Since states begin anew with each unit, a unit's sum of probabilities is computed once and remembered within a
bound. Trained by backpropagation through time on the units of a bounded number of documents, read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, held_out, text_of

HIDDEN, WINDOW = 16, 32
#: Documents of each language that the network is fitted to, steps, and units of a step.
FIT_DOCUMENTS, FIT_STEPS, BATCH, RATE = 400, 1500, 192, 0.01
SPARE = 4
#: Units whose sums a task remembers, units that run together, and characters that are cut at once.
MEMORY_UNITS, TOGETHER, STRETCH = 500_000, 2048, 1 << 20
#: The answer for a text without a letter, or where nothing was learnt.
UNKNOWN = "und"
SPACE = re.compile(r"[ \t-\r]")
#: ASCII letters and the bytes of other characters stay; all else ends a unit.
ENDS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass
class Layer:
    """One direction: what each byte adds to the three gates, their bias included, and the recurrent weights."""

    table: np.ndarray  # 256 x 3 HIDDEN: update, reset, candidate
    turn: np.ndarray  # HIDDEN x 3 HIDDEN


@dataclass
class Network:
    names: list[str]
    ahead: Layer
    back: Layer
    out: np.ndarray  # 2 HIDDEN x languages
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.ahead.table, self.ahead.turn, self.back.table, self.back.turn, self.out, self.bias]


def fresh(names: list[str], hidden: int = HIDDEN, seed: int = 11, kind: type = np.float32) -> Network:
    rng = np.random.default_rng(seed)
    layer = lambda: Layer(rng.normal(0, 0.3, (256, 3 * hidden)).astype(kind), rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(kind))
    return Network(names, layer(), layer(), rng.normal(0, 0.3, (2 * hidden, len(names))).astype(kind), np.zeros(len(names), kind))


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place of x."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def states(layer: Layer, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """x: units x length, bytes -> length x units x HIDDEN, the state after each byte; with `keep`, also what the way back needs."""
    hidden = len(layer.turn)
    h, out, kept = np.zeros((len(x), hidden), layer.table.dtype), np.empty((x.shape[1], len(x), hidden), layer.table.dtype), []
    for t in range(x.shape[1]):
        a, b = layer.table[x[:, t]], h @ layer.turn
        gates = sigmoid(a[:, : 2 * hidden] + b[:, : 2 * hidden])
        z, r, u = gates[:, :hidden], gates[:, hidden:], b[:, 2 * hidden :]
        c = np.tanh(a[:, 2 * hidden :] + r * u)
        if keep:
            kept.append((h, z, r, u, c))
        h = c + z * (h - c)
        out[t] = h
    return out, kept


def layer_gradient(layer: Layer, x: np.ndarray, kept: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backpropagation through time: gradients of the table and of the recurrent weights, from those of the states."""
    hidden = len(layer.turn)
    g_table, g_turn, d = np.zeros_like(layer.table), np.zeros_like(layer.turn), np.zeros_like(d_out[0])
    for t in range(len(kept) - 1, -1, -1):
        h, z, r, u, c = kept[t]
        d = d + d_out[t]
        d_c = d * (1 - z) * (1 - c * c)
        d_b = np.concatenate([d * (h - c) * z * (1 - z), d_c * u * r * (1 - r), d_c * r], axis=1)
        d_a = d_b.copy()
        d_a[:, 2 * hidden :] = d_c
        np.add.at(g_table, x[:, t], d_a)
        g_turn += h.T @ d_b
        d = d * z + d_b @ layer.turn.T
    return g_table, g_turn


def position_probabilities(net: Network, x: np.ndarray) -> np.ndarray:
    """x: units of one length -> length x units x languages."""
    ahead, _ = states(net.ahead, x)
    back, _ = states(net.back, x[:, ::-1])
    return softmax(np.concatenate([ahead, back[::-1]], axis=2) @ net.out + net.bias)


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def gradient(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """The mean loss over all positions of units of one length, whose labels are y, and its gradient for each part."""
    hidden = len(net.ahead.turn)
    ahead, kept_ahead = states(net.ahead, x, True)
    back, kept_back = states(net.back, x[:, ::-1], True)
    both = np.concatenate([ahead, back[::-1]], axis=2)
    p = softmax(both @ net.out + net.bias)
    truth = np.eye(len(net.names), dtype=p.dtype)[y]
    loss = -float(np.log(np.maximum((p * truth).sum(axis=2), 1e-30)).mean())
    d = (p - truth) / p[:, :, 0].size
    d_both = d @ net.out.T
    g_out = np.tensordot(both, d, axes=([0, 1], [0, 1]))
    ga = layer_gradient(net.ahead, x, kept_ahead, d_both[:, :, :hidden])
    gb = layer_gradient(net.back, x[:, ::-1], kept_back, d_both[::-1, :, hidden:])
    return loss, [*ga, *gb, g_out, d.sum(axis=(0, 1))]


def stretches(text: str) -> Iterator[str]:
    """A long text in parts that end at white space; a part without any is as long as it is."""
    at = 0
    while at < len(text):
        end = SPACE.search(text, at + STRETCH)
        end = end.start() if end else len(text)
        yield text[at:end]
        at = end


def units(text: str) -> list[bytes]:
    return text.lower().encode().translate(ENDS).split()


def lettered(unit: bytes) -> bool:
    return unit.isalpha() or any(c.isalpha() for c in unit.decode())


def windows(unit: bytes) -> list[bytes]:
    return [unit[i : i + WINDOW] for i in range(0, len(unit), WINDOW)]


def unit_sums(net: Network, found: list[bytes]) -> np.ndarray:
    """For each unit, probabilities summed over its positions, and the number of positions; zeros for units without a letter."""
    out = np.zeros((len(found), len(net.names) + 1))
    by_length: dict[int, tuple[list[int], list[bytes]]] = {}
    for i, unit in enumerate(found):
        if lettered(unit):
            for w in windows(unit):
                rows, parts = by_length.setdefault(len(w), ([], []))
                rows.append(i)
                parts.append(w)
    for length, (rows, parts) in by_length.items():
        for at in range(0, len(parts), TOGETHER):
            some = parts[at : at + TOGETHER]
            p = position_probabilities(net, np.frombuffer(b"".join(some), np.uint8).reshape(-1, length)).sum(axis=0)
            np.add.at(out, rows[at : at + TOGETHER], np.concatenate([p, np.full((len(some), 1), length, p.dtype)], axis=1))
    return out


class Reader:
    """Pooled probabilities of documents; remembers the sums of units within a bound."""

    last: tuple[bytes, Reader] | None = None

    def __init__(self, net: Network):
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.place, self.sums = {}, np.empty((0, len(self.net.names) + 1))

    @classmethod
    def of(cls, net: Network) -> Reader:
        """One reader for all tasks of a Python worker that have the same network."""
        key = b"".join(p.tobytes() for p in net.parts())
        if cls.last is None or cls.last[0] != key:
            cls.last = (key, cls(net))
        return cls.last[1]

    def _sums(self, cut: list[list[bytes]]) -> np.ndarray:
        """The sums of each text's units, added up."""
        new = {u for us in cut for u in us if u not in self.place}
        if len(self.place) + len(new) > MEMORY_UNITS:
            new = set(chain.from_iterable(cut))
            self._forget()
        if new:
            known = len(self.place)
            self.place.update((u, known + i) for i, u in enumerate(new))
            self.sums = np.concatenate([self.sums, unit_sums(self.net, list(new))])
        sizes = [len(us) for us in cut]
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(cut)), np.int64, sum(sizes))
        out = np.zeros((len(cut), len(self.net.names) + 1))
        full = np.flatnonzero(sizes)
        if len(full):
            starts = (np.cumsum(sizes) - sizes)[full]
            out[full] = np.add.reduceat(self.sums[at], starts, axis=0)
        return out

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities of each text; a row of zeros for one without letters."""
        total = np.zeros((len(texts), len(self.net.names) + 1))
        owners, cut, held = [], [], 0
        for i, text in enumerate(texts):
            for part in stretches(text):
                owners.append(i)
                cut.append(units(part))
                held += len(part)
                if held >= STRETCH:  # the units of many texts go through the network together
                    np.add.at(total, owners, self._sums(cut))
                    owners, cut, held = [], [], 0
        if cut:
            np.add.at(total, owners, self._sums(cut))
        return total[:, :-1] / np.maximum(total[:, -1:], 1)


def fit(texts: list[str], langs: list[str], steps: int = FIT_STEPS, hidden: int = HIDDEN, seed: int = 11) -> Network:
    """Adam on the loss of every position. Each step takes units of one length, as many of each language as chance has it.

    Languages weigh the same, and within one a unit weighs what it occurs, in whole texts.
    """
    names = sorted(set(langs))
    net, rng = fresh(names, hidden, seed), np.random.default_rng(seed)
    counts = [Counter() for _ in names]
    for text, lang in zip(texts, langs):
        for part in stretches(text):
            counts[names.index(lang)].update(w for u in units(part) if lettered(u) for w in windows(u))
    seen = [(w, k, n / total) for k, c in enumerate(counts) for total in [sum(c.values())] for w, n in sorted(c.items())]
    if len(names) < 2 or not seen:
        return net
    length = np.array([len(w) for w, _, _ in seen])
    weight = np.array([p for _, _, p in seen])
    share = np.bincount(length, weight * length)
    own = {int(n): np.flatnonzero(length == n) for n in np.unique(length)}
    drawn = {n: (np.frombuffer(b"".join(seen[i][0] for i in at), np.uint8).reshape(-1, n), np.array([seen[i][1] for i in at]), np.cumsum(weight[at])) for n, at in own.items()}
    first, second = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()]
    for step, n in enumerate(rng.choice(len(share), steps, p=share / share.sum()).tolist(), 1):
        x, y, heap = drawn[n]
        pick = np.minimum(np.searchsorted(heap, rng.random(BATCH) * heap[-1]), len(y) - 1)
        _, grads = gradient(net, x[pick], y[pick])
        rate = RATE * (1 - 0.9 * step / steps)
        for q, g, m, v in zip(net.parts(), grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def sample(docs: DataFrame, each: int = FIT_DOCUMENTS) -> tuple[list[str], list[str]]:
    """Whole texts and langs of at most `each` documents of each non-null lang outside the held-out fifth, by a hash of doc_id.

    Of rows that share doc_id and lang the least text is taken. Rows are the same on each run.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    keys = known.select("doc_id", "lang", F.xxhash64("doc_id", "lang").alias("_h"))
    # The least hashes are looked for among a share of each lang that holds some SPARE times as many as are wanted, so that no
    # task gets a lang's rows; where a lang has fewer, the share is all of it.
    counts = keys.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("_n"))
    share = F.pmod(F.col("_h"), F.lit(1 << 40)) * F.col("_n").cast("double") < SPARE * each * float(1 << 40)
    few = keys.join(F.broadcast(counts), "lang").where(share).select("doc_id", "lang", "_h").distinct()  # a row for each lang
    picked = few.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id"))).where(F.col("_r") <= each)
    # At most `each` rows for each language, narrow ones.
    rows = known.select("doc_id", "lang", "text").join(F.broadcast(picked.select("doc_id", "lang", "_h")), ["doc_id", "lang"])
    found = rows.groupBy("lang", "_h", "doc_id").agg(F.min("text").alias("text")).toPandas().sort_values(["lang", "_h", "doc_id"])
    return found["text"].tolist(), found["lang"].tolist()


def train(docs: DataFrame) -> Network | None:
    texts, langs = sample(docs)
    return fit(texts, langs) if texts else None


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of docs (doc_id, text, lang; more columns are ignored).

    score is the pooled probability of lang_pred. A null text, and one without a letter, has `und` and 0; so has every
    text when no document outside the held-out fifth has a lang. With one lang only, it is the answer for every text with a
    letter. A row without a doc_id is not held out, and not learnt from. Repeated rows are scored each. An empty table gives
    an empty result.
    """
    net, kind = train(docs), docs.schema["doc_id"].dataType.simpleString()
    names = [*(net.names if net else []), UNKNOWN]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader.of(net) if net else None
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            p = reader.pooled(texts) if net else np.zeros((len(texts), 1))
            best = np.where(p.max(axis=1) > 0, p.argmax(axis=1), len(names) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()).take(pa.array(best)), pa.array(np.minimum(p.max(axis=1), 1.0))], names=["doc_id", "lang_pred", "score"])

    scored = docs.select("doc_id", text_of().alias("text")).mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op11(spark, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
