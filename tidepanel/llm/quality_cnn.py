"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters run over chunks of CHUNK bytes that overlap by half and cover the whole document;
each filter's rectified maximum over the chunks is pooled, and the pooled values are combined into one probability.
Besides the embedded bytes a chunk holds, for each lag up to LAGS, how many of its bytes equal the byte that lag before,
so that filters see repetition whatever is repeated. Fitted by Adam on a bounded number of rows; fitting and scoring read
whole texts, long ones in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, held_out, labels, text_of
from .training import sample

HALF, DIM, FILTERS = 8, 4, 24
LAGS = tuple(range(2, 22))
#: Rows of each label that the network is fitted to, passes over them, and rows of a step.
FIT_ROWS, EPOCHS, BATCH = 1500, 10, 32
THRESHOLD = 0.3
#: Bytes that are read at once.
BLOCK = 1 << 20
GAP = 3 * HALF


@dataclass
class Network:
    embed: np.ndarray  # 256 x DIM
    filters: np.ndarray  # 2 x (HALF * DIM + len(LAGS)) x FILTERS: the first and the second half of a chunk
    shift: np.ndarray  # FILTERS
    out: np.ndarray  # FILTERS
    bias: np.ndarray  # 1

    def parts(self):
        return [self.embed, self.filters, self.shift, self.out, self.bias]


def fresh(seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    wide = HALF * DIM + len(LAGS)
    return Network(
        rng.normal(0, 0.5, (256, DIM)).astype(np.float32), rng.normal(0, 1 / np.sqrt(2 * wide), (2, wide, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS).astype(np.float32), np.zeros(1, np.float32),
    )


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer for many texts, each followed by zeros up to a whole half and a gap: bytes, first half and number of chunks of each."""
    sizes = np.array([len(t) for t in texts], np.int64)
    halves = -(-sizes // HALF) + GAP // HALF
    starts = np.cumsum(halves) - halves
    buffer = np.zeros(int(halves.sum()) * HALF, np.uint8)
    for t, s in zip(texts, starts * HALF):
        buffer[s : s + len(t)] = np.frombuffer(t, np.uint8)
    return buffer, starts, np.maximum(halves - GAP // HALF, 1)


def inputs(net: Network, buffer: np.ndarray) -> np.ndarray:
    """A row for each half chunk: its embedded bytes and its lag counts."""
    n = len(buffer) // HALF
    x = np.empty((n, HALF * DIM + len(LAGS)), np.float32)
    x[:, : HALF * DIM] = net.embed[buffer].reshape(n, HALF * DIM)
    same = np.zeros(len(buffer), np.uint8)
    for k, lag in enumerate(LAGS):
        same[:] = 0
        same[lag:] = (buffer[lag:] == buffer[:-lag]) & (buffer[lag:] != 0)
        x[:, HALF * DIM + k] = np.bitwise_count(same.view(np.uint64)) * np.float32(1 / HALF)
    return x


def responses(net: Network, x: np.ndarray) -> np.ndarray:
    """Each filter's response to the chunk that begins at each half."""
    r = x @ net.filters[0]
    r[:-1] += x[1:] @ net.filters[1]
    return r + net.shift


def blocks(net: Network, texts: list[bytes]) -> Iterator[tuple[list[int], list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in pieces of BLOCK at most: each piece's text, its own chunks (the first and how many), buffer, first halves, inputs, responses.

    Pieces of a text overlap by a chunk and the longest lag.
    """
    pieces, owner, own = [], [], []
    lead = -(-max(LAGS) // HALF) * HALF
    for i, t in enumerate(texts):
        for at in range(0, max(len(t), 1), BLOCK):
            before = min(at, lead)
            pieces.append(t[at - before : at + BLOCK + HALF])
            own.append((before // HALF, -(-min(BLOCK, len(t) - at) // HALF)))
            owner.append(i)
    at = 0
    while at < len(pieces):
        end, size = at, 0
        while end < len(pieces) and (end == at or size + len(pieces[end]) <= BLOCK):
            size += len(pieces[end])
            end += 1
        buffer, starts, _ = lay_out(pieces[at:end])
        x = inputs(net, buffer)
        yield owner[at:end], own[at:end], buffer, starts, x, responses(net, x)
        at = end


def scores(net: Network, texts: list[bytes]) -> np.ndarray:
    """Probabilities of label 1."""
    pooled = np.zeros((len(texts), FILTERS), np.float32)
    for owner, own, _, starts, _, r in blocks(net, texts):
        live = np.zeros(len(r), bool)
        for s, (first, n) in zip(starts, own):
            live[s + first : s + first + n] = True
        r[~live] = 0
        np.maximum.at(pooled, owner, np.maximum.reduceat(r, starts, axis=0))
    return 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.bias[0], -30, 30).astype(np.float64)))


def winners(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's and filter's largest response, at least 0, with the inputs and the bytes of both halves of the chunk that gave it."""
    top = np.zeros((len(texts), FILTERS), np.float32)
    rows = np.zeros((2, len(texts), FILTERS, HALF * DIM + len(LAGS)), np.float32)
    letters = np.zeros((2, len(texts), FILTERS, HALF), np.uint8)
    for owner, own, buffer, starts, x, r in blocks(net, texts):
        halves = buffer.reshape(-1, HALF)
        for i, s, (first, n) in zip(owner, starts, own):
            if not n:
                continue
            best = s + first + r[s + first : s + first + n].argmax(axis=0)
            found = r[best, np.arange(FILTERS)]
            more = np.flatnonzero(found > top[i])
            top[i, more] = found[more]
            for half in (0, 1):
                rows[half, i, more], letters[half, i, more] = x[best[more] + half], halves[best[more] + half]
    return top, rows, letters


def fit(texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the logistic loss. A filter's gradient flows through the chunk that had its maximum."""
    net, rng = fresh(seed), np.random.default_rng(seed)
    if len(texts) == 0 or y.min() == y.max():  # nothing to tell apart: the share of label 1, or a half
        net.out[:] = 0
        net.bias[:] = 0 if len(texts) == 0 else (3 if y[0] else -3)
        return net
    first, second = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            mine = order[at : at + BATCH]
            pooled, rows, letters = winners(net, [texts[i] for i in mine])
            p = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.bias[0], -30, 30)))
            d = ((p - y[mine]) / len(mine)).astype(np.float32)
            g_out, g_bias = d @ pooled + 1e-4 * net.out, d.sum(keepdims=True)
            g_top = d[:, None] * net.out * (pooled > 0)
            g_filters, g_embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
            for half in (0, 1):
                g_filters[half] = np.einsum("dfi,df->if", rows[half], g_top)
                back = (g_top[:, :, None] * net.filters[half].T)[:, :, : HALF * DIM].reshape(-1, DIM)
                np.add.at(g_embed, letters[half].reshape(-1), back)
            step += 1
            for q, g, m, v in zip(net.parts(), [g_embed, g_filters, g_top.sum(axis=0), g_out, g_bias], first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def train(docs: DataFrame, marks: DataFrame) -> Network:
    rows = sample(docs, marks, "quality", FIT_ROWS, FIT_ROWS)
    return fit([t.encode() for t in rows["text"]], rows["y"].to_numpy(np.float32))


def quality_scores(docs: DataFrame, marks: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs (doc_id, text; more columns are ignored).

    marks: doc_id, quality. Null texts are empty; an empty text pools nothing and has the score of the bias. Without
    labels, or with one label only, all texts have one score. Repeated rows are scored each.
    """
    net, kind = train(docs, marks), docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(net, [t.as_py().encode() for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", text_of().alias("text")).mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, marks: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least the threshold, with all their columns, in one pass without a shuffle."""
    net, place = train(docs, marks), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(place)]
            yield batch.filter(pa.array(scores(net, texts) >= threshold))

    return docs.mapInArrow(keep, docs.schema)


def op3(spark, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), labels(spark, sf_dir))
