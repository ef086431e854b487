"""Substring dedup by content-defined chunking with a gear rolling hash.

The gear hash of the last 32 bytes decides where a chunk ends, so an insertion moves the cuts near it and no others.
Chunks are named by a 128-bit digest; a chunk that a document with a smaller doc_id holds too is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, text_of

#: A chunk ends where the gear hash's top BITS bits are zero; chunks shorter than LEAST go on, and none is longer than MOST.
BITS, LEAST, MOST = 5, 16, 256
BLOCK, SPAN = 4 << 20, 1024
#: Default of `least_run`: chunks of common words meet by chance, and a run of repeated chunks shorter than this stays,
#: unless it is the whole text. 0 removes every repeated chunk.
LEAST_RUN = 64


def gear(seed: int = 2024) -> np.ndarray:
    """256 random 32-bit values."""
    return np.random.default_rng(seed).integers(0, 1 << 32, 256, np.uint64).astype(np.uint32)


GEAR = gear()


def rolling(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - k]] << k over the last 32 bytes, modulo 2^32, by doubling the window."""
    h = GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    return h


def cuts(data: bytes) -> list[int]:
    """Where the chunks of a text end."""
    array, ends = np.frombuffer(data, np.uint8), []
    for at in range(0, len(array), BLOCK):
        lead = min(at, 32)
        h = rolling(array[at - lead : at + BLOCK])[lead:]
        ends += (np.flatnonzero(h >> np.uint32(32 - BITS) == 0) + at + 1).tolist()
    out, start = [], 0
    for end in [*ends, len(array)]:
        if end - start < LEAST and end != len(array):
            continue
        while end - start > MOST:
            start += MOST
            out.append(start)
        if end > start:
            out.append(end)
            start = end
    return out


def chunks(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, span (begin * SPAN + size) and the digest's halves d1, d2 of each chunk of each row: longs, for narrow shuffles."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, of, span, digest = batch.column("text"), [], [], []
            for i in range(len(texts)):
                data, start = texts[i].as_py().encode(), 0
                for end in cuts(data):
                    of.append(i)
                    span.append(start * SPAN + end - start)
                    digest.append(hashlib.blake2b(data[start:end], digest_size=16).digest())
                    start = end
            halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            rows = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), pa.array(span, pa.int64()), *[pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)]], names=["doc_id", "text_hash", "span", "d1", "d2"])

    text = text_of()
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(split, f"doc_id {kind}, text_hash long, span long, d1 long, d2 long")


def removed_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, span, d1, d2, first_doc of each chunk that a document with a smaller doc_id holds."""
    found = chunks(docs)
    shared = found.groupBy("d1", "d2").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("_last")).where("first_doc < _last").drop("_last")
    return found.join(shared, ["d1", "d2"]).where("doc_id > first_doc")


def runs(spans: list[int], size: int, least_run: int = LEAST_RUN) -> list[tuple[int, int]]:
    """Begin and end of the runs of adjacent spans that have at least `least_run` bytes or are the whole text."""
    out: list[tuple[int, int]] = []
    for begin, n in (divmod(s, SPAN) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], begin + n))
        else:
            out.append((begin, begin + n))
    return [(a, b) for a, b in out if b - a >= least_run or b - a == size]


def chunk_dedup(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of docs (doc_id, text; more columns are ignored).

    A chunk that a document with a smaller doc_id holds is repeated. A run of repeated chunks is removed when it has
    least_run bytes or is the whole text; n_spans counts removed runs; kept_sha256 is of the bytes that remain, in order.
    Chunks of rows with a null doc_id, and chunks that repeat within one doc_id only, stay. Rows that repeat a doc_id are
    read by their own texts. Null texts are empty. An empty table gives an empty result.
    """
    spans = removed_spans(docs).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.sort_array(F.collect_set("span")).alias("spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                data, kept, at, n = text.as_py().encode(), hashlib.sha256(), 0, 0
                found = runs(spans.as_py() or (), len(data), least_run)
                for begin, end in found:
                    kept.update(data[at:begin])
                    at = end
                    n += end - begin
                kept.update(data[at:])
                rows.append((len(data), n, len(found), kept.hexdigest()))
            a, b, c, d = zip(*rows) if rows else ([],) * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    joined = docs.select("doc_id", text_of().alias("text")).join(spans, same, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op7(spark, sf_dir: str) -> DataFrame:
    return chunk_dedup(documents(spark, sf_dir))
