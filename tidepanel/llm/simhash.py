"""SimHash near-dedup: a segment-popcount embedding, a grid range-join under Manhattan distance, exact verification.

A fingerprint is embedded as its number of ones in each segment of SEGMENT bits. The Manhattan distance of two such
vectors is at most the Hamming distance of the fingerprints, so links within `radius` are found among vectors within
`radius`. The grid has SLABS slabs of segments: two vectors within the radius agree in all but `radius` slabs, so each
fingerprint goes to the cells of every choice of SLABS - radius slabs. A cell is read as a sorted stream: vectors
within the radius are compared bit by bit, and only links that join two parts of a cell are kept, at most one less than
the cell has fingerprints. Equal fingerprints are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, durable, text_of
from .components import components

WORDS, RADIUS, SLABS, SEGMENT, SEED = 4, 4, 7, 2, 42
#: Cells of up to so many fingerprints are compared at once; larger ones node by node.
SMALL = 8


def simhash(text: str, words: int = WORDS) -> int:
    """The 64-bit fingerprint of a text; 0 when it has no words."""
    found = text.encode().lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(words, len(found)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[: len(found) - last].tolist(), ends[last:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(t.as_py(), words) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(hashed, f"doc_id {kind}, fp long")


def slab_edges(slabs: int) -> list[int]:
    return [64 * i // slabs for i in range(slabs + 1)]


def grid_cells(fp: np.ndarray, radius: int = RADIUS, slabs: int = SLABS) -> np.ndarray:
    """The cells of each fingerprint, one column for each choice of slabs: a hash of the popcounts in them."""
    edges, columns = slab_edges(slabs), []
    for a, b in zip(edges, edges[1:]):
        key = np.zeros(len(fp), np.uint64)
        for bit in range(a, b, SEGMENT):
            ones = (fp >> np.uint64(bit)) & np.uint64((1 << (min(bit + SEGMENT, b) - bit)) - 1)
            key = key * np.uint64(SEGMENT + 1) + np.bitwise_count(ones).astype(np.uint64)
        columns.append(key)
    out = np.empty((len(fp), 0), np.uint64)
    cells = []
    for n, choice in enumerate(combinations(range(slabs), slabs - radius)):
        key = np.full(len(fp), n + 1, np.uint64)
        for slab in choice:
            key = (key ^ columns[slab]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        cells.append(key)
    return np.stack(cells, axis=1) if cells else out


def embedding(fp: np.ndarray) -> np.ndarray:
    """Ones in each byte of a fingerprint."""
    return np.bitwise_count(fp.view(np.uint8).reshape(-1, 8)).astype(np.int8)


def verified(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs are within the radius: by Manhattan distance of the embeddings first, then bit by bit."""
    near = np.abs(embedding(a) - embedding(b)).sum(axis=1) <= radius
    near[near] = np.bitwise_count(a[near] ^ b[near]) <= radius
    return near


def spanning_links(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join what of a cell is within the radius of one another, step by step: at most len(fp) - 1."""
    rest, links = np.unique(fp), []
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            near = verified(np.full(len(rest), one), rest, radius)
            links += [(int(one), int(x)) for x in rest[near]]
            front += list(rest[near])
            rest = rest[~near]
    return links


def cell_links(cells: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """Links of whole cells; both arrays in the order of the cells."""
    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    sizes = np.diff(np.r_[starts, len(cells)])
    size = np.repeat(sizes, sizes)
    found = [np.empty((0, 2), np.uint64)]
    for gap in range(1, SMALL):
        i = np.flatnonzero((cells[gap:] == cells[:-gap]) & (size[gap:] <= SMALL))
        a, b = fp[i], fp[i + gap]
        ok = verified(a, b, radius) & (a != b)
        found.append(np.stack([a[ok], b[ok]], axis=1))
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        if links := spanning_links(fp[s : s + n], radius):
            found.append(np.array(links, np.uint64))
    return np.concatenate(found)


def near_links(nodes: DataFrame, radius: int = RADIUS, slabs: int = SLABS) -> DataFrame:
    """nodes: fp, distinct -> links u, v whose components are those of all pairs within the radius."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            cells = grid_cells(fp, radius, slabs)
            yield pa.RecordBatch.from_arrays([pa.array(cells.ravel().view(np.int64)), pa.array(np.repeat(fp, cells.shape[1]).view(np.int64))], names=["cell", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64), np.empty(0, np.int64)]
        for batch in batches:
            cells = np.concatenate([kept[0], batch.column("cell").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([kept[1], batch.column("fp").to_numpy(zero_copy_only=False)])
            if not len(cells):
                continue
            cut = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on in the next batch
            kept = [cells[cut:], fp[cut:]]
            yield _pairs(cells[:cut], fp[:cut])
        if len(kept[0]):
            yield _pairs(*kept)

    def _pairs(cells: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        links = cell_links(cells, fp.view(np.uint64), radius) if len(cells) else np.empty((0, 2), np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(links[:, k]).view(np.int64)) for k in (0, 1)], names=["u", "v"])

    dealt = nodes.mapInArrow(spread, "cell long, fp long").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(link, "u long, v long").distinct()


def near_components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """prints: doc_id, fp -> fp, component_id (the smallest doc_id of all that are linked, directly or through others)."""
    nodes = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(nodes.select("fp"), radius))
    tagged = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    tagged = durable(tagged)
    return tagged.join(tagged.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")


def near_dedup(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id of each row of docs (doc_id, text; more columns are ignored).

    Null texts are empty; texts without words have the fingerprint 0 and are linked like any other. Repeated rows have
    rows of their own. Null doc_ids are never the smallest. An empty table gives an empty result.
    """
    prints = durable(fingerprints(docs, words))
    return prints.join(near_components(prints, radius), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its component, with all their columns; rows that repeat it stay together."""
    prints = durable(fingerprints(docs, words))
    stay = prints.join(near_components(prints, radius), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_tide_stays")).distinct()
    return docs.join(stay, F.col("doc_id").eqNullSafe(F.col("_tide_stays")), "left_semi")


def op4(spark, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir))
