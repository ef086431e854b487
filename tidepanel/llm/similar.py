"""SimHash near-dedup at a similarity of word shingles: the method of `simhash`, with fingerprints of 256 bits.

Two texts whose sets of shingles have the Jaccard similarity s differ in about acos(2s / (1 + s)) / pi of their bits: 38.8 of
256 at 0.8, where 64 bits say too little to tell 0.8 from 0.6. A fingerprint is embedded as its number of ones in each
segment of SEGMENT bits. Links are pairs within `radius` bits, by the Manhattan distance of the embeddings, which is a lower
bound (over a part of the segments too), and then bit by bit. The radius is the expected number of bits at the similarity and
one standard deviation.

A grid that holds every pair within so many bits would have cells by one or two segments only. So each cell takes the counts
of `width` segments out of a fixed random order, and there are as many such choices as find a pair of the similarity at the
rate RECALL, and a nearer one more often. The width follows from the number of fingerprints, so that at most COMPANY unrelated
ones meet in a cell, whatever their number; the choices follow from the width, so the rate stays. Comparing one pair costs a
few nanoseconds and dealing one fingerprint to one more cell some microseconds, which is why COMPANY is some hundreds.

What the cells and the radius leave out is found by the shingles themselves (`alike_roots`): every pair of texts of the
similarity, the Jaccard similarity of their sets of shingles, that is not linked yet gets its link. Shingles have one fixed
order, the rarer ones first. Two texts of the similarity s have a shingle in common among the first n - ceil(s n) + 1 of each
one's n, so texts meet by these shingles; a pair whose sizes, common first shingles and remaining shingles rule the similarity
out is left, and the whole sets of the others are compared. The order decides the work only, so counts by BUCKETS hash buckets
are enough for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, pi, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, shards_for, text_of
from .components import components
from .exact_dedup import marks
from .simhash import SEED, SEGMENT

LANES, WORDS, SIMILARITY, RECALL = 4, 5, 0.8, 0.9
BITS = 64 * LANES
#: Unrelated fingerprints that may meet in a cell, and the least number of segments of a cell.
COMPANY, WIDTH = 512, 6
#: Cells of up to so many fingerprints are compared together with the other small ones of their batch.
SMALL = 16
#: A cell with more links than so many for each of its fingerprints is a family: links that join it are found step by step.
FAMILY = 4
#: Pairs that are compared at once, and rows that one task deals to the cells.
BLOCK, SPREAD = 1 << 16, 500_000
#: The chance that two unrelated segments have as many ones: 1, 2 and 1 of 4 segments have 0, 1 and 2.
CHANCE = 0.375
#: Hash buckets whose counts order the shingles (a power of two), and buckets of one row of counts.
BUCKETS, CHUNK = 1 << 18, 1 << 13
#: Columns of the key of a text.
KEY = ("t1", "t2")
#: What a product of the similarity and a whole number may be off by.
SLACK = 1e-9
#: Multipliers that make LANES hashes of one; fixed values.
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def share(similarity: float) -> float:
    """The share of bits that differ."""
    return acos(2 * similarity / (1 + similarity)) / pi


def radius_of(similarity: float) -> int:
    s = share(similarity)
    return int(BITS * s + sqrt(BITS * s * (1 - s)))


def width_of(nodes: int) -> int:
    return max(WIDTH, ceil(log(max(nodes, COMPANY) / COMPANY) / log(1 / CHANCE)))


def choices_of(width: int, similarity: float, recall: float = RECALL) -> int:
    """Choices of `width` segments, of which one agrees in a pair of the similarity at the rate `recall`."""
    s = share(similarity)
    alike = ((1 - s) ** 2 + s * s / 2) ** width
    return 1 if alike >= 1 else ceil(log(1 - recall) / log(1 - alike))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; none when it has no words."""
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts, last, digest = ends - lengths, min(words, len(found)) - 1, xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a:b], SEED) for a, b in zip(starts[: len(found) - last].tolist(), ends[last:].tolist())], np.uint64))


def print_of(hashes: np.ndarray) -> bytes:
    """The fingerprint of a set of shingles: BITS bits; zeros of an empty set."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        mixed = hashes[at : at + (1 << 14), None] * ODD
        mixed ^= mixed >> np.uint64(32)
        mixed *= ODD[0]
        mixed ^= mixed >> np.uint64(29)
        bits = np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").view(np.uint64)  # eight counts in each
        ones += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0).view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").tobytes()


def wide_simhash(text: str, words: int = WORDS) -> bytes:
    """The fingerprint of a text's set of shingles; zeros when it has no words."""
    return print_of(shingles(text, words))


def as_array(column: pa.Array) -> np.ndarray:
    """Fingerprints as rows of LANES unsigned longs."""
    column = column.cast(pa.binary(BITS // 8))
    return np.frombuffer(column.buffers()[1], np.uint64, LANES * len(column), column.offset * BITS // 8).reshape(-1, LANES) if len(column) else np.empty((0, LANES), np.uint64)


def as_column(fp: np.ndarray) -> pa.Array:
    """The way back."""
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(BITS // 8), len(fp), [None, pa.py_buffer(np.ascontiguousarray(fp))]).cast(pa.binary())


def wide_fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp of each row of docs; null texts are empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array([wide_simhash(t.as_py(), words) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fp], names=["doc_id", "fp"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(hashed, f"doc_id {kind}, fp binary")


def embedding(fp: np.ndarray) -> np.ndarray:
    """Ones in each segment of two bits: a row of BITS / 2 for each fingerprint."""
    halves = np.uint64(0x5555555555555555)
    pairs = (fp & halves) + ((fp >> np.uint64(1)) & halves)
    quads = pairs.view(np.uint8).reshape(len(fp), -1, 1) >> np.array([0, 2, 4, 6], np.uint8)
    return (quads & np.uint8(3)).reshape(len(fp), -1)


def cells(fp: np.ndarray, width: int, choices: int) -> np.ndarray:
    """The cells of each fingerprint, one column for each choice: a hash of the choice and of the counts in its segments."""
    counts, rng = embedding(fp).astype(np.uint64), np.random.default_rng(64)
    powers = np.uint64(SEGMENT + 1) ** np.arange(20, dtype=np.uint64)
    out = np.empty((len(fp), choices), np.uint64)
    for n in range(choices):
        picked, key = rng.permutation(BITS // SEGMENT)[:width], np.full(len(fp), n + 1, np.uint64)
        for at in range(0, width, 20):
            part = picked[at : at + 20]
            key = (key ^ (counts[:, part] @ powers[: len(part)])) * ODD[0]
            key ^= key >> np.uint64(29)
        out[:, n] = key
    return out


def unary(fp: np.ndarray) -> np.ndarray:
    """The embedding with each count in unary, as many bits set at the segment's end: bits that differ are the Manhattan distance."""
    halves = np.uint64(0x5555555555555555)
    one, other = fp & halves, (fp >> np.uint64(1)) & halves
    return (one | other) | ((one & other) << np.uint64(1))


def near(one: np.ndarray, others: np.ndarray, radius: int) -> np.ndarray:
    """Which of the others are within the radius of one, or each of its own one: by the Manhattan distance of the embeddings first, then bit by bit."""
    one = np.atleast_2d(one)
    found = np.bitwise_count(unary(one) ^ unary(others)).sum(axis=1, dtype=np.int32) <= radius
    pairs = one[found] if len(one) > 1 else one
    found[found] = np.bitwise_count(others[found] ^ pairs).sum(axis=1, dtype=np.int32) <= radius
    return found


def near_pairs(ones: np.ndarray, others: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places i in ones and j in others of all pairs within the radius, in the order of i: by the Manhattan distance over all lanes but the last, then bit by bit."""
    far = np.zeros((len(ones), len(others)), np.uint8)
    for one, other in zip(unary(ones[:, :-1]).T, unary(others[:, :-1]).T):
        far += np.bitwise_count(one[:, None] ^ other)
    i, j = np.nonzero(far <= radius)
    ok = np.bitwise_count(ones[i] ^ others[j]).sum(axis=1, dtype=np.int32) <= radius
    return i[ok], j[ok]


def forest(fp: np.ndarray, radius: int) -> np.ndarray:
    """Places of links that join what of a cell is within the radius of one another, step by step: at most len(fp) - 1."""
    rest, links = np.arange(len(fp)), [np.empty((0, 2), np.int64)]
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            reached = []
            while len(front) and len(rest):
                step = max(1, BLOCK // len(rest))
                i, j = near_pairs(fp[front[:step]], fp[rest], radius)
                j, first = np.unique(j, return_index=True)
                links.append(np.stack([front[i[first]], rest[j]], axis=1))
                reached.append(rest[j])
                front, rest = front[step:], np.delete(rest, j)
            front = np.concatenate(reached)
    return np.concatenate(links)


def linked(fp: np.ndarray, radius: int) -> np.ndarray:
    """Places of all links of a cell, or of a forest of them when there are more than FAMILY for each fingerprint."""
    links, step, count = [], max(1, BLOCK // len(fp)), 0
    for at in range(0, len(fp), step):
        i, j = near_pairs(fp[at : at + step], fp[at:], radius)
        links.append(np.stack([i, j], axis=1)[i < j] + at)
        count += len(links[-1])
        if count > FAMILY * len(fp):
            return forest(fp, radius)
    return np.concatenate(links)


def cell_links(key: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """Places of the links of whole cells, in the order of the cells; those of up to SMALL fingerprints are compared together."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(key)])
    size, links = np.repeat(sizes, sizes), [np.empty((0, 2), np.int64)]
    for gap in range(1, min(SMALL, sizes.max(initial=0))):
        i = np.flatnonzero((key[gap:] == key[:-gap]) & (size[gap:] <= SMALL))
        for at in range(0, len(i), BLOCK):
            part = i[at : at + BLOCK]
            part = part[near(fp[part], fp[part + gap], radius)]
            links.append(np.stack([part, part + gap], axis=1))
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        links.append(linked(fp[s : s + n], radius) + s)
    return np.concatenate(links)


def similar_links(nodes: DataFrame, radius: int, width: int, choices: int) -> DataFrame:
    """nodes: fp, distinct -> links u, v within the radius; in each cell they join all that links of the cell join."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                column = batch.column("fp").slice(at, 1000)
                found = cells(as_array(column), width, choices)
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel().view(np.int64)), column.take(pa.array(np.repeat(np.arange(len(found)), choices)))], names=["cell", "fp"])

    def joined(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        ends = cell_links(key, fp, radius)
        return pa.RecordBatch.from_arrays([as_column(fp[ends[:, i]]) for i in (0, 1)], names=["u", "v"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = [], []  # the rows of the last cell, which may go on in the next batch
        for batch in batches:
            key, fp = batch.column("cell").to_numpy(zero_copy_only=False), as_array(batch.column("fp"))
            if not len(key):
                continue
            if keys and key[0] == key[-1] == keys[0][0]:
                keys.append(key), fps.append(fp)
                continue
            key, fp = np.concatenate([*keys, key]), np.concatenate([*fps, fp])
            cut = int(np.searchsorted(key, key[-1]))
            yield joined(key[:cut], fp[:cut])
            keys, fps = [key[cut:]], [fp[cut:]]
        if keys:
            yield joined(np.concatenate(keys), np.concatenate(fps))

    dealt = nodes.mapInArrow(spread, "cell long, fp binary").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(link, "u binary, v binary").distinct()


def similar_roots(prints: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """prints: doc_id, fp -> fp, least (its smallest doc_id), root (one fingerprint of all that are linked, directly or through others)."""
    nodes = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    count = nodes.count()
    width = width_of(count)
    choices = choices_of(width, similarity, recall)
    roots = components(similar_links(nodes.select("fp").repartition(shards_for(count * choices, SPREAD)), radius_of(similarity), width, choices))
    return durable(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))


def similar_components(prints: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """prints: doc_id, fp -> fp, component_id (the smallest doc_id of all that are linked, directly or through others)."""
    rooted = similar_roots(prints, similarity, recall)
    return rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return hashes >> np.uint64(65 - buckets.bit_length())


def bucket_counts(docs: DataFrame, words: int = WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How many shingles the texts have in each bucket, each text's distinct ones counted; a power of two of numbers, whatever the size of docs."""
    chunk = min(CHUNK, buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                np.add.at(counts, bucket_of(shingles(text.as_py(), words), buckets), 1)
        if counts.any():
            parts = counts.reshape(-1, chunk)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["chunk", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in pdf["counts"])
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "counts": [total.tobytes()]})

    kind, out = "chunk int, counts binary", np.zeros(buckets, np.int64)
    parts = out.reshape(-1, chunk)
    for r in docs.select(text_of().alias("text")).mapInArrow(count, kind).groupBy("chunk").applyInPandas(add, kind).collect():
        parts[r["chunk"]] = np.frombuffer(r["counts"], np.int64)
    return out


def first_shingles(hashes: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles of a set, rare buckets first, of which two sets of the similarity have one in common at least; signed."""
    n = len(hashes)
    most = counts[bucket_of(hashes, len(counts))]
    signed = hashes.view(np.int64)
    return signed[np.lexsort((signed, most))[: min(n, n - ceil(similarity * n - SLACK) + 1)]]


def keyed(docs: DataFrame) -> DataFrame:
    """docs with text (null: empty) and its key, two hashes."""
    return docs.withColumn("text", text_of()).withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64("text", F.lit(SEED))})


def shingle_prints(docs: DataFrame, counts: np.ndarray, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, fp, id (a number of the row), the text's key, n (its shingles), edge (the bucket's count and the hash of the last of firsts), firsts.

    A text that occurs again in a task has its firsts once there; they are empty in the other rows, as those of texts without words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            fp, n, ends, edges, firsts = [], [], [0], [], [np.empty(0, np.int64)]
            for text, key in zip(batch.column("text"), zip(*(batch.column(c).to_pylist() for c in KEY))):
                found = shingles(text.as_py(), words)
                fp.append(print_of(found))
                n.append(len(found))
                first = first_shingles(found, counts, similarity) if key not in seen else firsts[0]
                seen.add(key)
                firsts.append(first)
                ends.append(ends[-1] + len(first))
                last = int(first[-1]) if len(first) else 0
                edges.append({"count": int(counts[bucket_of(np.array([last]).view(np.uint64), len(counts))][0]), "hash": last})
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(firsts)))
            edge = pa.array(edges, pa.struct([("count", pa.int64()), ("hash", pa.int64())]))
            columns = [batch.column("doc_id"), pa.array(fp, pa.binary()), *(batch.column(c) for c in ("id", *KEY)), pa.array(n, pa.int32()), edge, listed]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "id", *KEY, "n", "edge", "firsts"])

    rows = keyed(docs.select("doc_id", "text")).withColumn("id", F.monotonically_increasing_id())
    return rows.mapInArrow(hashed, f"doc_id {kind}, fp binary, id long, t1 long, t2 long, n int, edge struct<count: long, hash: long>, firsts array<long>")


def candidates(prints: DataFrame, rooted: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """a, b (ids): of all pairs of texts of the similarity whose roots differ, and others that their first shingles do not rule out. A written table."""
    roots = durable(rooted.select("root").distinct().withColumn("rid", F.monotonically_increasing_id()))
    known = prints.where(F.size("firsts") > 0).select("fp", "id", "n", "edge", F.size("firsts").alias("p")).join(rooted.select("fp", "root"), "fp").join(roots, "root").drop("fp", "root")
    by_shingle = Window.partitionBy("h")
    rows = prints.select("id", F.posexplode("firsts").alias("pos", "h"))
    shared = durable(rows.withColumn("c", F.count("*").over(by_shingle)).where("c > 1").drop("c")).join(known, "id")
    apart = shared.withColumns({"few": F.min("rid").over(by_shingle), "many": F.max("rid").over(by_shingle)}).where("few < many").drop("few", "many")
    apart = durable(apart)
    one, other = (apart.select("h", *[F.col(c).alias(f"{side}_{c}") for c in apart.columns if c != "h"]) for side in "ab")
    met = one.join(other, "h").where("a_rid < b_rid").where(F.least("a_n", "b_n") >= similarity * F.greatest("a_n", "b_n") - SLACK)
    most = F.least("a_pos", "b_pos") + F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))  # common shingles, by this one's places
    met = met.where(most * (1 + similarity) >= similarity * (F.col("a_n") + F.col("b_n")) - SLACK)
    facts = [F.max(f"{side}_{c}").alias(f"{side}_{c}") for side in "ab" for c in ("pos", "n", "p", "edge")]
    pairs = met.groupBy(F.col("a_id").alias("a"), F.col("b_id").alias("b")).agg(F.count("*").alias("c"), *facts)
    # Beyond the last common first shingle, of the text whose firsts end first only what follows its firsts may be common too.
    a_left, b_left = (F.col(f"{side}_n") - 1 - F.col(f"{side}_pos") for side in "ab")
    a_after, b_after = (F.col(f"{side}_n") - F.col(f"{side}_p") for side in "ab")
    left = F.when(F.col("a_edge") <= F.col("b_edge"), F.least(a_after, b_left)).otherwise(F.least(a_left, b_after))
    return durable(pairs.where((F.col("c") + left) * (1 + similarity) >= similarity * (F.col("a_n") + F.col("b_n")) - SLACK).select("a", "b"))


def shingle_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The key of each text of docs and its shingles."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = pa.array([shingles(t.as_py(), words).view(np.int64) for t in part.column("text")], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in KEY), found], names=[*KEY, "shingles"])

    return docs.select("text", *KEY).mapInArrow(hashed, "t1 long, t2 long, shingles array<long>")


def alike_roots(docs: DataFrame, prints: DataFrame, rooted: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """u, v: all different roots that two texts of the similarity have. prints by `shingle_prints`, rooted: fp, root."""
    pairs = candidates(prints, rooted, similarity)
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    needed = durable(needed.join(prints.select("id", "fp", *KEY), "id").join(rooted.select("fp", "root"), "fp").drop("fp"))
    hashes = needed.select(F.col("t1").alias("h")).distinct()
    rows = marks(hashes, hashes.count()).passing(keyed(docs.select("text")).withColumn("h", F.col("t1")))
    sets = durable(shingle_sets(rows, words).dropDuplicates([*KEY]).join(needed, [*KEY]).select("id", "root", "shingles"))
    one, other = (sets.select(F.col("id").alias(x), F.col("root").alias(r), F.col("shingles").alias(f"{x}_set")) for x, r in (("a", "u"), ("b", "v")))
    met = pairs.join(one, "a").join(other, "b").withColumn("both", F.size(F.array_intersect("a_set", "b_set")))
    return met.where(F.col("both") >= similarity * (F.size("a_set") + F.size("b_set") - F.col("both")) - SLACK).select("u", "v").distinct()


def whole_roots(docs: DataFrame, prints: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """As `similar_roots`, and roots of which two texts have the similarity are one."""
    rooted = similar_roots(prints, similarity, recall)
    joined = components(alike_roots(docs, prints, rooted, words, similarity)).select("node", F.col("root").alias("joined"))
    return rooted.join(joined, rooted["root"] == joined["node"], "left").select("fp", "least", F.coalesce("joined", "root").alias("root"))


def drop_similar(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its component, with all their columns; rows that repeat it stay together.

    Texts of the similarity are of one component, all of them, and so are those whose fingerprints the cells find within the radius.
    Null and empty texts, and those without words, have one fingerprint and are one group. Rows without doc_id count as rows
    of one doc_id that is larger than all others. An empty table gives an empty result.

    Rows without a mark of a doc_id that goes stay where they are; only the others are shuffled, to be told apart exactly.
    """
    prints = durable(shingle_prints(docs, bucket_counts(docs, words), words, similarity))
    stay = whole_roots(docs, prints, words, similarity, recall).groupBy("root").agg(F.min("least").alias("_tide_stays")).select("_tide_stays").distinct()
    gone = prints.select("doc_id").distinct().join(stay, F.col("doc_id").eqNullSafe(F.col("_tide_stays")), "left_anti")
    gone = durable(gone.select(F.xxhash64("doc_id").alias("h"), F.col("doc_id").alias("_tide_gone")))
    marked = marks(gone, gone.count())
    named = [F.col(f"`_doc_{c}`").alias(c) for c in docs.columns]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_doc_{c}") for c in docs.columns], F.xxhash64("doc_id").alias("h"))
    told = marked.passing(rows).join(gone.select("_tide_gone"), F.col("_doc_doc_id").eqNullSafe(F.col("_tide_gone")), "left_anti")
    return marked.failing(rows).select(*named).unionByName(told.select(*named))
