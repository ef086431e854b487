"""Substring dedup by external induced sorting of sampled suffixes.

Which bytes are covered by a LENGTH-byte string that an earlier document holds too? Sorting every suffix of a corpus
would write several times its size, so suffixes are sampled and the rest is induced from them:

- In each window of LENGTH bytes the GRAM-byte string with the smallest hash is its anchor (the leftmost one). It
  depends on the window's bytes alone, so equal windows have equal anchors at equal places. The windows of one anchor
  are a stretch of LENGTH to LENGTH + LENGTH - GRAM bytes.
- Blocks of documents send the sorted hashes of their anchors to shards, Rice-coded, and receive a bit for each: does
  another document hold it? Anchors of one document hold no shared window and go no further.
- Blocks send a digest of each distinct stretch of the other anchors, with the smallest doc_id that holds it. A stretch
  that an earlier document holds whole needs no more, nor does one that is the only one of its anchor.
- What is left, the earliest copy of each of several stretches of one anchor, is sent as bytes. A shard keeps it in a
  disk-backed priority queue by anchor. It sorts the suffixes that begin at anchors, with the length of the prefix each
  shares with its neighbour, and then induces the order of the suffixes one byte further to the left, again and again:
  a stable sort by that byte, and one more than the smallest shared prefix of those passed over. Runs that share LENGTH
  bytes are one window, and what its smallest doc_id covers goes back to the blocks.

Stretches are equal when 40 bits of anchor hash and 64 bits of digest are; windows of different stretches when their
bytes are.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .codes import pack_bits, rice_decode, rice_encode, unpack_bits
from .common import documents, durable, shards_for, text_bytes, text_of

LENGTH, GRAM = 50, 32
SPAN = LENGTH - GRAM + 1  # grams in a window
WIDEST = LENGTH + SPAN - 1
ROW = -(-WIDEST // 8) * 8
BLOCK_BYTES, SHARD_BYTES, SEGMENT = 6 << 20, 12 << 20, 1 << 21
#: Bytes of stretches that a shard's queue holds in memory, and stretches that are sorted at once.
QUEUE_BYTES, SORTED = 48 << 20, 100_000
MULTIPLIER = 0x9E3779B97F4A7C15
TABLE = np.random.default_rng(11).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on, by doubling the width."""
    h, factor = TABLE[data], MULTIPLIER
    width = 1
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        width *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash (its upper 40 bits), place, first window and last window of each anchor of a text; long texts in segments."""
    found = []
    for at in range(0, len(data) - LENGTH + 1, SEGMENT):
        part = data[at : at + SEGMENT + LENGTH - 1]
        h = gram_hashes(part)
        v = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        m = v
        width = 1
        while 2 * width <= SPAN:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        m = np.minimum(m[: len(m) - (SPAN - width)], m[SPAN - width :]) if SPAN > width else m
        first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
        last = np.r_[first[1:] - 1, len(m) - 1]
        found.append((m[first] >> np.uint64(24), (m[first] & PLACE).astype(np.int64) + at, first + at, last + at))
    if not found:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
    return tuple(np.concatenate(x) for x in zip(*found))


def shard_edges(shards: int) -> np.ndarray:
    return np.array([(i << 40) // shards for i in range(1, shards)], np.uint64)


def cuts_of(values: np.ndarray, edges: np.ndarray) -> list[int]:
    return [0, *np.searchsorted(values, edges).tolist(), len(values)]


def pack_documents(ids: list[int], known: list[bool], texts: list[bytes]) -> bytes:
    head = np.array([len(ids)], "<i8").tobytes() + np.array(ids, "<i8").tobytes() + np.array(known, "u1").tobytes() + np.array([len(t) for t in texts], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(texts))


def unpack_documents(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    ids, known, sizes = np.frombuffer(data, "<i8", n, 8), np.frombuffer(data, "u1", n, 8 + 8 * n), np.frombuffer(data, "<i8", n, 8 + 9 * n)
    ends = 8 + 17 * n + np.cumsum(sizes)
    return ids, known.astype(bool), [data[e - z : e] for e, z in zip(ends.tolist(), sizes.tolist())]


class Block:
    """The documents of a block, in an order that only their content decides, and their anchors in order of hash."""

    def __init__(self, pdf: pd.DataFrame):
        rows, self.free = [], []  # free: texts of rows without a doc_id
        for blob in pdf["payload"]:
            for i, known, text in zip(*unpack_documents(blob)):
                rows.append((int(i), text)) if known else self.free.append(text)
        rows.sort()
        self.ids, self.texts = np.array([i for i, _ in rows], np.int64), [t for _, t in rows]
        self.starts = np.cumsum([0, *map(len, self.texts)])
        self.buffer = np.frombuffer(b"".join(self.texts) + bytes(ROW), np.uint8)
        found = [anchors(self.buffer[a:b]) for a, b in zip(self.starts, self.starts[1:])]
        doc = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        h, place, first, last = (np.concatenate([np.empty(0, np.uint64 if k == 0 else np.int64), *[f[k] for f in found]]) for k in range(4))
        order = np.argsort(h, kind="stable")
        self.hash, self.doc = h[order], doc[order]
        base = self.starts[self.doc]
        self.place, self.first, self.last = place[order] + base, first[order] + base, last[order] + base
        begin = np.flatnonzero(np.r_[True, self.hash[1:] != self.hash[:-1]]) if len(h) else np.empty(0, np.int64)
        self.hashes, self.counts = self.hash[begin], np.diff(np.r_[begin, len(h)])
        held = self.ids[self.doc]  # rows of one doc_id are one document
        self.shared = np.minimum.reduceat(held, begin) < np.maximum.reduceat(held, begin) if len(h) else np.empty(0, bool)

    def mark(self, marks: pd.DataFrame, edges: np.ndarray) -> None:
        """Takes the bits of the other blocks."""
        cuts = cuts_of(self.hashes, edges)
        for s, blob in zip(marks["shard"], marks["payload"]):
            self.shared[cuts[s] : cuts[s + 1]] |= unpack_bits(blob, cuts[s + 1] - cuts[s])
        self.find()

    def recall(self, answers: pd.DataFrame) -> None:
        """Takes the bits that the block sent itself."""
        self.shared = unpack_bits(answers.loc[answers["kind"] == 0, "payload"].iloc[0], len(self.hashes))
        self.find()

    def find(self) -> None:
        """The distinct stretches of the shared anchors."""
        hit = np.flatnonzero(np.repeat(self.shared, self.counts))
        digest = np.empty(len(hit), np.uint64)
        for at in range(0, len(hit), SORTED):
            digest[at : at + SORTED] = digests(self.rows(hit[at : at + SORTED]), self.size(hit[at : at + SORTED]))
        order = np.lexsort((self.doc[hit], digest, self.hash[hit]))
        self.hit, digest = hit[order], digest[order]
        h = self.hash[self.hit]
        new = np.r_[True, (h[1:] != h[:-1]) | (digest[1:] != digest[:-1])] if len(h) else np.empty(0, bool)
        self.entry_of = np.cumsum(new) - 1
        self.lead = self.hit[new]  # the anchor of each stretch's first document
        self.entry_hash, self.entry_digest, self.entry_doc = h[new], digest[new], self.ids[self.doc[self.lead]]

    def size(self, which: np.ndarray) -> np.ndarray:
        return self.last[which] - self.first[which] + LENGTH

    def rows(self, which: np.ndarray) -> np.ndarray:
        """The bytes of stretches, a row each, with zeros at the end."""
        out = np.lib.stride_tricks.sliding_window_view(self.buffer, ROW)[self.first[which]]
        out[np.arange(ROW) >= self.size(which)[:, None]] = 0
        return out


def digests(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64 bits of each row and its size."""
    h = size.astype(np.uint64) * np.uint64(MULTIPLIER)
    for column in rows.view("<u8").T:
        h = (h ^ column) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


ENTRY = np.dtype([("hash", "u8"), ("doc", "i8"), ("run", "u4"), ("number", "u4"), ("size", "u1"), ("place", "u1"), ("bytes", "u1", (WIDEST,))])
#: What the classes of stretches answer: nothing else to compare, all covered, or bytes are wanted.
ALONE, COVERED, WANTED = 0, 1, 2


def pack_entries(block: Block, which: np.ndarray) -> np.ndarray:
    out, lead = np.zeros(len(which), ENTRY), block.lead[which]
    out["hash"], out["doc"] = block.entry_hash[which], block.entry_doc[which]
    out["size"], out["place"] = block.size(lead), block.place[lead] - block.first[lead]
    out["bytes"] = block.rows(lead)[:, :WIDEST] if len(which) else out["bytes"]
    return out


class SpillQueue:
    """A priority queue of sorted runs: beyond a bound, runs wait on disk, and are read from there in order."""

    def __init__(self, bound: int = QUEUE_BYTES):
        self.bound, self.held, self.runs = bound, 0, []
        self.file, self.end = None, 0

    def push(self, run: np.ndarray) -> None:
        if self.held + run.nbytes > self.bound:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(self.end)
            self.file.write(run.tobytes())
            self.runs.append((self.end, len(run)))
            self.end += run.nbytes
        else:
            self.held += run.nbytes
            self.runs.append(run)

    def _read(self, run, at: int, n: int) -> np.ndarray:
        if isinstance(run, np.ndarray):
            return run[at : at + n]
        self.file.seek(run[0] + at * ENTRY.itemsize)
        return np.frombuffer(self.file.read(min(n, run[1] - at) * ENTRY.itemsize), ENTRY)

    def groups(self, size: int = SORTED) -> Iterator[np.ndarray]:
        """Entries in order of hash, about `size` at a time; those of one hash come together."""
        at = [0] * len(self.runs)
        total = [len(r) if isinstance(r, np.ndarray) else r[1] for r in self.runs]
        while open_runs := [k for k in range(len(at)) if at[k] < total[k]]:
            step = max(64, size // len(open_runs))
            heads = {k: self._read(self.runs[k], at[k], step) for k in open_runs}
            bound = min(h["hash"][-1] for h in heads.values())
            parts = []
            for k, head in heads.items():
                n = int(np.searchsorted(head["hash"], bound, "right"))
                while n == len(head) and at[k] + n < total[k]:  # the run goes on with this hash
                    head = np.concatenate([head, self._read(self.runs[k], at[k] + n, step)])
                    n = int(np.searchsorted(head["hash"], bound, "right"))
                at[k] += n
                parts.append(head[:n])
            yield np.concatenate(parts)
        if self.file:
            self.file.close()


def least_between(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """min(values[begin + 1 .. end]) for pairs with begin < end."""
    if not len(begin):
        return np.empty(0, values.dtype)
    padded = np.r_[values, values[-1:]]
    return np.minimum.reduceat(padded, np.stack([begin + 1, end + 1], axis=1).ravel())[::2]


def induced_windows(e: np.ndarray) -> np.ndarray:
    """For each entry a mask: bit t is set when a smaller doc_id than its own holds window t of it."""
    n, size, place = len(e), e["size"].astype(np.int64), e["place"].astype(np.int64)
    right = np.zeros((n, 56), np.uint8)
    column = place[:, None] + np.arange(LENGTH)
    inside = column < size[:, None]
    right[:, :LENGTH] = np.where(inside, np.take_along_axis(e["bytes"], np.minimum(column, WIDEST - 1), axis=1), 0)
    keys = right.view(">u8")
    order = np.lexsort([*[keys[:, j] for j in range(6, -1, -1)], e["hash"]])
    # Shared prefix with the one before; none across anchors.
    same = right[order[1:], :LENGTH] == right[order[:-1], :LENGTH]
    shared = np.where(same.all(axis=1), LENGTH, same.argmin(axis=1))
    rest = size - place
    shared = np.minimum(shared, np.minimum(rest[order[1:]], rest[order[:-1]]))
    shared = np.r_[0, np.where(e["hash"][order[1:]] == e["hash"][order[:-1]], shared, 0)]
    group = np.unique(e["hash"], return_inverse=True)[1].astype(np.int64)
    masks = np.zeros(n, np.uint32)
    for left in range(SPAN):
        live = np.flatnonzero(rest[order] >= LENGTH - left)  # windows that begin `left` bytes before the anchor
        if len(live):
            lcp = np.r_[0, least_between(shared, live[:-1], live[1:])]
            starts = np.flatnonzero(lcp < LENGTH)
            doc = e["doc"][order[live]]
            least = np.repeat(np.minimum.reduceat(doc, starts), np.diff(np.r_[starts, len(live)]))
            at = order[live]
            masks[at] |= (least < doc).astype(np.uint32) << (place[at] - left).astype(np.uint32)
        further = np.flatnonzero(place[order] > left)
        if not len(further):
            break
        byte = e["bytes"][order[further], place[order[further]] - left - 1].astype(np.int64)
        key = (group[order[further]] << 8) | byte
        by = np.argsort(key, kind="stable")
        old, key = further[by], key[by]
        together = np.flatnonzero(key[1:] == key[:-1])
        induced = np.zeros(len(old), shared.dtype)
        induced[together + 1] = 1 + least_between(shared, old[together], old[together + 1])
        order, shared = order[old], induced
    return masks


def dealt_blocks(docs: DataFrame) -> DataFrame:
    """block, payload: documents dealt to blocks by a hash, those of an Arrow batch that share a block compressed together."""
    blocks = shards_for(text_bytes(docs), BLOCK_BYTES)
    rows = docs.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), text_of().alias("text"))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, known, block = (batch.column(c).to_pylist() for c in ("doc_id", "known", "block"))
            of: dict[int, list[int]] = {}
            for i, b in enumerate(block):
                of.setdefault(b, []).append(i)
            texts = batch.column("text")
            packed = [pack_documents([ids[i] for i in mine], [known[i] for i in mine], [texts[i].as_py().encode() for i in mine]) for mine in of.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(of), pa.int32()), pa.array(packed, pa.binary())], names=["block", "payload"])

    return rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")).mapInArrow(compress, "block int, payload binary")


def shared_anchors(blocks: DataFrame, edges: np.ndarray) -> DataFrame:
    """block, shard, payload: bits of the block's anchor hashes in the shard's range that another block holds."""

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        block = Block(pdf)
        cuts = cuts_of(block.hashes, edges)
        rows = [(int(pdf["block"].iloc[0]), s, rice_encode(block.hashes[a:b] - (edges[s - 1] if s else np.uint64(0)))) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return pd.DataFrame(rows, columns=["block", "shard", "payload"])

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [rice_decode(x) for x in pdf["payload"]]
        everything = np.concatenate(parts)
        everything.sort()
        twice = np.unique(everything[1:][everything[1:] == everything[:-1]])
        return pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"], "payload": [pack_bits(np.isin(p, twice, assume_unique=True)) for p in parts]})

    fields = "block int, shard int, payload binary"
    return blocks.groupBy("block").applyInPandas(send, fields).groupBy("shard").applyInPandas(mark, fields)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of docs (doc_id, text; more columns are ignored).

    Bytes of a LENGTH-byte string that a document with a smaller doc_id holds are removed, as judged on the input.
    Null texts are empty; texts shorter than LENGTH lose nothing. Rows of one doc_id are no copies of each other, and a
    row with a null doc_id neither loses bytes nor makes others lose them. An empty table gives an empty result.
    """
    total = text_bytes(docs)
    edges = shard_edges(shards_for(total, SHARD_BYTES))
    blocks = dealt_blocks(docs)
    marks = shared_anchors(blocks, edges)
    fields = "block int, shard int, payload binary"

    def parts(pdf: pd.DataFrame, hashes: np.ndarray, make) -> pd.DataFrame:
        cuts = cuts_of(hashes, edges)
        rows = [(int(pdf["block"].iloc[0]), s, make(s, a, b)) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return pd.DataFrame(rows, columns=["block", "shard", "payload"])

    def joined(answers: pd.DataFrame, kind: int, dtype) -> np.ndarray:
        mine = answers[answers["kind"] == kind].sort_values("shard")
        return np.frombuffer(b"".join(mine["payload"]), dtype)

    def send_digests(pdf: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        block = Block(pdf)
        block.mark(marks, edges)

        def pack(s: int, a: int, b: int) -> bytes:
            code = rice_encode(block.entry_hash[a:b] - (edges[s - 1] if s else np.uint64(0)))
            return len(code).to_bytes(8, "little") + code + block.entry_digest[a:b].tobytes() + block.entry_doc[a:b].tobytes()

        number = int(pdf["block"].iloc[0])  # the block's own bits pass through the shards, in groups of their own
        own = pd.DataFrame([(number, -1 - number, pack_bits(block.shared))], columns=["block", "shard", "payload"])
        return pd.concat([parts(pdf, block.entry_hash, pack), own])

    def classes(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["shard"].iloc[0] < 0:
            return pdf
        found = []
        for blob in pdf["payload"]:
            size = int.from_bytes(blob[:8], "little")
            h = rice_decode(blob[8 : 8 + size])
            found.append((h, np.frombuffer(blob, "<u8", len(h), 8 + size), np.frombuffer(blob, "<i8", len(h), 8 + size + 8 * len(h))))
        h, digest, doc = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((doc, digest, h))
        hs, ds = h[order], digest[order]
        anchor = np.r_[True, hs[1:] != hs[:-1]]
        stretch = anchor | np.r_[True, ds[1:] != ds[:-1]]
        first = np.maximum.accumulate(np.where(stretch, np.arange(len(hs)), 0))
        group = np.cumsum(anchor) - 1
        several = np.bincount(group, stretch)[group] > 1
        state = np.empty(len(h), np.uint8)
        state[order] = np.where(doc[order] > doc[order][first], COVERED, np.where(several, WANTED, ALONE))
        ends = np.cumsum([len(f[0]) for f in found])
        return pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"], "payload": [state[e - len(f[0]) : e].tobytes() for f, e in zip(found, ends)]})

    def send_bytes(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(pdf)
        block.recall(answers)
        packed = pack_entries(block, np.flatnonzero(joined(answers, 1, np.uint8) == WANTED))
        return parts(pdf, packed["hash"], lambda s, a, b: packed[a:b].tobytes())

    def sort(pdf: pd.DataFrame) -> pd.DataFrame:
        queue, sizes = SpillQueue(), []
        for r, blob in enumerate(pdf["payload"]):
            run = np.frombuffer(blob, ENTRY).copy()
            run["run"], run["number"] = r, np.arange(len(run))
            sizes.append(len(run))
            queue.push(run)
        out = [np.zeros(n, np.uint32) for n in sizes]
        for part in queue.groups():
            masks = induced_windows(part)
            by = np.argsort(part["run"], kind="stable")
            runs = part["run"][by]
            starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
            for a, b in zip(starts, np.r_[starts[1:], len(by)]):
                out[runs[a]][part["number"][by[a:b]]] = masks[by[a:b]]
        return pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"], "payload": [m.tobytes() for m in out]})

    def cut(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(pdf)
        block.recall(answers)
        state = joined(answers, 1, np.uint8)
        masks = np.zeros(len(state), np.uint32)
        masks[state == WANTED] = joined(answers, 2, np.uint32)
        windows = covered_windows(block, state, masks)
        rows = [(int(d), *removed(t, windows[a : max(a, b - LENGTH + 1)])) for d, t, a, b in zip(block.ids, block.texts, block.starts, block.starts[1:])]
        rows += [(None, *removed(t, np.zeros(0, bool))) for t in block.free]
        ids, *rest = zip(*rows)
        return pd.DataFrame({"doc_id": pd.array(ids, "Int64"), **dict(zip(["n_bytes", "n_removed", "n_spans", "kept_sha256"], rest))})

    of = lambda df, kind: df.withColumn("kind", F.lit(kind))
    sent = blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInPandas(send_digests, fields)
    states = durable(sent.groupBy("shard").applyInPandas(classes, fields))
    known = states.withColumn("kind", F.when(F.col("shard") < 0, 0).otherwise(1))
    wanted = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(send_bytes, fields)
    answers = known.unionByName(of(wanted.groupBy("shard").applyInPandas(sort, fields), 2))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def covered_windows(block: Block, state: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """For each place of the block's buffer: is the window that begins there covered?"""
    out = np.zeros(len(block.buffer) + 1, bool)
    entry, first, last = block.entry_of, block.first[block.hit], block.last[block.hit]
    whole = (block.ids[block.doc[block.hit]] > block.entry_doc[entry]) | (state[entry] == COVERED)
    change = np.zeros(len(out), np.int32)
    np.add.at(change, first[whole], 1)
    np.add.at(change, last[whole] + 1, -1)
    out |= np.cumsum(change) > 0
    some = np.flatnonzero(~whole & (masks[entry] > 0))
    for t in range(SPAN):
        out[first[some[(masks[entry[some]] >> np.uint32(t)) & 1 == 1]] + t] = True
    return out


def removed(text: bytes, windows: np.ndarray) -> tuple[int, int, int, str]:
    """n_bytes, n_removed, n_spans and the hash of what is left, from the windows that are covered."""
    hit = np.flatnonzero(windows)
    if not len(hit):
        return len(text), 0, 0, hashlib.sha256(text).hexdigest()
    change = np.zeros(len(text) + 1, np.int32)
    change[hit] += 1
    change[hit + LENGTH] -= 1
    gone = np.cumsum(change[:-1]) > 0
    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
    return len(text), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(text, np.uint8)[~gone].tobytes()).hexdigest()


def op2(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(documents(spark, sf_dir))
