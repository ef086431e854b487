"""Best-fit packing of token sequences by bin completion.

Documents are tokenized in Arrow functions, cut into pieces of at most CAPACITY ids, and dealt evenly to shards, whatever
their doc_id; pieces as long as a sequence stay where they are. A shard packs by bin completion over the counts of each
length: the bin of the largest piece is closed with the undominated filling of least waste, bin after bin; then windows of
the worst bins are searched for a packing with one bin less, whose branches are cut once their waste passes what it may
waste. Best-fit packings are the incumbents. Shards hold about SHARD documents at every size of the table, so each adds one
open bin at most.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, durable, shards_for, text_of
from .token_counts import balanced, model_path

MODEL, CAPACITY, SHARD = "word_bpe_49k.json", 2048, 20_000
#: Branches that the search of a shard tries for each of its bins, and for one window.
NODES_A_BIN, NODES_A_WINDOW = 3, 400
#: Fillings of one bin that are tried, and bins of a window at most.
WIDTH, WINDOW = 4, 48
SPACES = re.compile(r"[ \n\t\r]+")
#: Characters that Python takes for white space and the tokenizer doesn't.
ODD = "\x1c\x1d\x1e\x1f"
#: Between a letter and these marks the tokenizer always cuts.
MARKS = re.compile(r"(?=[!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~])(?<=[a-zß-öø-ÿ])")
BATCH_BYTES, MEMORY_UNITS = 4 << 20, 250_000
#: What the tokenizer's closing ids of a word end with, and words that are encoded as one text.
END, TOGETHER = "</w>", 4000


def latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def units(text: str) -> list[str]:
    if "<" in text or not latin(text):
        return SPACES.split(text)
    low = MARKS.sub(" ", text.lower())
    return SPACES.split(low) if any(c in low for c in ODD) else low.split()


def one_word(unit: str) -> bool:
    """Letters of Latin-1 only, which the tokenizer takes together."""
    return unit.isalpha() and latin(unit)


class Encoder:
    """Ids of texts as little-endian bytes.

    Texts are cut at ASCII white space, which the tokenizer drops and merges never cross; each distinct unit is encoded
    once. Texts of Latin-1 characters, which lower-casing changes one by one and composition leaves alone, are
    lower-cased first, as the tokenizer would, and cut between letters and marks too; "<" may open a special string.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.old = Tokenizer.from_file(path), {}, {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(END)]] = True

    @classmethod
    @cache
    def of(cls, path: str) -> Encoder:
        """One encoder for all tasks of a Python worker."""
        return cls(path)

    def _learn(self, new: list[str]) -> None:
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            for u, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[u] = np.array(e.ids, "<u4").tobytes()

    def _learn_words(self, words: list[str]) -> None:
        """Words, each of which the tokenizer takes as one: they are encoded as one text, and each ends with a closing id."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(ends) != len(words):
            return self._learn(words)
        whole = ids.tobytes()
        self.known.update((w, whole[4 * a : 4 * b]) for w, a, b in zip(words, [0, *ends], ends))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > MEMORY_UNITS:  # units that were not met since the last time are forgotten
            self.known, self.old = {}, self.known
        cut, old = [units(t) for t in texts], self.old
        fresh = {u for us in cut for u in us if u not in self.known}
        self.known.update((u, old[u]) for u in fresh if u in old)
        new = [u for u in fresh if u not in old]
        words = [u for u in new if one_word(u)]
        for at in range(0, len(words), TOGETHER):
            self._learn_words(words[at : at + TOGETHER])
        self._learn([u for u in new if not one_word(u)])
        get = self.known.__getitem__
        return [b"".join(map(get, us)) for us in cut]


def pieces(docs: DataFrame, model: str = MODEL, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of each document: its ids and a closing 0, cut only when longer than the capacity."""
    path, kind = model_path(model), docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, step = Encoder.of(path), 4 * capacity
        for batch in batches:
            texts, rows = batch.column("text"), []

            def sized():
                for i in range(len(texts)):
                    text = texts[i].as_py()
                    yield i, len(text), text

            for group in balanced(sized(), BATCH_BYTES):
                for (i, _, _), ids in zip(group, encoder.encode([t for _, _, t in group])):
                    ids += b"\0\0\0\0"
                    rows += [(i, p, at // 4, min(step, len(ids) - at) // 4, zlib.crc32(ids[at : at + step])) for p, at in enumerate(range(0, len(ids), step))]
            of, number, start, length, crc = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(of, pa.int32())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Pool:
    """Lengths that are left, with counts; the distinct ones in order."""

    def __init__(self, lengths: dict[int, int]):
        self.count, self.order = dict(lengths), sorted(lengths)

    def take(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            del self.count[length]
            self.order.pop(bisect_right(self.order, length) - 1)

    def put(self, length: int) -> None:
        if length not in self.count:
            self.count[length] = 0
            self.order.insert(bisect_right(self.order, length), length)
        self.count[length] += 1

    def fit(self, room: int) -> int:
        """The largest length of at most `room`, or 0."""
        at = bisect_right(self.order, room)
        return self.order[at - 1] if at else 0


def best_fit(lengths: dict[int, int], capacity: int) -> list[list[int]]:
    """Each bin takes the largest piece left and then, again and again, the one that fits best."""
    pool, bins = Pool(lengths), []
    while pool.order:
        room, held = capacity, []
        while one := pool.fit(room):
            pool.take(one)
            held.append(one)
            room -= one
        bins.append(held)
    return bins


def pairs(pool: Pool, room: int, width: int) -> list[list[int]]:
    """The `width` pairs of pieces, the larger first, that leave the least of a room."""
    order = np.array(pool.order[: bisect_right(pool.order, room)], np.int64)
    at = np.minimum(np.searchsorted(order, room - order, "right"), np.arange(1, len(order) + 1)) - 1
    at -= np.array([a == i and pool.count[x] == 1 for i, (a, x) in enumerate(zip(at.tolist(), order.tolist()))], np.int64)
    fits = np.flatnonzero(at >= 0)
    waste = room - order[fits] - order[at[fits]]
    best = fits[np.lexsort((-order[fits], waste))[:width]]
    return [[int(order[i]), int(order[at[i]])] for i in best]


def fillings(pool: Pool, room: int, width: int = WIDTH) -> list[tuple[int, list[int]]]:
    """Undominated ways to fill a room, the least waste first: (waste, lengths in descending order), `width` at most.

    A filling is dominated when one more piece fits, or one of its pieces could be swapped for a larger one that is left
    and still fits. Tried are the best single piece, the best pairs, and the largest pieces with the best pairs beside
    each; what is then open is closed by best fit.
    """
    starts: list[list[int]] = [[]]
    starts += pairs(pool, room, width)
    first = pool.fit(room)
    for _ in range(width):
        if not first:
            break
        pool.take(first)
        starts += [[first, *p] for p in pairs(pool, room - first, width)]
        pool.put(first)
        first = pool.fit(first - 1)
    found: dict[tuple[int, ...], int] = {}
    for start in starts:
        held, left = list(start), room - sum(start)
        for x in start:
            pool.take(x)
        while one := pool.fit(left):
            pool.take(one)
            held.append(one)
            left -= one
        for x in held:
            pool.put(x)
        found[tuple(sorted(held, reverse=True))] = left
    return sorted(((w, list(f)) for f, w in found.items()), key=lambda f: (f[0], len(f[1]), f[1]))[:width]


def lower_bound(lengths: dict[int, int], capacity: int) -> int:
    """The larger of the sum bound and, over the halves, the bound that counts pieces too large to share a bin."""
    order = sorted(lengths)
    best = -(-sum(x * c for x, c in lengths.items()) // capacity)
    for k in {x for x in order if 2 * x <= capacity} | {0}:
        big = sum(c for x, c in lengths.items() if x > capacity - k)
        middle = [(x, c) for x, c in lengths.items() if capacity - k >= x > capacity // 2]
        small = sum(x * c for x, c in lengths.items() if capacity // 2 >= x >= k)
        n = sum(c for _, c in middle)
        spare = n * capacity - sum(x * c for x, c in middle)
        best = max(best, big + n + max(0, -(-(small - spare) // capacity)))
        if len(order) > 400 and best > big + n:  # the sum bound rules when lengths are many
            break
    return best


def counts_of(lengths: list[int]) -> dict[int, int]:
    values, counts = np.unique(np.array(lengths, np.int64), return_counts=True)
    return dict(zip(values.tolist(), counts.tolist()))


def dive(lengths: dict[int, int], capacity: int) -> list[list[int]]:
    """Bin after bin: the largest piece left and the filling of least waste beside it."""
    pool, bins = Pool(lengths), []
    while pool.order:
        largest = pool.order[-1]
        pool.take(largest)
        _, held = fillings(pool, capacity - largest)[0]
        for x in held:
            pool.take(x)
        bins.append([largest, *held])
    return bins


def search(lengths: dict[int, int], capacity: int, most: int, nodes: int) -> tuple[list[list[int]] | None, int]:
    """A packing in at most `most` bins, if `nodes` branches find one, and the branches tried. Depth first, the least waste first."""
    allowed = most * capacity - sum(x * c for x, c in lengths.items())
    pool, bins, tried = Pool(lengths), [], 0
    if allowed < 0:
        return None, 0
    stack: list[Iterator[tuple[int, list[int]]]] = []
    wasted: list[int] = []

    def ways() -> Iterator[tuple[int, list[int]]]:
        largest = pool.order[-1]
        pool.take(largest)
        found = [(w, [largest, *f]) for w, f in fillings(pool, capacity - largest)]
        pool.put(largest)
        return iter(found)

    while pool.order:
        if len(stack) == len(bins):
            stack.append(ways())
            tried += 1
        way = next((w for w in stack[-1] if sum(wasted) + w[0] <= allowed), None)
        if way and len(bins) < most:
            for x in way[1]:
                pool.take(x)
            bins.append(way[1])
            wasted.append(way[0])
            continue
        stack.pop()
        if not stack or tried >= nodes:
            return None, tried
        for x in bins.pop():
            pool.put(x)
        wasted.pop()
    return bins, tried


def complete(lengths: dict[int, int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bin completion: bins of lengths, as few as the search finds; best-fit packings are the incumbents.

    The branches that may be tried grow with the number of bins, so shards of every size are searched alike.
    """
    bins, least = best_fit(lengths, capacity), lower_bound(lengths, capacity)
    if len(bins) > least:
        bins = min(bins, dive(lengths, capacity), key=len)
    budget, at = NODES_A_BIN * len(bins), 0
    while len(bins) > least and budget > 0:
        bins.sort(key=sum)  # the bins with the most waste first
        window, room = [], 0
        while at + len(window) < len(bins) and len(window) < WINDOW:
            window.append(bins[at + len(window)])
            room += capacity - sum(window[-1])
            if room >= capacity and len(window) >= WINDOW // 4:
                break
        if room < capacity:  # no window from here on can lose a bin
            break
        found, tried = search(counts_of([x for b in window for x in b]), capacity, len(window) - 1, min(budget, NODES_A_WINDOW))
        budget -= max(1, tried)
        if found:
            bins[at : at + len(window)] = found
            at = 0
        else:
            at += len(window) // 2
    return bins


def pack(found: DataFrame, capacity: int = CAPACITY, shard_documents: int = SHARD) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, length of 1 to capacity, more columns).

    Sequences have no gaps and no piece is dropped; pieces of one length are exchangeable. Rows are dealt by their place in
    `found`, which has to be a written table, so that a doc_id on many rows is in many shards. The number of shards follows
    from the number of documents' last pieces.
    """
    shards = shards_for(found.where(f"length < {capacity}").count(), shard_documents)

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["_shard"].iloc[0])
        pdf = pdf.drop(columns="_shard").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        bins = complete(counts_of(lengths), capacity)
        placed = np.array([(x, s, o) for s, held in enumerate(bins) for x, o in zip(held, np.cumsum([0, *held[:-1]]).tolist())], np.int64).reshape(-1, 3)
        placed = placed[np.argsort(placed[:, 0], kind="stable")]
        mine = np.argsort(lengths, kind="stable")
        out = np.empty((len(pdf), 2), np.int64)
        out[mine] = placed[:, 1:]
        return pdf.assign(sequence_id=(shard << 32) + out[:, 0], offset=out[:, 1])

    kind, row = found.schema["doc_id"].dataType, F.monotonically_increasing_id()
    whole = found.where(f"length >= {capacity}").withColumns({"sequence_id": F.lit(1 << 62) + row, "offset": F.lit(0).cast("long")})
    rest = found.where(f"length < {capacity}").withColumn("doc_id", F.col("doc_id").cast("string"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    dealt = rest.withColumn("_shard", F.pmod(F.xxhash64(row), F.lit(shards)).cast("int"))
    placed = dealt.groupBy("_shard").applyInPandas(place, f"{fields}, sequence_id long, offset long")
    return placed.withColumn("doc_id", F.col("doc_id").cast(kind)).unionByName(whole)


def pack_documents(docs: DataFrame, model: str = MODEL, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of each row of docs.

    docs: doc_id, text; more columns are ignored. Null and empty texts are one piece, the closing 0 alone. Rows that
    repeat a doc_id are packed each. An empty table gives an empty result.
    """
    return pack(durable(pieces(docs, model, capacity)), capacity)


def op1(spark, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
