"""Integer vectors from a table of embeddings, packed in blocks that many passes read."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

#: Bytes of one block at most; a vector of more has a block of its own.
BLOCK_BYTES = 4 << 20
#: Entries must lie below, so that sums of squared differences are exact in a long.
LARGEST = 1 << 27


def finite(column: str) -> Column:
    """True for a vector that is not null and has neither null nor non-finite entries."""
    whole = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.col(column).isNotNull() & F.coalesce(whole, F.lit(False))


def scaled(column: str, scale: int) -> Column:
    """floor(scale * c) of each entry c as a double: longs."""
    return F.transform(column, lambda c: F.floor(c.cast("double") * float(scale)))


def entries(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    """A column of vectors of `width` longs as a matrix."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def blocks(vectors: DataFrame, width: int) -> DataFrame:
    """vectors: x (array of `width` longs) -> block (binary): the same vectors, in matrices of little-endian longs, written to the shared folder."""
    step = max(1, BLOCK_BYTES // (8 * width))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = entries(batch, "x", width)
            yield pa.RecordBatch.from_arrays([pa.array([x[i : i + step].astype("<i8").tobytes() for i in range(0, len(x), step)], pa.binary())], names=["block"])

    return durable(vectors.select("x").mapInArrow(pack, "block binary"))


def summed(packed: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of of(block) over all blocks, an array of a fixed size, in doubles or (exactly) longs.

    Each task adds up its own blocks; the tasks' arrays are added place by place in a shuffle, so the driver gets one number
    for each place, however many tasks there are. Longs that overflow are an error.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for blob in batch.column("block"):
                part = of(np.frombuffer(blob.as_buffer(), "<i8").reshape(-1, width)).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["place", "v"])

    found = packed.mapInArrow(add, f"place int, v {kind}").groupBy("place").agg(F.sum("v").alias("v")).orderBy("place").collect()
    return np.array([r["v"] for r in found], np.int64 if kind == "long" else np.float64)
