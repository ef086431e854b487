"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Each input partition signs its texts: 64 bits to compare, SHA-256 to name a text. The signatures are written once.
2. Each partition deals its distinct 64-bit values to their owners (ranges of the value) as sorted Golomb-Rice codes.
3. An owner sends back to each partition a bitmap of the values that another partition holds too.
4. Values that the bitmap marks, or that the partition holds twice, are suspects. Their hashes set marks in a table of
   bits, and only texts whose hash is marked are shuffled: they are grouped by their bytes. Partial aggregation collapses a
   hot text in each task before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .codes import pack_bits, rice_decode, rice_encode, unpack_bits
from .common import ascii_lower, documents, durable, shards_for, text_of

#: Hashes that one owner compares in one task.
OWNER_HASHES = 2_000_000
#: Bits for each marked hash, all bits at most (32 MB, which is what a broadcast of them may take), and bits of one row.
BITS_EACH, MOST_BITS, CHUNK = 16, 1 << 28, 1 << 15
#: Groups of more than this share of the rows are hot; there are at most as many of them.
HOT_SHARE = 1000


def signed_columns() -> list[Column]:
    """src (the input partition), h and text_sha256 of a row's normalised text."""
    norm = ascii_lower(text_of())
    return [F.spark_partition_id().alias("src"), F.xxhash64(norm).alias("h"), F.sha2(norm, 256).alias("text_sha256")]


def signatures(docs: DataFrame) -> DataFrame:
    """src, h, text_sha256, doc_id of each row."""
    return docs.select(*signed_columns(), "doc_id")


def _counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, and how often each occurs."""
    values, counts = np.unique(hashes.astype(np.int64).view(np.uint64), return_counts=True)
    return values, counts


def _cuts(values: np.ndarray, owners: int) -> np.ndarray:
    """Where each owner's range of hashes starts in the sorted values."""
    step = (1 << 64) // owners
    return np.searchsorted(values, np.array([step * i for i in range(owners)], np.uint64)).tolist() + [len(values)]


@dataclass
class Marks:
    """Bits that marked hashes have set, in rows (_chunk, _bits) of CHUNK bits; another hash has its bit set by chance only."""

    rows: DataFrame
    bits: int

    def _met(self, rows: DataFrame) -> tuple[DataFrame, Column]:
        at = F.pmod(F.col("h"), F.lit(self.bits))
        met = rows.withColumn("_at", F.pmod(at, F.lit(CHUNK))).join(F.broadcast(self.rows), F.floor(at / CHUNK) == F.col("_chunk"), "left")
        byte = F.conv(F.hex(F.substring("_bits", (F.floor(F.col("_at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
        return met, F.col("_bits").isNotNull() & (F.getbit(F.coalesce(byte, F.lit(0).cast("long")), (F.col("_at") % 8).cast("int")) == 1)

    def passing(self, rows: DataFrame) -> DataFrame:
        """The rows (h, more columns) whose hash may be marked: all that are, and few others."""
        met, hit = self._met(rows)
        return met.where(hit).drop("_at", "_chunk", "_bits")

    def failing(self, rows: DataFrame) -> DataFrame:
        met, hit = self._met(rows)
        return met.where(~hit).drop("_at", "_chunk", "_bits")


def marks(hashes: DataFrame, n: int) -> Marks:
    """Marks of n hashes (h). Beyond MOST_BITS / BITS_EACH of them more others pass, which costs time and changes nothing."""
    bits = CHUNK
    while bits < min(BITS_EACH * n, MOST_BITS):
        bits *= 2
    at = F.pmod(F.col("h"), F.lit(bits))
    return Marks(hashes.groupBy(F.floor(at / CHUNK).alias("_chunk")).agg(F.bitmap_construct_agg(F.pmod(at, F.lit(CHUNK))).alias("_bits")), bits)


def suspects(signed: DataFrame, n: int) -> DataFrame:
    """The distinct h, text_sha256 of the rows, n in number, whose 64-bit hash occurs in more than one of them."""
    owners = shards_for(n, OWNER_HASHES)

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        values, _ = _counted(pdf["h"].to_numpy())
        cuts = _cuts(values, owners)
        step = (1 << 64) // owners
        rows = [(int(pdf["src"].iloc[0]), o, rice_encode(values[a:b] - np.uint64(step * o))) for o, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return pd.DataFrame(rows, columns=["src", "owner", "code"])

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [rice_decode(x) for x in pdf["code"]]
        values, where, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        twice, ends = counts[where] > 1, np.cumsum([len(p) for p in parts])
        return pd.DataFrame({"src": pdf["src"], "owner": pdf["owner"], "marks": [pack_bits(twice[e - len(p) : e]) for p, e in zip(parts, ends)]})

    def pick(mine: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        values, counts = _counted(mine["h"].to_numpy())
        cuts, flags = _cuts(values, owners), counts > 1
        for o, blob in zip(marks["owner"], marks["marks"]):
            flags[cuts[o] : cuts[o + 1]] |= unpack_bits(blob, cuts[o + 1] - cuts[o])
        hit = flags[np.searchsorted(values, mine["h"].to_numpy().astype(np.int64).view(np.uint64))]
        return mine.loc[hit, ["h", "text_sha256"]].drop_duplicates()

    sent = signed.select("src", "h").groupBy("src").applyInPandas(send, "src int, owner int, code binary")
    marks = sent.groupBy("owner").applyInPandas(mark, "src int, owner int, marks binary")
    return signed.select("src", "h", "text_sha256").groupBy("src").cogroup(marks.groupBy("src")).applyInPandas(pick, "h long, text_sha256 string").distinct()


def duplicate_groups(texts: DataFrame, signed: DataFrame, n: int) -> DataFrame:
    """h, text_sha256, keep_id, group_size of each group of equal texts (doc_id, text, h), grouped by the normalised texts' bytes.

    signed has their n signatures. Texts that pass by chance are alone in their group. A written table.
    """
    found = durable(suspects(signed, n))
    members = marks(found, found.count()).passing(texts).select("doc_id", ascii_lower(F.col("text")).alias("norm"))
    groups = members.groupBy("norm").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return durable(groups.where("group_size > 1").select(F.xxhash64("norm").alias("h"), F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"))


def with_groups(rows: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """rows (text_sha256, more) with keep_id and group_size of their group, or nulls; n is the number of all documents.

    Groups of more than a HOT_SHARE-th of the documents, HOT_SHARE at most, are broadcast, so no task gets their rows.
    """
    hot = groups.where(F.col("group_size") * HOT_SHARE > n).select("text_sha256", "keep_id", "group_size")
    cold = groups.where(F.col("group_size") * HOT_SHARE <= n).select("text_sha256", "keep_id", "group_size")
    met = rows.join(F.broadcast(hot), "text_sha256", "left")
    return met.where("group_size IS NOT NULL").unionByName(met.where("group_size IS NULL").drop("keep_id", "group_size").join(cold, "text_sha256", "left"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of each row of docs (doc_id, text; more columns are ignored).

    Texts are equal when identical after lower-casing A-Z. The largest doc_id of a group stays. Null texts are empty
    texts; all empty texts are one group. Rows that repeat both doc_id and text stay or go together. A null doc_id
    loses to any other. An empty table gives an empty result.
    """
    signed = durable(signatures(docs))
    n = signed.count()
    texts = docs.select("doc_id", text_of().alias("text"), F.xxhash64(ascii_lower(text_of())).alias("h"))
    found = with_groups(signed.select("doc_id", "text_sha256"), duplicate_groups(texts, signed, n), n)
    return found.select(
        "doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns, by the rules of `exact_dedup`; null texts are empty texts.

    The documents are written with their signatures once. Texts without a mark of a group stay where they are; the others
    meet their groups by SHA-256. Rows that repeat both
    doc_id and text stay together. An empty table gives an empty result.
    """
    named = [F.col(f"`_doc_{c}`").alias(c) for c in docs.columns]
    rows = durable(docs.select(*[F.col(f"`{c}`").alias(f"_doc_{c}") for c in docs.columns], *signed_columns()))
    n = rows.count()
    texts = rows.select(F.col("_doc_doc_id").alias("doc_id"), text_of("_doc_text").alias("text"), "h")
    groups = duplicate_groups(texts, rows.select("src", "h", "text_sha256"), n)
    marked = marks(groups, groups.count())
    kept = with_groups(marked.passing(rows), groups, n).where(F.col("group_size").isNull() | F.col("_doc_doc_id").eqNullSafe(F.col("keep_id")))
    return marked.failing(rows).select(*named).unionByName(kept.select(*named))


def op8(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


OP8_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""
