"""Bounded training samples for the classifiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, text_of


def sample(docs: DataFrame, labels: DataFrame, label: str, zeros: int, ones: int) -> pd.DataFrame:
    """text, y of at most `zeros` and `ones` labelled rows outside the held-out fifth, in an order that is a hash of doc_id.

    The bounds are on the rows a model is fitted to; their texts are whole. Of a doc_id that
    several rows of docs share, the least text is taken. Rows are the same on each run.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col(label).cast("int").alias("y")).dropDuplicates(["doc_id"])
    picked = None
    for y, n in ((0, zeros), (1, ones)):
        part = known.where(F.col("y") == y).withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(n)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id", "_h", "y").agg(F.min("text").alias("text"))
    return rows.toPandas().sort_values(["_h", "doc_id"], ignore_index=True)[["text", "y"]]
