"""Labelled rows for the classifiers: which may be learnt from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(mod: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == rest, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, out: Column, rows: int, most_bytes: int) -> DataFrame:
    """doc_id, text, label of at most ``rows`` learnable labelled rows of each class.

    Rows are taken by a hash of their id, so the sample does not depend on storage. A row labelled twice
    counts as 1 if either label is 1. Texts over ``most_bytes`` are not learnt from. Of several rows under one id the
    smallest text is taken, so ``2 * rows`` rows come back at most.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(~out)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(*order).limit(rows)
        some = part if some is None else some.union(part)
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= most_bytes)
    found = texts.join(F.broadcast(some), "doc_id")  # 2 * rows ids at most
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
