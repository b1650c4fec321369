"""From raw documents to a training mix: five stages over whole tables.

Each stage takes what its predecessor kept and returns the columns of documents, the last one also
the copies to take of each document.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nightledger.llm import benchmarks, mixing, setsketch, substrings, toxicity
from nightledger.llm.frames import ready, shared_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; learnt from the labelled ones among them."""
    ready(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    ready(spark)
    return setsketch.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that an earlier document has."""
    ready(spark)
    return substrings.remove_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items do not contaminate."""
    ready(spark)
    return benchmarks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of copies and the words taken."""
    ready(spark)
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_documents),
    ("near_duplicates", near_copies),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("source_mixing", source_mix),
]

ORACLE_SQL = None  # a trained classifier and a random rounding; tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
