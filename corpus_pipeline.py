"""A corpus from raw documents to packed batches: rules, near-duplicates, personal data, mix, packing.

Every stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next
one's ``docs``. All but the last return the columns of ``documents``. An empty table passes every stage
and gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortbench.llm import mixing, packing, pii, quality, simhash
from cohortbench.llm.common import checkpoint_root, columns_of, with_place


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no quality rule rejects.

    Absent and empty texts fail the rules; long ones are measured whole. Repeated rows are judged alike.
    """
    kept = quality.judged(docs).where("failed is null")
    return kept.select(*columns_of(kept))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest id, absent ids last.

    Repeated rows are one group; texts without words are another.
    """
    return simhash.first_of_each(docs)


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its personal data replaced by their kind; absent texts stay absent."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, in mixed order; documents of small sources come again.

    An absent source is a source of its own; rows without an id are rows like any others.
    """
    return mixing.mixed_documents(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences with their bucket, batch, slot and text; the batches of a bucket follow the mix.

    An empty text is a sequence of its end mark; a long one is cut into chunks, whole when joined.
    """
    return packing.pack(with_place(docs), with_text=True, placed=("__part", "__row_place"))


STAGES = [("quality rules", keep_good), ("simhash near-dedup", keep_first), ("personal data", hide_personal),
          ("source mix", mix_sources), ("length packing", pack_batches)]

#: Hashes, reliabilities and schedules of the stages are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = f"{checkpoint_root(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
