"""A training corpus from the documents table: five stages, each written as Parquet and read again.

Documents that are toxic, near copies of others, or hold benchmark passages go; what is left is mixed to
the sources' target weights and dealt to shards. The last stage's rows are the documents with their places.

Defined cases: documents without text pass the first three stages and are in no mix; rows that are alike in id and
text are one document to the second stage; a null source is a source; columns beyond the table's own pass
through, and the last stage keeps one called size, shard or slot as own_size, own_shard or own_slot; empty tables
give no rows at every stage; texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from gristmill.llm.common import discard, keep, scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit, by a lexicon learned from the labels of these documents that aren't held out."""
    return toxicity.mark_toxic(docs, toxicity.learn_weights(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group linked at 80% of five-word shingles."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words that a benchmark item has too."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often, 0 to 2 times, as the mix takes its words."""
    return mixing.mixed_documents(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with size, shard and slot; the shards' bytes are near equal."""
    return sharding.histogram_shard(docs, shards=16)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", deal_shards),
]

#: The first stage is learned, so SQL can't express the whole; tests/llm/test_pipeline_rows.py holds each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's own tables go when it has been written, and its predecessor's table then too."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as written:
        for name, stage in STAGES[:-1]:
            with scratch(spark):
                docs = keep(stage(spark, docs, sf_dir), name, lasting=1)
            discard(spark, written[:-1])
            del written[:-1]
        written.clear()  # what the last stage reads stays
    return STAGES[-1][1](spark, docs, sf_dir)
