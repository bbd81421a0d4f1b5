"""A corpus pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes every result to the shared
folder and reads it again as the next stage's input. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import exact_dedup, mixing, near_dup, packing, toxicity
from larkspur.llm.queries import byte_bpe
from larkspur.llm.shared import table, written


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. Without labelled rows, and for null or empty texts, the model rejects nothing."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), modulus=4, held_out=2)
    return toxicity.without_toxic(docs, model)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays (of null ids one row); null and empty texts are equal."""
    return exact_dedup.deduplicate(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar texts the smallest doc_id stays, null last; texts without words have no class but their copies'."""
    return near_dup.one_of_each(docs, threshold=0.8, words=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; rows without words once per whole epoch of their source, a null source is a source of its own."""
    return mixing.mixed_rows(docs, weights=(5, 2, 1), max_epochs=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence; a null or empty text is one piece of the end token; repeated rows are packed each."""
    return packing.packed(docs, *byte_bpe())


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("near_dup", remove_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned models, tokenizers and sampling keys have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
