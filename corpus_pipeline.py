"""The corpus pipeline: filtering, dedup, mixing and packing of documents.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage
before kept, and calls one operator of ``ampere.llm``. ``run`` writes each
stage's result to the shared checkpoint folder as Parquet and reads it back
as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.llm.common import small_batches, stored, table
from ampere.llm.exact_dedup import drop_copies
from ampere.llm.mixing import mixed_documents
from ampere.llm.packing import pack_documents
from ampere.llm.queries import SEQUENCE, tokenizer_path
from ampere.llm.simhash import drop_near_copies
from ampere.llm.toxicity import fit_toxicity, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5, learned from all labels of these documents."""
    small_batches(spark)
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return docs.filter(toxicity(model, F.col("text")) < 0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 2 bits)."""
    small_batches(spark)
    return drop_near_copies(docs, n_words=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix of the sources takes them."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048 tokens."""
    small_batches(spark)
    return pack_documents(docs, tokenizer_path(), SEQUENCE)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", exact_dedup), ("simhash_near_dedup", near_dedup),
          ("mixing", mix), ("packing", pack)]

#: Scores, fingerprints, tokens and packing have no SQL form; tests check the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
