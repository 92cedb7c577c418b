"""The operators applied to the tables of a data folder, by their contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.llm.common import held_out, small_batches, table
from ampere.llm.conversation_repair import repair_conversations
from ampere.llm.exact_dedup import exact_groups
from ampere.llm.html_extract import extract_main_text
from ampere.llm.language_id import fit_language_id, identify_language
from ampere.llm.mixing import mix_sources
from ampere.llm.packing import pack_documents
from ampere.llm.quality_classifier import classify_quality
from ampere.llm.quality_rules import apply_rules
from ampere.llm.sharding import shard_documents
from ampere.llm.simhash import near_dup_components
from ampere.llm.suffix_dedup import remove_repeats
from ampere.llm.token_align import align_documents
from ampere.llm.toxicity import fit_toxicity, toxicity

N_SHARDS, SEQUENCE = 40, 2048


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file (a parameter of the operators); packing counts by the byte-level one."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labelled rows that aren't held out."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out())
    model = fit_toxicity(docs, labels)
    return (docs.select("doc_id", held_out().alias("held_out"), toxicity(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents; every row with its digest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_groups(docs, digest_all=True)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that aren't held out."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_language_id(docs.filter(~held_out()))
    return identify_language(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes; equal texts stay together."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_documents(docs, N_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    small_batches(spark)
    return extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    small_batches(spark)
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), SEQUENCE)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, 2 bits."""
    small_batches(spark)
    return near_dup_components(table(spark, sf_dir, "documents").select("doc_id", "text"), n_words=3, max_bits=2)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document; strata are the languages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return apply_rules(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), stratum=F.col("lang"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target weights."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that occur again, removed from every document."""
    small_batches(spark)
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned tokens of two tokenizers in every document, with corpus-wide counts of the linked pairs."""
    small_batches(spark)
    return align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(),
                           tokenizer_path("piece_bpe_32k.model"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every damaged conversation."""
    small_batches(spark)
    return repair_conversations(table(spark, sf_dir, "conversations"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labelled rows that aren't held out."""
    small_batches(spark)
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~fold)
    scored = classify_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline at the repository's top."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_exact_dedup, op3_language_id, op4_sharding, op5_html_extraction, op6_packing, op7_simhash_dedup,
    op8_quality_rules, op9_mixing, op10_suffix_dedup, op11_token_alignment, op12_conversation_repair,
    op13_quality_classifier, pipeline)}

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

ORACLE = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_NORM}) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
}
