"""The registered query of every operator, with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, lines, mixing
from millrace.llm.bpe import encode_documents
from millrace.llm.fingerprints import SENTENCES, compare_versions
from millrace.llm.hyperplanes import near_vectors
from millrace.llm.language import identify
from millrace.llm.minhash import near_duplicates
from millrace.llm.suffixes import remove_repeats
from millrace.llm.wrappers import extract_main_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document at similarity 0.75 on 5-word shingles. Not SQL: tested by brute force."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link counts and components of all vectors at cosine 0.98. Not SQL at this size: tested by brute force."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without bytes of 50-byte strings that an earlier one holds. Not SQL at this size: tested by brute force."""
    got = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return got.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages through the wrappers of their hosts. Not SQL: tested on written pages."""
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and edited versions, and their likeness. Not SQL: tested by set comparison."""
    got = compare_versions(table(spark, sf_dir, "documents"), paragraph=SENTENCES)
    return got.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def word_bpe_file() -> str:
    """The tokenizer file of the registered query; ``encode_documents`` takes any path."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op10_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of all documents as digests. Not SQL: tested against the tokenizers library."""
    got = encode_documents(table(spark, sf_dir, "documents"), word_bpe_file())
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from four fifths of them. Not SQL: tested by held-out accuracy."""
    return identify(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later occurrences of three-line windows, with line counts."""
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("text_hash")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted and read back."""
    tricky = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(chat.TRICK).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_conversations(rows.unionByName(tricky)))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op5_source_mixing": op5_source_mixing,
    "op6_chat_formatting": op6_chat_formatting,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_document_fingerprints": op9_document_fingerprints,
    "op10_bpe_encode_decode": op10_bpe_encode_decode,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": lines.sql(),
    "op5_source_mixing": mixing.sql(),
    "op6_chat_formatting": chat.SQL,
}
