"""The corpus pipeline: language ID, line dedup, near-dedup, mixing, tokenizing.

``STAGES`` are functions (spark, docs, sf_dir) -> DataFrame. Each works on all that its predecessor kept, written
as Parquet in between, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import encode_documents
from millrace.llm.language import keep_identified
from millrace.llm.lines import drop_repeated_lines
from millrace.llm.minhash import near_duplicates
from millrace.llm.mixing import mixed_documents
from millrace.llm.queries import word_bpe_file
from millrace.llm.shared import cut


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those that fit no language."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later occurrences of three-line windows; a document left without lines goes."""
    return drop_repeated_lines(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near-duplicates; of rows with equal id and text one. Rows without an id stay."""
    found = cut(near_duplicates(docs).select("doc_id", "kept"), "kept")
    gone = found.filter("NOT kept").select("doc_id").distinct()
    again = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id")
    single = docs.join(gone.unionByName(again).distinct(), "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.join(again.join(gone, "doc_id", "left_anti"), "doc_id", "left_semi").select(*docs.columns)
    return single.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the words that the target weights give each source, repeating documents where that is needed."""
    return mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return encode_documents(docs, word_bpe_file()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

#: SQL can't express language ID, near-dedup at this size or BPE; the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
