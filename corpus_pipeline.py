"""A corpus pipeline: documents pass stage after stage, each written as Parquet and read again by the next.

Bad documents go, later copies of line runs are cut, one document of each near-duplicate group stays (five-word shingles,
similarity 0.8), documents with a passage of the benchmark go, and what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import bpe, common, decontaminate, jaccard, line_dedup, quality_classifier
from tidewright.llm.queries import read, tokenizer
from tidewright.llm.scratch import landed


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance-resampling classifier keeps."""
    common.small_batches(spark)
    return quality_classifier.keep_good(docs, read(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of lines, single ones included; one that loses all its words goes.

    Lines without a word stay, so that paragraphs stay apart.
    ``n_chars`` follows the text.
    """
    cut = line_dedup.remove_repeated_lines(docs, min_lines=1, keep_blank=True)
    left = cut.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", length).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    common.small_batches(spark)
    return jaccard.keep_one(docs, k=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a ten-word window of the benchmark."""
    common.small_batches(spark)
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"), n=10)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (packed little-endian unsigned 32-bit integers), and whether they decode to the text."""
    path, pattern = tokenizer()
    both = bpe.decode(bpe.encode(docs, path, pattern), path, pattern)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return both.select("doc_id", "lang", "source", "n_tokens", "token_ids", same.alias("lossless"))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", tokens),
]

#: The classifier and the tokenizer have no SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
