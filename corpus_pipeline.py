"""From documents to packed training sequences.

Each stage is a function of (spark, docs, sf_dir) that works on all rows its predecessor
kept. All but the last return the columns of documents, of the rows that stay.

Null and empty texts have no language and go in the first stage. Rows of equal id and text are
one document and share every decision until the near-dedup stage keeps one of them; of equal
texts the smallest id stays, a null id counts as the largest. Texts of any length are read
whole. An empty table gives an empty one, and other columns are kept, whatever their names.
"""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, language_id, line_dedup, packing, simhash_dedup
from tidemark.llm.common import crc_mod
from tidemark.session import store


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, no language with a probability of one half, or a code
    longer than the text itself, as in a language that was not learned."""
    model = language_id.train(docs.where(crc_mod("doc_id", 4) != 2))
    return language_id.keep_known(docs, model)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, or are one word away from it, go from the texts;
    documents that lose all their lines go."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return simhash_dedup.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens' pieces and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", distinct_lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

#: Trees of byte contexts, tokens and the packing plan cannot be said in SQL; the tests hold
#: the pipeline against plain versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
