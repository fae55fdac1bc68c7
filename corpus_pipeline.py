"""A corpus pipeline over documents: quality classifier, quality rules, line dedup, near-duplicate join, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of documents. A
stage's result is written as Parquet in the shared folder and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import kn_quality, line_dedup, ngram_join, packing, rule_cascade
from panelspark.llm._graph import cut, drop

WORD = r"[^\x20\x09-\x0D]"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose perplexity stays under their language's threshold. Rows with a null id stay, rows of one id go together; a null or empty text is judged by its
    end mark; without trusted labels all rows stay; no rows give none; all columns stay."""
    return kn_quality.keep_trusted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose whole text passes every rule. A null or empty text has no words and goes; repeated rows are judged alike; null ids, any length and all columns stay as they are."""
    return rule_cascade.keep_good(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier in the corpus go, and so do rows that lose all their words by it; n_chars follows the text."""
    words = F.coalesce(F.col("text").cast("string").rlike(WORD), F.lit(False))
    done = line_dedup.dedup_lines(docs.withColumn("__words", words)).where(~F.col("__words") | words).drop("__words")
    return done.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents linked at 0.8 of their five-word shingles: that of the least id. Rows without words are linked with nothing; all columns stay."""
    return ngram_join.keep_one(docs, n=5, threshold=(4, 5))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1,024 tokens, as `op1_packing` gives them; a null text is its end mark alone, no rows give none."""
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", near_duplicates),
    ("packing", packed),
]

# The model, the token ids and the edit join have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again; a stage's table goes once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
        if before is not None:
            drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
