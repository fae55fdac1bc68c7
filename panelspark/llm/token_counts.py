"""Exact length histogram of encoded documents, with suffix sums for every context limit."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm._graph import cut
from panelspark.llm.bpe import shared_table

BUCKET = 256


def token_lengths(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row (length long) a document: its number of BPE ids; null and empty texts have 0."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        table = shared_table(vocabulary)
        return pd.Series([len(table.ids(t)) // 4 for t in texts], dtype="int64")

    return docs.select(count(F.col(text_col).cast("string")).alias("length"))


def length_histogram(lengths: DataFrame, length_col: str = "length") -> DataFrame:
    """(length, n_docs) of each length that occurs; null lengths are left out."""
    return lengths.groupBy(F.col(length_col).cast("long").alias("length")).agg(F.count("*").alias("n_docs")).where("length is not null")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Adds, for the context limit L = length: docs_over (longer than L), tokens_over (all tokens of those),
    truncated_total (sum of min(length, L) over all documents), total_tokens, total_docs and quantile
    (share of documents with at most L tokens).

    Between two neighbouring lengths the truncated total is linear in L with slope docs_over, so these rows
    answer every limit. Sums run inside buckets of BUCKET lengths, and a bucket's own suffix comes from
    the short table of bucket totals, so no window holds the whole histogram. An empty histogram gives no rows.
    """
    rows = histogram.select("length", "n_docs", F.expr("length * n_docs").alias("tokens"), F.expr(f"length div {BUCKET}").alias("bucket"))
    totals = rows.groupBy("bucket").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
    later = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "bucket",
        F.coalesce(F.sum("bd").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("bt").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("bd").over(everything).alias("total_docs"),
        F.sum("bt").over(everything).alias("total_tokens"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    over = rows.withColumn("d", F.coalesce(F.sum("n_docs").over(inside), F.lit(0))).withColumn("k", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    both = over.join(totals, "bucket").withColumns({"docs_over": F.expr("d + docs_later"), "tokens_over": F.expr("k + tokens_later")})
    return both.select(
        "length", "n_docs", "docs_over", "tokens_over",
        F.expr("total_tokens - tokens_over + docs_over * length").alias("truncated_total"),
        "total_docs", "total_tokens", ((F.col("total_docs") - F.col("docs_over")) / F.col("total_docs")).alias("quantile"),
    )


def token_counts(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Length histogram with suffix sums over all documents; repeated rows count each, an empty table gives no rows.

    The histogram, one row a length, is written once, since the suffix sums read it twice: texts are encoded a single time.
    """
    return suffix_sums(cut(length_histogram(token_lengths(docs, text_col, vocabulary))))


def answer(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, truncated_total) for any limits, from the suffix sums alone: the next greater length that
    occurs answers for a limit; beyond the longest, the total does."""
    asked = sums.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit long")
    pick = sums.select(F.explode(F.array(*[F.struct(F.lit(int(x)).cast("long").alias("context_limit"), F.when(F.col("length") >= int(x), F.col("length")).alias("at")) for x in limits])).alias("q"), "truncated_total", "docs_over", "n_docs", "length", "total_tokens").select("q.*", "truncated_total", "docs_over", "n_docs", "length", "total_tokens")
    best = pick.groupBy("context_limit").agg(F.min_by(F.struct("truncated_total", "docs_over", "n_docs", "length"), F.col("at")).alias("b"), F.max("total_tokens").alias("total"))
    value = F.when(F.col("b").isNull(), F.col("total")).otherwise(F.expr("b.truncated_total - (b.docs_over + b.n_docs) * (b.length - context_limit)"))
    return asked.join(best, "context_limit", "left").select("context_limit", F.coalesce(value, F.lit(0)).alias("truncated_total"))
