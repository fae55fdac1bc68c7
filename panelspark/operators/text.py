"""Statistics over free text, after contacts are scrubbed."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelspark.functions import columns as C


def description_statistics(rows: DataFrame, text: str) -> DataFrame:
    """Q23: texts, median and 90th percentile of characters, words and sentences; one row."""
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    sentences = F.size(F.filter(F.split(text, r"[.!?\n]+"), lambda s: F.trim(s) != ""))
    m = rows.where(F.col(text).isNotNull()).select(F.length(text).alias("chars"), words.alias("words"), sentences.alias("sentences"))
    two = lambda c: (F.round(F.median(c), 4).alias(f"median_{c}"), F.round(F.percentile(c, F.lit(0.9)), 4).alias(f"p90_{c}"))
    return m.agg(F.count("*").alias("texts"), *two("chars"), *two("words"), *two("sentences"))


def frequent_ngrams(rows: DataFrame, key: str, words: Column, n: int = 1, top: int = 50) -> DataFrame:
    """Q24: the most frequent n-grams with the number of texts that have them; ties go by the term.

    A row that has its key for itself counts its n-grams in place, so only a task's counts by term are shuffled; rows that share
    a key are one text and meet by (key, term) first.
    """
    base = rows.select(F.col(key).alias("k"), words.alias("w")).where(F.size("w") >= n)
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda i: F.array_join(F.slice("w", i, n), " "))
    shared = rows.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("rows")).where("rows > 1 and k is not null").select("k")
    mixed = not shared.limit(1).isEmpty()
    single = base.join(shared, "k", "left_anti") if mixed else base
    counted = lambda terms, c, texts: F.transform(terms, lambda x: F.struct(x.alias("term"), F.lit(c).cast("long").alias("c"), F.lit(texts).cast("long").alias("texts")))
    both = F.when(F.col("k").isNull(), counted(F.col("g"), 1, 0)).otherwise(F.concat(counted(F.col("g"), 1, 0), counted(F.array_distinct("g"), 0, 1)))
    per = single.select("k", grams.alias("g")).select(F.explode(both).alias("x")).select("x.*")
    if mixed:
        met = base.join(shared, "k", "left_semi").select("k", F.explode(grams).alias("term")).groupBy("k", "term").agg(F.count("*").alias("c"))
        per = per.unionByName(met.select("term", "c", F.lit(1).cast("long").alias("texts")))
    return per.groupBy("term").agg(F.sum("c").alias("n"), F.sum("texts").alias("texts")).orderBy(F.desc("n"), "term").limit(top)


def exact_duplicates(rows: DataFrame, key: str, text: str, least: int = 40) -> DataFrame:
    """Q25: texts of at least `least` normalised characters that occur more than once: hash, count, first key."""
    norm = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return rows.select(F.col(key).alias("k"), norm.alias("t")).where(F.length("t") >= least).groupBy(F.sha2("t", 256).alias("text_hash")).agg(F.count("*").alias("n"), F.min("k").alias("first_key")).where("n > 1")


def phrase_counts(rows: DataFrame, text: str, phrases: tuple[str, ...]) -> DataFrame:
    """Q26: texts that contain each phrase, in one scan."""
    one = rows.agg(*[F.count_if(F.col(text).contains(p)).alias(f"c{i}") for i, p in enumerate(phrases)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(p).alias("phrase"), F.col(f"c{i}").alias("texts")) for i, p in enumerate(phrases)])).alias("r")).select("r.*")


def length_by_group(rows: DataFrame, group: str, text: str) -> DataFrame:
    """Q27: median and quartiles of the length by group."""
    return rows.where(F.col(text).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.round(F.median(F.length(text)), 4).alias("median_chars"), F.round(F.percentile(F.length(text), F.lit(0.25)), 4).alias("p25_chars"), F.round(F.percentile(F.length(text), F.lit(0.75)), 4).alias("p75_chars"))


def leak_report(rows: DataFrame, columns: list[str]) -> DataFrame:
    """F25, V1g: (column, leaks): rows of each text column with contact-shaped content, in one scan."""
    one = rows.agg(*[F.count_if(C.leaks(F.col(c))).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("leaks")) for c in columns])).alias("r")).select("r.*")


@F.pandas_udf(StringType())  # a type by name would need a session at import
def nfc(texts: pd.Series) -> pd.Series:
    """Canonical composition, for F2's letters."""
    from unicodedata import normalize

    return texts.map(lambda t: None if t is None else normalize("NFC", t))
