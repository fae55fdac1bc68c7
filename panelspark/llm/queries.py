"""Queries over the supplied tables that apply each operator with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents as pieces in sequences of 1,024 tokens."""
    from panelspark.llm.packing import pack

    pieces = pack(_read(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents encoded and decoded again."""
    from panelspark.llm.sentencepiece_codec import decode, encode

    encoded = encode(_read(spark, sf_dir, "documents"))
    both = decode(encoded, out_col="decoded")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the models of trusted text, with its language's threshold."""
    from panelspark.llm.kn_quality import classify

    return classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents under the cascade of rules."""
    from panelspark.llm.rule_cascade import judge

    return judge(_read(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents looked up among known licence texts, its lines among known notices."""
    from panelspark.llm.licenses import scan

    return scan(_read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the numbers of its lines that stand earlier in the corpus, equal or within the edits."""
    from panelspark.llm.line_dedup import removed_lines

    return removed_lines(_read(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe, as event logs folded, formatted and read back."""
    from panelspark.llm import chat

    said = r"\### Assistant: </turn> ok"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    made = chat.format_chats(chat.streamed_events(turns))
    back = made.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact histogram of encoded lengths of all documents with its suffix sums."""
    from panelspark.llm.token_counts import token_counts

    return token_counts(_read(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document."""
    from panelspark.llm.minhash import neighbour_fingerprints

    return neighbour_fingerprints(_read(spark, sf_dir, "documents"))


def minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of the fingerprint operator: signature bands joined, Jaccard verified, one row a document with its class."""
    from panelspark.llm.minhash import near_duplicate_classes

    return near_duplicate_classes(_read(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at 0.85 of their four-word shingles."""
    from panelspark.llm.ngram_join import jaccard_components

    return jaccard_components(_read(spark, sf_dir, "documents"), n=4, threshold=(85, 100))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents under both vocabularies, aligned by bytes, with corpus-wide counts of linked pairs."""
    from panelspark.llm.token_alignment import token_links

    return token_links(_read(spark, sf_dir, "documents"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of pages, judged by the rules and by a model that is fitted on the library's own labelled URLs."""
    from panelspark.llm import url_filter

    return url_filter.judge(_read(spark, sf_dir, "pages"), url_filter.train(url_filter.labelled_urls(spark)), url_filter.RULES)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with finite components as eight codes of sixteen entries, after six rounds."""
    from panelspark.llm.vector_codes import compress

    return compress(_read(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {k: f for k, f in globals().items() if (k.startswith("op") or k == "minhash_classes") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from panelspark.llm import licenses, oracles

    return {"op4_quality_rules": oracles.QUALITY_RULES, "op5_license_scan": licenses.oracle_sql(), "op7_chat_formatting": oracles.CHAT_FORMATTING, "op10_ngram_jaccard_join": oracles.NGRAM_JACCARD_JOIN, "op13_vector_codes": oracles.vector_codes()}
