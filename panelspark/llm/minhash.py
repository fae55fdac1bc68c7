"""MinHash fingerprints of documents: universal hash permutations over word shingles in numpy, signature
bands joined in Spark, and Jaccard verified on the sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._graph import connected_components, cut, drop
from panelspark.llm._text import shingle_set, word_hashes
from panelspark.llm.ngram_join import _bits, _digest, _has, verified

PERMUTATIONS, BANDS, ROWS = 128, 25, 5
SHINGLE = 5
_RNG = np.random.Generator(np.random.PCG64(7))
#: x -> a * x + b modulo 2**64, a odd: a permutation of the 64-bit hashes; its upper half is kept.
_A = (_RNG.integers(0, 2**63, size=PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_B = _RNG.integers(0, 2**63, size=PERMUTATIONS, dtype=np.uint64)[:, None]


def signature(shingles: np.ndarray) -> np.ndarray:
    """uint32 minimum of each permutation; no shingles give the greatest value everywhere."""
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 256):
        np.minimum(least, (shingles[i : i + 256] * _A + _B).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(">u4")


def text_signature(text: str | None, fold: bool = True) -> np.ndarray:
    return signature(shingle_set(word_hashes(text, fold), SHINGLE))


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Share of equal signature places: an estimate of the Jaccard similarity, 0 to 1."""
    return float((x == y).mean())


def edited(text: str, following: str) -> str:
    """The text with its last floor(n/2) code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of each row: the signature in hexadecimal. Equal texts have equal fingerprints; a null text is empty."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([text_signature(t).tobytes().hex() for t in texts], dtype=object)

    return docs.select(F.col(id_col), run(F.col(text_col).cast("string")).alias("fingerprint"))


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The next document is the one with the next greater id, after the last the first; equal ids follow by text;
    a null id comes before all others. Null texts are empty. The rows are dealt by ranges of ids, and the first
    row of each range is also dealt to the range before it, so one shuffle gives every row its next one and a task
    streams its rows in order, holding two. An empty table gives no rows.
    """
    spark = docs.sparkSession
    least = -(2**63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("k"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = rows.select(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0] if n > 1 else []
    bounds = spark.sparkContext.broadcast(np.unique(np.array(marks or [], dtype=np.int64)))

    @F.pandas_udf("int")
    def bucket(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds.value, k.to_numpy(), side="left").astype(np.int32))

    firsts = sorted((b, k) for b, k in rows.select(bucket("k").alias("b"), "k").groupBy("b").agg(F.min("k")).collect())  # one row a bucket
    if not firsts:
        return spark.createDataFrame([], f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    before = {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}
    heads = spark.createDataFrame([(k, b) for k, b in before.items()], "k long, b int")
    dealt = rows.select(bucket("k").alias("b"), F.lit(False).alias("extra"), "k", "t").unionByName(rows.join(F.broadcast(heads), "k").select("b", F.lit(True).alias("extra"), "k", "t"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            out = []
            for b, extra, k, t in zip(frame["b"], frame["extra"], frame["k"], frame["t"], strict=True):
                if held is not None and held[0] != b:
                    held = None
                if held is not None and held[1]:
                    continue  # past this range's last pair
                sig = text_signature(t)
                if held is not None:
                    other = edited(held[3], t)
                    edit = text_signature(other)
                    out.append((held[2], len(held[3]), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), held[4].tobytes().hex(), edit.tobytes().hex(), likeness(held[4], edit), likeness(held[4], sig)))
                held = (b, extra, k, t, sig)
            yield pd.DataFrame(out, columns=["k", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    parted = dealt.repartition(n, "b").sortWithinPartitions("b", "extra", "k", "t")
    done = parted.mapInPandas(run, "k long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return done.select(F.when(F.col("k") != least, F.col("k")).alias(id_col), *done.columns[1:])


def _texts_of(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(h) of the rows whose node is an end of a pair."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    return rows.join(ends, "node", "left_semi").select("h").distinct()


def _with_hash_in(base: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows of base with an h of texts, and few others: a bit set of fixed greatest size keeps the rest from being hashed again."""
    texts = cut(texts.select((F.shiftrightunsigned("h", 24)).alias("bit")))
    held = base.sparkSession.sparkContext.broadcast(_bits(texts, "bit", 40))
    drop(texts)

    @F.pandas_udf("boolean")
    def maybe(bit: pd.Series) -> pd.Series:
        return pd.Series(_has(held.value, bit.to_numpy(), 40))

    return base.where(maybe(F.shiftrightunsigned("h", 24)))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """(id, component_id): documents linked by signature bands and an exact Jaccard of five-word shingles at the threshold.

    Equal sets are one node. In each band's list every node first meets the least node alone, so a list of
    m copies that are like their head gives m - 1 pairs. Then the pairs of different classes are made in each list, those
    with an end outside the list's largest class, so every pair that meets in a band is verified unless its ends are known to
    be in one class. Two sets of similarity s share a band with probability 1 - (1 - s**5)**25: 0.9999 at 0.8. Texts without
    words link with nothing; a null id never names a class; repeated rows stay repeated; an empty table gives no rows.
    """
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"), F.xxhash64(text).alias("h"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingle_set(word_hashes(t, fold=True), SHINGLE) for t in frame["t"]]
            bands = [[int.from_bytes(hashlib.blake2b(bytes([i]) + s[ROWS * i : ROWS * (i + 1)].tobytes(), digest_size=8).digest(), "little", signed=True) for i in range(BANDS)] if len(x) else [] for x in sets for s in [signature(x)]]
            yield pd.DataFrame({"id": frame["id"].astype("Int64"), "h": frame["h"], "node": [_digest(x) if len(x) else None for x in sets], "bands": bands})

    rows = cut(base.mapInPandas(run, "id long, h long, node binary, bands array<long>"))

    def checked(pairs: DataFrame) -> DataFrame:
        return verified(_with_hash_in(base, _texts_of(rows, pairs)), pairs, SHINGLE, threshold)

    nodes = rows.where("node is not null").groupBy("node").agg(F.first("bands").alias("bands"))
    every = nodes.select("node", F.explode("bands").alias("band"))
    heads = every.groupBy("band").agg(F.min("node").alias("head"), F.count("*").alias("size")).where("size > 1").drop("size")
    lists = cut(every.join(heads, "band"))
    stars = cut(lists.where("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct())
    links = checked(stars)
    labels = connected_components(links)

    inside = lists.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("class"))
    classes = inside.groupBy("band", "class").agg(F.count("*").alias("size"))
    main = classes.groupBy("band").agg(F.max(F.struct("size", "class")).alias("main"), F.count("*").alias("classes")).where("classes > 1").select("band", F.col("main.class").alias("main"))
    mixed = cut(inside.join(main, "band"))
    rest = mixed.where("class <> main").select("band", F.col("node").alias("y"), F.col("class").alias("cy"))
    more = mixed.select("band", F.col("node").alias("x"), F.col("class").alias("cx"), "main").join(rest, "band").where("cx <> cy and (cx = main or x < y)")
    more = more.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    more = cut(more.join(stars, ["a", "b"], "left_anti"))  # a star has its least node first, and one that failed needs no second look
    drop(lists, mixed, stars)
    if not more.isEmpty():
        links = cut(links.unionByName(checked(more)))
        labels = connected_components(links)
    named = rows.where("node is not null").join(labels, "node", "left").select("id", F.coalesce("label", "node").alias("class"))
    named = named.join(named.groupBy("class").agg(F.min("id").alias("component_id")), "class").select("id", "component_id")
    return named.unionByName(rows.where("node is null").select("id", F.col("id").alias("component_id"))).select(F.col("id").alias(id_col), "component_id")
