"""Quality classifier: an interpolated modified Kneser-Ney trigram model of trusted text gives every document a
perplexity, and a quantile for each language decides.

Trusted text is labelled text of good quality that is not toxic. The model is fitted on all of those rows but a quarter, held out by
a hash of the id, from which the thresholds come. Each language with a training row has a model of its own; one of all training
rows scores the languages without.

Fitting has two passes over trigram counts. A trigram (a, b, c) is dealt by its lower-order bigram (b, c) first, for counts and continuation
counts, then by its context (a, b), for totals and discounted probabilities. Both are windows whose groups the vocabulary bounds, so a
frequent word doesn't gather in one task; what belongs to a word alone is a table of a row a word. The log-probability of a token is
written as a sum over the n-grams that end in it:

    log p(c | a b) = log p1(c) + g2(b) + [bc seen] gain2(bc) + [ab seen] g3(ab) + [abc seen] gain3(abc)

where g are the logs of the back-off weights and a gain is what seeing the n-gram adds. The first two terms are
arrays of the bounded vocabulary. The others are one table, key to value, in shards: the HOT keys met most often in training go
along as a broadcast of fixed size, so that very common n-grams never reach the shuffle; a Bloom filter of fixed
greatest size drops n-grams that the model lacks; what remains of each document is joined with the shards of the
table and summed by document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm._graph import cut, drop
from panelspark.llm._text import mix

#: Labelled rows of a language for a caller who wants a bounded model (the queries don't). Bounds: words of a language's vocabulary (the rest is
#: one unknown word), keys in the broadcast, bits of a filter, bits of a language in a key.
TRAIN_DOCS, VOCABULARY, HOT, FILTER_BITS, CODE_BITS = 8000, 50_000, 1 << 21, 1 << 27, 14
#: Languages with a model of their own.
LANGUAGES = 256
BEGIN, END, UNKNOWN, FIRST_WORD = 0, 1, 2, 3
#: Trigrams' keys start here.
TRIGRAM = 1 << 62
QUANTILE = 0.995
#: Trigrams that a task holds before it counts them and sends them on.
TASK_TRIPLES = 4_000_000
#: Parts of the contexts that are fitted, and of the documents that are scored, one after another: the shuffle of one part is on disk at a time.
PARTS = 2


def _sequence(words: list[bytes], ids: dict[bytes, int]) -> np.ndarray:
    return np.array([BEGIN, BEGIN, *[ids.get(w, UNKNOWN) for w in words], END], dtype=np.int64)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _pairs(seq: np.ndarray, code: int) -> np.ndarray:
    return (code << 48) + (seq[:-1] << 16) + seq[1:]


def _triples(seq: np.ndarray, code: int) -> np.ndarray:
    return TRIGRAM + (code << 48) + (seq[:-2] << 32) + (seq[1:-1] << 16) + seq[2:]


def trusted_sample(docs: DataFrame, labels: DataFrame, id_col: str, train_docs: int | None = None, lang_col: str = "lang") -> DataFrame:
    """Ids of the training rows: all trusted ids but a quarter, always held out by a hash. With train_docs, of each language at most that
    many in docs, by another hash; each language is then drawn by itself, so its rows don't depend on its share of the corpus."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("id")).where("id is not null").distinct()
    some = good.where(F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(4)) != 0)
    if train_docs is None:
        return some
    spoken = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang")).join(some, "id").distinct()
    # hashes past a bound that leaves well over train_docs rows of a language can't be among its least, so none of them is sorted
    sizes = spoken.groupBy(F.col("lang").alias("spoken")).agg(F.count("*").alias("n"))  # one row a language
    bound = F.lit(1.2 * train_docs + 1000) / F.col("n") * 2.0**64 - 2.0**63
    least = spoken.join(F.broadcast(sizes), F.col("lang").eqNullSafe(F.col("spoken"))).where(F.xxhash64("id").cast("double") <= bound)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    return least.withColumn("at", F.row_number().over(order)).where(F.col("at") <= train_docs).select("id").distinct()


class Model:
    """What tasks need, as broadcasts alone, so that the driver holds it once: known (ids of words) and held (codes, unigram and back-off arrays, packed hot keys,
    filter); and the value table, packed by shard, and the ids of the sample."""

    def __init__(self, codes: dict[str, int], known: Broadcast, base: dict[int, np.ndarray], back: dict[int, np.ndarray], hot: list[tuple[bytes, bytes]], bits: np.ndarray, packed: DataFrame, shards: int, sample: DataFrame, tables: tuple[DataFrame, ...] = ()) -> None:
        self.codes, self.known, self.packed, self.shards, self.sample = codes, known, packed, shards, sample
        self.tables = tables  # rows of bigrams and of trigrams that packed was made of; scoring doesn't read them
        self.held = sample.sparkSession.sparkContext.broadcast((codes, base, back, hot, bits))

    @property
    def hot(self) -> tuple[np.ndarray, np.ndarray]:
        """Hot keys in order, and their values."""
        return _hot(self.held.value[3])

    def forget(self) -> None:
        """Free the broadcasts; no row can be scored any more."""
        self.held.destroy()
        self.known.destroy()


def _hot(pieces: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, and values, of packed pieces; first stands -1, no n-gram's key, so that the table is never empty."""
    keys = np.concatenate([np.array([-1], dtype=np.int64), *[_keys(k) for k, _ in pieces]])
    values = np.concatenate([np.zeros(1, dtype=np.float32), *[_numbers(v, np.float32) for _, v in pieces]])
    order = np.argsort(keys, kind="stable")  # pieces are in order already
    return keys[order], values[order]


def _spots(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.astype(np.uint64))
    return (h & np.uint64(size - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64)


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each key."""
    there = np.ones(len(keys), dtype=bool)
    for spot in _spots(keys, len(bits) * 8):
        there &= (bits[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8)) & 1 > 0
    return there


def _filter_bits(keys: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of n keys (column key, or packed ones in column keys), of FILTER_BITS at most. Tasks send theirs compressed."""
    size = min(FILTER_BITS, 1 << max(10, math.ceil(math.log2(8 * max(1, n)))))

    def filters(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros(size, dtype=bool)
        for frame in frames:
            for some in [frame["key"].to_numpy()] if "key" in frame else map(_keys, frame["keys"]):
                for spot in _spots(some, size):
                    found[spot] = True
        yield pd.DataFrame({"bits": [_planes(np.packbits(found))]})

    bits = np.zeros(size // 8, dtype=np.uint8)
    for r in keys.coalesce(4).mapInPandas(filters, "bits binary").toLocalIterator():
        bits |= _numbers(r.bits, np.uint8)
    return bits


def _discounts(counts: DataFrame, order: int) -> dict[int, list[float]]:
    """Modified Kneser-Ney discounts of each code from the counts of counts in column n of an order."""
    out = {}
    for r in counts.groupBy("code").agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).collect():  # one row a language
        n1, n2, n3, n4 = (max(r[f"n{k}"], 1e-3) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        out[r.code] = [min(max(v, 0.05), top - 0.05) for v, top in ((1 - 2 * y * n2 / n1, 1), (2 - 3 * y * n3 / n2, 2), (3 - 4 * y * n4 / n3, 3))]
    return out


def _cut_off(discounts: dict[int, list[float]], n: Column) -> Column:
    """The discount of a count n of column code."""
    of = F.create_map(*[x for c, v in sorted(discounts.items()) for x in (F.lit(c), F.array(*[F.lit(float(d)) for d in v]))])
    return F.get(F.element_at(of, F.col("code")), F.least(n, F.lit(3)).cast("int") - 1)


def _vocabulary(counted: DataFrame) -> tuple[dict[int, dict[bytes, int]], dict[int, int]]:
    """(ids of words by code, number of different words by code) from (code, word, n).

    A word needs two occurrences and a count that at most VOCABULARY words of its code reach: a bound from the counts of counts,
    so that no task ranks a language's words.
    """
    types, least = {}, {}
    by_count: dict[int, list[tuple[int, int]]] = {}
    for r in counted.groupBy("code", "n").agg(F.count("*").alias("words")).toLocalIterator():  # counts of counts
        by_count.setdefault(r.code, []).append((r.n, r.words))
    for code, rows in by_count.items():
        types[code], total, least[code] = sum(w for _, w in rows), 0, 2
        for n, w in sorted(rows, reverse=True):
            total += w
            if total > VOCABULARY:
                least[code] = max(2, n + 1)
                break
    if not types:
        return {}, {}
    bound = F.create_map(*[F.lit(x) for kv in sorted(least.items()) for x in kv])
    kept = counted.where(F.col("n") >= F.element_at(bound, F.col("code"))).orderBy("code", F.desc("n"), "word").select("code", "word").toArrow()
    ids: dict[int, dict[bytes, int]] = {c: {} for c in types}
    for code, word in zip(kept["code"].to_pylist(), kept["word"].to_pylist(), strict=True):
        ids[code][word] = len(ids[code]) + FIRST_WORD
    return ids, types


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int | None = None) -> Model | None:
    """The model of the training rows (``trusted_sample``), None if there is no trusted text.

    Every language with a training row has a model of its own, up to the LANGUAGES with most of them; all other rows share one of all
    training rows, which is fitted only where docs have such rows.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    sample = cut(trusted_sample(docs, labels, id_col, train_docs, lang_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("t"))
    trained = context.broadcast(_filter_bits(sample.select(F.col("id").alias("key")), sample.count()))

    @F.pandas_udf("boolean")
    def maybe(key: pd.Series) -> pd.Series:
        return pd.Series(_passes(trained.value, key.to_numpy()))

    # the filter keeps the other texts out of the join's shuffle
    text = cut(rows.where("id is not null").where(maybe("id")).join(sample, "id").select("lang", "t"))
    trained.destroy()
    most = text.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    spoken = sorted(r.lang for r in most.collect())
    codes = {lang: i + 1 for i, lang in enumerate(spoken)}
    shared = not codes or not rows.where(F.col("lang").isNull() | ~F.col("lang").isin(*codes)).limit(1).isEmpty()

    def models(lang: str | None) -> set[int]:
        return ({codes[lang]} if lang in codes else set()) | ({0} if shared else set())

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: dict[tuple[int, bytes], int] = {}
            for lang, t in zip(frame["lang"], frame["t"], strict=True):
                for w in _words(t):
                    for code in models(lang):
                        out[code, w] = out.get((code, w), 0) + 1
            yield pd.DataFrame({"code": [k[0] for k in out], "word": [k[1] for k in out], "n": list(out.values())})

    counted = cut(text.mapInPandas(words, "code int, word binary, n long").groupBy("code", "word").agg(F.sum("n").alias("n")))
    ids, types = _vocabulary(counted)
    drop(counted)
    if not types:
        return None
    known, sizes = context.broadcast(ids), {c: len(ids[c]) + 2 for c in types}
    del ids  # tasks have them

    def triples(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size = [], 0

        def counts() -> pd.DataFrame:
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            return pd.DataFrame({"bc": (keys >> 48 & (1 << CODE_BITS) - 1) << 32 | keys & 0xFFFFFFFF, "a": (keys >> 32 & 0xFFFF).astype(np.int32), "n": n})

        for frame in frames:
            for lang, t in zip(frame["lang"], frame["t"], strict=True):
                for code in models(lang):
                    parts.append(_triples(_sequence(_words(t), known.value.get(code, {})), code))
                    size += len(parts[-1])
                if size > TASK_TRIPLES:
                    yield counts()
                    parts, size = [], 0
        if parts:
            yield counts()

    word = lambda key, shift: F.shiftright(key, shift).bitwiseAND(0xFFFF).cast("int")
    parted = {"code": F.shiftright("bc", 32).cast("int"), "b": word("bc", 16), "c": word("bc", 0)}
    by_bc = Window.partitionBy("bc")
    t3 = text.mapInPandas(triples, "bc long, a int, n long").repartition("bc").groupBy("bc", "a").agg(F.sum("n").alias("n"))
    t3 = t3.withColumns({"n2": F.count("*").over(by_bc), "met2": F.when(F.row_number().over(by_bc.orderBy("a")) == 1, F.sum("n").over(by_bc))})
    counted3 = cut(t3)  # met2, the bigram's own count, stands in one of its rows
    drop(text)
    t2 = counted3.where("met2 is not null").withColumns(parted).select("code", "b", "c", F.col("n2").alias("n"))
    t1 = cut(t2.groupBy("code", "c").agg(F.count("*").alias("n")))
    d1, d2, d3 = _discounts(t1, 1), _discounts(t2, 2), _discounts(counted3.select(parted["code"].alias("code"), "n"), 3)

    # order one, and what belongs to a context b: tables of a row a vocabulary word
    size = F.create_map(*[x for c, v in sizes.items() for x in (F.lit(c), F.lit(float(v)))])
    r1 = t1.withColumn("cut", _cut_off(d1, F.col("n")))
    s1 = r1.groupBy("code").agg(F.sum("n").alias("total"), F.sum("cut").alias("mass"))
    weight = lambda mass, total: F.greatest(mass, F.lit(1e-9)) / total
    p1 = cut(r1.join(F.broadcast(s1), "code").select("code", "c", ((F.col("n") - F.col("cut")) / F.col("total") + weight(F.col("mass"), F.col("total")) / F.element_at(size, F.col("code"))).alias("p1")))
    rest = {r.code: r.w / sizes[r.code] for r in s1.select("code", weight(F.col("mass"), F.col("total")).alias("w")).collect()}
    contexts = t2.groupBy("code", "b").agg(F.sum("n").alias("total2"), F.sum(_cut_off(d2, F.col("n"))).alias("mass2"))
    contexts = cut(contexts.select("code", "b", "total2", weight(F.col("mass2"), F.col("total2")).alias("w2")))

    # orders two and three, dealt by the context (a, b), a part of the contexts at a time, so that a part's shuffle alone is on disk
    context_ab = F.shiftleft(F.shiftright("bc", 32), 32) + F.shiftleft(F.col("a").cast("long"), 16) + word("bc", 16)
    by_ab = Window.partitionBy("ab")
    low2, low3 = F.col("w2") * F.col("p1"), F.col("w3") * F.col("p2")
    key3 = F.expr(f"{TRIGRAM} + shiftleft(cast(code as bigint), 48) + shiftleft(cast(a as bigint), 32) + shiftleft(cast(b as bigint), 16) + c")

    def part(number: int) -> DataFrame:
        """(key, value, met) of each trigram, and in one of a bigram's rows its gain as (b, c), in another its weight as (a, b)."""
        dealt = counted3.select(context_ab.alias("ab"), word("bc", 0).alias("c"), "n", "n2", "met2").where(F.pmod(F.xxhash64("ab"), F.lit(PARTS)) == number).repartition("ab")
        rows3 = dealt.withColumns({"code": F.shiftright("ab", 32).cast("int"), "a": word("ab", 16), "b": word("ab", 0)}).withColumns({"cut3": _cut_off(d3, F.col("n")), "cut2": _cut_off(d2, F.col("n2"))})
        rows3 = rows3.withColumns({"total3": F.sum("n").over(by_ab), "mass3": F.sum("cut3").over(by_ab), "head3": F.row_number().over(by_ab.orderBy("c")) == 1})
        scored = rows3.join(F.broadcast(p1), ["code", "c"]).join(F.broadcast(contexts), ["code", "b"])
        scored = scored.withColumns({"w3": weight(F.col("mass3"), F.col("total3")), "low2": low2, "p2": (F.col("n2") - F.col("cut2")) / F.col("total2") + low2})
        value = F.log(((F.col("n") - F.col("cut3")) / F.col("total3") + low3) / low3)
        gain, back = F.when(F.col("met2").isNotNull(), F.log(F.col("p2") / F.col("low2"))), F.when(F.col("head3"), F.log("w3"))
        return scored.select(key3.alias("key"), value.cast("float").alias("value"), F.col("n").alias("met"), gain.cast("float").alias("gain"), "met2", back.cast("float").alias("back"), F.when(F.col("head3"), F.col("total3")).alias("met3"))

    parts = [cut(part(i)) for i in range(PARTS)]
    made = reduce(DataFrame.unionByName, parts)
    drop(counted3)
    backs = contexts.select((F.shiftleft(F.col("code").cast("long"), 16) + F.col("b")).alias("key"), F.log("w2").alias("value")).toArrow()
    # a bigram has a gain as (b, c) and a weight as (a, b), which are summed; trigrams have one row each
    of_code = F.shiftleft(F.shiftright(F.col("key") - TRIGRAM, 48), 48)
    gains = made.where("gain is not null").select((of_code + F.col("key").bitwiseAND(0xFFFFFFFF)).alias("key"), F.col("gain").alias("value"), F.col("met2").alias("met"))
    weights = made.where("back is not null").select((of_code + F.shiftright("key", 16).bitwiseAND(0xFFFFFFFF)).alias("key"), F.col("back").alias("value"), F.col("met3").alias("met"))
    pairs = cut(gains.unionByName(weights).groupBy("key").agg(F.sum("value").cast("float").alias("value"), F.max("met").alias("met")))
    values = pairs.unionByName(made.select("key", "value", "met"))

    at_least, n_values = _hot_bound(values)
    shards = 1 << max(3, math.ceil(math.log2(max(1, n_values) / SHARD_KEYS)))
    packed = cut(_model_shards(values.select("key", "value", (F.col("met") >= at_least).alias("hot")), shards))
    hot = [(r["keys"], r["data"]) for r in packed.where(F.col("shard") == -1).select("keys", "data").collect()]  # HOT keys at most
    bits = _filter_bits(packed.select("keys"), n_values)

    base = {c: np.full(sizes[c] + FIRST_WORD - 2, math.log(rest.get(c, 1e-9)), dtype=np.float64) for c in types}
    back = {c: np.zeros(sizes[c] + FIRST_WORD - 2, dtype=np.float64) for c in types}
    ones = p1.toArrow()
    for c in types:
        mine = ones["code"].to_numpy() == c
        base[c][ones["c"].to_numpy()[mine]] = np.log(ones["p1"].to_numpy()[mine])
        mine = backs["key"].to_numpy() >> 16 == c
        back[c][backs["key"].to_numpy()[mine] & 0xFFFF] = backs["value"].to_numpy()[mine]
        base[c][UNKNOWN] -= math.log(max(1, types[c] - (sizes[c] - 2)))  # an unknown word is one of those that the vocabulary left out
    return Model(codes, known, base, back, hot, bits, packed.where("shard >= 0"), shards, sample, (pairs, made, *parts))


def _hot_bound(values: DataFrame) -> tuple[int, int]:
    """The least count met at which no more than HOT keys are left, and the number of all keys."""
    counts = values.groupBy("met").count().orderBy(F.desc("met")).toArrow()  # counts of counts
    met, total = counts["met"].to_numpy(), counts["count"].to_numpy().cumsum()
    over = np.flatnonzero(total > HOT)
    return (int(met[over[0]]) + 1 if len(over) else 1), int(total[-1]) if len(total) else 0


def _planes(numbers: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones and so on, each compressed by itself, as bytes of one place are alike."""
    planes = [pa.compress(p.tobytes(), codec="zstd", asbytes=True) for p in numbers.view(np.uint8).reshape(-1, numbers.itemsize).T]
    return np.array([len(numbers), *map(len, planes)], dtype=np.uint32).tobytes() + b"".join(planes)


def _numbers(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    n, *sizes = np.frombuffer(data, dtype=np.uint32, count=width + 1).tolist()
    edges = np.cumsum([4 * (width + 1), *sizes]).tolist()
    planes = [np.frombuffer(pa.decompress(data[i:j], n, codec="zstd"), dtype=np.uint8) for i, j in zip(edges, edges[1:], strict=False)]
    return np.ascontiguousarray(np.stack(planes, axis=1)).view(kind).reshape(-1)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys: of bigrams and trigrams the steps between first words, and the other words as they are."""
    two = np.searchsorted(keys, TRIGRAM)
    steps = [np.diff(part >> shift, prepend=0) << shift | part & (1 << shift) - 1 for part, shift in ((keys[:two], 16), (keys[two:], 32))]
    return np.uint32(two).tobytes() + _planes(np.concatenate(steps))


def _keys(data: bytes) -> np.ndarray:
    two, steps = int(np.frombuffer(data, dtype=np.uint32, count=1)[0]), _numbers(data[4:], np.int64)
    return np.concatenate([np.cumsum(part >> shift) << shift | part & (1 << shift) - 1 for part, shift in ((steps[:two], 16), (steps[two:], 32))])


def _packed_shards(keys: np.ndarray, shards: int, *columns: np.ndarray) -> Iterator[tuple]:
    """(shard, packed keys in order, packed numbers of each column in that order) of each shard that has keys."""
    shard = (mix(keys.astype(np.uint64)) >> np.uint64(48)).astype(np.int64) & (shards - 1)
    order = np.lexsort((keys, shard))
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    for i in np.flatnonzero(edges[1:] > edges[:-1]):
        part = order[edges[i] : edges[i + 1]]
        yield (int(i), _packed_keys(keys[part]), *(_planes(c[part]) for c in columns))


def _model_shards(values: DataFrame, shards: int) -> DataFrame:
    """(shard, keys, data) rows of the value table, packed; hot keys stand under shard -1."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def packed() -> pd.DataFrame:
            keys, value, hot = (np.concatenate([f[c].to_numpy() for f in held]) for c in ("key", "value", "hot"))
            rows = list(_packed_shards(keys[~hot], shards, value[~hot].astype(np.float32)))
            rows += [(-1, *x[1:]) for x in _packed_shards(keys[hot], 1, value[hot].astype(np.float32))]
            return pd.DataFrame(rows, columns=["shard", "keys", "data"])

        for frame in frames:
            held.append(frame)
            if sum(map(len, held)) > 1_000_000:
                yield packed()
                held = []
        if held:
            yield packed()

    return values.mapInPandas(run, "shard int, keys binary, data binary")


#: Rows that travel to a shard: its number, a batch of documents (-1: the model's), keys, their values or the places of their documents,
#: and once a batch, under shard -1, the documents' own columns.
ROW = ["shard", "batch", "keys", "data", "docs"]
SHARDED = "shard int, batch long, keys binary, data binary, docs array<struct<id: bigint, own: string, code: int, n_words: bigint, total: double>>"
#: Keys of the model in a shard, about, and documents and tokens of a batch at most.
SHARD_KEYS, BATCH_DOCS, BATCH_TOKENS = 2_400_000, 1024, 500_000


def perplexities(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, own, lang, n_words, perplexity) of each row; own is its language, lang is null where the shared model scored it.

    Where shards are fewer than the cores ask for, each has copies, and a batch goes to one of them. A batch of documents leaves its n-grams that aren't hot packed by shard, sorted, with the place of each one's document. In a shard's
    task the model's rows come first and are kept (SHARD_KEYS of them, about), then the batches stream by; the sums of a batch
    over its shards meet again by batch.
    """
    context = docs.sparkSession.sparkContext
    known, held = model.known, model.held
    shards = model.shards
    copies = max(1, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * context.defaultParallelism) // shards)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, (codes, base, back, hot, bits) = known.value, held.value
        hot_keys, hot_values = _hot(hot)
        size, number = len(bits) * 8, TaskContext.get().partitionId() << 34
        copy = lambda: int(mix(np.array([number], dtype=np.uint64))[0] % np.uint64(copies))  # noqa: E731  mixed: the first batches of all tasks go to all copies
        some: list[tuple] = []

        def batch() -> pd.DataFrame:
            parts = [x for *_, seq, code, _ in some for x in (_pairs(seq, code), _triples(seq, code))]
            keys = np.concatenate(parts)
            place = np.repeat(np.arange(len(some)), [len(parts[2 * i]) + len(parts[2 * i + 1]) for i in range(len(some))]).astype(np.uint16)
            for which in (0, 1):
                spot = _spots(keys, size)[which]
                there = (bits[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8)) & 1 > 0
                keys, place = keys[there], place[there]
            order = np.argsort(keys)  # neighbours in the table are met in order
            keys, place = keys[order], place[order]
            at = np.minimum(np.searchsorted(hot_keys, keys), len(hot_keys) - 1)
            common = hot_keys[at] == keys
            warm = np.bincount(place[common], hot_values[at[common]], len(some))
            own = [{"id": key, "own": lang, "code": code, "n_words": len(seq) - 3, "total": total + float(w)} for (key, lang, seq, code, total), w in zip(some, warm, strict=True)]
            rows = [(-1, number, None, None, own), *((s + shards * copy(), number, k, p, None) for s, k, p in _packed_shards(keys[~common], shards, place[~common]))]
            return pd.DataFrame(rows, columns=ROW)

        tokens = 0
        for frame in frames:
            for key, lang, text in zip(frame["id"], frame["lang"], frame["t"], strict=True):
                code = codes.get(lang, 0)
                seq = _sequence(_words(text), ids.get(code, {}))
                some.append((None if pd.isna(key) else int(key), lang, seq, code, float(base[code][seq[2:]].sum() + back[code][seq[1:-1]].sum())))
                tokens += len(seq)
                if len(some) == BATCH_DOCS or tokens > BATCH_TOKENS:
                    yield batch()
                    some, tokens, number = [], 0, number + 1
        if some:
            yield batch()

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, keys, values, packs = None, None, None, []
        for frame in frames:
            out = []
            for shard, number, k, data, own in zip(frame["shard"], frame["batch"], frame["keys"], frame["data"], frame["docs"], strict=True):
                if shard == -1:
                    out.append((number, -1, own, None, None))
                    continue
                if shard != now:
                    now, keys, packs = shard, None, []
                if number == -1:
                    packs.append((k, data))
                    continue
                if keys is None:
                    keys = np.concatenate([np.zeros(0, dtype=np.int64), *[_keys(x) for x, _ in packs]])
                    order = np.argsort(keys)
                    keys, values, packs = keys[order], np.concatenate([np.zeros(0, dtype=np.float32), *[_numbers(x, np.float32) for _, x in packs]])[order], []
                if not len(keys):
                    continue
                asked, place = _keys(k), _numbers(data, np.uint16)
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                found = keys[at] == asked
                places, which = np.unique(place[found], return_inverse=True)  # a shard among many meets few of a batch's documents
                out.append((number, shard, None, _planes(np.diff(places, prepend=places.dtype.type(0))), np.bincount(which, values[at[found]]).tobytes()))
            yield pd.DataFrame(out, columns=["batch", "shard", "docs", "places", "sums"])

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, own, total = None, None, None

        def rows() -> pd.DataFrame:
            frame = pd.DataFrame([(d["id"], d["own"], d["code"], d["n_words"]) for d in own], columns=["id", "own", "code", "n_words"]).astype({"id": "Int64"})
            return frame.assign(total=total)

        for frame in frames:
            for n, docs_, places, sums in zip(frame["batch"], frame["docs"], frame["places"], frame["sums"], strict=True):
                if docs_ is not None:  # a batch's documents sort before its sums
                    if number is not None:
                        yield rows()
                    number, own = n, list(docs_)
                    total = np.array([d["total"] for d in own])
                else:
                    total[np.cumsum(_numbers(places, np.uint16))] += np.frombuffer(sums, dtype=np.float64)
        if number is not None:
            yield rows()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("t"))
    copied = model.packed.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    table = copied.select((F.col("shard") + shards * F.col("copy")).alias("shard"), F.lit(-1).cast("long").alias("batch"), "keys", "data", F.lit(None).alias("docs"))
    both = rows.mapInPandas(score, SHARDED).unionByName(table)
    # documents' own columns don't belong to a shard and are dealt by batch
    dealt = both.repartition(F.when(F.col("shard") >= 0, F.col("shard").cast("long")).otherwise(F.col("batch"))).sortWithinPartitions("shard", "batch")
    sums = dealt.mapInPandas(join, "batch long, shard int, docs array<struct<id: bigint, own: string, code: int, n_words: bigint, total: double>>, places binary, sums binary")
    summed = sums.repartition("batch").sortWithinPartitions("batch", "shard").mapInPandas(finish, "id long, own string, code int, n_words long, total double")
    names = F.create_map(F.lit(-1), F.lit(""), *[F.lit(x) for kv in ((c, n) for n, c in model.codes.items()) for x in kv])
    return summed.select("id", "own", F.try_element_at(names, F.col("code")).alias("lang"), "n_words", F.exp(-F.col("total") / (F.col("n_words") + 1)).alias("perplexity"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE, train_docs: int | None = None) -> DataFrame:
    """(id, lang, n_words, perplexity, threshold, kept) of each row.

    A language's threshold is the quantile of the perplexities of its trusted documents that the model was not
    fitted on (of all its trusted ones where there are none); a document is kept up to that of its own language. Languages
    without a training row share one model, shown as a null lang, yet each has its own threshold; one without any trusted
    document takes the quantile of all that the shared model scored, or keeps its rows where there are none. A null or empty text is the end mark alone. Rows of one id are judged
    each; labels of unknown ids and null labels teach nothing; without trusted text, or without a threshold, all rows
    are kept with null perplexity or threshold. An empty table gives no rows.
    """
    model = fit(docs, labels, id_col, text_col, lang_col, train_docs)
    if model is None:
        none = docs.select(F.col(id_col).cast("long").alias("id"), F.lit(None).cast("string").alias("lang"), F.size(F.array_remove(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long").alias("n_words"))
        return none.select(F.col("id").alias(id_col), "lang", "n_words", F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("kept"))
    drop(*model.tables)
    part = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string")), F.lit(PARTS))
    scores = reduce(DataFrame.unionByName, [cut(perplexities(docs.where(part == i), model, id_col, text_col, lang_col)) for i in range(PARTS)])
    drop(model.packed)
    model.forget()
    seen = model.sample.withColumn("seen", F.lit(True))
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("id")).distinct()
    held = cut(scores.join(good, "id").join(seen, "id", "left").select("own", "lang", "perplexity", "seen"))

    def threshold(rows: DataFrame, *by: str) -> DataFrame:
        at = rows.groupBy(*by).agg(F.percentile_approx(F.when(F.col("seen").isNull(), F.col("perplexity")), quantile, 10_000).alias("held"), F.percentile_approx("perplexity", quantile, 10_000).alias("whole"))
        return at.select(*by, F.coalesce("held", "whole").alias("threshold"))

    each = threshold(held, "own").withColumnRenamed("own", "spoken")  # one row a language
    pooled = threshold(held.where("lang is null")).first().threshold
    found = scores.join(F.broadcast(each), F.col("own").eqNullSafe(F.col("spoken")), "left")
    found = found.withColumn("threshold", F.coalesce("threshold", F.when(F.col("lang").isNull(), F.lit(pooled).cast("double"))))
    return found.select(F.col("id").alias(id_col), "lang", "n_words", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"))


def keep_trusted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE) -> DataFrame:
    """Rows of docs whose id the classifier rejects in no row of its; all columns stay, rows with a null id stay."""
    out = classify(docs, labels, id_col, text_col, lang_col, quantile).where("not kept").select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(out, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")
