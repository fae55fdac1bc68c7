"""N-gram Jaccard join with adaptive multi-match prefixes.

Each document is the set of its distinct n-word shingles. All sets follow one global order
(rare shingles first, by counts of the corpus's most frequent ones; the order steers only the cost).
Two sets of sizes s and t that reach the threshold share at least l tokens between their
prefixes of length ``s - ceil(threshold * s) + l``, for every l, and the first shared one, which the shortest prefix
holds, stands early enough for the rest to fill the overlap that is needed. A document picks its own l:
it lengthens its prefix as long as the estimated cost of candidates falls, and a pair goes to
verification only with min(l, l') shared prefix tokens. Lists hold the shortest prefixes, where pairs meet in the first token
they share; the longer ones then count.

Pairs inside one group of copies are never all made. Equal sets are one node. In each token's
list every node meets one head first, the node that has the token at the earliest place; verified pairs join into classes. What is
left are pairs of different classes, and in each list only those with an end outside the
list's largest class are made. All pairs that share enough tokens are thus verified unless
their ends are already known to be in one class, so no link between classes is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm._graph import connected_components, cut, drop
from panelspark.llm._text import shingle_set, word_hashes

#: Most frequent shingles that the order knows, the least count in one batch of rows to be counted, greatest number of bits of a
#: prefilter (16 MB, as a power of two).
FREQUENT, BATCH_COUNT, FILTER_BITS = 1 << 18, 3, 27
MAX_LEVEL = 4
#: Bytes kept of a prefix token, where a clash only adds a candidate.
TOKEN_BYTES = 5
#: Cost of one prefix row, one list entry met, and one verification per shingle, in like units.
#: RARE is the number of other documents assumed for a shingle that isn't among the frequent ones.
ROW_COST, MEET_COST, VERIFY_COST, RARE = 4.0, 1.0, 0.05, 0.3


def _sets(frame: pd.DataFrame, n: int) -> list[np.ndarray]:
    return [shingle_set(word_hashes(x, fold=True), n) for x in frame["t"]]


def _short(s: np.ndarray, size: int) -> bytes:
    """The upper bytes of each hash, big-endian, size bytes each."""
    return np.ascontiguousarray(s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _long(data: bytes, size: int) -> np.ndarray:
    full = np.zeros((len(data) // size, 8), dtype=np.uint8)
    full[:, 8 - size :] = np.frombuffer(data, dtype=np.uint8).reshape(-1, size)
    return full.view(">u8").reshape(-1).astype(np.int64)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _frequent(base: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of the corpus and their document counts, FREQUENT of them at most, sorted by shingle.

    Every batch of every partition counts its distinct sets; shingles below BATCH_COUNT there are left out, so what is
    shuffled is the head of each batch. The counts rank shingles and nothing else depends on them.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = {_digest(s): s for s in _sets(frame, n)}
            tokens, times = np.unique(np.concatenate([*sets.values(), np.zeros(0, dtype=np.uint64)]), return_counts=True)
            often = times >= BATCH_COUNT
            yield pd.DataFrame({"token": tokens[often].astype(np.int64), "n": times[often]})

    table = cut(base.select("t").mapInPandas(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    least, total = 1, 0
    for r in table.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        total += r["count"]
        if total > FREQUENT:
            least = r.n + 1
            break
    rows = table.where(F.col("n") >= least).toArrow()
    tokens, times = rows["token"].to_numpy().astype(np.uint64), rows["n"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], times[order]


def choose_prefix(tokens: np.ndarray, extra: np.ndarray, threshold: tuple[int, int], size: int) -> tuple[int, int]:
    """(level, prefix length) with the least estimated cost; extra: other documents estimated for each token, in order."""
    least = -(-threshold[0] * size // threshold[1])
    best = (float("inf"), 1, 1)
    for level in range(1, MAX_LEVEL + 1):
        length = size - least + level
        if length > size:
            break
        met = float(extra[:length].sum())
        # a candidate with `level` matches uses up that many of the list entries met
        cost = ROW_COST * length + MEET_COST * met + VERIFY_COST * size * met / level
        if cost < best[0]:
            best = (cost, level, length)
    return best[1], best[2]


def _prefixes(base: DataFrame, n: int, threshold: tuple[int, int], frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """One row a document: id, set size, digest, level, prefix tokens (TOKEN_BYTES each)."""
    held = base.sparkSession.sparkContext.broadcast(frequent)

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts = held.value
        for frame in frames:
            out = []
            for s in _sets(frame, n):
                if not len(s):
                    out.append((0, None, 0, b""))
                    continue
                often = np.zeros(len(s), dtype=np.int64)
                if len(known):
                    place = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    there = known[place] == s
                    often[there] = counts[place[there]]
                order = np.lexsort((s, often))
                level, length = choose_prefix(s, np.maximum(often[order], RARE), threshold, len(s))
                out.append((len(s), _digest(s), level, _short(s[order][:length], TOKEN_BYTES)))
            yield pd.DataFrame({"id": frame["id"], "n": [x[0] for x in out], "node": [x[1] for x in out], "level": [x[2] for x in out], "prefix": [x[3] for x in out]})

    return base.mapInPandas(make, "id long, n long, node binary, level int, prefix binary")


def _bits(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bit set of the upper numbers of a hash column with values of that many bits: 16 bits of the set for each row, 2**FILTER_BITS at
    most. Partitions mark their rows and the packed sets of a few tasks meet on the driver."""
    size = min(bits, FILTER_BITS, max(10, (16 * df.count()).bit_length()))

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros(1 << size, dtype=bool)
        for frame in frames:
            found[frame[column].to_numpy() >> (bits - size)] = True
        yield pd.DataFrame({"bits": [np.packbits(found).tobytes()]})

    out = np.zeros((1 << size) // 8, dtype=np.uint8)
    for r in df.select(column).coalesce(4).mapInPandas(mark, "bits binary").toLocalIterator():
        out |= np.frombuffer(r.bits, dtype=np.uint8)
    return out


def _has(found: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Whether the set, made of values of that many bits, has each value."""
    places = values >> (bits - (8 * len(found)).bit_length() + 1)
    return (found[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 > 0


def _in_common(x: np.ndarray, y: np.ndarray) -> int:
    """Numbers that two arrays share, repeated ones as often as both have them."""
    u, n = np.unique(x, return_counts=True)
    v, m = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def _token_rows(nodes: DataFrame, bits: np.ndarray | None) -> DataFrame:
    """(token, nid, n, pos) of each token of the shortest prefix at place pos, without those whose bit says they occur once."""
    held = nodes.sparkSession.sparkContext.broadcast(bits)

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = [_long(x, TOKEN_BYTES)[: len(x) // TOKEN_BYTES - k + 1] for x, k in zip(frame["prefix"], frame["level"], strict=True)]
            sizes = [len(x) for x in parts]
            at = np.repeat(np.arange(len(parts)), sizes)
            pos = np.concatenate([*[np.arange(x, dtype=np.int32) for x in sizes], np.zeros(0, dtype=np.int32)])
            tokens = np.concatenate([*parts, np.zeros(0, dtype=np.int64)])
            if held.value is not None:
                keep = _has(held.value, tokens, 8 * TOKEN_BYTES)
                at, tokens, pos = at[keep], tokens[keep], pos[keep]
            for i in range(0, len(tokens), 100_000):
                some = at[i : i + 100_000]
                yield pd.DataFrame({"token": tokens[i : i + 100_000], "nid": frame["nid"].to_numpy()[some], "n": frame["n"].to_numpy()[some], "pos": pos[i : i + 100_000]})

    return nodes.select("nid", "n", "level", "prefix").mapInPandas(rows, "token long, nid long, n long, pos int")


def verified(base: DataFrame, pairs: DataFrame, n: int, threshold: tuple[int, int]) -> DataFrame:
    """(a, b) of the pairs of set digests whose sets reach the threshold, counted exactly on 64-bit hashes.

    base: t. The sets of the pairs' ends alone are made again from the texts.
    """
    ends = cut(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    lead = F.conv(F.hex(F.substring("node", 1, 5)), 16, 10).cast("long")
    bits = base.sparkSession.sparkContext.broadcast(_bits(ends.select(lead.alias("bit")), "bit", 40))

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[bytes] = set()
        for frame in frames:
            found = []
            for s in _sets(frame, n):
                if len(s) and (d := _digest(s)) not in done:
                    if _has(bits.value, np.array([int.from_bytes(d[:5], "big")]), 40)[0]:
                        found.append((d, s.tobytes()))
                        if len(done) < 100_000:
                            done.add(d)
            yield pd.DataFrame(found, columns=["node", "tokens"])

    table = base.select("t").mapInPandas(sets, "node binary, tokens binary")
    table = cut(table.join(ends, "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens")))

    @F.pandas_udf("long")
    def common(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(np.frombuffer(p, dtype=np.uint64), np.frombuffer(q, dtype=np.uint64), assume_unique=True)) for p, q in zip(x, y, strict=True)], dtype="int64")

    first = pairs.join(table.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
    both = first.join(table.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
    size = lambda c: (F.octet_length(c) / 8).cast("long")
    sized = both.select("a", "b", size("ta").alias("na"), size("tb").alias("nb"), common("ta", "tb").alias("both"))
    good = cut(sized.where(F.col("both") * threshold[1] >= (F.col("na") + F.col("nb") - F.col("both")) * threshold[0]).select("a", "b"))
    drop(ends, table)
    return good


def _fit(threshold: tuple[int, int], x: str, y: str, i: str, j: str) -> Column:
    """Sizes x and y can reach the threshold, and a token shared at places i and j can be the first one that a pair which does
    shares: all that it shares follows from there on."""
    left = F.least(F.col(x) - F.col(i), F.col(y) - F.col(j))
    return (F.least(x, y) * threshold[1] >= F.greatest(x, y) * threshold[0]) & (left * sum(threshold) >= (F.col(x) + F.col(y)) * threshold[0])


def _matched(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(x, y) pairs to (a, b) of digests, those whose prefixes share as many tokens as the lower of their levels."""
    ends = pairs.select(F.col("x").alias("nid")).unionByName(pairs.select(F.col("y").alias("nid"))).distinct()
    part = nodes.select("nid", "node", "level", "prefix").join(ends, "nid", "left_semi")

    @F.pandas_udf("int")
    def shared(p: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series([_in_common(_long(u, TOKEN_BYTES), _long(v, TOKEN_BYTES)) for u, v in zip(p, q, strict=True)], dtype="int32")

    side = lambda nid, node, name: part.select(F.col("nid").alias(nid), F.col("node").alias(node), F.col("level").alias(f"l{name}"), F.col("prefix").alias(f"p{name}"))
    both = pairs.join(side("x", "a", "x"), "x").join(side("y", "b", "y"), "y")
    return both.where(shared("px", "py") >= F.least("lx", "ly")).select("a", "b")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """(id, n_shingles, component_id) of each document row.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Two documents link when
    ``threshold[1] * |common| >= threshold[0] * |union|`` of their distinct n-word shingles; with fewer
    than n words the whole sequence is the one shingle. Texts that are null or without a word have size
    0 and link with nothing. component_id is the least id reachable by links, its own included; a row
    with a null id keeps a null or a smaller neighbour's id. Repeated rows stay repeated; other columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    made = cut(_prefixes(base, n, threshold, _frequent(base, n)))
    nodes = made.where("node is not null").groupBy("node").agg(F.min("id").alias("own"), F.first("n").alias("n"), F.first("level").alias("level"), F.first("prefix").alias("prefix"))
    nodes = cut(nodes.withColumn("nid", F.monotonically_increasing_id()))
    rows = cut(made.select("id", "n", "node"))
    drop(made)
    digests = nodes.select("nid", "node")
    often = cut(_token_rows(nodes, None).groupBy("token").count().where("count > 1").select("token"))
    rare = _token_rows(nodes, _bits(often, "token", 8 * TOKEN_BYTES))
    # the node that has the token earliest has the fewest tokens of its own: of a group of copies the one that most others are near to
    heads = rare.groupBy("token").agg(F.min(F.struct("pos", "nid", "n")).alias("head"), F.count("*").alias("size")).where("size > 1").drop("size")
    lists = cut(rare.join(heads, "token"))  # tokens that two nodes or more have, each row with its list's head
    drop(often)

    def linked(pairs: DataFrame) -> DataFrame:
        matched = cut(_matched(nodes, pairs))
        good = verified(base, matched, n, threshold)
        drop(matched)
        first = good.join(digests.select(F.col("node").alias("a"), F.col("nid").alias("x")), "a")
        return first.join(digests.select(F.col("node").alias("b"), F.col("nid").alias("y")), "b").select("x", "y")

    stars = lists.where("nid <> head.nid").select(F.col("head.nid").alias("x"), F.col("nid").alias("y"), F.col("n").alias("ny"), F.col("head.n").alias("nx"), F.col("pos").alias("j"), F.col("head.pos").alias("i"))
    stars = cut(stars.where(_fit(threshold, "nx", "ny", "i", "j")).select("x", "y").distinct())
    links = cut(linked(stars))

    labels = connected_components(links)
    inside = lists.join(labels.withColumnRenamed("node", "nid"), "nid", "left").select("token", "nid", "n", "pos", F.coalesce("label", "nid").alias("class"))
    classes = inside.groupBy("token", "class").agg(F.count("*").alias("size"))
    main = classes.groupBy("token").agg(F.max(F.struct("size", "class")).alias("main"), F.count("*").alias("classes")).where("classes > 1").select("token", F.col("main.class").alias("main"))
    mixed = cut(inside.join(main, "token"))
    drop(lists)
    rest = mixed.where("class <> main").select("token", F.col("nid").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("j"), F.col("class").alias("cy"))
    more = (
        mixed.select("token", F.col("nid").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("i"), F.col("class").alias("cx"), "main")
        .join(rest, "token").where("cx <> cy and (cx = main or x < y)").where(_fit(threshold, "nx", "ny", "i", "j"))
        .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    )
    tried = stars.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    more = cut(more.join(tried, ["x", "y"], "left_anti"))  # a star that failed needs no second look
    drop(mixed, stars)
    if not more.isEmpty():
        links = cut(links.unionByName(linked(more)))
        labels = connected_components(links)
    classed = nodes.select("nid", "node", "own").join(labels.withColumnRenamed("node", "nid"), "nid", "left").select("node", "own", F.coalesce("label", "nid").alias("class"))
    least = classed.groupBy("class").agg(F.min("own").alias("component_id"))
    final = cut(classed.join(least, "class").select("node", "component_id"))
    drop(nodes)
    found = rows.where("node is not null").select("id", "n", "node").join(final, "node").select("id", "n", "component_id")
    alone = rows.where("node is null").select("id", "n", F.col("id").alias("component_id"))
    return found.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """Rows of docs that stay: of each class of near-duplicates the one with the least id, every column kept.

    Rows without words link with nothing and all stay, as do rows with a null id. Rows that repeat an
    id stay or go together.
    """
    found = jaccard_components(docs, id_col, text_col, n, threshold)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
