"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked id pairs.

First pass: every text is encoded by both tokenizers, each block of documents sends its distinct linked id pairs with their
counts, by shard of the second id. The distinct pairs of a shard get a minimal perfect hash with the keys stored in its order. Blocks' counts become
dense vectors under that hash, which are summed as a tree; a pair is best where its count is the highest of its second
id. Second pass: counts go back to the blocks that have the pairs, which align their documents again and look them up.

Nothing that grows with the corpus is broadcast or collected: a shard's table is bounded by the two vocabularies, a block by its rows and characters.

Texts are cut into chunks (white space with what follows it), as neither tokenizer has a token across such a cut; the distinct chunks of a
block are encoded and aligned once, together. Texts with white space other than spaces and line feeds, and texts with a chunk whose tokens don't
spell its bytes, are aligned whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm import bpe, sentencepiece_codec
from panelspark.llm._graph import cut, drop
from panelspark.llm._text import _powers, mix
from panelspark.llm.mphf import PerfectHash, verified_index

#: Shards of the pair table; documents of a block, and characters from which a document is long and very long.
SHARDS, BLOCK_ROWS, LONG = 64, 4096, (16_384, 131_072)
#: Rows of blocks whose counts meet in one dense vector, least number of such vectors a shard, vectors summed at a time.
VECTOR_ROWS, LEAST_VECTORS, FAN_IN = 4096, 4, 8
#: White space other than spaces and line feeds; bytes of texts that have none of it: ASCII without other controls, and leads of two bytes but the first.
_OTHER = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
_PLAIN = bytes([10, *range(32, 128), *range(0x80, 0xC0), *range(0xC3, 0xE0)])
_CODE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


class Vocabularies:
    """Both tokenizers, with the bytes and the decimal text of each id."""

    def __init__(self, ranks: str | None, model: str | None) -> None:
        table, pieces = bpe.ChunkTable(ranks), sentencepiece_codec.PieceTable(model)
        self.encode_a, self.model_b, self.separable = table.encode, pieces.whole, pieces.separable
        self.marker = self.model_b.piece_to_id(sentencepiece_codec.MARK)
        self.bytes_a = table.token_bytes
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.model_b.is_byte(i) else p.replace(sentencepiece_codec.MARK, " ").encode() for i in range(self.model_b.get_piece_size()) for p in [self.model_b.id_to_piece(i)]]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.texts = {end: np.array([f"{i}{end}" for i in range(most)], dtype=object) for end in (",", "|", ";", "\n")}

    def first(self, solid: list[str], others: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids a text) of the first side; solid texts begin with white space and end in another character, so one call over all of them gives each one's ids."""
        flat = np.array(self.encode_a("".join(solid)), dtype=np.int64)
        ends, wanted = np.concatenate([[0], np.cumsum(self.sizes_a[flat])]), np.concatenate([[0], np.cumsum(sizes)])
        cuts = np.searchsorted(ends, wanted)
        if ends[-1] != wanted[-1] or (ends[cuts] != wanted).any():
            return _flattened([self.encode_a(t) for t in (*solid, *others)])
        rest, counts = _flattened([self.encode_a(t) for t in others])
        return np.concatenate([flat, rest]), np.concatenate([np.diff(cuts), counts])

    def second(self, chunks: list[str], wholes: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids a text) of the second side, which puts a marker before a text: it stands for a chunk's own space, or goes with a line feed put before the chunk."""
        found = self.model_b.encode([c[1:] if c[0] == " " else "\n" + c for c in chunks], num_threads=1)
        ids = [x if c[0] == " " else x[2:] for c, x in zip(chunks, found, strict=True)]
        return _flattened([x or [self.marker] for x in ids] + (self.model_b.encode(wholes, num_threads=1) if wholes else []))

    def spelt(self, texts: list[str], sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Whether the second side's tokens of each text spell it."""
        of = self.bytes_b
        ends = np.concatenate([[0], np.cumsum(self.sizes_b[ids])])[np.concatenate([[0], np.cumsum(counts)])]
        made, wanted = b"".join([of[i] for i in ids.tolist()]), "".join(texts).encode()
        good = np.diff(ends) == sizes
        if good.all() and made == wanted:
            return good
        own = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        return np.array([made[ends[i] : ends[i + 1]] == wanted[own[i] : own[i + 1]] for i in range(len(texts))], dtype=bool)


def _flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array(list(map(len, lists)), dtype=np.int64)
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(counts.sum())), counts


def _odd_space(text: bytes) -> bool:
    """Whether a text has white space other than spaces and line feeds."""
    return text.translate(None, _PLAIN) != b"" and bool(_OTHER.search(text.decode()))


def cut_chunks(texts: list[bytes]) -> tuple[list[str], list[np.ndarray]]:
    """(distinct chunks, each text's chunks as positions there) of texts that aren't empty, with a space put before each.

    A chunk begins where white space follows another character. Chunks are told apart by a hash of their bytes, and then compared with the first of their hash.
    """
    if not texts:
        return [], []
    blob = b" " + b" ".join(texts)
    data = np.frombuffer(blob, dtype=np.uint8)
    heads = np.concatenate([[0], np.cumsum(np.array(list(map(len, texts)), dtype=np.int64) + 1)])
    space = (data == 32) | (data == 10)
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[heads[:-1]] = True
    starts = np.flatnonzero(first)
    sizes = np.diff(starts, append=len(data))
    inside = np.arange(len(data)) - np.repeat(starts, sizes)
    with np.errstate(over="ignore"):
        hashes = mix(np.add.reduceat(_CODE[data] * _powers(int(sizes.max()))[inside], starts))
    _, one, at = np.unique(hashes, return_index=True, return_inverse=True)
    same = (sizes == sizes[one][at]).all() and (data == data[np.repeat(starts[one][at], sizes) + inside]).all()
    if not same:  # two chunks with one hash: tell them apart by their bytes
        known: dict[bytes, int] = {}
        at = np.array([known.setdefault(blob[i : i + n], len(known)) for i, n in zip(starts.tolist(), sizes.tolist(), strict=True)], dtype=np.int64)
        return [c.decode() for c in known], np.split(at, np.searchsorted(starts, heads[1:-1]))
    chunks = [blob[i : i + n].decode() for i, n in zip(starts[one].tolist(), sizes[one].tolist(), strict=True)]
    return chunks, np.split(at, np.searchsorted(starts, heads[1:-1]))


class Block:
    """Documents as positions in a list of distinct chunks, which are aligned together.

    A group ends where tokens of both sides end; every pair of tokens that overlap is a link, so links end where a token of either side
    does. The table has each chunk's tokens of either side, groups and links.
    """

    def __init__(self, words: Vocabularies, texts: list[bytes | None], groups: bool = True) -> None:
        some = [i for i, t in enumerate(texts) if t]
        whole = {i: texts[i].decode() for i in some if not words.separable or _odd_space(texts[i])}
        cut = [i for i in some if i not in whole]
        chunks, at = cut_chunks([texts[i] for i in cut])
        blank = np.array([c[-1] in " \n" for c in chunks], dtype=bool)
        order = np.argsort(blank, kind="stable")
        chunks, to = [chunks[i] for i in order.tolist()], np.argsort(order)
        places = {i: to[x] for i, x in zip(cut, at, strict=True)}
        good = self._encode(words, chunks, int((~blank).sum()), [])
        if not good.all():  # such texts are tried whole
            whole |= {i: texts[i].decode() for i, x in places.items() if not good[x].all()}
        if whole:
            rows = {t: len(chunks) + k for k, t in enumerate(dict.fromkeys(whole.values()))}
            good = self._encode(words, chunks, int((~blank).sum()), list(rows))
            places |= {i: np.array([rows[t]] if good[rows[t]] else [], dtype=np.int64) for i, t in whole.items()}
        self.places = [places.get(i, np.zeros(0, dtype=np.int64)) for i in range(len(texts))]
        self._align(words, groups)

    def _encode(self, words: Vocabularies, chunks: list[str], solid: int, wholes: list[str]) -> np.ndarray:
        """Encodes all texts; the tokens of those that they don't spell are left out, and the rest is said to be good."""
        texts = [*chunks, *(" " + t for t in wholes)]
        sizes = np.array(list(map(len, map(str.encode, texts))), dtype=np.int64)
        a, count_a = words.first(texts[:solid], texts[solid:], sizes[:solid])
        b, count_b = words.second(chunks, wholes)
        good = words.spelt(texts, sizes, b, count_b)
        ends = np.concatenate([[0], np.cumsum(words.sizes_a[a])])[np.concatenate([[0], np.cumsum(count_a)])]
        good &= np.diff(ends) == sizes  # byte-level tokens spell what they were cut from
        if not good.all():
            a, b = a[np.repeat(good, count_a)], b[np.repeat(good, count_b)]
        self.a, self.b, self.count_a, self.count_b = a, b, np.where(good, count_a, 0), np.where(good, count_b, 0)
        return good

    def _align(self, words: Vocabularies, groups: bool) -> None:
        a, b = self.a, self.b
        ends_a, ends_b = np.cumsum(words.sizes_a[a]), np.cumsum(words.sizes_b[b])
        chunk_ends = np.concatenate([[0], ends_a])[np.cumsum(self.count_a)]
        link_ends = np.union1d(ends_a, ends_b)
        self.links = a[np.searchsorted(ends_a, link_ends)].astype(np.uint64) << np.uint64(32) | b[np.searchsorted(ends_b, link_ends)].astype(np.uint64)
        count = lambda ends: np.diff(np.searchsorted(ends, chunk_ends, side="right"), prepend=0)
        self.sizes = count(link_ends)
        if not groups:
            return
        group_ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.table = np.stack([self.count_a, self.count_b, count(group_ends), self.sizes], axis=1)
        # the ids as text: of each group its first side's tokens, then its second's
        group_a, group_b = np.searchsorted(group_ends, ends_a), np.searchsorted(group_ends, ends_b)
        before_a, before_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=len(group_ends)))]) for g in (group_a, group_b))
        out = np.empty(len(a) + len(b), dtype=object)
        out[np.arange(len(a)) + before_b[group_a]] = np.where(ends_a == group_ends[group_a], words.texts["|"][a], words.texts[","][a]) if len(a) else None
        last = np.where(np.isin(ends_b, chunk_ends), words.texts["\n"][b], words.texts[";"][b])
        out[np.arange(len(b)) + before_a[group_b + 1]] = np.where(ends_b == group_ends[group_b], last, words.texts[","][b]) if len(b) else None
        rows = iter("".join(out.tolist()).split("\n"))
        self.groups = [next(rows) if n else "" for n in self.count_a.tolist()]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct pairs, counts) over all documents."""
        seen = np.bincount(np.concatenate(self.places), minlength=len(self.sizes)) if self.places else np.zeros(0, dtype=np.int64)
        keys, at = np.unique(self.links, return_inverse=True)
        counts = np.zeros(len(keys), dtype=np.int64)
        np.add.at(counts, at, np.repeat(seen, self.sizes))
        return keys[counts > 0], counts[counts > 0]

    def rows(self, keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> Iterator[tuple]:
        """Of each document: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; keys are sorted and hold every pair that a document has."""
        ends = np.concatenate([[0], np.cumsum(self.sizes)])
        of, flags = np.zeros(len(self.links), dtype=np.int64), np.zeros(len(self.links), dtype=np.int64)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, self.links), len(keys) - 1)
            known = keys[at] == self.links  # a chunk of texts that were aligned whole may hold others
            of, flags = np.where(known, counts[at], 0), np.where(known, best[at], 0)
        sums, bests = np.concatenate([[0], np.cumsum(of)]), np.concatenate([[0], np.cumsum(flags)])
        table = np.column_stack([self.table, bests[ends[1:]] - bests[ends[:-1]], sums[ends[1:]] - sums[ends[:-1]]])
        for places in self.places:
            groups = ";".join([self.groups[x] for x in places.tolist()])
            yield *table[places].sum(axis=0).tolist(), hashlib.sha256(groups.encode()).hexdigest() if len(places) else ""


@lru_cache(maxsize=1)
def _words(ranks: str | None, model: str | None) -> Vocabularies:
    """Those of this Python worker, kept from task to task."""
    return Vocabularies(ranks, model)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """By the second id, so that all pairs of one such id are together."""
    with np.errstate(over="ignore"):
        return ((keys & np.uint64(0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(shards)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32), pa.array(np.concatenate(values) if values else np.zeros(0, dtype=np.int64), pa.int64()))


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def block_pairs(blocks: DataFrame, shards: int = SHARDS, ranks: str | None = None, model: str | None = None) -> DataFrame:
    """(block, shard, keys, counts) of (block, text) rows: the distinct linked pairs of a batch's rows of one block. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).cast(pa.binary())
            order = np.argsort(of, kind="stable")  # documents of one block together
            of, texts = of[order], texts.take(pa.array(order))
            edges = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                keys, counts = Block(_words(ranks, model), texts.slice(lo, hi - lo).to_pylist(), groups=False).pairs()
                at = _shard(keys, shards).astype(np.int64)
                order = np.argsort(at, kind="stable")
                found, first = np.unique(at[order], return_index=True)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), of[lo]), pa.int64()), pa.array(found, pa.int32()), _lists(np.split(keys[order].astype(np.int64), first[1:])), _lists(np.split(counts[order], first[1:]))], names=["block", "shard", "keys", "counts"])

    return blocks.select("block", "text").mapInArrow(run, "block long, shard int, keys array<long>, counts array<long>")


def pair_hashes(pairs: DataFrame) -> DataFrame:
    """(shard, hash, keys): the minimal perfect hash of each shard's distinct pairs, and the pairs by their index."""

    def build(rows: pa.Table) -> pa.Table:
        keys = rows.column("key").to_numpy().astype(np.uint64)
        table = PerfectHash.build(keys)
        stored = np.zeros(len(keys), dtype="<u8")
        stored[table.index(keys)] = keys
        return pa.table({"shard": rows.column("shard").slice(0, 1), "hash": pa.array([table.to_bytes()], pa.binary()), "stored": pa.array([stored.tobytes()], pa.binary())})

    return pairs.select("shard", F.explode("keys").alias("key")).distinct().groupBy("shard").applyInArrow(build, "shard int, hash binary, stored binary")


def pair_counts(pairs: DataFrame, hashes: DataFrame, slices: int, fan_in: int = FAN_IN) -> DataFrame:
    """hashes with counts and best of each index: dense vectors of the slices of blocks, summed fan_in at a time."""
    copies = hashes.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def dense(own: pa.Table, table: pa.Table) -> pa.Table:
        stored = np.frombuffer(table.column("stored")[0].as_py(), dtype="<u8")
        keys, vector = _flat(own.column("keys")).astype(np.uint64), np.zeros(len(stored), dtype="<i8")
        np.add.at(vector, verified_index(PerfectHash.from_bytes(table.column("hash")[0].as_py()), stored, keys), _flat(own.column("counts")))
        return pa.table({"shard": table.column("shard"), "slice": table.column("slice"), "vector": pa.array([vector.tobytes()], pa.binary())})

    def add(rows: pa.Table) -> pa.Table:
        total = np.frombuffer(rows.column("vector")[0].as_py(), dtype="<i8").copy()
        for i in range(1, rows.num_rows):
            total += np.frombuffer(rows.column("vector")[i].as_py(), dtype="<i8")
        return pa.table({"shard": rows.column("shard").slice(0, 1), "slice": rows.column("slice").slice(0, 1), "vector": pa.array([total.tobytes()], pa.binary())})

    kind = "shard int, slice int, vector binary"
    vectors = pairs.select("shard", "slice", "keys", "counts").groupBy("shard", "slice").cogroup(copies.groupBy("shard", "slice")).applyInArrow(dense, kind)
    while slices > 1:
        vectors, slices = vectors.withColumn("slice", (F.col("slice") / fan_in).cast("int")).groupBy("shard", "slice").applyInArrow(add, kind), -(-slices // fan_in)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for stored, vector in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                second, counts = np.frombuffer(stored, dtype="<u8") & np.uint64(0xFFFFFFFF), np.frombuffer(vector, dtype="<i8")
                order = np.argsort(second, kind="stable")
                _, first, size = np.unique(second[order], return_index=True, return_counts=True)
                best = np.zeros(len(counts), dtype=np.uint8)
                best[order] = counts[order] == np.repeat(np.maximum.reduceat(counts[order], first), size)
                marks.append(best.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.binary())], names=["shard", "hash", "stored", "vector", "best"])

    return hashes.join(vectors.select("shard", "vector"), "shard").select("shard", "hash", "stored", "vector").mapInArrow(mark, "shard int, hash binary, stored binary, vector binary, best binary")


def _answers(pairs: DataFrame, counted: DataFrame, slices: int) -> DataFrame:
    """(block, keys, counts, best) of each row of pairs."""
    copies = counted.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def look_up(own: pa.Table, table: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "keys": _lists([]), "counts": _lists([]), "best": _lists([])})
        stored, counts, best = (np.frombuffer(table.column(c)[0].as_py(), dtype=t) for c, t in (("stored", "<u8"), ("vector", "<i8"), ("best", np.uint8)))
        lists = own.column("keys").combine_chunks()
        at = verified_index(PerfectHash.from_bytes(table.column("hash")[0].as_py()), stored, lists.flatten().to_numpy().astype(np.uint64))
        cuts = np.cumsum([len(x) for x in lists])[:-1]
        return pa.table({"block": own.column("block"), "keys": own.column("keys"), "counts": _lists(np.split(counts[at], cuts)), "best": _lists(np.split(best[at].astype(np.int64), cuts))})

    return pairs.select("block", "shard", "slice", "keys").groupBy("shard", "slice").cogroup(copies.groupBy("shard", "slice")).applyInArrow(look_up, "block long, keys array<long>, counts array<long>, best array<long>")


def _block(rows: int) -> Column:
    """Blocks of neighbouring rows: short documents by themselves, long ones by themselves in smaller blocks, very long ones each alone."""
    size = F.length("text")
    short, long = F.coalesce(size <= LONG[0], F.lit(True)), size <= LONG[1]
    number = F.when(short, F.expr(f"row div {rows}")).when(long, F.expr(f"row div {max(1, rows // 4)}")).otherwise(F.col("row"))
    return number * 4 + F.when(short, 0).when(long, 1).otherwise(2)


def token_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, model: str | None = None, shards: int = SHARDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row's whole text.

    A null or empty text, and one whose tokens don't spell it, has zeros and ''. Repeated rows and null ids are kept and count each
    time; other columns are ignored; an empty table gives no rows. ranks and model: files of the byte-level and of the piece vocabulary.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id())
    blocks = cut(rows.select("id", "text", _block(block_rows).alias("block")))
    made = cut(block_pairs(blocks, shards, ranks, model))
    slices = max(LEAST_VECTORS, -(-made.count() // (VECTOR_ROWS * shards)))
    pairs = made.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int"))
    hashes = cut(pair_hashes(pairs))
    counted = cut(pair_counts(pairs, hashes, slices))
    drop(hashes)
    answers = cut(_answers(pairs, counted, slices))
    drop(made, counted)

    def finish(own: pa.Table, answer: pa.Table) -> pa.Table:
        keys, at = np.unique(_flat(answer.column("keys")).astype(np.uint64), return_index=True)
        block = Block(_words(ranks, model), own.column("text").cast(pa.binary()).to_pylist())
        found = list(zip(*block.rows(keys, _flat(answer.column("counts"))[at], _flat(answer.column("best"))[at]), strict=True)) or [()] * 7
        names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
        return pa.table({"id": own.column("id"), **{c: pa.array(found[i], pa.int64()) for i, c in enumerate(names)}, "groups_sha256": pa.array(found[6], pa.string())})

    schema = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, schema).withColumnRenamed("id", id_col)
