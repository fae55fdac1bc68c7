"""Vectors as short codes: each part of a vector becomes the index of its nearest codebook entry (product quantisation) in integer arithmetic.

The nearest entry is found by equal-average search: entries are sorted by the sum of their components, and from a part's
own sum the search goes outward to both sides. As (sum gap)^2 / dimension is a lower bound of the squared distance, it ends where that
bound strictly exceeds the best distance so far, so ties are still seen. Tasks send one row of counts and sums for each part position and entry; codebooks
(parts x entries rows, a bound set by the parameters) go through the driver between the rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm._graph import cut

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integers beyond this are held at it, so that the squared distance of a vector of up to 64 components fits 64 bits.
LARGEST = 2**27


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, held within +-LARGEST; null where the vector is null, empty or holds null or non-finite components."""
    limit = float(LARGEST)
    good = (F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.when(good, F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), x.cast("double") * scale))).cast("int")))


def nearest(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest row of book to each row of vectors (int64), ties to the lower index.

    Every vector holds two places in the entries' order by sum; the side whose sum gap is smaller is tried next, until the
    smaller gap's bound strictly exceeds its best distance.
    """
    n, (entries, dimension) = len(vectors), book.shape
    order = np.argsort(book.sum(axis=1), kind="stable")
    sums = book.sum(axis=1)[order]
    index, best = np.full(n, entries, dtype=np.int64), np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
    active, own = np.arange(n), vectors.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    far = np.int64(2**62)
    while len(active):
        gap_left = np.where(left >= 0, own - sums[np.maximum(left, 0)], far)
        gap_right = np.where(right < entries, sums[np.minimum(right, entries - 1)] - own, far)
        gap, to_left = np.minimum(gap_left, gap_right), gap_left <= gap_right
        # gap ** 2 / dimension > best, without leaving 64 bits: both sides as floats decide only where they are clearly apart
        bound, held = gap.astype(np.float64) ** 2, best[active].astype(np.float64) * dimension
        go = (gap < far) & ~(bound > held * (1 + 1e-9))
        close = go & (bound > held * (1 - 1e-9))
        if close.any():
            go[close] = [int(g) ** 2 <= int(b) * dimension for g, b in zip(gap[close], best[active[close]], strict=True)]
        if not go.all():
            active, own, left, right, to_left = active[go], own[go], left[go], right[go], to_left[go]
            if not len(active):
                break
        entry = order[np.where(to_left, left, np.minimum(right, entries - 1))]
        distance = ((vectors[active] - book[entry]) ** 2).sum(axis=1)
        better = (distance < best[active]) | ((distance == best[active]) & (entry < index[active]))
        index[active[better]], best[active[better]] = entry[better], distance[better]
        left, right = left - to_left, right + ~to_left
    return index, best


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _sums(books: list[np.ndarray], width: int):
    """Task: counts and componentwise sums of the parts that fall to each entry, one row a part position and entry."""
    step = width // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(b), dtype=np.int64) for b in books]
        total = [np.zeros(b.shape, dtype=np.int64) for b in books]
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            for p, book in enumerate(books):
                part = rows[:, p * step : (p + 1) * step]
                index, _ = nearest(part, book)
                count[p] += np.bincount(index, minlength=len(book))
                np.add.at(total[p], index, part)
        rows = [(p, e, int(count[p][e]), total[p][e].tolist()) for p in range(len(books)) for e in range(len(books[p])) if count[p][e]]
        yield pa.RecordBatch.from_pydict({"part": pa.array([r[0] for r in rows], pa.int32()), "entry": pa.array([r[1] for r in rows], pa.int32()), "n": pa.array([r[2] for r in rows], pa.int64()), "total": pa.array([r[3] for r in rows], pa.list_(pa.int64()))})

    return run


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", ints_col: str = "ints") -> list[np.ndarray]:
    """Codebooks, one array (entry, component) a part, of a table of integer vectors of one length.

    The first codebook holds the parts of the vectors with the smallest ids (nulls last, equal ids by their components), at most entries of them; each round assigns all parts
    and puts floor(sum / count) in place of each used entry. No rows give no entries.
    """
    first = vectors.orderBy(F.col(id_col).asc_nulls_last(), ints_col).limit(entries).select(ints_col).collect()
    if not first:
        return []
    start = np.array([r[0] for r in first], dtype=np.int64)
    width = start.shape[1]
    books = [start[:, p * (width // parts) : (p + 1) * (width // parts)].copy() for p in range(parts)]
    for _ in range(rounds):
        sent = vectors.select(ints_col).mapInArrow(_sums(books, width), "part int, entry int, n long, total array<long>")
        places = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width // parts)]
        books = [b.copy() for b in books]
        for row in sent.groupBy("part", "entry").agg(F.sum("n").alias("n"), *places).collect():
            books[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width // parts)]
    return books


def books_sha256(books: list[np.ndarray]) -> str:
    """Of all components as decimal text by part, entry and place, with commas between."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def assign(vectors: DataFrame, books: list[np.ndarray], ints_col: str = "ints") -> DataFrame:
    """Adds code (two hex digits a part, so at most 256 entries) and error (squared distances of all parts); ints_col goes. No shuffle."""
    names = [c for c in vectors.columns if c != ints_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [batch.column(i) for i in range(len(names))]
            rows = _matrix(batch.column(len(names)), sum(b.shape[1] for b in books)) if batch.num_rows else np.zeros((0, 1), dtype=np.int64)
            codes, error, at = np.zeros((len(rows), len(books)), dtype=np.uint8), np.zeros(len(rows), dtype=np.int64), 0
            for p, book in enumerate(books):
                codes[:, p], distance = nearest(rows[:, at : at + book.shape[1]], book) if len(rows) else (0, 0)
                error, at = error + distance, at + book.shape[1]
            yield pa.RecordBatch.from_arrays([*rest, pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())], names=[*names, "code", "error"])

    kinds = vectors.select(*names).schema.add("code", "string").add("error", "long")
    return vectors.select(*names, ints_col).mapInArrow(run, kinds)


def compress(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of each row whose vector is neither null nor empty nor holds null or non-finite components.

    label_error is the error summed over the rows of an equal label, nulls together. Components count as floor(scale * x), held within +-2^27 (see
    LARGEST). Vectors of another length than that of the smallest kept id, or whose length the parts don't divide, cannot be coded: they keep their
    row with code and error null and count in no sum. Repeated and null ids keep their rows; a label's total is null where it passes 64 bits; other
    columns are ignored; an empty table gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256: a code has two hex digits a part")
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), integers(F.col(vector_col), scale).alias("ints")).where("ints is not null")
    kept = cut(rows)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "ints").select(F.size("ints").alias("n")).limit(1).collect()
    width = first[0]["n"] if first and first[0]["n"] % parts == 0 else 0
    fits = kept.where(F.size("ints") == width)
    books = train(fits, parts, entries, rounds, "id") if width else []
    coded = cut(assign(fits, books)) if books else kept.limit(0).select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    totals = coded.groupBy("label").agg(F.expr("try_cast(sum(cast(error as decimal(38,0))) as long)").alias("label_error")).select(F.col("label").alias("of"), "label_error")
    summed = coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").select("id", "code", "error", "label_error")
    odd = kept.where(F.size("ints") != width).select("id", F.lit(None).cast("string").alias("code"), *(F.lit(None).cast("long").alias(c) for c in ("error", "label_error")))
    return summed.unionByName(odd).select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
