"""Sum-of-squares online packing of token sequences into windows of fixed capacity.

Each document is placed, in order of arrival, into the fill level h that makes the sum over all
levels of N(h)**2 least, where N(h) counts the partially filled windows at level h; N is the level
array, and each level keeps a stack of its windows. Documents longer than a window fill whole
windows first; the rest is placed. What stays partially filled at the end of a partition is closed by
cutting: the pieces of the emptier windows fill up the fuller ones, so a partition leaves one window
with padding. A partition packs on its own, so there is no shuffle, and memory is the level
array, at most a few open windows for each level, and a batch of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.bpe import shared_table

WINDOW = 1024
SCHEMA = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class LevelArray:
    """Open windows by fill level, and the least-squares choice among them."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(capacity)]

    def place(self, size: int) -> tuple[int, list]:
        """(level, window) for a piece of size tokens; a new window is an empty list. Ties go to the fullest level."""
        capacity, count = self.capacity, self.count
        levels = np.flatnonzero(count[1 : capacity - size + 1]) + 1
        # change of the sum of squares: one window leaves level h and, unless now full, enters h + size
        change = np.append(1 - 2 * count[levels] + np.where(levels + size < capacity, 2 * count[np.minimum(levels + size, capacity - 1)] + 1, 0), 2 * count[size] + 1 if size < capacity else 0)
        best = len(change) - 1 - int(np.argmin(change[::-1]))
        if best == len(levels) and len(levels) and change[best] == change[:-1].min():
            best = len(levels) - 1 - int(np.argmin(change[:-1][::-1]))
        if best == len(levels):
            return 0, []
        level = int(levels[best])
        count[level] -= 1
        return level, self.open[level].pop()

    def put(self, level: int, window: list) -> None:
        self.count[level] += 1
        self.open[level].append(window)

    def rest(self) -> list[list]:
        """Open windows, fullest first."""
        return [w for level in reversed(self.open) for w in level]


def pack_pieces(documents: Iterator[tuple[object, bytes]], capacity: int = WINDOW) -> Iterator[list[tuple]]:
    """Windows as lists of (id, start, ids, doc_tokens); ids are little-endian 32-bit, each in exactly one piece."""
    levels = LevelArray(capacity)
    for key, ids in documents:
        total, start = len(ids) // 4, 0
        while total - start >= capacity:
            yield [(key, start, ids[4 * start : 4 * (start + capacity)], total)]
            start += capacity
        if start == total:
            continue
        piece = (key, start, ids[4 * start :], total)
        level, window = levels.place(total - start)
        window.append(piece)
        if level + total - start == capacity:
            yield window
        else:
            levels.put(level + total - start, window)
    windows = levels.rest()
    sizes = [sum(len(p[2]) // 4 for p in w) for w in windows]
    first, last = 0, len(windows) - 1
    while first < last:  # the emptiest window's pieces fill the fullest one
        room = capacity - sizes[first]
        if not room:
            yield windows[first]
            first += 1
            continue
        key, start, ids, total = windows[last].pop()
        n = len(ids) // 4
        if n > room:
            windows[last].append((key, start + room, ids[4 * room :], total))
            ids, n = ids[: 4 * room], room
        windows[first].append((key, start, ids, total))
        sizes[first] += n
        sizes[last] -= n
        if not sizes[last]:
            last -= 1
    if first == last:
        yield windows[first]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = WINDOW, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """One row a piece: id, start, length, ids, doc_tokens, sequence_id, offset.

    A document's tokens are its BPE ids and then end_id, so a null or empty text is the one token end_id. ids
    holds the piece's tokens as little-endian unsigned 32-bit numbers; offset is gapless from 0 in each
    sequence. Only the last sequence of a partition has padding. Rows with a null id are packed under that
    null; repeated rows are packed each; other columns are ignored; an empty table gives no rows. The
    result depends on the rows and their order in each partition alone, so a lost task is redone alike.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, end = shared_table(vocabulary), np.array([end_id], dtype="<u4").tobytes()
        base, out = TaskContext.get().partitionId() << 36, []
        rows = ((k, table.ids(t) + end) for f in frames for k, t in zip(f["id"], f["t"], strict=True))
        size = 0
        for number, window in enumerate(pack_pieces(rows, capacity)):
            at = 0
            for key, start, ids, total in window:
                n = len(ids) // 4
                out.append((key, start, n, ids, total, base + number, at))
                at += n
            size += at
            if size > 1_000_000:
                yield _frame(out)
                out, size = [], 0
        yield _frame(out)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInPandas(run, SCHEMA).withColumnRenamed("id", id_col)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
    return frame.astype({"id": "Int64"})
