"""SentencePiece encoding and decoding of whole texts through a table of distinct chunks.

No piece of the model has a whitespace marker after another character, and none holds a line feed, so
no piece spans a change from another character to a marker, nor a line feed. A text, with markers for
its spaces and one before it, is cut there; each distinct chunk is segmented once by the library
and the ids are joined back by position. ``chunks_are_separable`` checks the model for both facts; where
they don't hold, whole texts go to the library.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._text import stretches

MARK = "\u2581"
_CHUNK = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
_BOUNDARY = re.compile(f"[^{MARK}](?={MARK})|\n")
#: Distinct chunks that a worker keeps, their longest length, and characters that are handled at a time.
TABLE_ROWS, TABLE_CHARS, STRETCH = 400_000, 64, 1_000_000


class PieceTable:
    def __init__(self, path: str | None = None) -> None:
        import public_tokenizers
        import sentencepiece

        path = path or public_tokenizers.path("piece_bpe_32k.model")
        self.whole = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.whole.id_to_piece(i) for i in range(self.whole.get_piece_size())]
        self.separable = chunks_are_separable(pieces) and self._plain()
        self.table: dict[str, bytes] = {}

    def _plain(self) -> bool:
        """The normaliser adds the leading marker and changes nothing else, as probed on awkward strings."""
        probe = " a  b\n\n c \u00c5\u212b\ufb01 \u00a0x\u3000y "
        return self.whole.decode(self.whole.encode(probe)) == probe

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of distinct chunks that aren't in the table; short ones go there."""
        # the library puts a marker before a text: it stands for the chunk's own, or comes off with a line feed
        marked = [c[1:] if c[0] == MARK else "\n" + c for c in chunks]
        found = {}
        for c, ids in zip(chunks, self.whole.encode(marked, num_threads=1), strict=True):
            if c == MARK:
                ids = [self.whole.piece_to_id(MARK)]
            found[c] = np.array(ids if c[0] == MARK else ids[2:], dtype="<u4").tobytes()
        room = TABLE_ROWS - len(self.table)
        for c, ids in found.items():
            if room <= 0:
                break
            if len(c) <= TABLE_CHARS:
                self.table[c] = ids
                room -= 1
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if not self.separable:
            return [np.array(self.whole.encode(t), dtype="<u4").tobytes() for t in texts]
        parts: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        size = 0

        def join() -> None:
            known = self.table
            new = [c for c in {c for _, cs in waiting for c in cs} if c not in known]
            extra = self.learn(new) if new else {}
            for i, cs in waiting:
                parts[i].append(b"".join([known.get(c) or extra[c] for c in cs]))
            waiting.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            for s in stretches(MARK + text.replace(" ", MARK), _BOUNDARY, STRETCH):
                waiting.append((i, _CHUNK.findall(s)))
                size += len(s)
                if size >= STRETCH:
                    join()
                    size = 0
        join()
        return [b"".join(p) for p in parts]


def chunks_are_separable(pieces: list[str]) -> bool:
    """No piece has a marker after another character, and none holds a line feed."""
    return not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)


@lru_cache(maxsize=2)
def shared_table(path: str | None = None) -> PieceTable:
    return PieceTable(path)


def _small(frames: Iterator[pd.DataFrame], rows: int = 512) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for i in range(0, len(frame), rows):
            yield frame.iloc[i : i + rows]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """(id, ids array<int>) of each row's whole text, as the library encodes it without begin and end ids.

    A null or empty text has no ids. Repeated rows and null ids are kept; other columns are ignored; an empty
    table gives no rows. No shuffle: each task holds its own table of distinct chunks, of bounded size.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared_table(model)
        for frame in _small(frames):
            ids = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in table.encode([t or "" for t in frame["t"]])]
            yield pd.DataFrame({"id": frame["id"].astype("Int64"), "ids": ids})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInPandas(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", out_col: str = "text", model: str | None = None) -> DataFrame:
    """Adds out_col, the library's decode(ids); null or empty ids give an empty text."""

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        whole, out = shared_table(model).whole, []
        for x in ids:
            out.append(whole.decode(x.tolist()) if x is not None and len(x) else "")
        return pd.Series(out, dtype=object)

    return encoded.withColumn(out_col, run(F.col(ids_col)))
