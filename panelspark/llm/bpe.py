"""Byte-level BPE ids of whole texts, one distinct chunk at a time.

A chunk is white space (spaces and line feeds) with the run of other characters after it. No
token of the vocabulary's pattern spans the change from such a character to white space, so the
ids of a text are the ids of its chunks in order. Each worker keeps the ids of chunks met before in a
table of bounded size. A text with any other white space is encoded whole. Strings of the vocabulary's added
tokens (such as the end-of-text mark) inside a text become those tokens, as the tokenizers library does by default;
the text around them is encoded by itself.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import numpy as np

from panelspark.llm._text import stretches

_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_BOUNDARY = re.compile(r"[^ \n](?=[ \n])")
_OTHER = re.compile(r"[^\S \n]|[\x1c-\x1f\x85᠎​﻿]")
#: Chunks kept by a worker, and their longest length: some 100 MB at most.
TABLE_ROWS, TABLE_CHARS = 500_000, 48


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a vocabulary file; the tokenizer package is read where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkTable:
    """Ids of texts. path: ranks of the vocabulary; added: the JSON file that lists its added tokens."""

    def __init__(self, path: str | None = None, added: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        with open(added or vocabulary_path()) as file:
            self.added = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes() for t in json.load(file)["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

        with open(path or vocabulary_path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.token_bytes = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.table: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        ids = np.array(self.encode(chunk), dtype="<u4").tobytes()
        if len(chunk) <= TABLE_CHARS and len(self.table) < TABLE_ROWS:
            self.table[chunk] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit numbers; a null or empty text has none."""
        if not text:
            return b""
        if self.marks and self.marks.search(text):
            return b"".join(self.added.get(part) or self._plain(part) for part in self.marks.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if _OTHER.search(text):
            return np.array(self.encode(text), dtype="<u4").tobytes()
        known = self.table.get
        return b"".join([b"".join([known(c) or self._chunk(c) for c in _CHUNK.findall(s)]) for s in stretches(text, _BOUNDARY)])


@lru_cache(maxsize=2)
def shared_table(path: str | None = None) -> ChunkTable:
    """The table of this Python worker, kept from task to task."""
    return ChunkTable(path)
