"""Raw web pages to records: title, language, linked-data blocks, script payloads, text (standard-library parser, Arrow batches)."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "id long, title string, lang string, linked_data array<string>, scripts int, links int, text string"
SKIPPED = ("script", "style", "head")


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.title, self.lang, self.kind = None, None, None
        self.blocks: list[str] = []
        self.words: list[str] = []
        self.scripts = self.links = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        found = dict(attrs)
        if tag == "html":
            self.lang = found.get("lang")
        self.links += tag == "a" and bool(found.get("href"))
        if tag == "script":
            self.scripts += 1
            self.kind = found.get("type")
        if tag in (*SKIPPED, "title"):
            self.stack.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1] == "title":
            self.title = (self.title or "") + data
        elif self.stack and self.stack[-1] == "script" and self.kind == "application/ld+json":
            self.blocks.append(data)
        elif not self.stack and data.strip():
            self.words.append(" ".join(data.split()))


#: Pages that a task reads and gives at a time.
SLICE = 128


def extract(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row a page; a null page has nulls and no links; linked data that isn't JSON is left out.

    A batch stays in Arrow's buffers and is read and given out in slices, so no second copy of its pages is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("id", pa.int64()), ("title", pa.string()), ("lang", pa.string()), ("linked_data", pa.list_(pa.string())), ("scripts", pa.int32()), ("links", pa.int32()), ("text", pa.string())])
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part, out = batch.slice(start, SLICE), []
                for key, html in zip(part["id"], part["html"], strict=True):
                    html = html.as_py()
                    r = _Reader()
                    r.feed(html or "")
                    r.close()
                    fine = []
                    for b in r.blocks:
                        try:
                            json.loads(b)
                            fine.append(b)
                        except ValueError:
                            pass
                    out.append((key.as_py(), r.title, r.lang, fine, r.scripts, r.links, " ".join(r.words) if html is not None else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind.type) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)
