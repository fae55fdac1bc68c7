"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Each rule is a test of one document that shares lazily computed features with the others. On a sample, every
rule is timed and its rejections are counted; the cascade then runs the rules in descending order of
rejections per second and stops at the first that rejects. The order changes the cost alone: a document
is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._text import _SPACE, mix, word_hashes

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BLANK = " \t\n\x0b\x0c\r"
SAMPLE_ROWS = 512


class Document:
    """Features of one text, each computed when a rule first asks for it."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def data(self) -> np.ndarray:
        return np.frombuffer(self.text.encode("utf-8", "surrogatepass"), dtype=np.uint8)

    @cached_property
    def hashes(self) -> np.ndarray:
        return word_hashes(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.hashes)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - int(_SPACE[self.data].sum())

    @cached_property
    def n_symbols(self) -> int:
        return int(_SYMBOL[self.data].sum())

    @cached_property
    def lines(self) -> list[str]:
        """Lines with a word."""
        return [x for x in self.text.split("\n") if x.strip(_BLANK)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        h = self.hashes
        if len(h) < 4:
            return 0
        _, at, n = np.unique(mix(h[:-2] * np.uint64(3) + mix(h[1:-1] * np.uint64(5) + mix(h[2:] * np.uint64(7)))), return_inverse=True, return_counts=True)
        again = n[at] > 1
        covered = np.zeros(len(h), dtype=bool)
        for j in range(3):
            covered[j : len(h) - 2 + j] |= again
        return int(covered.sum())

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.tobytes().split()

    @cached_property
    def most_common(self) -> int:
        return int(np.unique(self.hashes, return_counts=True)[1].max()) if self.n_words else 0


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


def _few_words(d: Document) -> bool:
    return d.n_words < 50


def _word_length(d: Document) -> bool:
    return not 2 * d.n_words <= d.word_chars <= 16 * d.n_words


def _symbols(d: Document) -> bool:
    return d.n_symbols > 0.2 * d.n_words


def _dup_lines(d: Document) -> bool:
    return d.n_dup_lines > 0.5 * len(d.lines)


def _repeats(d: Document) -> bool:
    return 2 * d.n_repeat_words > d.n_words


def _not_letters(d: Document) -> bool:
    spelt = sum(any(c >= 128 or 65 <= c <= 90 or 97 <= c <= 122 for c in w) for w in d.words)
    return spelt < 0.8 * d.n_words


def _capitals(d: Document) -> bool:
    small = ((d.data >= 97) & (d.data <= 122)).sum()
    return ((d.data >= 65) & (d.data <= 90)).sum() > small


def _ellipsis(d: Document) -> bool:
    return sum(x.rstrip(_BLANK).endswith(("...", "\u2026")) for x in d.lines) > 0.3 * len(d.lines)


def _bullets(d: Document) -> bool:
    return sum(x.lstrip(_BLANK).startswith(("-", "*", "\u2022")) for x in d.lines) > 0.9 * len(d.lines)


def _one_word(d: Document) -> bool:
    return d.most_common > 0.3 * d.n_words


#: The base tests of the contract, and the further rules.
BASE = (Rule("few_words", _few_words), Rule("repeats", _repeats))
RULES = (
    Rule("word_length", _word_length), Rule("symbols", _symbols), Rule("dup_lines", _dup_lines), Rule("not_letters", _not_letters),
    Rule("capitals", _capitals), Rule("ellipsis", _ellipsis), Rule("bullets", _bullets), Rule("one_word", _one_word),
)


def measure(docs: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS) -> pd.DataFrame:
    """(rule, seconds, rejected, seen) over at most sample_rows rows, picked by a hash of the id; timed inside tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spent, hit, seen = [0.0] * len(rules), [0] * len(rules), 0
        for frame in frames:
            for text in frame["t"]:
                seen += 1
                for i, rule in enumerate(rules):
                    d, t = Document(text), time.perf_counter()
                    hit[i] += rule.rejects(d)
                    spent[i] += time.perf_counter() - t
        yield pd.DataFrame({"rule": [r.name for r in rules], "seconds": spent, "rejected": hit, "seen": seen})

    rows = docs.where(F.pmod(F.xxhash64(id_col), F.lit(16)) == 0).select(F.col(text_col).cast("string").alias("t")).limit(sample_rows)
    return rows.mapInPandas(run, "rule string, seconds double, rejected long, seen long").groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"), F.sum("seen").alias("seen")).toPandas()


def order_rules(rules: tuple[Rule, ...], measured: pd.DataFrame) -> tuple[Rule, ...]:
    """Descending rejections per second, each rate smoothed by half a rejection; unmeasured rules keep their place at the end."""
    worth = {r.rule: (r.rejected + 0.5) / (r.seen + 1) / max(r.seconds / r.seen, 1e-9) for r in measured.itertuples() if r.seen}
    return tuple(sorted(rules, key=lambda r: -worth.get(r.name, 0.0)))


def first_rejection(text: str | None, ordered: tuple[Rule, ...]) -> str | None:
    """The first rule in order that rejects the text."""
    d = Document(text)
    return next((r.name for r in ordered if r.rejects(d)), None)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of each row.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, a null text has none and so fails the base. Repeated
    rows and null ids are judged each; other columns are ignored; an empty table gives no rows.
    """
    ordered = order_rules(rules, measure(docs, id_col, text_col, rules))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text in frame["t"]:
                d = Document(text)
                failed = d.n_words < 50 or 100 * d.n_repeat_words > 50 * d.n_words
                out.append((d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words, failed, not failed and not any(r.rejects(d) for r in ordered)))
            part = pd.DataFrame(out, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])
            yield part.assign(id=frame["id"].astype("Int64").to_numpy())

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInPandas(run, "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE + RULES) -> DataFrame:
    """Rows of docs that no rule rejects, in one pass that stops at a document's first rejection; all columns stay."""
    ordered = order_rules(rules, measure(docs, id_col, text_col, rules))

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        return pd.Series([first_rejection(t, ordered) is None for t in texts], dtype=bool)

    return docs.where(kept(F.col(text_col).cast("string")))
