"""All sums that associations between features need, from one scan.

Numbers are ranked once, over their value counts; every task then adds up products of its rows' values, ranks, clipped values, null masks
and level indicators as matrices of features by features, and the tasks' matrices are summed as a tree. Nothing is made for each row
and pair, and what reaches the driver is one set of matrices whose size follows the features and their levels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators import ranks
from panelspark.sources.work import cut, drop

#: Distinct values up to which a number's ranks are broadcast (of all such numbers together); 2 ** FAN_BITS matrices are summed at a
#: time, DEPTH times, which is enough for a million tasks.
BROADCAST_VALUES, FAN_BITS, DEPTH = 200_000, 5, 4
#: Percentiles between which values are clipped, by name.
CLIPS = {"trimmed": (0.01, 0.99), "robust": (0.10, 0.90)}


@dataclass
class Sums:
    """Matrices over numbers (rows and columns in order of names) and levels (in order of level_names)."""

    numeric: list[str]
    levels: dict[str, list[str]]
    products: dict[str, np.ndarray]
    ties: dict[str, float] = field(default_factory=dict)
    filled: dict[str, int] = field(default_factory=dict)
    #: Categories of more levels than the matrices take; ``wide_tables``, ``wide_spreads`` and ``rank_tests`` have their sums.
    wide: list[str] = field(default_factory=list)

    def correlation(self, kind: str) -> np.ndarray:
        """Pearson of all pairs of numbers on their complete rows, over values, ranks or clipped values; NaN for a constant side."""
        n, p = self.products["n"], self.products
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = p[f"{kind}_sum"] / n  # of the row's number, where the column's is there
            spread = p[f"{kind}_square"] / n - mean**2
            scale = np.where(spread > 1e-12 * np.maximum(p[f"{kind}_square"] / n, 1e-300), spread, np.nan)
            return (p[f"{kind}_product"] / n - mean * mean.T) / np.sqrt(scale * scale.T)

    def span(self, name: str) -> slice:
        start = 0
        for other, found in self.levels.items():
            if other == name:
                return slice(start, start + len(found))
            start += len(found)
        raise KeyError(name)

    def table(self, a: str, b: str) -> np.ndarray:
        """The contingency table of two categories."""
        return self.products["cells"][self.span(a), self.span(b)]

    def groups(self, number: str, category: str) -> dict[str, np.ndarray]:
        """Of each level: rows with the number, and sums of its values, squares and ranks, each less its centre."""
        i, at = self.numeric.index(number), self.span(category)
        return {k: self.products[f"level_{k}"][at, i] for k in ("n", "sum", "square", "rank")}


def level_lists(rows: DataFrame, categorical: list[str], most: int) -> tuple[dict[str, list[str]], list[str]]:
    """(the levels of each category that has no more than most of them, the categories of more); null is no level."""
    if not categorical:
        return {}, []
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("level")) for c in categorical])).alias("x")).select("x.*").where("level is not null")
    counts = long.distinct()
    sizes = counts.groupBy("c").agg(F.count("*").alias("k"))  # one row a category
    wide = {r.c for r in sizes.where(F.col("k") > most).collect()}
    found = counts.where(~F.col("c").isin(wide)).collect() if wide else counts.collect()
    return {c: sorted(r.level for r in found if r.c == c) for c in categorical if any(r.c == c for r in found)}, [c for c in categorical if c in wide]


def _number(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _ranked(base: DataFrame, numeric: list[str]) -> tuple[DataFrame, dict[str, dict]]:
    """(base with a column __r_i for the mid-rank of number i, facts of each number): each number's values are counted by themselves and its ranks
    joined to the rows by value, by broadcast where all have few values."""
    counts = [base.where(F.col(f"__v{i}").isNotNull()).groupBy(F.lit(i).alias("i"), F.col(f"__v{i}").alias("value")).agg(F.count("*").alias("n")) for i in range(len(numeric))]
    counted = ranks.ranked_counts(reduce(DataFrame.unionByName, counts), ["i"], "value", few_keys=True)
    placed = cut(counted.select("i", "value", "n", "below", (F.col("below") + (F.col("n") + 1) / 2).alias("rank")))
    drop(counted)
    totals = placed.groupBy("i").agg(F.sum("n").alias("total"), F.sum(F.col("value") * F.col("n")).alias("sum"), F.count("*").alias("values"), F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("ties"))
    ps = sorted({p for bounds in CLIPS.values() for p in bounds})
    quantiles = placed.join(F.broadcast(totals), "i").groupBy("i").agg(F.first("total").alias("total"), F.first("sum").alias("sum"), F.first("values").alias("values"), F.first("ties").alias("ties"), F.array(*[ranks.percentile_at("value", p, F.col("total")) for p in ps]).alias("q"))
    facts = {r.i: {"total": r.total, "mean": r["sum"] / r.total, "values": r["values"], "ties": r.ties, **dict(zip(ps, r.q, strict=True))} for r in quantiles.collect()}  # one row a number
    few, left = [], BROADCAST_VALUES
    for i in sorted(facts, key=lambda i: facts[i]["values"]):
        if facts[i]["values"] <= left:
            few, left = [*few, i], left - facts[i]["values"]
    out = base
    for i in sorted(facts, key=lambda i: i in few):  # shuffled joins first, while rows are narrow
        of = placed.where(F.col("i") == i).select(F.col("value").alias(f"__v{i}"), F.col("rank").alias(f"__r{i}"))
        out = out.join(F.broadcast(of) if i in few else of, f"__v{i}", "left")
    return out, facts


def association_sums(rows: DataFrame, numeric: list[str], categorical: list[str], max_levels: int) -> Sums:
    """Sums of all pairs of features. Nulls and NaN are missing; categories of more than max_levels levels have no matrices and are named as wide; no rows give zeros."""
    whole = cut(rows.select(*[_number(c).alias(f"__v{i}") for i, c in enumerate(numeric)], *[F.col(c).cast("string").alias(f"__c{j}") for j, c in enumerate(categorical)]))  # rows are made once
    found, wide = level_lists(whole, [f"__c{j}" for j in range(len(categorical))], max_levels)
    levels = {c: found[f"__c{j}"] for j, c in enumerate(categorical) if f"__c{j}" in found}
    codes = [(F.array_position(F.lit(found[f"__c{j}"]), F.col(f"__c{j}")) - 1).cast("int").alias(f"__c{k}") for k, j in enumerate(j for j, c in enumerate(categorical) if c in levels)]
    base = whole.select(*[f"__v{i}" for i in range(len(numeric))], *codes)
    ranked, facts = _ranked(base, numeric) if numeric else (base, {})
    c, size = len(numeric), sum(map(len, levels.values()))
    present = [i for i in range(c) if i in facts]
    columns = ranked.select(*[f"__v{i}" for i in range(c)], *[F.col(f"__r{i}") if i in facts else F.lit(None).cast("double").alias(f"__r{i}") for i in range(c)], *[f"__c{j}" for j in range(len(levels))])
    mean = np.array([facts[i]["mean"] if i in facts else 0.0 for i in range(c)])
    middle = np.array([(facts[i]["total"] + 1) / 2 if i in facts else 0.0 for i in range(c)])
    bounds = {k: np.array([[facts[i][p] if i in facts else 0.0 for p in ps] for i in range(c)]).reshape(c, 2) for k, ps in CLIPS.items()}
    shapes = {"n": (c, c), **{f"{k}_{x}": (c, c) for k in ("value", "rank", *CLIPS) for x in ("sum", "square", "product")}, "cells": (size, size), **{f"level_{k}": (size, c) for k in ("n", "sum", "square", "rank")}}

    def add(batch: pa.RecordBatch, out: dict[str, np.ndarray]) -> None:
        read = lambda k: batch.column(k).to_numpy(zero_copy_only=False).astype(np.float64)  # noqa: E731  nulls become NaN
        v = np.column_stack([read(i) for i in range(c)]) if c else np.zeros((batch.num_rows, 0))
        r = np.column_stack([read(c + i) for i in range(c)]) if c else v
        there = ~np.isnan(v)
        mask = there.astype(np.float64)
        made = {"value": v - mean, "rank": r - middle, **{k: np.clip(v, b[:, 0], b[:, 1]) - mean for k, b in bounds.items()}}
        made = {k: np.where(there, x, 0.0) for k, x in made.items()}
        out["n"] += mask.T @ mask
        for k, x in made.items():
            out[f"{k}_sum"] += x.T @ mask
            out[f"{k}_square"] += (x * x).T @ mask
            out[f"{k}_product"] += x.T @ x
        hot, start = np.zeros((batch.num_rows, size)), 0
        for j, found in enumerate(levels.values()):
            code = read(2 * c + j)
            here = np.flatnonzero(~np.isnan(code))
            hot[here, start + code[here].astype(np.int64)] = 1.0
            start += len(found)
        out["cells"] += hot.T @ hot
        for k, x in (("n", mask), ("sum", made["value"]), ("square", made["value"] ** 2), ("rank", made["rank"])):
            out[f"level_{k}"] += hot.T @ x

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = {k: np.zeros(s) for k, s in shapes.items()}
        for batch in batches:
            add(batch, out)
        yield pa.RecordBatch.from_pydict({"at": pa.array([TaskContext.get().partitionId()], pa.int32()), "data": pa.array([np.concatenate([x.reshape(-1) for x in out.values()]).tobytes()], pa.binary())})

    def total(found: pa.Table) -> pa.Table:
        data = np.frombuffer(found.column("data")[0].as_py(), dtype=np.float64).copy()
        for i in range(1, found.num_rows):
            data += np.frombuffer(found.column("data")[i].as_py(), dtype=np.float64)
        return pa.table({"at": found.column("at").slice(0, 1), "data": pa.array([data.tobytes()], pa.binary())})

    sums = columns.mapInArrow(partial, "at int, data binary")
    for _ in range(DEPTH):
        sums = sums.withColumn("at", F.shiftright("at", FAN_BITS)).groupBy("at").applyInArrow(total, "at int, data binary")
    first = sums.collect()
    data, at, products = np.frombuffer(first[0].data, dtype=np.float64) if first else np.zeros(sum(int(np.prod(s)) for s in shapes.values())), 0, {}
    for k, s in shapes.items():
        products[k] = data[at : at + int(np.prod(s))].reshape(s)
        at += int(np.prod(s))
    drop(whole)
    return Sums(numeric, levels, products, {numeric[i]: facts[i]["ties"] for i in present}, {numeric[i]: facts[i]["total"] for i in present}, [c for j, c in enumerate(categorical) if f"__c{j}" in wide])


@dataclass
class Blocks:
    """What rank tests need of a number by the levels of a category: levels, sum of squared centred rank sums over sizes, rows, ties, and of two levels (size, centred rank sum) each."""

    k: int = 0
    spread: float = 0.0
    n: float = 0.0
    ties: float = 0.0
    two: list[tuple[float, float]] = field(default_factory=list)


def _by_level(rows: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(a, b, v, g): a number's value and a category's level where both are there."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), _number(a).alias("v"), F.col(b).cast("string").alias("g")) for a, b in pairs])).alias("x")).select("x.*")
    return long.where("v is not null and g is not null")


def rank_tests(rows: DataFrame, pairs: list[tuple[str, str]], least: int) -> dict[tuple[str, str], Blocks]:
    """Rank sums of (number, category) pairs whose ranks leave rows out or whose categories are wide: only levels of least rows and more are ranked, each pair by itself.

    The levels of a pair are summed where they are; one row a pair reaches the driver.
    """
    if not pairs:
        return {}
    counts = cut(_by_level(rows, pairs).groupBy("a", "b", "g", "v").agg(F.count("*").alias("c")))
    sizes = counts.groupBy("a", "b", "g").agg(F.sum("c").alias("n")).where(F.col("n") >= least)
    kept = counts.join(sizes.select("a", "b", "g"), ["a", "b", "g"])
    placed = ranks.ranked_counts(kept.groupBy("a", "b", "v").agg(F.sum("c").alias("t")), ["a", "b"], "v", "t").withColumn("rank", F.col("below") + (F.col("t") + 1) / 2)
    ties = placed.groupBy("a", "b").agg(F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("ties"), F.sum("t").alias("n"))
    sums = kept.join(placed.select("a", "b", "v", "rank"), ["a", "b", "v"]).groupBy("a", "b", "g").agg(F.sum(F.col("c") * F.col("rank")).alias("r"), F.sum("c").alias("c"))
    centred = sums.join(F.broadcast(ties), ["a", "b"]).withColumn("r", F.col("r") - F.col("c") * (F.col("n") + 1) / 2)  # ties has one row a pair
    ends = [f(F.struct("g", "c", "r")).alias(k) for f, k in ((F.min, "low"), (F.max, "high"))]
    each = centred.groupBy("a", "b").agg(F.count("*").alias("k"), F.sum(F.col("r") * F.col("r") / F.col("c")).alias("spread"), F.first("n").alias("n"), F.first("ties").alias("ties"), *ends)
    out = {(r.a, r.b): Blocks(r.k, r.spread, r.n, r.ties, [(x.c, x.r) for x in (r.low, r.high)] if r.k == 2 else []) for r in each.collect()}
    drop(placed, counts)
    return out


def wide_spreads(rows: DataFrame, pairs: list[tuple[str, str]]) -> dict[tuple[str, str], tuple[int, int, float, float]]:
    """(rows, levels, sum of squares between levels, in all) of (number, category) pairs, for categories of any number of levels."""
    if not pairs:
        return {}
    levels = cut(_by_level(rows, pairs).groupBy("a", "b", "g").agg(F.count("*").alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s")))
    whole = levels.groupBy("a", "b").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    each = levels.join(F.broadcast(whole), ["a", "b"]).groupBy("a", "b").agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * F.pow(F.col("m") - F.col("mean"), 2)).alias("between"), F.sum(F.col("n") * F.col("s")).alias("within"))
    out = {(r.a, r.b): (r.n, r.k, r.between, r.between + r.within) for r in each.collect()}  # one row a pair
    drop(levels)
    return out


def wide_tables(rows: DataFrame, pairs: list[tuple[str, str]]) -> dict[tuple[str, str], tuple[int, int, int, float]]:
    """(rows, levels, levels, chi-square) of pairs of categories, for any number of levels: cells that are there are summed, and the expected rows of the others."""
    if not pairs:
        return {}
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")) for a, b in pairs])).alias("p")).select("p.*").where("x is not null and y is not null")
    cells = cut(long.groupBy("a", "b", "x", "y").agg(F.count("*").alias("o")))
    left, right = (cells.groupBy("a", "b", c).agg(F.sum("o").cast("double").alias(f"n{c}")) for c in "xy")
    sizes = left.groupBy("a", "b").agg(F.sum("nx").alias("n"), F.count("*").alias("r")).join(right.groupBy("a", "b").agg(F.count("*").alias("k")), ["a", "b"])
    expected = F.col("nx") * F.col("ny") / F.col("n")
    met = cells.join(left, ["a", "b", "x"]).join(right, ["a", "b", "y"]).join(F.broadcast(sizes), ["a", "b"]).withColumn("e", expected)  # sizes has one row a pair
    each = met.groupBy("a", "b").agg(F.first("n").alias("n"), F.first("r").alias("r"), F.first("k").alias("k"), F.sum(F.pow(F.col("o") - F.col("e"), 2) / F.col("e")).alias("gaps"), F.sum("e").alias("e"))
    out = {(r.a, r.b): (int(r.n), r.r, r.k, r.gaps + max(r.n - r.e, 0.0)) for r in each.collect()}  # one row a pair
    drop(cells)
    return out
