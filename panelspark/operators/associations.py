"""Associations between all pairs of features, with the measure and test that fit their kinds, and rankings of the results.

All pairs come from the sums of one scan (``gram``); only pairs whose ranks leave rows out (nulls, rare levels) and categories of more than
max_levels levels, whose matrices would grow with them, are summed by themselves, over value counts and levels. Rankings, corrections and summaries run on one row a pair.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import isfinite, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions import special
from panelspark.operators import ranks
from panelspark.operators import stats as S
from panelspark.operators.gram import CLIPS, Blocks, Sums, association_sums, rank_tests, wide_spreads, wide_tables
from panelspark.sources.work import cut, drop


@dataclass(frozen=True)
class Features:
    """Names of numeric and categorical features; aliases are measures of one thing and aren't compared with one another."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    aliases: tuple[tuple[str, ...], ...] = ()

    def apart(self, a: str, b: str) -> bool:
        return not any(a in group and b in group for group in self.aliases)


MIN_PAIRS, MAX_LEVELS, TAUTOLOGY, MIN_BLOCK = 30, 30, 0.95, 3
PAIR = "a string, b string, kind string, n long, measure string, value double, pearson double, trimmed double, robust double, statistic double, dof double, p_value double"


def _rounded(x: float | None, digits: int = 4) -> float | None:
    return None if x is None or not isfinite(x) else round(float(x), digits) + 0.0


def chi_square(table: np.ndarray) -> tuple[float, int, int, int, float | None]:
    """(statistic, dof, levels, levels, bias-corrected V) of a contingency table without its empty lines; Yates' correction at one degree of freedom."""
    table = table[table.sum(axis=1) > 0][:, table.sum(axis=0) > 0]
    (r, k), n = table.shape, table.sum()
    if r < 2 or k < 2:
        return 0.0, 0, r, k, None
    expected = np.outer(table.sum(axis=1), table.sum(axis=0)) / n
    gap, dof = np.abs(table - expected), (r - 1) * (k - 1)
    statistic = float((np.where(dof == 1, np.maximum(gap - 0.5, 0.0), gap) ** 2 / expected).sum())
    return statistic, dof, r, k, cramers_v(statistic, n, r, k)


def cramers_v(statistic: float, n: float, r: int, k: int) -> float | None:
    """Bias-corrected V of a chi-square; null where a side has one level or hardly more levels than rows allow."""
    side = lambda m: m - (m - 1) ** 2 / (n - 1) - 1
    low = min(side(r), side(k)) if n > 1 else 0.0
    return sqrt(max(statistic / n - (r - 1) * (k - 1) / (n - 1), 0.0) / low) if low > 0 else None


def _tables(rows: DataFrame, sums: Sums, pairs: list[tuple[str, str]]) -> dict[tuple[str, str], tuple[int, float, int, int, float | None]]:
    """(n, statistic, dof, levels of the second, V) of pairs of categories."""
    out = {}
    for a, b in (p for p in pairs if not set(p) & set(sums.wide)):
        table = sums.table(a, b)
        statistic, dof, _, k, v = chi_square(table)
        out[a, b] = int(table.sum()), statistic, dof, k, v
    for pair, (n, r, k, statistic) in wide_tables(rows, [p for p in pairs if set(p) & set(sums.wide)]).items():
        out[pair] = n, statistic, (r - 1) * (k - 1), k, cramers_v(statistic, n, r, k)
    return {p: out[p] for p in pairs if p in out}


def kruskal_wallis(blocks: Blocks) -> float | None:
    """H of the levels; null where all values are equal."""
    n = blocks.n
    correction = 1 - blocks.ties / (n**3 - n) if n > 1 else 0.0
    return 12 / (n * (n + 1)) * blocks.spread / correction if correction > 0 else None


def mann_whitney(groups: list[tuple[float, float]], n: float, ties: float) -> tuple[float, float, float]:
    """(U of the second group, z with continuity, rank-biserial) of two (size, sum of ranks less their middle)."""
    (n1, _), (n2, r2) = groups
    u = r2 + n2 * (n + 1) / 2 - n2 * (n2 + 1) / 2
    spread = sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
    return u, (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / spread if spread > 0 else 0.0, 2 * u / (n1 * n2) - 1


def _blocks(sums: Sums, number: str, category: str, least: int) -> tuple[list[tuple[float, float]], bool]:
    """((size, centred rank sum) of levels with least rows, in order; whether the column's own ranks are theirs, as no row is left out)."""
    if category in sums.wide:
        return [], False
    g = sums.groups(number, category)
    kept = [(float(c), float(r)) for c, r in zip(g["n"], g["rank"], strict=True) if c >= least]
    return kept, sum(c for c, _ in kept) == sums.filled.get(number, 0)


def _ranked_blocks(rows: DataFrame, sums: Sums, pairs: list[tuple[str, str]], least: int) -> dict[tuple[str, str], Blocks]:
    """What rank tests need of each (number, category) pair, over levels of least rows."""
    out, apart = {}, []
    for a, b in pairs:
        kept, whole = _blocks(sums, a, b, least)
        if whole:
            out[a, b] = Blocks(len(kept), sum(r * r / c for c, r in kept), sum(c for c, _ in kept), sums.ties.get(a, 0.0), kept if len(kept) == 2 else [])
        else:
            apart.append((a, b))
    return out | rank_tests(rows, apart, least)


def _partial_ranks(rows: DataFrame, pairs: list[tuple[str, str]]) -> dict[tuple[str, str], tuple[float | None, float | None, float | None]]:
    """(spearman, trimmed, robust) of pairs of numbers on their complete rows, for pairs where a null leaves rows out."""
    if not pairs:
        return {}
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    long = cut(rows.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), number(a).alias("x"), number(b).alias("y")) for a, b in pairs])).alias("p")).select("p.*").where("x is not null and y is not null"))
    ranked = S.midranks(S.midranks(long, ["a", "b"], "x", "rx"), ["a", "b"], "y", "ry")
    ps = [p for bounds in CLIPS.values() for p in bounds]
    for c in "xy":
        ranked = ranked.join(F.broadcast(ranks.percentiles(long, ["a", "b"], c, tuple(ps)).select("a", "b", F.col("q").alias(f"q{c}"))), ["a", "b"])  # a row a pair
    clip = lambda c, i: F.greatest(F.least(F.col(c), F.col(f"q{c}")[i + 1]), F.col(f"q{c}")[i])
    found = ranked.groupBy("a", "b").agg(F.corr("rx", "ry").alias("s"), *[F.corr(clip("x", 2 * i), clip("y", 2 * i)).alias(k) for i, k in enumerate(CLIPS)]).collect()
    drop(long)
    return {(r.a, r.b): (r.s, r.trimmed, r.robust) for r in found}


def numeric_pairs(rows: DataFrame, features: Features, min_n: int = MIN_PAIRS, sums: Sums | None = None, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Q7, num x num: Spearman, with Pearson and Pearson of values clipped to 1-99 and 10-90 percent beside it; the statistic is Spearman's t. All pairs of
    features, or those given."""
    sums = sums or association_sums(rows, [c for c in features.numeric if pairs is None or any(c in p for p in pairs)], [], 0)
    at = {c: i for i, c in enumerate(sums.numeric)}
    pairs = [p for p in combinations(features.numeric, 2) if features.apart(*p)] if pairs is None else pairs
    n, by = sums.products["n"], {k: sums.correlation(k) for k in ("value", "rank", *CLIPS)}
    apart = [(a, b) for a, b in pairs if n[at[a], at[b]] >= min_n and n[at[a], at[b]] < max(sums.filled.get(a, 0), sums.filled.get(b, 0))]
    own, out = _partial_ranks(rows, apart), []
    for a, b in pairs:
        i, j = at[a], at[b]
        size, pearson = int(n[i, j]), by["value"][i, j]
        rho, trimmed, robust = own.get((a, b)) or (by["rank"][i, j], by["trimmed"][i, j], by["robust"][i, j])
        if size < min_n or rho is None or not isfinite(rho):
            rho = None
        t = rho * sqrt((size - 2) / max(1 - rho * rho, 1e-300)) if rho is not None else None
        some = size >= min_n
        out.append((a, b, "num_num", size, "spearman", _rounded(rho), _rounded(pearson) if some else None, _rounded(trimmed) if some else None, _rounded(robust) if some else None, _rounded(t), float(size - 2) if t is not None else None, _rounded(special.t_two_sided(t, size - 2), 6) if t is not None else None))
    return rows.sparkSession.createDataFrame(out, PAIR)


def categorical_pairs(rows: DataFrame, features: Features, min_n: int = MIN_PAIRS, max_levels: int = MAX_LEVELS, sums: Sums | None = None) -> DataFrame:
    """Q7, cat x cat: bias-corrected Cramer's V with chi-square of every pair."""
    sums, out = sums or association_sums(rows, [], list(features.categorical), max_levels), []
    names = [c for c in features.categorical if c in sums.wide or len(sums.levels.get(c, ())) >= 2]
    for (a, b), (n, statistic, dof, _, v) in _tables(rows, sums, [p for p in combinations(names, 2) if features.apart(*p)]).items():
        ok = n >= min_n and v is not None
        out.append((a, b, "cat_cat", n, "cramers_v", _rounded(v) if ok else None, None, None, None, _rounded(statistic) if ok else None, float(dof) if ok else None, _rounded(special.chi2_tail(statistic, dof), 6) if ok else None))
    return rows.sparkSession.createDataFrame(out, PAIR)


def mixed_pairs(rows: DataFrame, features: Features, min_n: int = MIN_PAIRS, max_levels: int = MAX_LEVELS, sums: Sums | None = None) -> DataFrame:
    """Q7, num x cat: correlation ratio of number a by the levels of b; the test is Kruskal-Wallis over levels of three rows and more."""
    sums, out = sums or association_sums(rows, list(features.numeric), list(features.categorical), max_levels), []
    pairs = [(a, b) for a in features.numeric for b in features.categorical if (b in sums.wide or len(sums.levels.get(b, ())) >= 2) and features.apart(a, b)]
    tested, spreads = _ranked_blocks(rows, sums, pairs, MIN_BLOCK), wide_spreads(rows, [p for p in pairs if p[1] in sums.wide])
    for a, b in pairs:
        if b in sums.wide:
            n, levels, between, total = spreads.get((a, b), (0, 0, 0.0, 0.0))
        else:
            g = sums.groups(a, b)
            here = g["n"] > 0
            n, levels, whole = g["n"].sum(), here.sum(), g["sum"].sum()
            total = g["square"].sum() - whole**2 / max(n, 1)
            between = (g["sum"][here] ** 2 / g["n"][here]).sum() - whole**2 / max(n, 1)
        ok = n >= min_n and levels > 1 and total > 0
        eta = sqrt(min(max(between / total, 0.0), 1.0)) if ok else None
        blocks = tested.get((a, b), Blocks())
        h = kruskal_wallis(blocks) if ok and blocks.k >= 2 else None
        out.append((a, b, "num_cat", int(n), "eta", _rounded(eta), None, None, None, _rounded(h), float(blocks.k - 1) if h is not None else None, _rounded(special.chi2_tail(h, blocks.k - 1), 6) if h is not None else None))
    return rows.sparkSession.createDataFrame(out, PAIR)


def pairwise_associations(rows: DataFrame, features: Features, min_n: int = MIN_PAIRS, max_levels: int = MAX_LEVELS) -> DataFrame:
    """Q7: every pair of features with the measure of its kinds, its test, its strength, whether it is a tautology, and p-values corrected over all pairs.

    The frame has a row a pair and is made when this is called.
    """
    sums = association_sums(rows, list(features.numeric), list(features.categorical), max_levels)
    every = numeric_pairs(rows, features, min_n, sums).unionByName(categorical_pairs(rows, features, min_n, max_levels, sums)).unionByName(mixed_pairs(rows, features, min_n, max_levels, sums))
    size = F.greatest(F.abs("value"), F.abs("pearson"))
    return S.benjamini_hochberg(every, "p_value", name="q_value").withColumns({"strength": S.strength_of(F.abs("value")), "tautology": F.coalesce(size > TAUTOLOGY, F.lit(False))})


TEST = "feature string, kind string, test string, groups int, n long, statistic double, dof double, effect_size double, p_value double"


def _tested(rows: DataFrame, out: list[tuple], top: int | None = None) -> DataFrame:
    """Result rows with Holm's correction, the tautology flag and a rank by effect."""
    found = S.holm(rows.sparkSession.createDataFrame(out, TEST), "p_value").withColumn("tautology", F.coalesce(F.abs("effect_size") > TAUTOLOGY, F.lit(False)))
    order = Window.orderBy(F.desc_nulls_last(F.abs("effect_size")), "feature")  # one row a feature
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def target_associations(rows: DataFrame, features: Features, target: str, min_n: int = MIN_PAIRS, max_levels: int = MAX_LEVELS, top: int = 40) -> DataFrame:
    """Q12, Q19: every feature against a numeric target above zero, by the test of its kind: Spearman for numbers, Mann-Whitney with rank-biserial for
    categories of two levels, Kruskal-Wallis with epsilon squared for more, over levels of min_n rows; Holm-adjusted, aliases of the target left out."""
    kept = rows.where(F.col(target) > 0)
    others = [c for c in features.numeric if c != target and features.apart(c, target)]
    categories = [c for c in features.categorical if features.apart(c, target)]
    sums = association_sums(kept, [target, *others], categories, max_levels)
    out: list[tuple] = []
    for r in numeric_pairs(kept, Features((target, *others), (), tuple((a, b) for a, b in combinations(others, 2))), min_n, sums).collect():  # a row a feature
        if r.value is not None:
            out.append((r.b if r.a == target else r.a, "numeric", "spearman", None, r.n, r.statistic, r.dof, r.value, r.p_value))
    tested = _ranked_blocks(kept, sums, [(target, c) for c in categories if c in sums.wide or len(sums.levels.get(c, ())) >= 2], min_n)
    for (_, c), blocks in tested.items():
        k, n = blocks.k, blocks.n
        if k == 2:
            u, z, effect = mann_whitney(blocks.two, n, blocks.ties)
            out.append((c, "boolean", "mann_whitney_u", 2, int(n), _rounded(u), None, _rounded(effect), _rounded(special.normal_two_sided(z), 6)))
        elif k > 2 and (h := kruskal_wallis(blocks)) is not None:
            out.append((c, "categorical", "kruskal_wallis", k, int(n), _rounded(h), float(k - 1), _rounded((h - k + 1) / (n - k)) if n > k else None, _rounded(special.chi2_tail(h, k - 1), 6)))
    return _tested(rows, out, top)


def differentiating_features(rows: DataFrame, features: Features, dimension: str, min_group: int = 10, max_levels: int = MAX_LEVELS) -> DataFrame:
    """Q18: features that differ between all groups of a dimension of min_group rows and more: Kruskal-Wallis with epsilon squared for
    numbers, chi-square with bias-corrected V for categories; Holm-adjusted, with a tautology flag. No rows with fewer than two groups.

    Groups and levels may be any number: beyond max_levels they are summed by themselves and not in matrices."""
    numbers, others = ([c for c in some if c != dimension and features.apart(c, dimension)] for some in (features.numeric, features.categorical))
    rows = cut(rows.select(dimension, *numbers, *others))
    group = F.col(dimension).cast("string")
    sizes = rows.where(group.isNotNull()).groupBy(group.alias("g")).agg(F.count("*").alias("n")).where(F.col("n") >= min_group)
    out: list[tuple] = []
    if sizes.count() >= 2:
        kept = cut(rows.join(sizes.select(F.col("g").alias("__group")), group == F.col("__group"), "left_semi"))
        sums = association_sums(kept, numbers, [dimension, *others], max_levels)
        for (c, _), blocks in _ranked_blocks(kept, sums, [(c, dimension) for c in numbers], min_group).items():
            if blocks.k >= 2 and (h := kruskal_wallis(blocks)) is not None:
                k, n = blocks.k, blocks.n
                out.append((c, "numeric", "kruskal_wallis", k, int(n), _rounded(h), float(k - 1), _rounded((h - k + 1) / (n - k)) if n > k else None, _rounded(special.chi2_tail(h, k - 1), 6)))
        tables = _tables(kept, sums, [(c, dimension) for c in others if c in sums.wide or len(sums.levels.get(c, ())) >= 2])
        for (c, _), (n, statistic, dof, k, v) in tables.items():
            if v is not None and n >= 2 * min_group:
                out.append((c, "categorical", "chi_square", k, n, _rounded(statistic), float(dof), _rounded(v), _rounded(special.chi2_tail(statistic, dof), 6)))
        drop(kept)
    drop(rows)
    return _tested(rows, out).withColumn("dimension", F.lit(dimension))


def non_linear(pairs: DataFrame, least: float = 0.05, top: int = 25) -> DataFrame:
    """Number pairs whose rank correlation passes the linear one, the widest gaps first; pairs with the same
    figures (aliases of one measure) once, under the least names."""
    gap = F.round(F.abs("value") - F.abs("pearson"), 4)
    rows = pairs.where("kind = 'num_num'").select("a", "b", "n", F.col("value").alias("spearman"), "pearson", gap.alias("gap")).where(F.col("gap") >= least)
    one = rows.groupBy("n", "spearman", "pearson", "gap").agg(F.min(F.struct("a", "b")).alias("p"))
    return one.orderBy(F.desc("gap"), "p.a", "p.b").limit(top).select("p.a", "p.b", "n", "spearman", "pearson", "gap")


def pair_summary(pairs: DataFrame) -> DataFrame:
    """Q10: counts of pairs by kind: computed, strong and more, tautologies, significant after correction."""
    n = F.count_if
    return pairs.groupBy("kind").agg(F.count("*").alias("pairs"), n(F.col("value").isNotNull()).alias("computed"), n(F.col("strength").isin("strong", "very_strong")).alias("strong"), n("tautology").alias("tautologies"), n(F.coalesce(F.col("q_value") < 0.05, F.lit(False))).alias("significant"))


def feature_profiles(rows: DataFrame, features: Features) -> DataFrame:
    """Q15: one row a feature by its kind: filled, share, distinct values, and mean, least and greatest for numbers, the most frequent level
    and its share for categories."""
    numbers = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit("numeric").alias("kind"), F.col(c).cast("double").alias("x"), F.lit(None).cast("string").alias("level")) for c in features.numeric])
    words = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit("categorical").alias("kind"), F.lit(None).cast("double").alias("x"), F.col(c).cast("string").alias("level")) for c in features.categorical])
    counts = rows.select(F.explode(F.concat(numbers, words)).alias("f")).select("f.*").groupBy("feature", "kind", "x", "level").agg(F.count("*").alias("c"))  # values first, so that no feature's rows meet
    there = F.col("x").isNotNull() | F.col("level").isNotNull()
    some = F.when(there, F.col("c"))
    out = counts.groupBy("feature", "kind").agg(F.sum("c").alias("n"), F.coalesce(F.sum(some), F.lit(0)).alias("filled"), F.count_if(there).alias("distinct"), (F.sum(F.col("x") * F.col("c")) / F.sum(F.when(F.col("x").isNotNull(), F.col("c")))).alias("mean"), F.min("x").alias("least"), F.max("x").alias("greatest"), F.max(F.when(F.col("level").isNotNull(), F.struct("c", "level"))).alias("top"))
    share = lambda c: F.round(100.0 * c / F.col("n"), 4)
    return out.select("feature", "kind", "filled", share(F.col("filled")).alias("filled_pct"), "distinct", F.round("mean", 4).alias("mean"), F.round("least", 4).alias("least"), F.round("greatest", 4).alias("greatest"), F.col("top.level").alias("top_level"), share(F.col("top.c")).alias("top_pct"))


def level_distribution(rows: DataFrame, features: Features, top: int = 25, min_group: int = 10) -> DataFrame:
    """Q16: the most frequent levels of each categorical feature with shares; small ones flagged."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in features.categorical])).alias("f")).select("f.*").where("level is not null")
    counts = long.groupBy("feature", "level").agg(F.count("*").alias("n"))
    w = Window.partitionBy("feature")
    ranked = counts.withColumns({"total": F.sum("n").over(w), "rank": F.row_number().over(w.orderBy(F.desc("n"), "level"))})
    return ranked.where(F.col("rank") <= top).select("feature", "level", "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("share_pct"), "rank", (F.col("n") >= min_group).alias("sufficient"))


def catalogue_summary(catalogue: DataFrame, by: list[str], usable: Column) -> DataFrame:
    """Q20: features and usable ones by kind, by grain and in all."""
    return catalogue.groupingSets([[c] for c in by] + [[]], *by).agg(F.count("*").alias("features"), F.count_if(usable).alias("usable"))
