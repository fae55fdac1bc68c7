"""Rank tests, associations and corrections. Row data stays distributed; p-values are a last step on result rows."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions import special
from panelspark.operators import ranks


def _p(kind: str):
    """Arrow UDF over result rows: p-value of a statistic."""
    @F.pandas_udf("double")
    def run(statistic: pd.Series, size: pd.Series) -> pd.Series:
        def one(s, n):
            if pd.isna(s) or pd.isna(n):
                return None
            if kind == "normal":
                return special.normal_two_sided(s)
            if kind == "chi2":
                return special.chi2_tail(s, int(n))
            return special.t_two_sided(s, n)
        return pd.Series([one(s, n) for s, n in zip(statistic, size, strict=True)], dtype="float64")
    return run


def midranks(rows: DataFrame, keys: list[str], value: str, name: str = "rank") -> DataFrame:
    """Mid-ranks for ties within keys, from value counts and their running sum over ranges of values."""
    ranked = ranks.ranked_counts(ranks.value_counts(rows, keys, value), keys, value)
    return rows.join(ranked.select(*keys, value, (F.col("below") + (F.col("n") + 1) / 2).alias(name)), [*keys, value])


def strength_of(size: Column, weak: float = 0.2) -> Column:
    """Q1: the name of a coefficient's size."""
    return F.when(size < weak, "negligible").when(size < 0.4, "weak").when(size < 0.6, "moderate").when(size < 0.8, "strong").when(size.isNotNull(), "very_strong")


def correlations(rows: DataFrame, pairs: list[tuple[str, str]], min_n: int = 30) -> DataFrame:
    """Q1: Pearson and Spearman of each pair on its complete rows; null below min_n rows or for a constant side.

    All pairs come from the sums of one scan; pairs where a null leaves rows out are ranked on their own rows.
    """
    from panelspark.operators.associations import Features, numeric_pairs

    found = numeric_pairs(rows, Features(tuple(sorted({c for p in pairs for c in p})), ()), min_n, pairs=pairs)
    return found.select("a", "b", "n", "pearson", F.col("value").alias("spearman"), "p_value", strength_of(F.abs("value")).alias("strength"))


def cramers_v(rows: DataFrame, a: str, b: str, min_n: int = 30) -> DataFrame:
    """Q2: chi-square with all cells, bias-corrected V, Yates' correction at one degree of freedom; one row."""
    cells = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).agg(F.count("*").alias("o"))
    sums = {c: cells.groupBy(c).agg(F.sum("o").alias(n)) for c, n in (("a", "ra"), ("b", "cb"))}
    sizes = cells.agg(F.count_distinct("a").alias("r"), F.count_distinct("b").alias("k"), F.sum("o").alias("n"))
    full = cells.join(sums["a"], "a").join(sums["b"], "b").join(F.broadcast(sizes.withColumn("__j", F.lit(1))), F.lit(1) == F.col("__j"))
    e = F.col("ra") * F.col("cb") / F.col("n")
    # cells without rows add their expected count, which is n less the expected counts of the others (no Yates there beyond 2 x 2)
    plain = F.sum((F.col("o") - e) * (F.col("o") - e) / e) + F.first("n") - F.sum(e)
    yates = F.sum(F.pow(F.greatest(F.abs(F.col("o") - e) - 0.5, F.lit(0.0)), 2) / e)
    got = full.groupBy("r", "k", "n").agg(plain.alias("plain"), yates.alias("yates"), F.count_if(e < 5).alias("small"), F.count("*").alias("cells"))
    dof = (F.col("r") - 1) * (F.col("k") - 1)
    chi2 = F.when((dof == 1) & (F.col("cells") == 4), F.col("yates")).otherwise(F.col("plain"))
    x = got.select("n", "r", "k", dof.alias("dof"), chi2.alias("c"))
    phi = F.greatest(F.col("c") / F.col("n") - F.col("dof") / (F.col("n") - 1), F.lit(0.0))
    side = lambda c: F.col(c) - F.pow(F.col(c) - 1, 2) / (F.col("n") - 1) - 1
    ok = (F.col("n") >= min_n) & (F.col("r") > 1) & (F.col("k") > 1)
    return x.select(F.lit(a).alias("variable_a"), F.lit(b).alias("variable_b"), "n", F.col("r").alias("levels_a"), F.col("k").alias("levels_b"), "dof", F.when(ok, F.round("c", 4)).alias("chi2"), F.when(ok, F.round(F.sqrt(phi / F.least(side("r"), side("k"))), 4)).alias("cramers_v"), F.when(ok, F.round(_p("chi2")(F.col("c"), F.col("dof").cast("double")), 6)).alias("p_value"))


def correlation_ratio(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Q3: eta: root of the share of variance between groups."""
    g = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
    t = g.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("m"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("s"), F.sum(F.col("n") * F.col("v")).alias("w"), F.count("*").alias("groups"))
    between = F.col("s") - F.col("n") * F.col("m") * F.col("m")
    return t.select("n", "groups", F.round(F.sqrt(between / (between + F.col("w"))), 4).alias("eta"))


def trimmed_correlation(rows: DataFrame, x: str, y: str, low: float = 0.01, high: float = 0.99, min_n: int = 20) -> DataFrame:
    """Q5: Pearson after clipping both sides to their percentiles."""
    base = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    bound = lambda c: ranks.percentiles(base, [], c, (low, high)).first()  # noqa: E731  one row
    bx, by = bound("x"), bound("y")
    if bx is None:
        return base.agg(F.count("*").alias("n"), F.lit(None).cast("double").alias("trimmed_pearson"))
    clip = lambda c, v: F.greatest(F.least(F.col(c), F.lit(v[1])), F.lit(v[0]))
    return base.agg(F.count("*").alias("n"), F.when(F.count("*") >= min_n, F.round(F.corr(clip("x", bx.q), clip("y", by.q)), 4)).alias("trimmed_pearson"))


def shape_name(pearson: Column, spearman: Column, dcor: Column, trimmed: Column | None = None, robust: Column | None = None, weak: float = 0.2, non_linear: float = 0.10, non_monotone: float = 0.15) -> Column:
    """Q6: the shape of a relation between numbers from its coefficients; dcor may be null, trimmed and robust are Pearson after clipping.

    Rank against linear: a gap that clipping closes is linear within the trimmed range, else monotone but not linear.
    """
    p, s = F.abs(pearson), F.abs(spearman)
    whole = F.coalesce(dcor, s)
    clipped = F.greatest(*[F.abs(c) if c is not None else F.lit(None).cast("double") for c in (trimmed, robust)])
    return (F.when(pearson.isNull() | spearman.isNull(), "not_computed").when(whole - s > non_monotone, "non_monotone_dependence")
            .when(s - p > non_linear, F.when(F.coalesce(clipped, p) - p > non_linear, "linear_within_trimmed_range").otherwise("monotone_nonlinear"))
            .when((s < weak) & (whole < weak), "no_detected_association").when(p >= weak, "approximately_linear").otherwise("weak_or_unclear"))


def holm(rows: DataFrame, p: str, family: list[str] | None = None, name: str = "p_holm") -> DataFrame:
    """Q11: Holm's step-down correction over a result frame; null p-values stay null and don't count."""
    f = [F.col(c) for c in (family or [])] or [F.lit(0)]
    known = F.col(p).isNotNull()
    w = Window.partitionBy(*f, known)
    rank, m = F.row_number().over(w.orderBy(p)), F.count("*").over(w)
    staged = rows.withColumn("__a", F.least((m - rank + 1) * F.col(p), F.lit(1.0))).withColumn("__r", rank)
    return staged.withColumn(name, F.round(F.max("__a").over(w.orderBy("__r").rowsBetween(Window.unboundedPreceding, 0)), 6)).drop("__a", "__r")


def benjamini_hochberg(rows: DataFrame, p: str, family: list[str] | None = None, name: str = "p_bh") -> DataFrame:
    """Q11: false-discovery correction: running minimum from the largest p-value."""
    f = [F.col(c) for c in (family or [])] or [F.lit(0)]
    known = F.col(p).isNotNull()
    w = Window.partitionBy(*f, known)
    rank, m = F.row_number().over(w.orderBy(p)), F.count("*").over(w)
    staged = rows.withColumn("__r", rank).withColumn("__a", F.least(F.col(p) * m / rank, F.lit(1.0)))
    return staged.withColumn(name, F.round(F.min("__a").over(w.orderBy(F.desc("__r")).rowsBetween(Window.unboundedPreceding, 0)), 6)).drop("__a", "__r")


def group_differences(rows: DataFrame, dimensions: list[str], value: str, min_group: int = 10) -> DataFrame:
    """Q13: Kruskal-Wallis (three groups and more, epsilon squared) or Mann-Whitney (two, rank-biserial) by dimension, Holm-adjusted.

    Groups below min_group are left out before ranking. Ties have mid-ranks and the usual correction.
    """
    base = rows.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"), F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("g")) for d in dimensions])).alias("p")).select("v", "p.dimension", "p.g").where("g is not null")
    sizes = base.groupBy("dimension", "g").agg(F.count("*").alias("n")).where(F.col("n") >= min_group)
    kept = base.join(F.broadcast(sizes.select("dimension", "g")), ["dimension", "g"], "left_semi")
    by_value = kept.groupBy("dimension", "g", "v").agg(F.count("*").alias("c"))
    totals = by_value.groupBy("dimension", "v").agg(F.sum("c").alias("t"))
    placed = ranks.ranked_counts(totals, ["dimension"], "v", "t").withColumn("rank", F.col("below") + (F.col("t") + 1) / 2)
    ties = placed.groupBy("dimension").agg(F.sum(F.pow("t", 3) - F.col("t")).alias("ties"), F.sum("t").alias("N"))
    sums = by_value.join(placed, ["dimension", "v"]).groupBy("dimension", "g").agg(F.sum(F.col("c") * F.col("rank")).alias("R"), F.sum("c").alias("n"))
    per = sums.groupBy("dimension").agg(F.count("*").alias("groups"), F.sum(F.col("R") * F.col("R") / F.col("n")).alias("S"), F.min_by(F.struct("n", "R"), "g").alias("a"), F.max_by(F.struct("n", "R"), "g").alias("b")).join(ties, "dimension")
    N = F.col("N").cast("double")
    correction = 1 - F.col("ties") / (N * N * N - N)
    h = (12 / (N * (N + 1)) * F.col("S") - 3 * (N + 1)) / correction
    n1, n2 = F.col("a.n").cast("double"), F.col("b.n").cast("double")
    u = F.col("a.R") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * ((N + 1) - F.col("ties") / (N * (N - 1))))
    z = (F.greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sd
    two, more = F.col("groups") == 2, F.col("groups") > 2
    out = per.select("dimension", F.when(two, "mann_whitney_u").when(more, "kruskal_wallis").otherwise("none").alias("test"), "groups", F.col("N").alias("n"), F.when(two, u).when(more, h).alias("s"), z.alias("z"), (F.col("groups") - 1).cast("double").alias("dof"),
                     F.when(two, 2 * u / (n1 * n2) - 1).when(more, (h - F.col("groups") + 1) / (N - F.col("groups"))).alias("effect"))
    pv = out.withColumn("p", F.when(F.col("test") == "mann_whitney_u", _p("normal")("z", "dof")).when(F.col("test") == "kruskal_wallis", _p("chi2")("s", "dof")))
    return holm(pv.select("dimension", "test", "groups", "n", F.round("s", 4).alias("statistic"), F.round("effect", 4).alias("effect_size"), F.round("p", 6).alias("p_value")), "p_value")


def deterministic_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """U4: the n rows with the least hash of key and seed."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def distance_correlation(rows: DataFrame, key: str, pairs: list[tuple[str, str]], n: int = 1000, seed: int = 42) -> DataFrame:
    """Distance correlation on a deterministic sample of complete rows of each pair; the quadratic work is on the sample."""
    import numpy as np

    long = rows.select(F.col(key).alias("k"), F.explode(F.array(*[F.struct(F.concat_ws("|", F.lit(a), F.lit(b)).alias("pair"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for a, b in pairs])).alias("p")).select("k", "p.*").where("x is not null and y is not null")
    # hashes past a bound that leaves well over n rows of a pair can't be among its least, so none of them is sorted
    sizes = long.groupBy("pair").agg(F.count("*").alias("__n"))  # one row a pair
    bound = F.lit(1.5 * n + 1000) / F.col("__n") * 2.0**64 - 2.0**63
    some = long.join(F.broadcast(sizes), "pair").where(F.xxhash64("k", F.lit(seed)).cast("double") <= bound).drop("__n")
    w = Window.partitionBy("pair").orderBy(F.xxhash64("k", F.lit(seed)), "k")
    sample = some.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).drop("r")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        def centred(v):
            d = np.abs(v[:, None] - v[None, :])
            return d - d.mean(0)[None, :] - d.mean(1)[:, None] + d.mean()
        a, b = centred(frame["x"].to_numpy()), centred(frame["y"].to_numpy())
        low = math.sqrt((a * a).mean() * (b * b).mean())
        value = math.sqrt(max((a * b).mean(), 0) / low) if low > 0 else None
        return pd.DataFrame({"pair": [frame["pair"].iloc[0]], "n": [len(frame)], "distance_correlation": [None if value is None else round(value, 4)]})

    return sample.groupBy("pair").applyInPandas(run, "pair string, n long, distance_correlation double")
