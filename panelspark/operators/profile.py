"""Profiles, compositions, segments and missingness: each one scan in long form, then rules on a small result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.listings import absence_cause
from panelspark.operators import ranks

PERCENTILES = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)


def long_form(rows: DataFrame, columns: list[str], keep: list[str] | None = None, kind: str = "double") -> DataFrame:
    """(keep..., variable, value): one row a column and input row."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast(kind).alias("value")) for c in columns])
    return rows.select(*(keep or []), F.explode(pairs).alias("__p")).select(*(keep or []), "__p.variable", "__p.value")


def skewness(value: str) -> Column:
    """Sample skewness with the correction for small samples; null below three values."""
    n = F.count(value)
    return F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * F.skewness(value))


def numeric_profile(rows: DataFrame, columns: list[str], places: int = 4) -> DataFrame:
    """A1: one row a numeric column: counts, moments, percentiles, range, zeros, negatives, distinct, note."""
    long = long_form(rows, columns)
    out = long.groupBy("variable").agg(
        F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("missing"), F.round(100.0 * F.avg(F.col("value").isNull().cast("int")), 2).alias("missing_pct"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"), skewness("value").alias("skewness"), F.count_if(F.col("value") == 0).alias("zeros"), F.count_if(F.col("value") < 0).alias("negatives"), F.count_distinct("value").alias("distinct"))
    out = out.join(ranks.percentiles(long, ["variable"], "value", PERCENTILES).drop("n"), "variable", "left")
    names = ["p01", "p05", "p10", "p25", "median", "p75", "p90", "p95", "p99"]
    r = lambda c: F.round(c, places)
    note = F.when(F.col("count") == 0, "no non-null values").when(F.abs("skewness") > 1, "skewed; prefer the median")
    return out.select("variable", "count", "missing", "missing_pct", *[r(F.col(c)).alias(c) for c in ("mean", "std", "min", "max", "skewness")], *[r(F.col("q")[i]).alias(n) for i, n in enumerate(names)], r(F.col("q")[5] - F.col("q")[3]).alias("iqr"), "zeros", "negatives", "distinct", note.alias("note"))


def categorical_distribution(rows: DataFrame, columns: list[str], top: int = 10, min_group: int = 10) -> DataFrame:
    """A2, K2: the most frequent values of each column with '(missing)' as a value, share, and whether the group is large enough."""
    counts = long_form(rows, columns, kind="string").groupBy("variable", F.coalesce("value", F.lit("(missing)")).alias("value")).agg(F.count("*").alias("n"))
    whole, order = Window.partitionBy("variable"), Window.partitionBy("variable").orderBy(F.desc("n"), "value")
    ranked = counts.withColumns({"total": F.sum("n").over(whole), "rank": F.row_number().over(order)}).where(F.col("rank") <= top)
    return ranked.select("variable", "value", "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("share_pct"), (F.col("n") >= min_group).alias("sufficient"), "rank")


def composition(rows: DataFrame, columns: list[str]) -> DataFrame:
    """A3: share of known and of all rows by value of each dimension, and its coverage; one scan through grouping sets."""
    sets = rows.groupingSets([[c] for c in columns], *columns).agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    name, value = None, None
    for i, c in enumerate(columns):
        here = F.col("g").bitwiseAND(1 << (len(columns) - 1 - i)) == 0
        name = F.when(here, c) if name is None else name.when(here, c)
        value = F.when(here, F.col(c).cast("string")) if value is None else value.when(here, F.col(c).cast("string"))
    w = Window.partitionBy("dimension")
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    out = sets.select(name.alias("dimension"), value.alias("value"), "n").withColumns({"total": F.sum("n").over(w), "known": F.sum(known).over(w)})
    return out.where("value is not null").select("dimension", "value", "n", F.round(100.0 * F.col("n") / F.col("known"), 4).alias("share_known_pct"), F.round(100.0 * F.col("n") / F.col("total"), 4).alias("share_total_pct"), F.round(100.0 * F.col("known") / F.col("total"), 4).alias("coverage_pct"))


def cross_tab(rows: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """A4: counts and medians by two keys."""
    return rows.groupBy(a, b).agg(F.count("*").alias("n"), F.round(F.median(value), 4).alias("median"))


def segment_statistics(rows: DataFrame, dimensions: list[str], value: str, min_group: int = 10, trim: float = 0.1, z: float = 1.959963984540054) -> DataFrame:
    """By value of each dimension: n, moments, quartiles, trimmed mean, order-statistic interval of the median.

    Groups below min_group are suppressed. Rank-based figures come from counts of values with running sums, so no level's rows meet in one task.
    """
    base = rows.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("__v"), *[F.col(d).cast("string").alias(d) for d in dimensions])
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("level")) for d in dimensions])
    rows_ = base.select("__v", F.explode(pairs).alias("p")).select("p.dimension", "p.level", F.col("__v").alias("v")).where("level is not null")
    keys = ["dimension", "level"]
    moments = rows_.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"), F.stddev_samp("v").alias("sd")).where(F.col("n") >= min_group)
    counts = ranks.value_counts(rows_, keys, "v").withColumnRenamed("n", "c").join(moments.select(*keys), keys, "left_semi")
    n = F.col("n")
    cut_off = F.floor(n * trim)
    low = F.greatest(F.lit(0), F.least(F.floor((n - z * F.sqrt(n)) / 2), n - 1))
    high = F.greatest(F.lit(0), F.least(F.ceil(1 + (n + z * F.sqrt(n)) / 2) - 1, n - 1))
    kept = F.greatest(F.least(F.col("below") + F.col("c"), n - cut_off) - F.greatest(F.col("below"), cut_off), F.lit(0))
    ranked = ranks.ranked_counts(counts, keys, "v", "c").join(moments.select(*keys, "n"), keys)
    q = [F.round(ranks.percentile_at("v", p, n, "c"), 12).alias(f"q{i}") for i, p in enumerate((0.25, 0.5, 0.75))]
    order = ranked.groupBy(*keys).agg(*q, (F.sum(F.col("v") * kept) / F.sum(kept)).alias("trimmed"), ranks.at_rank("v", low, "c").alias("lo"), ranks.at_rank("v", high, "c").alias("hi"))
    out = moments.join(order, keys)
    r = lambda c, name: F.round(c, 4).alias(name)
    return out.select("dimension", "level", "n", r(F.col("q1"), "median"), r(F.col("mean"), "mean"), r(F.col("q0"), "p25"), r(F.col("q2"), "p75"), r(F.col("min"), "min"), r(F.col("max"), "max"), r(F.col("sd"), "sd"), r(F.col("trimmed"), "trimmed_mean"), r(F.col("q2") - F.col("q0"), "iqr"), r(F.col("lo"), "median_ci_low"), r(F.col("hi"), "median_ci_high"))


def completeness(rows: DataFrame, columns: list[str], min_coverage: float = 0.05) -> DataFrame:
    """Filled count, missing share, distinct values, constant, usable; each rejection has its reason."""
    out = long_form(rows, columns, kind="string").groupBy("variable").agg(F.count("value").alias("filled"), F.count("*").alias("n"), F.count_distinct("value").alias("distinct"))
    share = F.col("filled") / F.col("n")
    reason = F.when(F.col("filled") == 0, "all_null").when(share < min_coverage, "low_coverage").when(F.col("distinct") <= 1, "constant")
    return out.select("variable", "filled", F.round(100.0 * (1 - share), 4).alias("missing_pct"), "distinct", (F.col("distinct") == 1).alias("constant"), reason.isNull().alias("usable"), reason.alias("reason"))


def missingness_summary(complete: DataFrame, structural: tuple[str, ...] = (), recent: tuple[str, ...] = ()) -> DataFrame:
    """(cause, columns, mean_missing_pct) from completeness rows."""
    cause = absence_cause(F.col("missing_pct"), F.col("variable"), structural, recent)
    return complete.groupBy(cause.alias("cause")).agg(F.count("*").alias("columns"), F.round(F.avg("missing_pct"), 4).alias("mean_missing_pct"))


def missing_patterns(rows: DataFrame, columns: list[str], top: int = 25) -> DataFrame:
    """Joint missingness: one character a column, 1 where null; the most frequent patterns."""
    signature = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return rows.groupBy(signature.alias("pattern")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pattern").limit(top)


def missing_by_group(rows: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Missing percent of each column by group."""
    return long_form(rows, columns, [group], "string").groupBy(group, "variable").agg(F.round(100.0 * F.avg(F.col("value").isNull().cast("int")), 4).alias("missing_pct"))


def calibration(rows: DataFrame, score: str, outcome: str, steps: int = 10, min_band: int = 10, min_total: int = 40) -> DataFrame:
    """Outcome rate by score band, null below min_band decided rows; no rows below min_total in all."""
    decided = rows.where(F.col(score).isNotNull() & F.col(outcome).isNotNull())
    band = F.least(F.floor(F.col(score) * steps), F.lit(steps - 1))
    by = decided.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.avg(F.col(outcome).cast("double")).alias("rate"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # one row a band
    return by.withColumn("total", total).where(F.col("total") >= min_total).select("band", "n", F.round(F.when(F.col("n") >= min_band, F.col("rate")), 4).alias("rate"))


def pivot_long(rows: DataFrame, key: str, name: str, value: str, names: list[str]) -> DataFrame:
    """Long to wide with a fixed list of columns, the least value of each."""
    return rows.groupBy(key).agg(*[F.min(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def catalogue_of(rows: DataFrame, name: str, value: str, key: str) -> DataFrame:
    """Rows, keys and distinct values of each name in a long table."""
    return rows.groupBy(name).agg(F.count("*").alias("n"), F.count_distinct(key).alias("keys"), F.count_distinct(value).alias("distinct_values"))
