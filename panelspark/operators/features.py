"""Features of a wide table: what kind each is, whether it is usable, and how it differs between groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.operators.profile import long_form

GRAINS = {"spec_": "trim", "deep_": "vehicle", "snap_": "vehicle", "obs_": "listing", "events_": "listing"}


def discover(rows: DataFrame, columns: list[str], min_coverage: float = 0.05, max_levels: int = 30) -> DataFrame:
    """Q14: (feature, kind, grain, coverage, levels, usable, reason) from one scan in long form; rules work on the result."""
    v = F.col("value")
    out = long_form(rows, columns, kind="string").groupBy(F.col("variable").alias("feature")).agg(
        F.count("value").alias("filled"), F.count("*").alias("n"), F.count_distinct("value").alias("levels"), F.count(v.try_cast("double")).alias("numbers"), F.count_if(F.lower(v).isin("true", "false", "yes", "no", "0", "1")).alias("flags"))
    filled, coverage = F.col("filled"), F.col("filled") / F.col("n")
    kind = F.when(filled == 0, "empty").when(F.col("flags") == filled, "boolean").when(F.col("numbers") >= 0.95 * filled, "numeric").when(F.col("levels") <= max_levels, "categorical").otherwise("text")
    grain = F.lit("unknown")
    for prefix, name in GRAINS.items():
        grain = F.when(F.col("feature").startswith(prefix), name).otherwise(grain)
    reason = F.when(filled == 0, "all_null").when(coverage < min_coverage, "low_coverage").when(F.col("levels") <= 1, "constant").when(kind == "text", "too_many_levels")
    return out.select("feature", kind.alias("kind"), grain.alias("grain"), F.round(coverage, 4).alias("coverage"), "levels", reason.isNull().alias("usable"), reason.alias("reason"))


def compare_groups(rows: DataFrame, group: str, numeric: list[str], categorical: list[str], min_group: int = 10, max_groups: int = 12) -> DataFrame:
    """Q17: by feature and group: n, median of numbers, modal value and its share of categories; the largest groups alone."""
    sizes = rows.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("__n")).where(F.col("__n") >= min_group)
    large = sizes.orderBy(F.desc("__n"), group).limit(max_groups).select(group)
    kept = rows.join(F.broadcast(large), group, "left_semi")
    g = F.col(group).cast("string").alias("group")
    numbers = long_form(kept, numeric, [group]).where("value is not null").groupBy(F.col("variable").alias("feature"), g).agg(F.count("*").alias("n"), F.round(F.median("value"), 4).alias("median"))
    counts = long_form(kept, categorical, [group], "string").where("value is not null").groupBy(F.col("variable").alias("feature"), g, "value").agg(F.count("*").alias("c"))
    w = Window.partitionBy("feature", "group")
    modes = counts.withColumns({"n": F.sum("c").over(w), "r": F.row_number().over(w.orderBy(F.desc("c"), "value"))}).where("r = 1")
    modes = modes.select("feature", "group", "n", F.col("value").alias("mode"), F.round(F.col("c") / F.col("n"), 4).alias("mode_share"))
    return numbers.select("feature", "group", "n", "median", F.lit(None).cast("string").alias("mode"), F.lit(None).cast("double").alias("mode_share")).unionByName(modes.select("feature", "group", "n", F.lit(None).cast("double").alias("median"), "mode", "mode_share"))
