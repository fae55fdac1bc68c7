"""Records of one item from two sources: precedence by field, provenance codes, conflicts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from panelspark.functions import columns as C


@dataclass(frozen=True)
class Rule:
    """A field's order of sources (first wins), how its values count as equal, and how grave a difference is."""

    field: str
    first: str = "A"
    mode: str = "text"
    severity: str = "minor"


#: Characters without meaning in a loose comparison, and those between the parts of a place.
LOOSE, BETWEEN = "[\u060c,/\\\\\\s\u200c|-]+", "[\u060c,/\\\\|]+"
TRAIL = "array<struct<title: string, url: string, to: string>>"


def equivalent(a: Column, b: Column, mode: str) -> Column:
    """whether two values say the same under a mode. A missing value disagrees with nothing.

    text: equal once normalised, case kept. loose: equal without punctuation and spaces. subset: one loose form in the other.
    components: the parts of one, split at commas, slashes and bars, are all among the other's, neither without parts. breadcrumb: the (title, link)
    trails of two JSON lists are equal; what isn't such a list has no trail. number: within 1e-6. boolean: equal. temporal: always, as both are relative.
    """
    if mode == "temporal":
        return F.lit(True)
    plain = lambda c: F.coalesce(C.normalize_text(c.cast("string")), F.lit(""))
    loose = lambda c: F.regexp_replace(plain(c), LOOSE, "")
    if mode == "number":
        same = F.abs(a.cast("double") - b.cast("double")) < 1e-6
    elif mode == "boolean":
        same = a.cast("boolean") == b.cast("boolean")
    elif mode == "text":
        same = plain(a) == plain(b)
    elif mode == "loose":
        same = loose(a) == loose(b)
    elif mode == "subset":
        same = F.contains(loose(a), loose(b)) | F.contains(loose(b), loose(a))
    elif mode == "components":
        parts = lambda c: F.array_distinct(F.filter(F.transform(F.split(plain(c), BETWEEN), lambda x: F.trim(x)), lambda x: x != ""))
        x, y = parts(a), parts(b)
        same = (F.size(x) > 0) & (F.size(y) > 0) & ((F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0))
    elif mode == "breadcrumb":
        def trail(c: Column) -> Column:
            items = F.when(F.ltrim(c.cast("string")).startswith("["), F.from_json(c.cast("string"), TRAIL))
            pairs = F.transform(F.array_compact(items), lambda x: F.struct(F.coalesce(x["title"], F.lit("")).alias("title"), F.coalesce(x["url"], x["to"], F.lit("")).alias("link")))
            return F.coalesce(pairs, F.array().cast("array<struct<title: string, link: string>>"))

        same = trail(a) == trail(b)
    else:
        raise ValueError(f"unknown mode {mode}")
    return a.isNull() | b.isNull() | same


def merge_records(left: DataFrame, right: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    """One row a key: each field's value, its provenance code (A, H, B for both, - for none) and an array of conflicts.

    left is source A, right is source H; a field one side alone has comes from there; values that differ under the rule's mode
    are a conflict and the preferred source's stands.
    """
    a = left.select(F.col(key), *[F.col(r.field).alias(f"a_{r.field}") for r in rules])
    h = right.select(F.col(key), *[F.col(r.field).alias(f"h_{r.field}") for r in rules])
    both = a.join(h, key, "full_outer")
    values, codes, conflicts = [], [], []
    for r in rules:
        x, y = F.col(f"a_{r.field}"), F.col(f"h_{r.field}")
        types = [s.schema[r.field].dataType for s in (left, right)]
        mode = r.mode if r.mode == "temporal" else "boolean" if any(isinstance(t, BooleanType) for t in types) else "number" if all(isinstance(t, NumericType) for t in types) else r.mode
        same = F.coalesce(equivalent(x, y, mode), F.lit(False))
        values.append((F.coalesce(x, y) if r.first == "A" else F.coalesce(y, x)).alias(r.field))
        codes.append(F.when(x.isNull() & y.isNull(), "-").when(y.isNull(), "A").when(x.isNull(), "H").when(same, "B").otherwise(r.first).alias(f"{r.field}_source"))
        conflicts.append(F.when(x.isNotNull() & y.isNotNull() & ~same, F.struct(F.lit(r.field).alias("field"), F.lit(r.severity).alias("severity"), x.cast("string").alias("a"), y.cast("string").alias("h"))))
    return both.select(key, *values, *codes, F.array_compact(F.array(*conflicts)).alias("conflicts"))


def merge_children(first: DataFrame, second: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Children by key: the first source's values, gaps filled from the second, with the source that gave the row."""
    a = first.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("__a"))
    b = second.select(*keys, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("__b"))
    return a.join(b, keys, "full_outer").select(*keys, *[F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in columns], F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "first").otherwise("second").alias("source"))


def merge_report(merged: DataFrame, gate: float = 0.01) -> DataFrame:
    """(field, severity, n, share, passes): conflicts by field against all records; critical ones must stay under the gate."""
    total = merged.agg(F.count("*").alias("total"))
    by = merged.select(F.explode("conflicts").alias("c")).groupBy("c.field", "c.severity").agg(F.count("*").alias("n"))
    rows = by.join(F.broadcast(total.withColumn("k", F.lit(1))), F.lit(1) == F.col("k"))
    share = F.col("n") / F.col("total")
    return rows.select("field", "severity", "n", F.round(share, 6).alias("share"), ((F.col("severity") != "critical") | (share < gate)).alias("passes"))


def replace_children(children: DataFrame, parent: str, version: str) -> DataFrame:
    """Children of each parent's last version alone."""
    last = children.groupBy(parent).agg(F.max(version).alias(version))
    return children.join(last, [parent, version], "left_semi")


def nest(parents: DataFrame, key: str, parts: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """One record a parent with each part's rows inlined as an ordered array of structs; empty where there are none."""
    out = parents
    for name, (rows, columns) in parts.items():
        grouped = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))
        out = out.join(grouped, key, "left")
    return out
