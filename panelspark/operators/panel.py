"""Observations of an inventory at successive runs: as-of joins, panels, run comparison, ordered changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_as_of(rows: DataFrame, key: str, order: list[str], until: Column | None = None) -> DataFrame:
    """One row a key, the greatest by the order columns among rows where until holds. Combines before the shuffle."""
    seen = rows if until is None else rows.where(until)
    others = [c for c in rows.columns if c != key]
    best = seen.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("__best"))
    return best.select(key, *[F.col("__best")[c].alias(c) for c in others])


def as_of_join(left: DataFrame, right: DataFrame, key: str, at: str, since: str, columns: list[str]) -> DataFrame:
    """J2 for many instants: each left row with the right row of its key that has the greatest `since` not after `at`.

    Both sides go into one sorted stream for each key and the last right row is carried forward, so no pair of
    instants is made. Of right rows at one instant the greatest by columns counts; unmatched left rows keep nulls.
    """
    l = left.select(F.struct(*left.columns).alias("l"), F.col(key).alias("__k"), F.col(at).alias("__t"), F.lit(1).alias("__s"), F.lit(None).cast(right.select(F.struct(*columns)).schema[0].dataType).alias("r"))
    r = right.select(F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("l"), F.col(key).alias("__k"), F.col(since).alias("__t"), F.lit(0).alias("__s"), F.struct(*columns).alias("r"))
    w = Window.partitionBy("__k").orderBy("__t", "__s", "r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = l.unionByName(r).withColumn("m", F.last("r", ignorenulls=True).over(w)).where("__s = 1")
    return joined.select("l.*", *[F.col("m")[c].alias(c if c not in left.columns else f"source_{c}") for c in columns])


def with_absences(observations: DataFrame, key: str = "ad_id", run: str = "run_id") -> DataFrame:
    """The observations plus a row with was_seen false for each run after a key's first in which it wasn't seen.

    Runs are those that occur in the observations.
    """
    first = observations.groupBy(key).agg(F.min(run).alias("__first"))
    runs = F.array(*[F.lit(r[0]) for r in observations.select(run).distinct().orderBy(run).collect()])  # one number a run
    grid = first.select(key, F.explode(F.filter(runs, lambda r: r >= F.col("__first"))).alias(run))
    return grid.join(observations.withColumn("was_seen", F.lit(True)), [key, run], "left").withColumn("was_seen", F.coalesce("was_seen", F.lit(False)))


def event_counts(events: DataFrame, key: str, kind: str, kinds: list[str]) -> DataFrame:
    """Event counts pivoted wide; the list of kinds fixes the columns."""
    return events.groupBy(key).agg(*[F.count_if(F.col(kind) == k).alias(f"events_{k}") for k in kinds], F.count("*").alias("events_total"))


def event_rollup(events: DataFrame, keys: list[str], kind: str, value: str) -> DataFrame:
    """Distinct kinds joined in order, count, least and greatest value by keys."""
    return events.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("event_types"), F.count("*").alias("event_count"), F.min(value).alias("previous_value"), F.max(value).alias("new_value"))


def value_changes(rows: DataFrame, key: str, run: str, value: str) -> DataFrame:
    """Change against the previous observation of the key: absolute, percent, direction."""
    w = Window.partitionBy(key).orderBy(run)
    out = rows.where(F.col(value).isNotNull()).select(key, run, F.col(value).alias("value"), F.lag(value).over(w).alias("previous"))
    change = F.col("value") - F.col("previous")
    return out.where("previous is not null").select(
        key, run, "previous", "value", F.round(change, 4).alias("change"), F.round(F.when(F.col("previous") != 0, 100 * change / F.col("previous")), 4).alias("change_pct"),
        F.when(change > 0, "increase").when(change < 0, "decrease").otherwise("none").alias("direction"))


def shown_changes(rows: DataFrame, key: str, run: str, value: str, seen: str | None = None) -> DataFrame:
    """Change type against the previous seen observation, where null to value and back count: revealed, hidden. Rows in
    which the key wasn't seen take no part."""
    w = Window.partitionBy(key).orderBy(run)
    out = (rows.where(F.col(seen)) if seen else rows).select(key, run, F.col(value).alias("value"), F.lag(value).over(w).alias("previous"), F.row_number().over(w).alias("n")).where("n > 1")
    kind = (F.when(F.col("previous").isNull() & F.col("value").isNotNull(), "revealed").when(F.col("previous").isNotNull() & F.col("value").isNull(), "hidden")
            .when(F.col("value") > F.col("previous"), "increase").when(F.col("value") < F.col("previous"), "decrease"))
    return out.select(key, run, "previous", "value", kind.alias("change_type")).where("change_type is not null")


def gaps(rows: DataFrame, key: str, at: str) -> DataFrame:
    """Hours since the previous observation of the key."""
    w = Window.partitionBy(key).orderBy(at)
    return rows.select(key, at, F.round((F.unix_micros(at) - F.unix_micros(F.lag(at).over(w))) / 3.6e9, 4).alias("gap_hours")).where("gap_hours is not null")


def consecutive_misses(panel: DataFrame, key: str = "ad_id", run: str = "run_id", seen: str = "was_seen") -> DataFrame:
    """Number of misses in a row up to each run, 0 where seen (gaps and islands)."""
    w = Window.partitionBy(key).orderBy(run)
    island = panel.withColumn("__island", F.sum(F.col(seen).cast("int")).over(w))
    inside = Window.partitionBy(key, "__island").orderBy(run)
    return island.select(key, run, seen, F.when(F.col(seen), 0).otherwise(F.sum((~F.col(seen)).cast("int")).over(inside)).cast("long").alias("misses"))


def content_versions(rows: DataFrame, key: str, order: list[str], content: Column) -> DataFrame:
    """Only the first row of each content of a key, with a version number in order."""
    first = rows.withColumn("content_hash", content).groupBy(key, "content_hash").agg(F.min(F.struct(*order)).alias("__at"))
    return first.select(key, "content_hash", *[F.col("__at")[c].alias(c) for c in order], F.row_number().over(Window.partitionBy(key).orderBy("__at")).alias("version"))


def trailing_unavailable(checks: DataFrame, key: str, order: list[str], gone: Column, most: int = 10) -> DataFrame:
    """Unavailable checks in a row from the newest backwards, at most `most`."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    last = checks.select(key, gone.alias("__gone"), F.row_number().over(w).alias("__n")).where(F.col("__n") <= most)
    return last.groupBy(key).agg(F.coalesce(F.min(F.when(~F.col("__gone"), F.col("__n"))) - 1, F.count("*")).alias("unavailable_checks"))


def run_baseline(runs: DataFrame, order: str, count: str, group: list[str] | None = None, runs_back: int = 7, share: float = 0.30) -> DataFrame:
    """(group..., order, count, baseline_median, is_valid): a run is valid from this share of the median count of the last
    `runs_back` valid runs of its group (its configuration), the first ones without any are.

    Whether a run is valid depends on the valid ones before it, so each group's runs are folded in order; there is one row a run,
    so the folded array is as long as a configuration has runs.
    """
    keys = group or []
    ordered = runs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("run"), F.col(count).cast("long").alias("n")))).alias("__r"))
    kind = dict(runs.dtypes)[order]
    start = F.expr(f"cast(named_struct('last', array(), 'out', array()) as struct<last: array<bigint>, out: array<struct<run: {kind}, n: bigint, base: double, fine: boolean>>>)")

    def middle(xs: Column) -> Column:
        s = F.array_sort(xs)
        half = lambda k: F.get(s, F.floor(k / 2).cast("int"))
        return (half(F.size(xs) - 1) + half(F.size(xs))) / F.lit(2.0)

    def step(acc: Column, r: Column) -> Column:
        base = F.when(F.size(acc["last"]) > 0, middle(acc["last"]))
        fine = F.coalesce(r["n"] >= base * share, F.lit(True))
        grown = F.concat(acc["last"], F.array(r["n"]))
        last = F.when(fine, F.slice(grown, F.greatest(F.size(grown) - runs_back + 1, F.lit(1)), F.lit(runs_back))).otherwise(acc["last"])
        return F.struct(last.alias("last"), F.concat(acc["out"], F.array(F.struct(r["run"].alias("run"), r["n"].alias("n"), base.alias("base"), fine.alias("fine")))).alias("out"))

    folded = ordered.select(*keys, F.explode(F.aggregate("__r", start, step)["out"]).alias("o"))
    return folded.select(*keys, F.col("o.run").alias(order), F.col("o.n").alias(count), F.col("o.base").alias("baseline_median"), F.col("o.fine").alias("is_valid"))


def previous_valid(runs: DataFrame, order: str, run: str, valid: Column, group: list[str] | None = None) -> DataFrame:
    """The last valid run before each run."""
    w = Window.partitionBy(*(group or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumn("previous_valid_run", F.last(F.when(valid, F.col(run)), ignorenulls=True).over(w))


def leader_clusters(rows: DataFrame, key: str, at: str, minutes: int = 60) -> DataFrame:
    """Clusters in which every row lies within `minutes` of the cluster's first row: (key, leader, n).

    A row more than that after its leader starts a new cluster, so a cluster isn't a session. The fold runs over the
    sorted times of one key and day, and carries the leader over the days of the key.
    """
    step = minutes * 60 * 1_000_000
    times = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.unix_micros(at))).alias("times"))
    start = F.expr("cast(named_struct('leader', null, 'n', 0, 'done', array()) as struct<leader: bigint, n: bigint, done: array<struct<leader: bigint, n: bigint>>>)")
    closed = lambda s: F.struct(s["leader"].alias("leader"), s["n"].alias("n"))

    def fold(s: Column, t: Column) -> Column:
        """The open cluster, and the closed ones, which grow only when a cluster ends."""
        same = F.struct(s["leader"].alias("leader"), (s["n"] + 1).alias("n"), s["done"].alias("done"))
        first = F.struct(t.alias("leader"), F.lit(1).cast("long").alias("n"), s["done"].alias("done"))
        fresh = F.struct(t.alias("leader"), F.lit(1).cast("long").alias("n"), F.concat(s["done"], F.array(closed(s))).alias("done"))
        return F.when(s["leader"].isNull(), first).when(t - s["leader"] > step, fresh).otherwise(same)

    folded = times.select(key, F.aggregate("times", start, fold, lambda s: F.concat(s["done"], F.array(closed(s)))).alias("c"))
    return folded.select(key, F.explode("c").alias("c")).select(key, F.timestamp_micros("c.leader").alias("leader"), "c.n")


def compare_runs(observations: DataFrame, a: Column, b: Column, key: str = "ad_id", run: str = "run_id") -> DataFrame:
    """Keys in both runs, only the first, only the second; one row of counts and whether they are equal."""
    sides = observations.where(a | b).groupBy(key).agg(F.max(a.cast("int")).alias("a"), F.max(b.cast("int")).alias("b"))
    n = lambda c: F.count_if(c).alias
    both = sides.agg(n((F.col("a") == 1) & (F.col("b") == 1))("both"), n((F.col("a") == 1) & (F.col("b") == 0))("only_first"), n((F.col("a") == 0) & (F.col("b") == 1))("only_second"))
    return both.withColumn("stable", (F.col("only_first") == 0) & (F.col("only_second") == 0))


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str], name: str) -> DataFrame:
    """(check, count) of child rows whose non-null key has no parent."""
    keys = parent.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
    rows = child.dropna(subset=list(on))
    return rows.join(keys, list(on), "left_anti").agg(F.count("*").alias("count")).select(F.lit(name).alias("check"), "count")


def first_occurrence(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows deduplicated by each key in turn, the first by order staying."""
    out = rows
    for k in keys:
        w = Window.partitionBy(k).orderBy(*order)
        out = out.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return out


def upsert(old: DataFrame, new: DataFrame, key: list[str], version: str, first_wins: bool = False) -> DataFrame:
    """Keyed upsert of whole rows, last version (or first) of each key."""
    columns = old.columns
    rows = old.unionByName(new)
    pick = F.min_by if first_wins else F.max_by
    best = rows.groupBy(*key).agg(pick(F.struct(*columns), F.col(version)).alias("__row"))
    return best.select("__row.*")


def upsert_non_null(rows: DataFrame, key: str, columns: list[str], version: str) -> DataFrame:
    """For each column the last non-null value by version, and the number of sightings."""
    return rows.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(version))).alias(c) for c in columns], F.count("*").alias("sightings"))


def entity_rollup(rows: DataFrame, entity: str, listing: str, at: str, value: str, status: str) -> DataFrame:
    """One row a physical entity: listings, first and last time, value range and changes, last status."""
    w = Window.partitionBy(listing).orderBy(at)
    changed = rows.withColumn("__c", (F.col(value) != F.lag(value).over(w)).cast("int"))
    return changed.groupBy(entity).agg(
        F.count_distinct(listing).alias("listings"), F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.min(value).alias("value_min"), F.max(value).alias("value_max"),
        F.coalesce(F.sum("__c"), F.lit(0)).alias("value_changes"), F.max_by(status, F.struct(at, listing)).alias("last_status"))


def chain_deltas(rows: DataFrame, entity: str, listing: str, at: str, value: str) -> DataFrame:
    """First against last listing of each entity with more than one, in one grouping."""
    both = rows.groupBy(entity).agg(F.min_by(F.struct(listing, value, at), F.struct(at, listing)).alias("f"), F.max_by(F.struct(listing, value, at), F.struct(at, listing)).alias("l"), F.count_distinct(listing).alias("listings"))
    return both.where("listings > 1").select(entity, "listings", F.col("f")[listing].alias("first_listing"), F.col("l")[listing].alias("last_listing"), F.round(F.col("l")[value] - F.col("f")[value], 4).alias("value_delta"))


def consistency(rows: DataFrame, entity: str, order: list[str], value: str, tolerance: float) -> DataFrame:
    """E5: (pairs, falls, false_match_share): neighbours along the entities' chains, and those whose value falls by more than the tolerance."""
    step = F.col(value) - F.lag(value).over(Window.partitionBy(entity).orderBy(*order))
    falls = F.count_if(F.col("d") < -tolerance)
    return rows.select(step.alias("d")).where("d is not null").agg(F.count("*").alias("pairs"), falls.alias("falls"), F.round(falls / F.count("*"), 4).alias("false_match_share"))
