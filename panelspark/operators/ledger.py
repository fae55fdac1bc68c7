"""Event logs, applied outcomes and per-run extracts: each an idempotent step over keyed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions import columns as C

#: Event names by the status that a run leads to.
EVENTS = {"new": "discovered", "active": "seen", "reappeared": "reappeared", "missing_once": "missing_once", "likely_removed": "confirmed_removed"}


def append_once(log: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """A log with new rows; of rows with one key the first written stays, so appending twice changes nothing.

    Rows of the log come before new ones, then the order columns count. Null keys are equal to one another.
    """
    both = log.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    kept = both.groupBy(*key).agg(F.min_by(F.struct(*log.columns), F.struct("__new", *order)).alias("__row"))
    return kept.select("__row.*")


def insert_new(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key the table lacks, where null equals null; each key once (the least row)."""
    have = table.select(*[F.col(k).alias(f"__{k}") for k in key]).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]
    fresh = rows.join(have, on, "left_anti")
    return fresh.groupBy(*key).agg(F.min(F.struct(*rows.columns)).alias("__row")).select("__row.*")


def run_events(statuses: DataFrame, key: str, run: str, status: str, previous: str) -> DataFrame:
    """L2: (key, run, event_type, previous_status, new_status) of status rows; one that stays removed makes no event."""
    name = F.element_at(F.create_map(*[F.lit(x) for kv in EVENTS.items() for x in kv]), F.col(status))
    stays = (F.col(status) == "likely_removed") & F.coalesce(F.col(previous) == "likely_removed", F.lit(False))
    return statuses.where(~stays).select(key, run, name.alias("event_type"), F.col(previous).alias("previous_status"), F.col(status).alias("new_status"))


def event_counters(events: DataFrame, run: str = "run_id") -> DataFrame:
    """L2: counters of a run from its events."""
    n = lambda *kinds: F.count_if(F.col("event_type").isin(*kinds))
    return events.groupBy(run).agg(n("discovered").alias("new_ads"), n("seen", "reappeared").alias("seen_again"), n("missing_once").alias("first_misses"), n("confirmed_removed").alias("removals"), n("reappeared").alias("returns"))


def apply_filter_exits(state: DataFrame, live: DataFrame, key: str, reason: Column) -> DataFrame:
    """State rows with status and misses after filter exits; live has the key and what reason needs of pages found alive.

    Only an absent row (missing once or removed) whose live page fails a bound leaves for active_outside_filter, and its misses go to 0.
    """
    failed = live.select(key, reason.alias("exit_reason")).where("exit_reason is not null").groupBy(key).agg(F.min("exit_reason").alias("exit_reason"))
    rows = state.join(failed, key, "left")
    exits = F.col("exit_reason").isNotNull() & F.col("status").isin("missing_once", "likely_removed")
    return rows.select(*[c for c in state.columns if c not in ("status", "misses")], F.when(exits, "active_outside_filter").otherwise(F.col("status")).alias("status"), F.when(exits, 0).otherwise(F.col("misses")).alias("misses"), F.when(exits, F.col("exit_reason")).alias("exit_reason"))


def apply_links(state: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """State rows with entity_id, parent and status after links (parent, child).

    Both ends take the parent's entity id, or a new one of the pair; an absent parent becomes reposted; the child points to its parent.
    """
    ends = state.select(F.col(key).alias("parent"), F.col("entity_id").alias("__has"))
    named = links.join(ends, "parent").select("parent", "child", C.entity_id(F.col("parent").cast("string"), F.col("child").cast("string"), F.col("__has")).alias("__entity"))
    as_child = named.select(F.col("child").alias(key), F.col("parent").alias("__parent"), F.col("__entity").alias("__child_entity"))
    as_parent = named.groupBy(F.col("parent").alias(key)).agg(F.min("__entity").alias("__parent_entity"))
    rows = state.join(as_child, key, "left").join(as_parent, key, "left")
    gone = F.col("__parent_entity").isNotNull() & F.col("status").isin("missing_once", "likely_removed", "likely_sold")
    keep = [c for c in state.columns if c not in ("status", "entity_id")]
    return rows.select(*keep, F.when(gone, "reposted").otherwise(F.col("status")).alias("status"), F.coalesce("__child_entity", "__parent_entity", "entity_id").alias("entity_id"), F.col("__parent").alias("parent"))


def detail_changes(snapshots: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """(key, order..., change_type, old_value, new_value) of snapshots whose value differs from the snapshot before, null included."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = snapshots.select(key, *order, F.col(value).alias("new_value"), F.lag(value).over(w).alias("old_value"), F.row_number().over(w).alias("__n")).where("__n > 1 and not (old_value <=> new_value)")
    kind = F.when(F.col("new_value").isNull(), "hidden").when(F.col("old_value").isNull(), "revealed").when(F.col("new_value") > F.col("old_value"), "increase").otherwise("decrease")
    return rows.select(key, *order, F.concat(F.lit("detail_price_"), kind).alias("change_type"), "old_value", "new_value")


def with_last_change(panel: DataFrame, changes: DataFrame, key: str, run: str, columns: list[str]) -> DataFrame:
    """Panel rows with their key's last change."""
    last = changes.groupBy(key).agg(F.max_by(F.struct(*columns), F.col(run)).alias("__last"), F.max(run).alias("last_change_run"))
    return panel.join(last, key, "left").select("*", *[F.col("__last")[c].alias(f"last_{c}") for c in columns]).drop("__last")


def newest(rows: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The newest rows, as many as asked."""
    return rows.orderBy(*[F.desc(c) for c in order]).limit(limit)


def run_extract(rows: DataFrame, identity: DataFrame, key: str, run: str, at: int) -> DataFrame:
    """The rows of one run with their item's identity; the run filter reaches the scan."""
    return rows.where(F.col(run) == at).join(identity, key)


def membership(rows: DataFrame, seed: DataFrame, key: str, name: str) -> DataFrame:
    """Rows with a flag whether the seed has their key."""
    have = seed.select(key).distinct().withColumn(name, F.lit(True))
    return rows.join(have, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def exclusions(rows: DataFrame, key: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """(key, reason) of rows that an analysis leaves out, the first rule that holds."""
    reason = None
    for name, condition in rules:
        reason = F.when(condition, name) if reason is None else reason.when(condition, name)
    return rows.select(key, reason.alias("reason")).where("reason is not null")


def genuine_runs(runs: DataFrame, genuine: Column, order: str) -> tuple[DataFrame, DataFrame]:
    """P25: (runs of the genuine history, one row with its first run and the number of runs before it that don't count)."""
    marked = runs.withColumn("__g", genuine)
    edge = marked.agg(F.min(F.when(F.col("__g"), F.col(order))).alias("first_genuine"), F.count_if(F.col("__g")).alias("genuine"), F.count_if(~F.col("__g")).alias("left_out"))
    return marked.where("__g").drop("__g"), edge


def backfill(rows: DataFrame, column: str, value: Column, only_missing: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows with a derived column worked out again, one row of counts): each row anchored to its own fields."""
    todo = F.col(column).isNull() if only_missing else F.lit(True)
    out = rows.withColumn("__new", F.when(todo, value).otherwise(F.col(column)))
    counts = out.agg(F.count("*").alias("rows"), F.count_if(todo).alias("examined"), F.count_if(todo & F.col("__new").isNotNull()).alias("filled"))
    return out.drop(column).withColumnRenamed("__new", column), counts


def key_references(rows: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(kind, key, references) of join keys derived from rows; rows without a key count for none."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in keys.items()])
    return rows.select(F.explode(pairs).alias("p")).select("p.*").where("key is not null").groupBy("kind", "key").agg(F.count("*").alias("references"))


def prioritised(tagged: list[tuple[str, DataFrame]], key: str, cap: int) -> DataFrame:
    """P20: (key, tag, priority) of the union of tagged key sets in order of priority: each key under its first tag, the first `cap` by priority and key."""
    every = None
    for i, (tag, rows) in enumerate(tagged):
        one = rows.select(key, F.struct(F.lit(i).alias("priority"), F.lit(tag).alias("tag")).alias("p"))
        every = one if every is None else every.unionByName(one)
    best = every.groupBy(key).agg(F.min("p").alias("p"))
    return best.select(key, "p.tag", "p.priority").orderBy("priority", key).limit(cap)


def stratified(rows: DataFrame, stratum: Column, order: list[str], most: int = 25) -> DataFrame:
    """K3: up to `most` rows of each stratum by the order columns; partitions keep their first rows before the shuffle."""
    named = rows.withColumn("stratum", stratum)
    w = Window.partitionBy("stratum").orderBy(*order)
    return named.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most).drop("__n")


def enriched(rows: DataFrame, extra: DataFrame, key: str, at: str | None, cutoff: Column, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a second source's columns, one row of coverage): of each key the last extra row not after the cutoff counts, nothing later leaks in."""
    seen = extra.where(F.col(at) <= cutoff) if at else extra
    last = seen.groupBy(key).agg(F.max_by(F.struct(*columns), F.col(at)).alias("__x") if at else F.min(F.struct(*columns)).alias("__x"))
    out = rows.join(last, key, "left")
    coverage = out.agg(F.count("*").alias("rows"), F.count("__x").alias("matched"), F.round(100.0 * F.count("__x") / F.count("*"), 4).alias("matched_pct"))
    return out.select(*rows.columns, *[F.col("__x")[c].alias(c) for c in columns]), coverage


def rate_alerts(runs: DataFrame, removal: float = 0.20, failure: float = 0.20) -> DataFrame:
    """L4: (run_id, alert_type, severity, observed) of runs whose removals among known items, or failures among checks, pass a share."""
    share = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 4))
    rules = [("unusually_high_removal_rate", share("removals", "known_active"), removal), ("detail_failure_rate_exceeded", share("failures", "checks"), failure)]
    rows = F.array_compact(F.array(*[F.when(x > limit, F.struct(F.lit(name).alias("alert_type"), F.lit("warning").alias("severity"), x.alias("observed"))) for name, x, limit in rules]))
    return runs.select("run_id", F.explode(rows).alias("a")).select("run_id", "a.*")
