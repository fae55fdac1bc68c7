"""Integrity audit: one row a check, zero findings included; a critical finding can halt."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

CRITICAL, WARNING = "critical", "warning"


def count_where(rows: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """V1c-V1f: (check, severity, count) of row conditions, all in one scan; a null condition is no finding."""
    one = rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, (_, _, c) in enumerate(checks)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), F.col(f"c{i}").alias("count")) for i, (n, s, _) in enumerate(checks)])).alias("r")).select("r.*")


def duplicates(rows: DataFrame, keys: list[str], name: str, severity: str = CRITICAL) -> DataFrame:
    """Number of keys that occur more than once."""
    return rows.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("count")).select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), "count")


def conflicting(rows: DataFrame, key: str, column: str, name: str, severity: str = WARNING) -> DataFrame:
    """V1f: number of keys with more than one value of a column."""
    return rows.groupBy(key).agg(F.count_distinct(column).alias("d")).where("d > 1").agg(F.count("*").alias("count")).select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), "count")


def columns_present(rows: DataFrame, wanted: list[str], name: str = "provenance_columns") -> DataFrame:
    """V1h: number of wanted columns that are missing."""
    missing = len([c for c in wanted if c not in rows.columns])
    return rows.sparkSession.range(1).select(F.lit(name).alias("check"), F.lit(CRITICAL).alias("severity"), F.lit(missing).cast("long").alias("count"))


def samples(rows: DataFrame, checks: list[tuple[str, str, Column]], keys: list[str], most: int = 5) -> DataFrame:
    """V1: (check, severity, count, keys...) of each check's first rows by its keys; checks without findings have none.

    Each partition keeps its first rows of a check before the shuffle, so a check that very many rows fail is no burden.
    """
    hits = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"))) for n, s, c in checks]))
    found = rows.select(*keys, F.explode(hits).alias("__c")).select("__c.*", *keys)
    first = found.withColumn("__n", F.row_number().over(Window.partitionBy("check", "severity").orderBy(*keys))).where(F.col("__n") <= most).drop("__n")
    return first.join(F.broadcast(found.groupBy("check", "severity").agg(F.count("*").alias("count"))), ["check", "severity"])  # one row a check


def findings(rows: DataFrame, checks: list[tuple[str, str, Column]], key: str, most: int = 5) -> DataFrame:
    """V1: (check, severity, count, samples) of row conditions, with a row for each check, also without findings; samples are the least keys among its findings.

    Each task adds up its counts and keeps its least keys a check, so the rows are read once and a task sends as many rows as there are checks. A null
    condition is no finding, a null key no sample.
    """
    names = [f"c{i}" for i in range(len(checks))]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts, least = [0] * len(names), [[] for _ in names]
        for batch in batches:
            keys = batch.column(0)
            for i in range(len(names)):
                hit = keys.filter(batch.column(i + 1))
                counts[i] += len(hit)
                least[i] = heapq.nsmallest(most, least[i] + hit.drop_null().to_pylist())
        yield pa.RecordBatch.from_pydict({"at": pa.array([TaskContext.get().partitionId() % 64] * len(names), pa.int32()), "i": pa.array(range(len(names)), pa.int32()), "n": pa.array(counts, pa.int64()), "least": pa.array(least, pa.list_(keys_type))})

    flagged = rows.select(F.col(key).alias("key"), *[F.coalesce(c, F.lit(False)).alias(n) for n, (_, _, c) in zip(names, checks, strict=True)])
    keys_type = to_arrow_type(flagged.schema["key"].dataType)
    sums = flagged.mapInArrow(partial, f"at int, i int, n long, least array<{flagged.schema['key'].dataType.simpleString()}>")
    for by in (["at", "i"], ["i"]):
        sums = sums.groupBy(*by).agg(F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("least"))), 1, most).alias("least"))
    said = F.array(*[F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity")) for n, s, _ in checks])
    every = rows.sparkSession.range(len(checks)).select(F.col("id").cast("int").alias("i"))
    out = every.join(F.broadcast(sums), "i", "left").withColumn("said", F.get(said, F.col("i")))
    return out.select("said.check", "said.severity", F.coalesce("n", F.lit(0)).alias("count"), F.array_join(F.coalesce(F.col("least").cast("array<string>"), F.array().cast("array<string>")), ",").alias("samples"))


#: Fixed values of the checks of listings: statuses of a listing that is there, and of one that is gone; labels that say a sale; years that can be.
PRESENT, GONE = ("active", "new", "reappeared", "active_outside_filter"), ("likely_removed", "likely_sold")
SALES, YEARS = ("likely_sold", "highly_likely_sold", "confirmed_sold"), (1300, 1450)


def listing_checks(lowest_price: float | None = None, run_end: Column | None = None) -> list[tuple[str, str, Column]]:
    """V1a, V1c, V1d, V1f: checks of a cross-section of listings by their row: identity, order of times, ranges, and words that contradict one another.

    Columns: platform_ad_id, canonical_url, first_seen_at, last_seen_at, first_missing_at, snapshot_at, current_status, sale_label, price, mileage, year, filter_exit_reason.
    """
    c, gone = F.col, F.col("current_status").isin(*GONE)
    checks = [
        ("ad_id_url_mismatch", "error", ~F.contains(F.lower("canonical_url"), F.lower(c("platform_ad_id").cast("string")))),
        ("last_seen_before_first_seen", "error", c("last_seen_at") < c("first_seen_at")),
        ("disappearance_before_last_seen", "error", gone & (c("first_missing_at") < c("last_seen_at"))),
        ("negative_price", "error", c("price") < 0), ("zero_price", WARNING, c("price") == 0), ("negative_mileage", "error", c("mileage") < 0),
        ("implausible_production_year", "error", ~c("year").between(*YEARS)),
        ("sale_label_inconsistent_with_status", "error", c("current_status").isin(*PRESENT) & c("sale_label").isin(*SALES)),
        ("confirmed_sale_label_present", CRITICAL, c("sale_label") == "confirmed_sold"),
        ("filter_exit_counted_as_disappearance", "error", c("filter_exit_reason").isNotNull() & gone),
    ]
    if lowest_price is not None:
        checks.append(("price_below_search_lower_bound", WARNING, (c("price") > 0) & (c("price") < lowest_price)))
    if run_end is not None:
        checks.append(("future_snapshot_leaked_into_cross_section", CRITICAL, c("snapshot_at") > run_end))
    return checks


def private_columns(frames: dict[str, DataFrame], private: tuple[str, ...]) -> list[str]:
    """V1g: frame.column of each private column in the frames, by name without case."""
    return [f"{name}.{c}" for name, frame in frames.items() for c in frame.columns if c.lower() in private]


def without_private(rows: DataFrame, private: tuple[str, ...]) -> DataFrame:
    """Rows without the private columns, by name without case."""
    return rows.drop(*[c for c in rows.columns if c.lower() in private])


def select_run(runs: DataFrame, run_id: int | None = None, run: str = "run_id") -> tuple[DataFrame, list[str]]:
    """(one row, warnings): the newest run that is valid, finished, compared and not empty, or the run asked for, with a warning if it isn't valid.

    A condition whose column is missing is left out, with a warning. Without such a run, or without the run asked for, LookupError.
    """
    conditions = {"status": F.col("status") == "valid", "finished_at": F.col("finished_at").isNotNull(), "comparison_applied": F.col("comparison_applied"), "discovered_count": F.col("discovered_count") > 0}
    known, warnings = {c: x for c, x in conditions.items() if c in runs.columns}, []
    if run_id is not None:
        chosen = runs.where(F.col(run) == run_id).limit(1)
        if (found := chosen.first()) is None:
            raise LookupError(f"run {run_id} does not exist")
        if "status" in known and found["status"] != "valid":
            warnings.append(f"run {run_id} was asked for but its status is {found['status']}: absences in it can't be trusted")
        return chosen, warnings
    warnings = [f"no column {c}: the run was chosen without this condition" for c in conditions if c not in known]
    chosen = runs.where(reduce(lambda a, b: a & b, known.values(), F.lit(True))).orderBy(F.desc(run)).limit(1)
    if chosen.isEmpty():
        raise LookupError("no run meets the conditions")
    return chosen, warnings


def audit(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def enforce(findings: DataFrame) -> DataFrame:
    """Raises where a critical check has findings; else gives the frame back."""
    bad = findings.where((F.col("severity") == CRITICAL) & (F.col("count") > 0)).collect()  # one row a check
    if bad:
        raise ValueError("critical findings: " + ", ".join(f"{r['check']}={r['count']}" for r in bad))
    return findings


def snapshot_gate(runs: DataFrame, checks: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, each gate, publishable): run valid, all ads checked, accounted equals discovered, nothing to retry, compared, verified end,
    production run with a start, not blocked."""
    done = checks.groupBy(run).agg(F.count("*").alias("accounted"), F.count_if(F.col("outcome") == "retryable").alias("retryable"))
    rows = runs.join(done, run, "left")
    gates = {
        "run_status_valid": F.coalesce(F.col("status") == "valid", F.lit(False)), "all_checked": F.coalesce("accounted", F.lit(0)) >= F.col("discovered_count"), "accounted_equals_discovered": F.coalesce("accounted", F.lit(0)) == F.col("discovered_count"), "no_retryable": F.coalesce("retryable", F.lit(0)) == 0,
        "compared": F.col("comparison_applied"), "verified_end": F.col("verified_end"), "production": F.col("production"), "not_blocked": ~F.col("blocked")}
    whole = reduce(lambda a, b: a & b, gates.values())
    return rows.select(run, *[c.alias(n) for n, c in gates.items()], whole.alias("publishable"))
