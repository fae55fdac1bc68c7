"""Status of a listing over runs, run health, durations and survival.

A disappearance is an observation; a sale is an inference. Nothing here turns the one into the other.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Status names, thresholds and weights that results depend on.
PRESENT = ("new", "active", "reappeared", "missing_once")
DISAPPEARED = ("likely_removed", "likely_sold")
ABSENT = ("missing_once", "likely_removed", "likely_sold", "reposted")


@dataclass(frozen=True)
class Health:
    """Thresholds that make a run fit for comparison."""

    min_count_ratio: float = 0.30
    median_runs: int = 7
    min_count: int = 50
    max_failed_page_ratio: float = 0.20
    max_empty_title_ratio: float = 0.20
    max_missing_ratio: float = 0.50


@dataclass(frozen=True)
class Evidence:
    """Weights of the evidence that a disappearance is a sale, and the label bounds."""

    absent_two_valid_runs: float = 0.30
    detail_explicitly_unavailable: float = 0.15
    detail_persistent_404_410: float = 0.15
    recent_price_reduction: float = 0.10
    disappeared_soon_after_publication: float = 0.10
    seller_did_not_repost: float = 0.10
    disappearance_persists_seven_days: float = 0.10
    reappeared: float = -0.30
    vehicle_reposted: float = -0.25
    detail_remains_accessible: float = -0.20
    appears_outside_original_filter: float = -0.20
    soon_days: float = 3.0
    labels: tuple = field(default=((0.85, "highly_likely_sold"), (0.65, "likely_sold"), (0.40, "possibly_sold")))


def status_step(state: Column, run: Column, seen: Column, confirm: int = 2) -> Column:
    """One observation of a valid run applied to a state struct; a null status means not known yet.

    State: status, misses, seen_runs, missing_runs, first_seen, last_seen, first_missing, confirmed_removed, reappeared.
    """
    s = {c: state[c] for c in STATE}
    was_absent = s["status"].isin(*ABSENT)
    misses = s["misses"] + 1
    status_seen = F.when(s["status"].isNull(), "new").when(was_absent, "reappeared").otherwise("active")
    status_gone = F.when(misses >= confirm, "likely_removed").otherwise("missing_once")
    confirmed = F.coalesce(s["confirmed_removed"], F.when(misses >= confirm, run)) if confirm > 1 else F.coalesce(s["confirmed_removed"], F.when(misses > 1, run))
    if confirm <= 1:
        status_gone = F.when(misses == 1, "missing_once").otherwise("likely_removed")
    return F.struct(
        F.when(seen, status_seen).otherwise(status_gone).alias("status"),
        F.when(seen, 0).otherwise(misses).cast("int").alias("misses"),
        (s["seen_runs"] + seen.cast("int")).alias("seen_runs"),
        (s["missing_runs"] + (~seen).cast("int")).alias("missing_runs"),
        F.coalesce(s["first_seen"], F.when(seen, run)).alias("first_seen"),
        F.when(seen, run).otherwise(s["last_seen"]).alias("last_seen"),
        F.coalesce(s["first_missing"], F.when(~seen, run)).alias("first_missing"),
        F.when(seen, s["confirmed_removed"]).otherwise(confirmed).alias("confirmed_removed"),
        F.when(seen & was_absent, run).otherwise(s["reappeared"]).alias("reappeared"),
    )


STATE = ("status", "misses", "seen_runs", "missing_runs", "first_seen", "last_seen", "first_missing", "confirmed_removed", "reappeared")
START = "cast(named_struct('status', null, 'misses', 0, 'seen_runs', 0, 'missing_runs', 0, 'first_seen', null, 'last_seen', null, 'first_missing', null, 'confirmed_removed', null, 'reappeared', null) as struct<status: string, misses: int, seen_runs: int, missing_runs: int, first_seen: bigint, last_seen: bigint, first_missing: bigint, confirmed_removed: bigint, reappeared: bigint>)"


def fold_status(panel: DataFrame, key: str = "ad_id", run: str = "run_id", seen: str = "was_seen", valid: str | None = None, confirm: int = 2) -> DataFrame:
    """L1: the state of each key after all its runs, by one ordered fold a key.

    An absence counts only in a valid run and for a key that was seen before and isn't in a terminal status, as in compare_run; a
    sighting always counts. The array of a key is as long as the number of runs.
    """
    rows = panel.where(F.col(seen) | (F.col(valid) if valid else F.lit(True)))
    steps = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(run).cast("long").alias("run"), F.col(seen).alias("seen")))).alias("steps"))
    state = F.aggregate("steps", F.expr(START), lambda s, x: F.when(~x["seen"] & ~F.coalesce(s["status"].isin(*PRESENT), F.lit(False)), s).otherwise(status_step(s, x["run"], x["seen"], confirm)))
    return steps.select(key, state.alias("s")).where("s.status is not null").select(key, "s.*")


def compare_run(state: DataFrame, cards: DataFrame, run_id: int, key: str = "ad_id", confirm: int = 2) -> DataFrame:
    """L2: the state after one valid run, given the state before and the keys seen in it; repeated cards count once.

    Keys in a terminal status aren't tested for absence, but a sighting brings them back.
    """
    seen = cards.select(key).distinct().withColumn("__seen", F.lit(True))
    both = state.join(seen, key, "full_outer")
    blank = F.expr(START)
    before = F.when(F.col("status").isNotNull(), F.struct(*[F.col(c) for c in STATE])).otherwise(blank)
    tested = F.coalesce("__seen", F.lit(False))
    keep = ~tested & ~F.coalesce(F.col("status").isin(*PRESENT), F.lit(False))
    after = F.when(keep, before).otherwise(status_step(before, F.lit(run_id).cast("long"), tested, confirm))
    return both.select(key, after.alias("s")).select(key, "s.*")


def run_health(runs: DataFrame, limits: Health = Health()) -> DataFrame:
    """L3: (run_id, check, passed, blocking, observed, threshold) rows in long form.

    runs: run_id, initial_page_ok, blocked, verified_end, stabilized, persisted, discovered_count, baseline_median,
    pages_fetched, pages_failed, empty_titles, missing_urls, known_active, expected_missing, errors.
    """
    d = lambda c: F.col(c).cast("double")
    pages = d("pages_fetched") + d("pages_failed")
    count, floor = d("discovered_count"), d("baseline_median") * limits.min_count_ratio
    none = F.lit(None).cast("double")
    checks = [
        ("target_url_loaded", F.col("initial_page_ok"), True, F.col("initial_page_ok").cast("double"), none, None),
        ("not_blocked", ~F.col("blocked"), True, F.col("blocked").cast("double"), none, None),
        ("verified_termination", F.col("verified_end"), True, F.col("verified_end").cast("double"), none, None),
        ("stabilization_completed", F.col("stabilized"), True, F.col("stabilized").cast("double"), none, None),
        ("inventory_persisted", F.col("persisted"), True, F.col("persisted").cast("double"), none, None),
        ("minimum_absolute_count", count >= limits.min_count, True, count, F.lit(float(limits.min_count)), None),
        ("count_vs_recent_median", F.coalesce(count >= floor, F.lit(True)), None, count, F.round(floor, 1), None),
        ("failed_page_ratio", d("pages_failed") / pages <= limits.max_failed_page_ratio, True, F.round(d("pages_failed") / pages, 4), F.lit(limits.max_failed_page_ratio), pages > 0),
        ("card_titles_present", d("empty_titles") / count <= limits.max_empty_title_ratio, True, F.round(d("empty_titles") / count, 4), F.lit(limits.max_empty_title_ratio), count > 0),
        ("card_urls_present", F.col("missing_urls") == 0, True, d("missing_urls"), F.lit(0.0), count > 0),
        ("plausible_missing_ratio", d("expected_missing") / d("known_active") <= limits.max_missing_ratio, True, F.round(d("expected_missing") / d("known_active"), 4), F.lit(limits.max_missing_ratio), (d("known_active") > 0) & F.col("expected_missing").isNotNull()),
        ("no_critical_errors", F.lit(False), True, d("errors"), none, F.col("errors") > 0),
    ]
    rows = [F.when(F.lit(True) if applies is None else F.coalesce(applies, F.lit(False)), F.struct(F.lit(name).alias("check"), passed.alias("passed"), (F.col("baseline_median").isNotNull() if blocking is None else F.lit(blocking)).alias("blocking"), observed.alias("observed"), threshold.alias("threshold")))
            for name, passed, blocking, observed, threshold, applies in checks]
    return runs.select("run_id", F.explode(F.array_compact(F.array(*rows))).alias("c")).select("run_id", "c.*")


def classify_runs(checks: DataFrame) -> DataFrame:
    """L3: (run_id, status) from the blocking checks that failed, most specific first."""
    failed = F.collect_set(F.when(F.col("blocking") & ~F.col("passed"), F.col("check")))
    has = lambda *names: F.arrays_overlap("failed", F.array(*[F.lit(n) for n in names]))
    out = checks.groupBy("run_id").agg(failed.alias("failed"))
    status = (F.when(F.size("failed") == 0, "valid").when(has("not_blocked"), "blocked").when(has("target_url_loaded", "inventory_persisted"), "failed")
              .when(has("verified_termination", "stabilization_completed", "failed_page_ratio"), "partial").otherwise("invalid"))
    return out.select("run_id", status.alias("status"))


def health_alerts(checks: DataFrame) -> DataFrame:
    """L4: one alert row for each failed check."""
    return checks.where(~F.col("passed")).select("run_id", F.concat(F.lit("health_"), F.col("check")).alias("alert_type"), F.when(F.col("blocking"), "critical").otherwise("warning").alias("severity"))


def durations(rows: DataFrame, first: str, last: str, missing: str, status: str, now: Column | None = None) -> DataFrame:
    """Adds min_days, max_days, estimate_days, interval_hours, right_censored (interval-censored duration).

    Times are seconds (long or double). A return after the first miss voids the upper bound; without one, `now` extends
    the lower bound. A null first time gives nulls and counts as censored.
    """
    f, l, m = F.col(first).cast("double"), F.coalesce(F.col(last), F.col(first)).cast("double"), F.col(missing).cast("double")
    open_ = m.isNull() | (m <= l)
    reference = now.cast("double") if now is not None else l
    low = F.when(open_, F.greatest(l - f, reference - f, F.lit(0.0))).otherwise(F.greatest(l - f, F.lit(0.0)))
    day = lambda c: F.round(c / 86400.0, 4)
    closed = lambda c: F.when(~open_ & f.isNotNull(), c)
    return rows.withColumns({
        "min_days": F.when(f.isNotNull(), day(low)), "max_days": closed(day(F.greatest(m - f, low))), "estimate_days": closed(day(F.greatest((l + m) / 2 - f, F.lit(0.0)))),
        "interval_hours": closed(F.round((m - l) / 3600.0, 4)), "right_censored": f.isNull() | open_ | F.coalesce(F.col(status).isin(*PRESENT), F.lit(False))})


def market_durations(rows: DataFrame, published: str, last: str, missing: str, eligible: str) -> DataFrame:
    """market_min_days, market_max_days, market_estimate_days from publication, null for ineligible rows."""
    p, m = F.col(published).cast("double"), F.col(missing).cast("double")
    a = F.coalesce(F.col(last), F.col(published)).cast("double")
    ok = F.coalesce(F.col(eligible), F.lit(False)) & p.isNotNull()
    low = F.greatest(a - p, F.lit(0.0))
    day = lambda c, when: F.when(ok & when, F.round(c / 86400.0, 4))
    return rows.withColumns({"market_min_days": day(low, F.lit(True)), "market_max_days": day(F.greatest(m - p, low), m.isNotNull()), "market_estimate_days": day(F.greatest((a + m) / 2 - p, F.lit(0.0)), m.isNotNull())})


def survival_event(status: Column) -> Column:
    """D3: what ended the observation of a row."""
    return F.when(status.isin(*DISAPPEARED), "disappearance_observed").when(status == "reposted", "reposted").when(status == "active_outside_filter", "left_search_filter").otherwise("still_present_or_returned")


def censoring_class(status: Column, exit_reason: Column, truncated: Column) -> Column:
    """Filter exit, repost, return, gone (truncated or interval-censored), present, unknown, in this order."""
    return (F.when((status == "active_outside_filter") | exit_reason.isNotNull(), "active_outside_filter").when(status == "reposted", "reposted").when(status == "reappeared", "reappeared")
            .when(status.isin(*DISAPPEARED), F.when(F.coalesce(truncated, F.lit(True)), "left_truncated").otherwise("interval_censored")).when(status.isin(*PRESENT), "right_censored").otherwise("unknown"))


def kaplan_meier(rows: DataFrame, time: str, event: str, entry: str | None = None, group: str | None = None, min_subjects: int = 30, min_events: int = 10) -> DataFrame:
    """Q21, Q22: (group, time, at_risk, events, survival, ci_lower, ci_upper) at each event time, with delayed entry.

    At risk at t are subjects that entered before t and leave at t or later: entries before t less exits before t,
    where a subject that enters after its exit is never at risk. Groups below the minimum subjects or events give no
    rows. Only sums by distinct time reach the ordered windows. Greenwood variance, log-log band.
    """
    g = F.col(group) if group else F.lit("all")
    base = rows.select(g.alias("group"), F.col(time).cast("double").alias("t"), F.coalesce(F.col(event).cast("int"), F.lit(0)).alias("e"), (F.coalesce(F.col(entry).cast("double"), F.lit(0.0)) if entry else F.lit(0.0)).alias("s")).where("t >= 0")
    enough = base.groupBy("group").agg(F.count("*").alias("n"), F.sum("e").alias("k")).where((F.col("n") >= min_subjects) & (F.col("k") >= min_events)).select("group")
    exits = base.select("group", F.col("t").alias("at"), F.lit(0).alias("enter"), F.when(F.col("s") < F.col("t"), 1).otherwise(0).alias("leave"), F.col("e").alias("dead"))
    enters = base.where("s < t").select("group", F.col("s").alias("at"), F.lit(1).alias("enter"), F.lit(0).alias("leave"), F.lit(0).alias("dead"))
    by_time = exits.unionByName(enters).groupBy("group", "at").agg(*[F.sum(c).alias(c) for c in ("enter", "leave", "dead")]).join(enough, "group", "left_semi")
    past = Window.partitionBy("group").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    risk = by_time.withColumn("at_risk", F.coalesce(F.sum("enter").over(past) - F.sum("leave").over(past), F.lit(0)).cast("long")).where("dead > 0 and at_risk > 0")
    run = Window.partitionBy("group").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    n, d = F.col("at_risk"), F.col("dead")
    # a factor of 0 ends the curve for good: its log is left out and a running flag says so
    logs = F.sum(F.when(d < n, F.log1p(-d / n)).otherwise(0.0)).over(run)
    ended = F.max((d >= n).cast("int")).over(run)
    curve = risk.select("group", F.col("at").alias("time"), "at_risk", F.col("dead").cast("long").alias("events"), F.when(ended == 1, 0.0).otherwise(F.exp(logs)).alias("s"), F.sum(F.when(d < n, d / (n * (n - d))).otherwise(0.0)).over(run).alias("v"))
    factor = F.exp(1.96 * F.sqrt("v") / F.abs(F.log("s")))
    inside = (F.col("s") > 0) & (F.col("s") < 1) & (F.col("v") > 0)
    band = lambda power: F.round(F.when(inside, F.pow("s", power)).otherwise(F.col("s")), 6)
    return curve.select("group", "time", "at_risk", "events", F.round("s", 6).alias("survival"), band(factor).alias("ci_lower"), band(1 / factor).alias("ci_upper"))


def evidence_components(w: Evidence = Evidence(), confirm: int = 2) -> Column:
    """Array of (rule, weight) that hold, from columns misses, verdict, had_price_reduction, first_seen, first_missing (days),
    reposted, reappeared, outside_filter, now (days)."""
    gone = F.coalesce(F.col("verdict"), F.lit(""))
    no = F.lit(False)
    rules = [
        ("absent_two_valid_runs", F.col("misses") >= confirm), ("detail_explicitly_unavailable", gone == "explicitly_unavailable"), ("detail_persistent_404_410", gone.isin("http_404", "http_410")),
        ("recent_price_reduction", F.col("had_price_reduction")), ("disappeared_soon_after_publication", F.col("first_missing") - F.col("first_seen") <= w.soon_days), ("seller_did_not_repost", ~F.coalesce(F.col("reposted"), no)),
        ("disappearance_persists_seven_days", F.col("now") - F.col("first_missing") >= 7), ("reappeared", F.col("reappeared")), ("vehicle_reposted", F.col("reposted")), ("detail_remains_accessible", gone == "still_active"), ("appears_outside_original_filter", F.col("outside_filter")),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, no), F.struct(F.lit(n).alias("rule"), F.lit(getattr(w, n)).alias("weight"))) for n, c in rules]))


def evidence_score(components: Column) -> Column:
    """Sum of weights clamped to [0, 1], four places."""
    total = F.aggregate(F.transform(components, lambda c: c["weight"]), F.lit(0.0), lambda a, x: a + x)
    return F.round(F.greatest(F.least(total, F.lit(1.0)), F.lit(0.0)), 4)


def evidence_label(score: Column, w: Evidence = Evidence()) -> Column:
    out = None
    for bound, name in w.labels:
        out = F.when(score >= bound, name) if out is None else out.when(score >= bound, name)
    return out.otherwise("unknown")


def promote(status: Column, score: Column, at: float = 0.65) -> Column:
    """Strong evidence makes likely_sold of likely_removed alone."""
    return F.when((status == "likely_removed") & (score >= at), "likely_sold").otherwise(status)


def reclassify_start(slot: Column, start: Column, within_minutes: int = 30) -> Column:
    """Provenance of a run from its start against its slot."""
    late = (F.unix_micros(start) - F.unix_micros(slot)) / 6e7
    return F.when(slot.isNull(), "no_slot").when(start.isNull(), "no_start").when(late < 0, "started_before_slot").when(late <= within_minutes, "scheduled").otherwise("manual_or_late")


def slot_decision(minutes_late: Column, ran: Column, grace: int = 240) -> Column:
    """None, wait, catch_up or record_missed for a slot. A missed slot is recorded, never made up."""
    return F.when(ran, "none").when(minutes_late < 0, "wait").when(minutes_late <= grace, "catch_up").otherwise("record_missed")
