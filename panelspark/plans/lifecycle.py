"""Queries over statuses, run health, durations and survival."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.operators import lifecycle as L
from panelspark.operators import panel as P
from panelspark.plans import frames
from panelspark.plans.catalogue import query, table
from panelspark.plans.frames import PANEL, RUNS

STATUS = f"""{PANEL}, steps as (select p.ad_id, p.run_id, p.was_seen, row_number() over (partition by p.ad_id order by p.run_id) as n from panel p join runs r using (run_id) where p.was_seen or r.is_valid),
fold as (select ad_id, n, run_id, 'new' as status, 0 as misses, 1 as seen_runs, 0 as missing_runs, run_id as first_seen, run_id as last_seen, null::bigint as first_missing, null::bigint as confirmed_removed, null::bigint as reappeared from steps where n = 1
  union all select s.ad_id, s.n, s.run_id,
    case when s.was_seen then case when f.status in ('missing_once', 'likely_removed') then 'reappeared' else 'active' end when f.misses + 1 >= 2 then 'likely_removed' else 'missing_once' end,
    case when s.was_seen then 0 when f.status = 'likely_removed' then f.misses else f.misses + 1 end, f.seen_runs + s.was_seen::int, f.missing_runs + (not s.was_seen and f.status <> 'likely_removed')::int, f.first_seen, case when s.was_seen then s.run_id else f.last_seen end,
    coalesce(f.first_missing, case when not s.was_seen then s.run_id end), coalesce(f.confirmed_removed, case when not s.was_seen and f.misses + 1 >= 2 then s.run_id end),
    case when s.was_seen and f.status in ('missing_once', 'likely_removed') then s.run_id else f.reappeared end
  from fold f join steps s on s.ad_id = f.ad_id and s.n = f.n + 1),
final as (select * from (select *, row_number() over (partition by ad_id order by n desc) as last from fold) where last = 1)"""
WITH = f"with recursive {STATUS}"


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.panel(spark, sf_dir).join(F.broadcast(frames.runs(spark, sf_dir).select("run_id", "is_valid")), "run_id")
    return L.fold_status(rows, valid="is_valid")


@query("status_fold", f"{WITH} select ad_id, status, misses, seen_runs, missing_runs, first_seen, last_seen, first_missing, confirmed_removed, reappeared from final")
def status_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states(spark, sf_dir)


@query("status_totals", f"{WITH} select status, count(*) as ads, sum(missing_runs)::bigint as missing_runs from final group by status")
def status_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states(spark, sf_dir).groupBy("status").agg(F.count("*").alias("ads"), F.sum("missing_runs").alias("missing_runs"))


@query("status_transitions", f"{WITH} select coalesce(p.status, 'none') as previous_status, f.status as new_status, count(*) as n from fold f left join fold p on p.ad_id = f.ad_id and p.n = f.n - 1 group by all")
def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same statuses from windows: what a run shows depends on the run of misses before it."""
    rows = frames.panel(spark, sf_dir).join(F.broadcast(frames.runs(spark, sf_dir).select("run_id", "is_valid")), "run_id").where("was_seen or is_valid")
    misses = P.consecutive_misses(rows.select("ad_id", "run_id", "was_seen"))
    w = Window.partitionBy("ad_id").orderBy("run_id")
    before = F.lag("misses").over(w)
    status = F.when(before.isNull(), "new").when(F.col("was_seen"), F.when(before > 0, "reappeared").otherwise("active")).when(F.col("misses") >= 2, "likely_removed").otherwise("missing_once")
    named = misses.withColumn("new_status", status)
    return named.select(F.coalesce(F.lag("new_status").over(w), F.lit("none")).alias("previous_status"), "new_status").groupBy("previous_status", "new_status").agg(F.count("*").alias("n"))


@query("run_comparison", """with recursive prev as (select user_id as ad_id, count(distinct cast(ts as date)) as days, max(cast(ts as date)) as last_day from events where ts < timestamp '2024-01-21' group by user_id),
cards as (select distinct user_id as ad_id from events where cast(ts as date) = date '2024-01-21')
select coalesce(p.ad_id, c.ad_id) as ad_id, case when p.ad_id is null then 'new' when c.ad_id is null then case when p.last_day = date '2024-01-20' then 'missing_once' else 'likely_removed' end when p.last_day = date '2024-01-20' then 'active' else 'reappeared' end as status
from prev p full join cards c on c.ad_id = p.ad_id""")
def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: one run's cards against the state before it (all runs taken as valid, absence since the day before)."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("ad_id"), frames.run_of("ts").alias("run_id"))
    day = 19743
    before = events.where(F.col("run_id") < day).groupBy("ad_id").agg(F.max("run_id").alias("last"), F.min("run_id").alias("first"), F.count_distinct("run_id").cast("int").alias("n"))
    missed = (day - 1 - F.col("last")).cast("int")
    state = before.select("ad_id", F.when(missed == 0, "active").otherwise("missing_once").alias("status"), missed.alias("misses"), F.col("n").alias("seen_runs"), missed.alias("missing_runs"), F.col("first").alias("first_seen"), F.col("last").alias("last_seen"), *[F.lit(None).cast("long").alias(c) for c in ("first_missing", "confirmed_removed", "reappeared")])
    return L.compare_run(state, events.where(F.col("run_id") == day), day).select("ad_id", "status")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health metrics of each day: an error event is a failed page, a low value an empty title."""
    events = table(spark, sf_dir, "events").select("user_id", frames.run_of("ts").alias("run_id"), "event_type", "value")
    page = events.groupBy("run_id").agg(F.count_if(F.col("event_type") == "error").alias("pages_failed"), F.count_if(F.col("event_type") != "error").alias("pages_fetched"), F.count_if(F.col("value") < 2).alias("empty_titles"), F.lit(0).alias("missing_urls"), F.count_if(F.col("value") > 400).alias("errors"))
    rows = frames.runs(spark, sf_dir).drop("is_valid").join(page, "run_id")
    panel = frames.panel(spark, sf_dir).groupBy("run_id").agg(F.count_if(~F.col("was_seen")).alias("expected_missing"), F.count("*").alias("known_active"))
    t = F.lit(True)
    return rows.join(panel, "run_id").withColumns({"initial_page_ok": t, "blocked": F.col("run_id") % 11 == 0, "verified_end": F.col("run_id") % 7 != 0, "stabilized": t, "persisted": t})


HEALTH = f"""{PANEL}, page as (select date_diff('day', date '1970-01-01', cast(ts as date)) as run_id, count(*) filter (event_type = 'error') as pages_failed, count(*) filter (event_type <> 'error') as pages_fetched, count(*) filter (value < 2) as empty_titles, count(*) filter (value > 400) as errors from events group by 1),
miss as (select run_id, count(*) filter (not was_seen) as expected_missing, count(*) as known_active from panel group by 1),
m as (select * from runs join page using (run_id) join miss using (run_id)),
checks as (
  select run_id, 'target_url_loaded' as "check", true as passed, true as blocking from m union all select run_id, 'not_blocked', run_id % 11 <> 0, true from m
  union all select run_id, 'verified_termination', run_id % 7 <> 0, true from m union all select run_id, 'stabilization_completed', true, true from m union all select run_id, 'inventory_persisted', true, true from m
  union all select run_id, 'minimum_absolute_count', discovered_count >= 50, true from m union all select run_id, 'count_vs_recent_median', coalesce(discovered_count >= 0.3 * baseline_median, true), baseline_median is not null from m
  union all select run_id, 'failed_page_ratio', pages_failed / (pages_failed + pages_fetched) <= 0.2, true from m union all select run_id, 'card_titles_present', empty_titles / discovered_count <= 0.2, true from m
  union all select run_id, 'card_urls_present', true, true from m union all select run_id, 'plausible_missing_ratio', expected_missing / known_active <= 0.5, true from m union all select run_id, 'no_critical_errors', false, true from m where errors > 0)"""


@query("run_health_checks", f'with recursive {HEALTH} select run_id, "check", passed, blocking from checks')
def run_health_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.run_health(metrics(spark, sf_dir)).select("run_id", "check", "passed", "blocking")


@query("run_health_status", f"""with recursive {HEALTH}, failed as (select run_id, list("check") filter (blocking and not passed) as f from checks group by run_id)
select run_id, case when f is null then 'valid' when list_contains(f, 'not_blocked') then 'blocked' when list_has_any(f, ['target_url_loaded', 'inventory_persisted']) then 'failed' when list_has_any(f, ['verified_termination', 'stabilization_completed', 'failed_page_ratio']) then 'partial' else 'invalid' end as status from failed""")
def run_health_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.classify_runs(L.run_health(metrics(spark, sf_dir)))


@query("health_alerts", f"""with recursive {HEALTH} select run_id, 'health_' || "check" as alert_type, case when blocking then 'critical' else 'warning' end as severity from checks where not passed""")
def health_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.health_alerts(L.run_health(metrics(spark, sf_dir)))


DUR = f"""{STATUS}, d as (select *, (first_missing is null or first_missing <= last_seen) as open, (select max(run_id) from obs) as now_run from final),
dur as (select ad_id, status, first_seen, last_seen, first_missing,
  case when open then greatest(last_seen, now_run) - first_seen else last_seen - first_seen end::double as min_days, case when not open then first_missing - first_seen end::double as max_days,
  case when not open then round((last_seen + first_missing) / 2 - first_seen, 4) end as estimate_days, case when not open then (first_missing - last_seen) * 24.0::double end as interval_hours, (open or status in ('new', 'active', 'reappeared', 'missing_once')) as right_censored from d)"""


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = states(spark, sf_dir)
    now = frames.observations(spark, sf_dir).agg(F.max("run_id")).first()[0]
    seconds = rows.withColumns({c: F.col(c) * 86400 for c in ("first_seen", "last_seen", "first_missing")})
    return L.durations(seconds, "first_seen", "last_seen", "first_missing", "status", F.lit(now * 86400))


@query("durations", f"with recursive {DUR} select ad_id, status, min_days, max_days, estimate_days, interval_hours, right_censored from dur")
def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed(spark, sf_dir).select("ad_id", "status", "min_days", "max_days", "estimate_days", "interval_hours", "right_censored")


@query("duration_summary", f"""with recursive {DUR} select count(*) as ads, count(*) filter (right_censored) as censored, round(median(min_days), 4) as median_min_days, round(quantile_cont(estimate_days, 0.9), 4) as p90_estimate_days, count(*) filter (max_days < min_days) as inverted_bounds from dur""")
def duration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed(spark, sf_dir).agg(F.count("*").alias("ads"), F.count_if("right_censored").alias("censored"), F.round(F.median("min_days"), 4).alias("median_min_days"), F.round(F.percentile("estimate_days", F.lit(0.9)), 4).alias("p90_estimate_days"), F.count_if(F.col("max_days") < F.col("min_days")).alias("inverted_bounds"))


@query("survival_rows", f"""with recursive {DUR} select ad_id, case when status = 'likely_removed' then 'disappearance_observed' else 'still_present_or_returned' end as event_type, (status = 'likely_removed')::int as event_observed,
  case when status = 'reappeared' then 'reappeared' when status = 'likely_removed' then case when first_seen = (select min(run_id) from obs) then 'left_truncated' else 'interval_censored' end else 'right_censored' end as censoring from dur""")
def survival_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timed(spark, sf_dir)
    first = frames.observations(spark, sf_dir).agg(F.min("run_id")).first()[0]
    status = F.col("status")
    return rows.select("ad_id", L.survival_event(status).alias("event_type"), status.isin(*L.DISAPPEARED).cast("int").alias("event_observed"), L.censoring_class(status, F.lit(None).cast("string"), F.col("first_seen") == first * 86400).alias("censoring"))


KM = """with b as (select {group} as "group", date_diff('day', o_orderdate, last_ship)::double as t, (o_orderstatus = 'F')::int as e, (o_orderkey % 5)::double as s from orders join (select l_orderkey, max(l_shipdate) as last_ship from lineitem group by 1) on l_orderkey = o_orderkey where last_ship >= o_orderdate),
g as (select "group" from b group by 1 having count(*) >= 30 and sum(e) >= 10), ev as (select distinct "group", t from b join g using ("group") where e = 1),
r as (select ev."group", ev.t, (select count(*) from b where b."group" = ev."group" and b.s < ev.t and b.t >= ev.t) as n, (select sum(e) from b where b."group" = ev."group" and b.t = ev.t) as d from ev),
c as (select *, exp(sum(case when d < n then ln(1 - d / n) else 0 end) over w) * (1 - max((d >= n)::int) over w) as sv, sum(case when d < n then d / (n * (n - d)) else 0 end) over w as v from r where n > 0 window w as (partition by "group" order by t)),
f as (select *, exp(1.96 * sqrt(v) / abs(ln(case when sv > 0 then sv else 0.5 end))) as k, sv > 0 and sv < 1 and v > 0 as inside from c)
select "group", t as time, n as at_risk, d::bigint as events, round(sv, 6) as survival, round(case when inside then pow(sv, k) else sv end, 6) as ci_lower, round(case when inside then pow(sv, 1 / k) else sv end, 6) as ci_upper from f"""


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("last_ship"))
    rows = table(spark, sf_dir, "orders").join(last, "o_orderkey")
    return rows.select("o_orderpriority", F.datediff("last_ship", "o_orderdate").alias("t"), (F.col("o_orderstatus") == "F").cast("int").alias("e"), (F.col("o_orderkey") % 5).alias("s"))


@query("survival_curve", KM.format(group="'all'"))
def survival_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.kaplan_meier(subjects(spark, sf_dir), "t", "e", "s")


@query("survival_by_group", KM.format(group="o_orderpriority"))
def survival_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.kaplan_meier(subjects(spark, sf_dir), "t", "e", "s", "o_orderpriority")


SCORE = f"""{DUR}, fell as (select ad_id, bool_or(d < 0) as fell from (select ad_id, price - lag(price) over (partition by ad_id order by run_id) as d from obs) group by ad_id),
i as (select u.*, coalesce(fell, false) as fell, ad_id % 3 as v from dur u join fell using (ad_id) join final f using (ad_id)), m as (select ad_id, misses from final),
c as (select ad_id, status, round(greatest(0, least(1, 0.30 * (misses >= 2)::int + 0.15 * (v = 0)::int + 0.15 * (v = 1)::int + 0.10 * fell::int + 0.10 * coalesce(first_missing - first_seen <= 3, false)::int + 0.10
  + 0.10 * coalesce((select max(run_id) from obs) - first_missing >= 7, false)::int - 0.30 * (status = 'reappeared')::int - 0.20 * (v = 2)::int)), 4) as score from i join m using (ad_id))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = frames.observations(spark, sf_dir)
    fell = P.value_changes(obs, "ad_id", "run_id", "price").groupBy("ad_id").agg(F.bool_or(F.col("direction") == "decrease").alias("had_price_reduction"))
    now = obs.agg(F.max("run_id")).first()[0]
    verdict = F.when(F.col("ad_id") % 3 == 0, "explicitly_unavailable").when(F.col("ad_id") % 3 == 1, "http_404").otherwise("still_active")
    rows = states(spark, sf_dir).withColumn("reappeared", F.col("status") == "reappeared").join(fell, "ad_id", "left").withColumns({"verdict": verdict, "reposted": F.lit(False), "outside_filter": F.lit(False), "now": F.lit(now)})
    out = rows.withColumn("components", L.evidence_components()).withColumn("score", L.evidence_score(F.col("components")))
    return out.select("ad_id", "status", "components", "score")


@query("evidence_scores", f"with recursive {SCORE} select ad_id, score, case when score >= 0.85 then 'highly_likely_sold' when score >= 0.65 then 'likely_sold' when score >= 0.4 then 'possibly_sold' else 'unknown' end as label, case when status = 'likely_removed' and score >= 0.65 then 'likely_sold' else status end as promoted from c")
def evidence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("ad_id", "score", L.evidence_label(F.col("score")).alias("label"), L.promote(F.col("status"), F.col("score")).alias("promoted"))


@query("evidence_bands", f"with recursive {SCORE} select status, floor(score * 10) / 10 as band, count(*) as ads, round(avg(score), 4) as mean_score from c group by grouping sets ((status), (floor(score * 10) / 10), ())")
def evidence_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).withColumn("band", F.floor(F.col("score") * 10) / 10)
    return rows.groupingSets([["status"], ["band"], []], "status", "band").agg(F.count("*").alias("ads"), F.round(F.avg("score"), 4).alias("mean_score"))


@query("slot_decisions", f"""with recursive {RUNS}, days as (select unnest(generate_series((select min(run_id) from obs), (select max(run_id) from obs) + 2)) as run_id)
select d.run_id, case when r.run_id is not null then 'none' when ((select max(run_id) from obs) + 1 - d.run_id) * 1440 < 0 then 'wait' when ((select max(run_id) from obs) + 1 - d.run_id) * 1440 <= 240 then 'catch_up' else 'record_missed' end as decision from days d left join runs r on r.run_id = d.run_id and r.is_valid""")
def slot_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = frames.runs(spark, sf_dir).where("is_valid").select("run_id", F.lit(True).alias("ran"))
    bounds = frames.observations(spark, sf_dir).agg(F.min("run_id").alias("a"), F.max("run_id").alias("b"))
    slots = bounds.select(F.explode(F.sequence("a", F.col("b") + 2)).alias("run_id"), "b")
    return slots.join(runs, "run_id", "left").select("run_id", L.slot_decision((F.col("b") + 1 - F.col("run_id")) * 1440, F.coalesce("ran", F.lit(False))).alias("decision"))
