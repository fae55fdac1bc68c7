"""Queries over event logs, applied outcomes, extracts, ledgers and entity chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.functions import columns as C
from panelspark.functions import listings as V
from panelspark.operators import ledger as G
from panelspark.operators import panel as P
from panelspark.operators import profile as R
from panelspark.operators import quality as Q
from panelspark.plans import frames, lifecycle
from panelspark.plans.catalogue import query, table
from panelspark.plans.frames import OBS, RUNS
from panelspark.plans.lifecycle import DUR, SCORE, WITH

DAY = "date_diff('day', date '1970-01-01', cast(ts as date))"
CHAINS = """st as (select o_orderkey, o_custkey, o_orderdate, o_totalprice, case o_orderstatus when 'F' then 'likely_removed' when 'O' then 'active' else 'new' end as status, lead(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as child from orders),
links as (select o_orderkey as parent, child from st where status = 'likely_removed' and child is not null)"""


@query("event_log_append", f"select user_id, run_id, event_type, event_id from (select user_id, {DAY} as run_id, event_type, event_id, row_number() over (partition by user_id, {DAY}, event_type order by ts, event_id) as n from events) where n = 1")
def event_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the events, then all of them, appended to the log of the first half."""
    rows = table(spark, sf_dir, "events").select("user_id", frames.run_of("ts").alias("run_id"), "event_type", "event_id", "ts")
    early, key = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), ["user_id", "run_id", "event_type"]
    log = G.append_once(rows.where(early), rows.where(~early), key, ["ts", "event_id"])
    return G.append_once(log, rows, key, ["ts", "event_id"]).drop("ts")


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ad_id, run_id, status, previous) at each run that counts."""
    rows = frames.panel(spark, sf_dir).join(F.broadcast(frames.runs(spark, sf_dir).select("run_id", "is_valid")), "run_id").where("was_seen or is_valid")
    misses = P.consecutive_misses(rows.select("ad_id", "run_id", "was_seen"))
    w = Window.partitionBy("ad_id").orderBy("run_id")
    before = F.lag("misses").over(w)
    status = F.when(before.isNull(), "new").when(F.col("was_seen"), F.when(before > 0, "reappeared").otherwise("active")).when(F.col("misses") >= 2, "likely_removed").otherwise("missing_once")
    return misses.withColumn("status", status).withColumn("previous", F.lag("status").over(w))


RUN_EVENTS = "ev as (select f.ad_id, f.run_id, case f.status when 'new' then 'discovered' when 'active' then 'seen' when 'likely_removed' then 'confirmed_removed' else f.status end as event_type, p.status as previous_status, f.status as new_status from fold f left join fold p on p.ad_id = f.ad_id and p.n = f.n - 1 where not (f.status = 'likely_removed' and coalesce(p.status = 'likely_removed', false)))"


@query("run_events", f"{WITH}, {RUN_EVENTS} select * from ev")
def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: events of every run's comparison."""
    return G.run_events(statuses(spark, sf_dir), "ad_id", "run_id", "status", "previous")


@query("run_counters", f"{WITH}, {RUN_EVENTS} select run_id, count(*) filter (event_type = 'discovered') as new_ads, count(*) filter (event_type in ('seen', 'reappeared')) as seen_again, count(*) filter (event_type = 'missing_once') as first_misses, count(*) filter (event_type = 'confirmed_removed') as removals, count(*) filter (event_type = 'reappeared') as returns from ev group by run_id")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2."""
    return G.event_counters(run_events(spark, sf_dir))


@query("filter_exit_application", f"{WITH}, live as (select user_id as ad_id, max(value) as price from events where value > 100 group by 1) select f.ad_id, case when l.price is not null and status in ('missing_once', 'likely_removed') then 'active_outside_filter' else status end as status, case when l.price is not null and status in ('missing_once', 'likely_removed') then 0 else misses end as misses, case when l.price is not null and status in ('missing_once', 'likely_removed') then 'price_above_filter' end as exit_reason from final f left join live l using (ad_id)")
def filter_exit_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A live page with a price over the search's bound takes an absent listing out of the population."""
    live = table(spark, sf_dir, "events").select(F.col("user_id").alias("ad_id"), F.col("value").alias("price"))
    state = lifecycle.states(spark, sf_dir).select("ad_id", "status", "misses")
    return G.apply_filter_exits(state, live, "ad_id", C.filter_reason(F.col("price"), F.lit(None).cast("int"), price_to=100, epsilon=0))


@query("link_application", f"""with {CHAINS}, named as (select parent, child, 'veh_' || substr(sha256(least(parent::varchar, child::varchar) || '|' || greatest(parent::varchar, child::varchar)), 1, 16) as entity from links)
select s.o_orderkey, case when p.parent is not null then 'reposted' else s.status end as status, coalesce(c.entity, p.entity) as entity_id, c.parent from st s left join named p on p.parent = s.o_orderkey left join named c on c.child = s.o_orderkey""")
def link_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finished order and the same customer's next one are linked."""
    state, links = chains(spark, sf_dir)
    return G.apply_links(state.select("o_orderkey", "status").withColumn("entity_id", F.lit(None).cast("string")), links, "o_orderkey")


def chains(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as listings with a status, and links from a removed one to its customer's next."""
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "likely_removed").when(F.col("o_orderstatus") == "O", "active").otherwise("new")
    child = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    state = o.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", status.alias("status"), child.alias("child"))
    links = state.where("status = 'likely_removed' and child is not null").select(F.col("o_orderkey").alias("parent"), "child")
    return state.drop("child"), links


@query("link_summary", f"with {CHAINS} select count(*) as links, count(distinct links.parent) as parents, count(distinct links.child) as children, round(avg(date_diff('day', p.o_orderdate, c.o_orderdate)), 4) as mean_gap_days, round(median(date_diff('day', p.o_orderdate, c.o_orderdate)), 4) as median_gap_days from links join st p on p.o_orderkey = links.parent join st c on c.o_orderkey = links.child")
def link_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6."""
    state, links = chains(spark, sf_dir)
    at = lambda name: state.select(F.col("o_orderkey").alias(name), F.col("o_orderdate").alias(f"{name}_at"))
    gap = F.datediff("child_at", "parent_at")
    return links.join(at("parent"), "parent").join(at("child"), "child").agg(F.count("*").alias("links"), F.count_distinct("parent").alias("parents"), F.count_distinct("child").alias("children"), F.round(F.avg(gap), 4).alias("mean_gap_days"), F.round(F.median(gap), 4).alias("median_gap_days"))


@query("chain_consistency", "with p as (select o_custkey, o_totalprice - lag(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey) as d from orders) select count(*) as pairs, count(*) filter (d < -1000) as falls, round(count(*) filter (d < -1000) / count(*), 4) as false_match_share from p where d is not null")
def chain_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: a mileage may not fall by more than the tolerance along a chain; the order's price stands for it."""
    return P.consistency(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 1000)


@query("entity_durations", "select o_custkey, count(*) as listings, date_diff('day', min(o_orderdate), max(o_orderdate))::double as min_days, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) <> 'F' as right_censored from orders group by 1")
def entity_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an entity over all its listings."""
    e = P.entity_rollup(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    return e.select("o_custkey", "listings", C.days_between(F.col("last_seen"), F.col("first_seen")).alias("min_days"), (F.col("last_status") != "F").alias("right_censored"))


@query("entity_grain", "with c as (select o_custkey, count(*) as listings from orders group by 1) select listings, count(*) as entities, round(100.0 * count(*) / sum(count(*)) over (), 4) as share_pct from c group by 1")
def entity_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain sizes."""
    c = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("listings")).groupBy("listings").agg(F.count("*").alias("entities"))
    return c.withColumn("share_pct", F.round(100.0 * F.col("entities") / F.sum("entities").over(Window.partitionBy(F.lit(0))), 4))  # one row a size


SNAPSHOT = "case when o_orderstatus <> 'P' then o_totalprice end"


@query("detail_price_changes", f"with s as (select o_custkey, o_orderdate, o_orderkey, {SNAPSHOT} as v, lag({SNAPSHOT}) over w as p, row_number() over w as n from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)) select o_custkey, o_orderdate, o_orderkey, 'detail_price_' || case when v is null then 'hidden' when p is null then 'revealed' when v > p then 'increase' else 'decrease' end as change_type, p as old_value, v as new_value from s where n > 1 and v is distinct from p")
def detail_price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pending order hides its price."""
    rows = table(spark, sf_dir, "orders").withColumn("price", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    return G.detail_changes(rows, "o_custkey", ["o_orderdate", "o_orderkey"], "price")


CHANGES = f"{OBS}, c as (select ad_id, run_id, lag(price) over (partition by ad_id order by run_id) as previous, price as value from obs), ch as (select * from c where previous is not null and value <> previous)"


@query("panel_last_change", f"with {CHANGES}, l as (select ad_id, max(run_id) as last_change_run, arg_max(previous, run_id) as last_previous, arg_max(value, run_id) as last_value from ch group by 1) select o.ad_id, o.run_id, l.last_change_run, l.last_previous, l.last_value from obs o left join l using (ad_id)")
def panel_last_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6."""
    obs = frames.observations(spark, sf_dir)
    changes = P.value_changes(obs, "ad_id", "run_id", "price").where("change <> 0 or value <> previous")
    return G.with_last_change(obs.select("ad_id", "run_id"), changes, "ad_id", "run_id", ["previous", "value"])


@query("price_change_history", f"with {CHANGES} select ad_id, run_id, previous, value from ch order by run_id desc, ad_id desc limit 1000")
def price_change_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest thousand."""
    changes = P.value_changes(frames.observations(spark, sf_dir), "ad_id", "run_id", "price").where("value <> previous")
    return G.newest(changes.select("ad_id", "run_id", "previous", "value"), ["run_id", "ad_id"], 1000)


@query("run_extract", f"select e.user_id, e.event_id, {DAY} as run_id, c.c_name from events e join customer c on c.c_custkey = e.user_id where event_type = 'purchase' and {DAY} = (select max({DAY}) from events)")
def run_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last run's purchases with the buyer's name."""
    events = table(spark, sf_dir, "events").where("event_type = 'purchase'").select("user_id", "event_id", frames.run_of("ts").alias("run_id"))
    last = table(spark, sf_dir, "events").agg(F.max(frames.run_of("ts"))).first()[0]
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return G.run_extract(events, people, "user_id", "run_id", last)


@query("seed_membership", "select p_partkey, p_partkey in (select l_partkey from lineitem where l_returnflag = 'R') as in_seed from part")
def seed_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J22."""
    seed = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return G.membership(table(spark, sf_dir, "part").select("p_partkey"), seed, "p_partkey", "in_seed")


@query("null_safe_insert", "select distinct on (o_custkey, k) o_custkey, k, o_orderkey from (select o_custkey, case when o_orderstatus <> 'P' then o_orderpriority end as k, o_orderkey from orders where o_orderdate >= timestamp '1998-01-01') n where not exists (select 1 from orders t where t.o_orderdate < timestamp '1998-01-01' and t.o_custkey = n.o_custkey and (case when t.o_orderstatus <> 'P' then t.o_orderpriority end) is not distinct from n.k) order by o_custkey, k, o_orderkey")
def null_safe_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null priority is a key like any other."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("k"), "o_orderkey", "o_orderdate")
    edge = F.lit("1998-01-01").cast("timestamp_ntz")
    return G.insert_new(rows.where(F.col("o_orderdate") < edge), rows.where(F.col("o_orderdate") >= edge).drop("o_orderdate"), ["o_custkey", "k"])


@query("check_proofs", "select o_custkey, run_id, min(o_orderkey) as o_orderkey from (select o_custkey, year(o_orderdate) as run_id, o_orderkey from orders) group by 1, 2")
def check_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One proof of a check for each (run, item), however often it is written."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("run_id"), "o_orderkey")
    return G.append_once(rows, rows, ["o_custkey", "run_id"], ["o_orderkey"])


GONE = f"{SCORE}, gone as (select c.ad_id, c.status, c.score, u.min_days, u.max_days, u.estimate_days, u.first_seen > (select min(run_id) from obs) as fully_observed from c join dur u using (ad_id) where c.status = 'likely_removed')"


def gone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a disappeared listing: bounds and estimate of its time, evidence, whether it was seen from its first run."""
    first = frames.observations(spark, sf_dir).agg(F.min("run_id")).first()[0]
    times = lifecycle.timed(spark, sf_dir).select("ad_id", "min_days", "max_days", "estimate_days", (F.col("first_seen") > first * 86400).alias("fully_observed"))
    return lifecycle.scored(spark, sf_dir).where("status = 'likely_removed'").select("ad_id", "status", "score").join(times, "ad_id")


@query("time_to_disappearance", f"with recursive {GONE} select * from gone")
def time_to_disappearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gone(spark, sf_dir)


@query("fastest_disappearing", f"with recursive {GONE} select ad_id, estimate_days, score from gone where score >= 0.4 and fully_observed order by estimate_days, score desc, ad_id limit 50")
def fastest_disappearing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: with a lower bound on the evidence than the default, which no row of the small tables reaches. A listing that came back
    after its first miss has no estimate and comes last."""
    return gone(spark, sf_dir).where("score >= 0.4 and fully_observed").orderBy(F.asc_nulls_last("estimate_days"), F.desc("score"), "ad_id").limit(50).select("ad_id", "estimate_days", "score")


@query("truncation_ledger", f"with recursive {DUR} select ad_id, case when first_seen = (select min(run_id) from obs) then 'left_truncated' when right_censored then 'right_censored' end as reason from dur where first_seen = (select min(run_id) from obs) or right_censored")
def truncation_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a ranking of durations leaves out, and why."""
    first = frames.observations(spark, sf_dir).agg(F.min("run_id")).first()[0]
    return G.exclusions(lifecycle.timed(spark, sf_dir), "ad_id", [("left_truncated", F.col("first_seen") == first * 86400), ("right_censored", F.col("right_censored"))])


@query("status_meanings", f"{WITH} select status, count(*) as ads, status in ('likely_removed', 'likely_sold') as is_disappearance, case status " + " ".join(f"when '{k}' then '{v}'" for k, v in V.MEANINGS.items()) + " end as meaning from final group by status")
def status_meanings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15."""
    totals = lifecycle.states(spark, sf_dir).groupBy("status").agg(F.count("*").alias("ads"))
    return totals.select("status", "ads", F.col("status").isin(*V.DISAPPEARANCES).alias("is_disappearance"), V.lookup(F.col("status"), V.MEANINGS).alias("meaning"))


@query("genuine_history", f"with recursive {RUNS} select min(run_id) filter (is_valid) as first_genuine, count(*) filter (is_valid) as genuine, count(*) filter (not is_valid) as left_out from runs")
def genuine_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P25: valid runs are the genuine ones here."""
    return G.genuine_runs(frames.runs(spark, sf_dir), F.col("is_valid"), "run_id")[1]


@query("first_last_url", "select arg_min(url, page_id) as first_url, arg_max(url, page_id) as last_url from pages")
def first_last_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5."""
    return table(spark, sf_dir, "pages").agg(F.min_by("url", "page_id").alias("first_url"), F.max_by("url", "page_id").alias("last_url"))


@query("key_references", r"""with k as (select regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as host, regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]+)', 1) as section from pages)
select 'dealer' as kind, lower(host) as key, count(*) as references from k where host <> '' group by 2 union all select 'section', section, count(*) from k where section <> '' group by 2""")
def key_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join keys from URLs."""
    some = lambda c: F.nullif(c, F.lit(""))
    return G.key_references(table(spark, sf_dir, "pages"), {"dealer": some(F.lower(F.try_parse_url("url", F.lit("HOST")))), "section": some(F.regexp_extract(F.try_parse_url("url", F.lit("PATH")), "^/([^/]+)", 1))})


@query("backfilled_lengths", "select count(*) as rows, count(*) filter (o) as examined, count(*) filter (o and text is not null) as filled from (select text, coalesce(n_chars, 0) % 2 = 1 as o from documents)")
def backfilled_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """even lengths count as stored, the others are worked out again."""
    rows = table(spark, sf_dir, "documents").select("text", F.when(F.coalesce("n_chars", F.lit(0)) % 2 == 0, F.col("n_chars")).alias("stored"))
    kept = rows.withColumn("stored", F.coalesce("stored", F.when(F.length("text") % 2 == 0, F.length("text").cast("long"))))
    return G.backfill(kept, "stored", F.length("text").cast("long"))[1]


@query("missingness_causes", """with c as (select 'text' as "column", round(100.0 * avg((text is null)::int), 4) as m from documents union all select 'lang', round(100.0 * avg((lang is null)::int), 4) from documents union all select 'quality', round(100.0 * avg((quality is null)::int), 4) from documents left join labels using (doc_id) union all select 'never', 100.0)
select case when m = 0 then 'complete' when m = 100 then 'not_collected' when "column" = 'quality' then 'collected_later' else 'not_stated' end as cause, count(*) as columns, round(avg(m), 4) as mean_missing_pct from c group by 1""")
def missingness_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A23."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").withColumn("never", F.lit(None).cast("string"))
    return R.missingness_summary(R.completeness(rows, ["text", "lang", "quality", "never"]), (), ("quality",))


@query("duration_bounds_audit", f"""with recursive {DUR} select 'inverted_bounds' as "check", 'critical' as severity, count(*) filter (max_days < min_days) as count from dur union all select 'negative_duration', 'critical', count(*) filter (min_days < 0 or max_days < 0) from dur union all select 'estimate_outside_bounds', 'warning', count(*) filter (estimate_days < min_days or estimate_days > max_days) from dur""")
def duration_bounds_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1e."""
    c = F.col
    return Q.count_where(lifecycle.timed(spark, sf_dir), [("inverted_bounds", Q.CRITICAL, c("max_days") < c("min_days")), ("negative_duration", Q.CRITICAL, (c("min_days") < 0) | (c("max_days") < 0)), ("estimate_outside_bounds", Q.WARNING, (c("estimate_days") < c("min_days")) | (c("estimate_days") > c("max_days")))])


AUDIT = (
    ("quantity_not_positive", "critical", "l_quantity <= 0"), ("zero_price", "warning", "l_extendedprice = 0"), ("negative_price", "critical", "l_extendedprice < 0"), ("discount_out_of_range", "critical", "l_discount < 0 or l_discount > 1"),
    ("tax_out_of_range", "critical", "l_tax < 0 or l_tax > 1"), ("missing_ship_date", "warning", "l_shipdate is null"), ("large_discount", "info", "l_discount >= 0.1"), ("open_but_returned", "warning", "l_linestatus = 'O' and l_returnflag = 'R'"), ("unknown_flag", "critical", "l_returnflag not in ('A', 'N', 'R')"),
)


@query("sampled_audit", "with s as (" + " union all ".join(f"select '{n}' as \"check\", '{s}' as severity, l_orderkey, l_linenumber, row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey) as r, count(*) over () as count from lineitem where {c}" for n, s, c in AUDIT) + ') select "check", severity, count, l_orderkey, l_linenumber from s where r <= 5')
def sampled_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: value and meaning checks with the first five rows of each."""
    rows = table(spark, sf_dir, "lineitem")
    return Q.samples(rows, [(n, s, F.expr(c)) for n, s, c in AUDIT], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 5).select("check", "severity", "count", "l_orderkey", "l_linenumber")


@query("future_snapshots", "select 'future_snapshot' as \"check\", 'critical' as severity, count(*) filter (l_shipdate > o_orderdate + interval '121 days') as count from lineitem join orders on o_orderkey = l_orderkey")
def future_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No version of an item may be later than the run it is shown in."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    return Q.count_where(rows, [("future_snapshot", Q.CRITICAL, F.col("l_shipdate") > F.col("o_orderdate") + F.expr("interval 121 days"))])


@query("converted_years", "select year(o_orderdate) - case when o_orderkey % 2 = 0 then 621 else 0 end as stated, year(o_orderdate) - 621 as year, o_orderkey % 2 = 1 as converted, count(*) as n from orders group by all")
def converted_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the years are stated in the other calendar."""
    stated = F.year("o_orderdate") - F.when(F.col("o_orderkey") % 2 == 0, 621).otherwise(0)
    rows = table(spark, sf_dir, "orders").select(stated.alias("stated"), V.converted_year(stated).alias("y"))
    return rows.groupBy("stated", "y").agg(F.count("*").alias("n")).select("stated", "y.*", "n")


@query("snapshot_ages", "with s as (select o_orderkey, o_orderdate, max(l_shipdate) as seen from orders left join lineitem on l_orderkey = o_orderkey and l_shipdate <= o_orderdate + interval '30 days' group by all) select o_orderkey, round(date_diff('microsecond', seen, o_orderdate + interval '30 days') / 3.6e9, 4) as age_hours, coalesce(date_diff('microsecond', seen, o_orderdate + interval '30 days') / 3.6e9 > 72, true) as stale from s")
def snapshot_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's last shipment, seen thirty days after it."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    until = F.expr("o_orderdate + interval 30 days")
    last = o.join(l, "o_orderkey").where(F.col("l_shipdate") <= until).groupBy("o_orderkey").agg(F.max("l_shipdate").alias("at"))
    return o.join(last, "o_orderkey", "left").select("o_orderkey", V.snapshot_age(until, F.col("at")).alias("a")).select("o_orderkey", "a.*")


@query("prioritised_targets", f"with {OBS}, e as (select ad_id, min(run_id) as f, max(run_id) as l, max(price) - min(price) as moved from obs group by 1), t as (select ad_id, (0, 'new') as p from e where f > 19730 union all select ad_id, (1, 'missing') from e where l < 19750 union all select ad_id, (2, 'card_changed') from e where moved > 100 union all select distinct ad_id, (3, 'previous_failure') from obs where event_type = 'error' union all select ad_id, (4, 'refresh') from e), b as (select ad_id, min(p) as p from t group by 1) select ad_id, p[2] as tag, p[1]::integer as priority from b order by priority, ad_id limit 100")
def prioritised_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: all tags but the sample for quality control, which a hash draws."""
    obs = frames.observations(spark, sf_dir)
    ends = obs.groupBy("ad_id").agg(F.min("run_id").alias("f"), F.max("run_id").alias("l"), (F.max("price") - F.min("price")).alias("moved"))
    tagged = [("new", ends.where("f > 19730")), ("missing", ends.where("l < 19750")), ("card_changed", ends.where("moved > 100")), ("previous_failure", obs.where("event_type = 'error'")), ("refresh", ends)]
    return G.prioritised(tagged, "ad_id", 100)


@query("score_band_sample", f"with recursive {SCORE} select ad_id, score, floor(score * 10) / 10 as stratum from c qualify row_number() over (partition by floor(score * 10) order by ad_id) <= 25")
def score_band_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: up to 25 of each band of the evidence score."""
    return G.stratified(lifecycle.scored(spark, sf_dir).select("ad_id", "score"), F.floor(F.col("score") * 10) / 10, ["ad_id"])


@query("enrichment_as_of", "with l as (select l_orderkey, arg_max(l_extendedprice, (l_shipdate, l_linenumber, l_extendedprice)) as price from lineitem where l_shipdate <= timestamp '1998-06-30' group by 1) select count(*) as rows, count(price) as matched, round(100.0 * count(price) / count(*), 4) as matched_pct from orders left join l on l_orderkey = o_orderkey")
def enrichment_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped by an instant as the second source."""
    extra = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_extendedprice")
    return G.enriched(table(spark, sf_dir, "orders").select("o_orderkey"), extra, "o_orderkey", "l_shipdate", F.lit("1998-06-30").cast("timestamp_ntz"), ["l_extendedprice"])[1]


RATES = f"{WITH}, {RUN_EVENTS}, rem as (select run_id, count(*) filter (event_type = 'confirmed_removed') as removals from ev group by 1), kn as (select run_id, count(*) as known_active from panel group by 1), ck as (select {DAY} as run_id, count(*) as checks, count(*) filter (event_type = 'error') as failures from events group by 1), r as (select run_id, round(removals / known_active, 4) as a, round(failures / checks, 4) as b from rem join kn using (run_id) join ck using (run_id))"


@query("rate_alerts", f"{RATES} select run_id, 'unusually_high_removal_rate' as alert_type, 'warning' as severity, a as observed from r where a > 0.01 union all select run_id, 'detail_failure_rate_exceeded', 'warning', b from r where b > 0.2")
def rate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: with a lower share of removals than the default, which no small table reaches."""
    removals = run_events(spark, sf_dir).groupBy("run_id").agg(F.count_if(F.col("event_type") == "confirmed_removed").alias("removals"))
    known = frames.panel(spark, sf_dir).groupBy("run_id").agg(F.count("*").alias("known_active"))
    checks = table(spark, sf_dir, "events").groupBy(frames.run_of("ts").alias("run_id")).agg(F.count("*").alias("checks"), F.count_if(F.col("event_type") == "error").alias("failures"))
    return G.rate_alerts(removals.join(known, "run_id").join(checks, "run_id"), removal=0.01)


@query("evidence_medians", f"with recursive {SCORE} select status, misses, count(*) as ads, round(median(score), 4) as median_score from c join m using (ad_id) group by status, misses")
def evidence_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians by status and misses."""
    misses = lifecycle.states(spark, sf_dir).select("ad_id", "misses")
    return lifecycle.scored(spark, sf_dir).join(misses, "ad_id").groupBy("status", "misses").agg(F.count("*").alias("ads"), F.round(F.median("score"), 4).alias("median_score"))


DIMS = ("p_brand", "p_type", "l_returnflag", "l_linestatus", "o_orderpriority", "o_orderstatus", "c_mktsegment", "n_name", "size_band", "year")
WIDE = "wide as (select p_brand, p_type, l_returnflag, l_linestatus, o_orderpriority, nullif(o_orderstatus, 'P') as o_orderstatus, c_mktsegment, n_name, case when p_size < 10 then 'small' when p_size < 30 then 'middle' end as size_band, year(o_orderdate)::varchar as year from lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)"


@query("wide_composition", f"with {WIDE}, l as (" + " union all ".join(f"select '{d}' as dimension, {d} as value, count(*) as n from wide group by {d}" for d in DIMS) + "), t as (select dimension, sum(n) as total, sum(n) filter (value is not null) as known from l group by 1) select dimension, value, n, round(100.0 * n / known, 4) as share_known_pct, round(100.0 * n / total, 4) as share_total_pct, round(100.0 * known / total, 4) as coverage_pct from l join t using (dimension) where value is not null")
def wide_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: ten dimensions from one scan."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), F.year("o_orderdate").cast("string").alias("year"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "middle").alias("size_band"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))  # 25 rows at any size
    return R.composition(l.join(o, "l_orderkey").join(p, "l_partkey").join(c, "o_custkey").join(n, "n_nationkey"), list(DIMS))
