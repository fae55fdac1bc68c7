"""Queries over observations, runs and as-of snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.functions import columns as C
from panelspark.operators import panel as P
from panelspark.plans import frames
from panelspark.plans.catalogue import query, table
from panelspark.plans.frames import OBS, PANEL, RUNS

INSTANT = "1998-06-30"


@query("as_of_latest", f"""select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice from (
  select *, row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, l_quantity desc) as rn
  from lineitem where l_shipdate <= timestamp '{INSTANT}') where rn = 1""")
def as_of_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    last = P.latest_as_of(rows, "l_orderkey", ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"], F.col("l_shipdate") <= F.lit(INSTANT).cast("timestamp"))
    return last.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")


@query("as_of_join_many", """select o_orderkey, o_orderdate, (select max(p.o_orderdate) from orders p where p.o_custkey = o.o_custkey and p.o_orderstatus = 'F' and p.o_orderdate <= o.o_orderdate) as last_final_date
from orders o""")
def as_of_join_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    left = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    right = orders.where("o_orderstatus = 'F'").select("o_custkey", "o_orderdate")
    out = P.as_of_join(left, right, "o_custkey", "o_orderdate", "o_orderdate", ["o_orderdate"])
    return out.select("o_orderkey", "o_orderdate", F.col("source_o_orderdate").alias("last_final_date"))


@query("select_run", f"with recursive {RUNS} select run_id, discovered_count from runs where is_valid and discovered_count > 0 order by run_id desc limit 1")
def select_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.runs(spark, sf_dir).where("is_valid and discovered_count > 0").orderBy(F.desc("run_id")).limit(1).select("run_id", "discovered_count")


@query("cross_section", f"""with recursive {RUNS}, sel as (select max(run_id) as run_id from runs where is_valid)
select o.ad_id, o.run_id, o.price, f.first_run, o.run_id - f.first_run as age_runs, o.price = 0 as is_zero,
  case when price < 10 then '<10' when price < 50 then '10-50' when price < 100 then '50-100' else '100+' end as price_band
from obs o join sel using (run_id) join (select ad_id, min(run_id) as first_run from obs group by ad_id) f using (ad_id)""")
def cross_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = frames.observations(spark, sf_dir)
    chosen = select_run(spark, sf_dir).first().run_id
    first = obs.groupBy("ad_id").agg(F.min("run_id").alias("first_run"))
    rows = obs.where(F.col("run_id") == chosen).join(first, "ad_id")
    return rows.select("ad_id", "run_id", "price", "first_run", (F.col("run_id") - F.col("first_run")).alias("age_runs"), (F.col("price") == 0).alias("is_zero"), C.band(F.col("price"), [float("-inf"), 10, 50, 100, float("inf")], ["<10", "10-50", "50-100", "100+"]).alias("price_band"))


@query("panel", f"""with recursive {PANEL}, roll as (select user_id as ad_id, date_diff('day', date '1970-01-01', cast(ts as date)) as run_id, string_agg(distinct event_type, ',' order by event_type) as event_types, count(*) as event_count from events group by all)
select p.ad_id, p.run_id, p.was_seen, case when r.is_valid then p.was_seen end as was_seen_trusted, p.price, e.event_types, coalesce(e.event_count, 0) as event_count
from panel p join runs r using (run_id) left join roll e on e.ad_id = p.ad_id and e.run_id = p.run_id""")
def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("ad_id"), frames.run_of("ts").alias("run_id"), "event_type", "value")
    roll = P.event_rollup(events, ["ad_id", "run_id"], "event_type", "value").select("ad_id", "run_id", "event_types", "event_count")
    rows = frames.panel(spark, sf_dir).join(F.broadcast(frames.runs(spark, sf_dir).select("run_id", "is_valid")), "run_id").join(roll, ["ad_id", "run_id"], "left")
    return rows.select("ad_id", "run_id", "was_seen", F.when(F.col("is_valid"), F.col("was_seen")).alias("was_seen_trusted"), "price", "event_types", F.coalesce("event_count", F.lit(0)).alias("event_count"))


KINDS = ("click", "error", "purchase", "signup", "view")


@query("event_pivot", "select user_id, " + ", ".join(f"count(*) filter (event_type = '{k}') as events_{k}" for k in KINDS) + ", count(*) as events_total from events group by user_id")
def event_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.event_counts(table(spark, sf_dir, "events"), "user_id", "event_type", list(KINDS))


@query("event_rollup", "select user_id, cast(ts as date) as day, string_agg(distinct event_type, ',' order by event_type) as event_types, count(*) as event_count, min(value) as previous_value, max(value) as new_value from events group by all")
def event_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.event_rollup(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), ["user_id", "day"], "event_type", "value")


@query("price_changes", f"""with {OBS}, c as (select ad_id, run_id, lag(price) over (partition by ad_id order by run_id) as previous, price as value from obs)
select ad_id, run_id, previous, value, round(value - previous, 4) as change, round(case when previous <> 0 then 100 * (value - previous) / previous end, 4) as change_pct,
  case when value > previous then 'increase' when value < previous then 'decrease' else 'none' end as direction from c where previous is not null""")
def price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.value_changes(frames.observations(spark, sf_dir), "ad_id", "run_id", "price")


@query("price_change_summary", f"""with {OBS}, c as (select ad_id, price - lag(price) over (partition by ad_id order by run_id) as d from obs),
a as (select ad_id, count(*) filter (d <> 0) as changes, count(*) filter (d < 0) as reductions from c group by ad_id)
select count(*) as ads, count(*) filter (changes > 0) as changed_ads, round(100.0 * count(*) filter (changes > 0) / count(*), 4) as changed_pct, round((select median(d) from c where d < 0), 4) as median_decrease, round(avg(changes), 4) as changes_per_ad, max(changes) as most_changes from a""")
def price_change_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("ad_id").orderBy("run_id")
    rows = frames.observations(spark, sf_dir).select("ad_id", (F.col("price") - F.lag("price").over(w)).alias("d"))
    ads = rows.groupBy("ad_id").agg(F.count_if(F.col("d") != 0).alias("changes")).agg(
        F.count("*").alias("ads"), F.count_if(F.col("changes") > 0).alias("changed_ads"), F.round(100.0 * F.count_if(F.col("changes") > 0) / F.count("*"), 4).alias("changed_pct"), F.round(F.avg("changes"), 4).alias("changes_per_ad"), F.max("changes").alias("most_changes"))
    middle = rows.where("d < 0").agg(F.round(F.median("d"), 4).alias("median_decrease"))
    one = F.lit(1)
    return ads.withColumn("k", one).join(middle.withColumn("k", one), "k").drop("k")


@query("shown_price_changes", f"""with recursive {PANEL}, c as (select ad_id, run_id, price as value, lag(price) over w as previous, row_number() over w as n from (select ad_id, run_id, case when event_type <> 'error' then price end as price from panel where was_seen) window w as (partition by ad_id order by run_id))
select ad_id, run_id, previous, value, case when previous is null and value is not null then 'revealed' when previous is not null and value is null then 'hidden' when value > previous then 'increase' else 'decrease' end as change_type
from c where n > 1 and ((previous is null) <> (value is null) or value <> previous)""")
def shown_price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price is hidden where the day's last event is an error."""
    rows = frames.panel(spark, sf_dir).withColumn("price", F.when(F.col("event_type") != "error", F.col("price")))
    return P.shown_changes(rows, "ad_id", "run_id", "price", "was_seen")


@query("observation_gaps", """select event_id, user_id, round(date_diff('microsecond', lag(ts) over (partition by user_id order by ts, event_id), ts) / 3.6e9, 4) as gap_hours from events qualify gap_hours is not null""")
def observation_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.select("event_id", "user_id", F.round((F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(w))) / 3.6e9, 4).alias("gap_hours")).where("gap_hours is not null")


@query("observation_gap_summary", """with g as (select round(date_diff('microsecond', lag(ts) over (partition by user_id order by ts), ts) / 3.6e9, 4) as h from events qualify h is not null)
select count(*) as gaps, round(median(h), 4) as median_hours, round(quantile_cont(h, 0.9), 4) as p90_hours, round(max(h), 4) as max_hours from g""")
def observation_gap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = P.gaps(table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts")), "user_id", "ts")
    return g.agg(F.count("*").alias("gaps"), F.round(F.median("gap_hours"), 4).alias("median_hours"), F.round(F.percentile("gap_hours", F.lit(0.9)), 4).alias("p90_hours"), F.round(F.max("gap_hours"), 4).alias("max_hours"))


@query("consecutive_misses", f"""with recursive {PANEL}, i as (select ad_id, run_id, was_seen, sum(was_seen::int) over (partition by ad_id order by run_id) as island from panel join runs using (run_id) where was_seen or is_valid)
select ad_id, run_id, was_seen, case when was_seen then 0 else sum((not was_seen)::int) over (partition by ad_id, island order by run_id) end::bigint as misses from i""")
def consecutive_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An absence in a run that isn't valid says nothing."""
    return P.consecutive_misses(frames.panel(spark, sf_dir).join(F.broadcast(frames.runs(spark, sf_dir).select("run_id", "is_valid")), "run_id").where("was_seen or is_valid"))


@query("content_versions", """with h as (select o_custkey, o_orderdate, o_orderkey, sha256('v' || o_orderstatus || chr(31) || 'v' || o_orderpriority) as content_hash from orders),
f as (select o_custkey, content_hash, min((o_orderdate, o_orderkey)) as t from h group by all)
select o_custkey, content_hash, t[1] as o_orderdate, t[2] as o_orderkey, row_number() over (partition by o_custkey order by t) as version from f""")
def content_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.content_versions(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], C.content_hash(F.col("o_orderstatus"), F.col("o_orderpriority")))


@query("trailing_errors", """with n as (select user_id, event_type = 'error' as gone, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events)
select user_id, coalesce(min(n) filter (not gone) - 1, count(*)) as unavailable_checks from n where n <= 10 group by user_id""")
def trailing_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.trailing_unavailable(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@query("run_baseline", f"with recursive {RUNS} select run_id, discovered_count, baseline_median, is_valid from runs")
def run_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.runs(spark, sf_dir).select("run_id", "discovered_count", "baseline_median", "is_valid")


@query("previous_valid_run", f"with recursive {RUNS} select run_id, (select max(p.run_id) from runs p where p.run_id < r.run_id and p.is_valid and p.config = r.config) as previous_valid_run from runs r")
def previous_valid_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the same configuration."""
    return P.previous_valid(frames.runs(spark, sf_dir), "run_id", "run_id", F.col("is_valid"), ["config"]).select("run_id", "previous_valid_run")


@query("leader_clusters", """with recursive e as (select user_id, ts, row_number() over (partition by user_id order by ts) as n from events),
c as (select user_id, n, ts as leader, ts from e where n = 1 union all select e.user_id, e.n, case when date_diff('microsecond', c.leader, e.ts) > 21600000000 then e.ts else c.leader end, e.ts from c join e on e.user_id = c.user_id and e.n = c.n + 1)
select user_id, leader, count(*) as n from c group by all""")
def leader_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.leader_clusters(table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts")), "user_id", "ts", 360).select("user_id", F.col("leader").cast("timestamp_ntz").alias("leader"), "n")


@query("compare_runs", f"""with {OBS}, s as (select ad_id, max((run_id = 19730)::int) as a, max((run_id = 19731)::int) as b from obs where run_id in (19730, 19731) group by ad_id)
select count(*) filter (a = 1 and b = 1) as both, count(*) filter (a = 1 and b = 0) as only_first, count(*) filter (a = 0 and b = 1) as only_second, count(*) filter (a <> b) = 0 as stable from s""")
def compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.compare_runs(frames.observations(spark, sf_dir), F.col("run_id") == 19730, F.col("run_id") == 19731)


@query("missing_and_new", f"""with {OBS} select ad_id, 'missing' as side from obs where run_id = 19730 and ad_id not in (select ad_id from obs where run_id = 19731)
union all select distinct ad_id, 'new' from obs o where run_id = 19731 and not exists (select 1 from obs p where p.ad_id = o.ad_id and p.run_id < 19731)""")
def missing_and_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = frames.observations(spark, sf_dir).select("ad_id", "run_id")
    today, before = obs.where("run_id = 19731").select("ad_id"), obs.where("run_id = 19730").select("ad_id")
    known = obs.where("run_id < 19731").select("ad_id").distinct()
    return before.join(today, "ad_id", "left_anti").withColumn("side", F.lit("missing")).unionByName(today.join(known, "ad_id", "left_anti").withColumn("side", F.lit("new")))


@query("orphan_checks", """select 'lineitem_without_order' as "check", count(*) as count from lineitem l where not exists (select 1 from orders where o_orderkey = l_orderkey)
union all select 'lineitem_without_part', count(*) from lineitem l where not exists (select 1 from part where p_partkey = l_partkey)
union all select 'orders_without_customer', count(*) from orders where not exists (select 1 from customer where c_custkey = o_custkey)
union all select 'label_without_document', count(*) from labels l where not exists (select 1 from documents d where d.doc_id = l.doc_id)""")
def orphan_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    out = P.orphans(t("lineitem"), t("orders"), {"l_orderkey": "o_orderkey"}, "lineitem_without_order")
    out = out.unionByName(P.orphans(t("lineitem"), t("part"), {"l_partkey": "p_partkey"}, "lineitem_without_part"))
    out = out.unionByName(P.orphans(t("orders"), t("customer"), {"o_custkey": "c_custkey"}, "orders_without_customer"))
    return out.unionByName(P.orphans(t("labels"), t("documents"), {"doc_id": "doc_id"}, "label_without_document"))


@query("stale_refresh", "select c_custkey from customer c where not exists (select 1 from orders where o_custkey = c_custkey and o_orderdate > timestamp '2000-06-01')")
def stale_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = table(spark, sf_dir, "orders").where("o_orderdate > timestamp_ntz'2000-06-01'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(fresh, "c_custkey", "left_anti")


@query("had_reduction", f"""with {OBS}, c as (select ad_id, price - lag(price) over (partition by ad_id order by run_id) as d from obs)
select ad_id, coalesce(bool_or(d < 0), false) as had_price_reduction from c group by ad_id""")
def had_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = frames.observations(spark, sf_dir)
    fell = P.value_changes(obs, "ad_id", "run_id", "price").where("direction = 'decrease'").select("ad_id").distinct().withColumn("fell", F.lit(True))
    return obs.select("ad_id").distinct().join(fell, "ad_id", "left").select("ad_id", F.coalesce("fell", F.lit(False)).alias("had_price_reduction"))


@query("run_timeline", f"with recursive {PANEL} select p.run_id, count(*) as observations, count(*) filter (was_seen) as seen, count(*) filter (not was_seen) as absent, any_value(r.is_valid) as is_valid from panel p join runs r using (run_id) group by p.run_id")
def run_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = frames.panel(spark, sf_dir).groupBy("run_id").agg(F.count("*").alias("observations"), F.count_if("was_seen").alias("seen"), F.count_if(~F.col("was_seen")).alias("absent"))
    return counts.join(frames.runs(spark, sf_dir).select("run_id", "is_valid"), "run_id")


@query("daily_inventory", f"with recursive {RUNS} select run_id, discovered_count from runs where is_valid order by run_id desc limit 10")
def daily_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.runs(spark, sf_dir).where("is_valid").orderBy(F.desc("run_id")).limit(10).select("run_id", "discovered_count")


@query("cohorts", f"""with {OBS}, a as (select ad_id, min(run_id) as first_run, max(run_id) as last_run, min(observed_at) as t0 from obs group by ad_id)
select cast(isoyear(t0) as integer) as iso_year, cast(weekofyear(t0) as integer) as iso_week, count(*) as ads, """ + ", ".join(f"round(100.0 * avg((last_run - first_run >= {d})::int), 4) as active_{d}d_pct" for d in (1, 3, 7, 14, 30)) + " from a group by all")
def cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = frames.observations(spark, sf_dir).groupBy("ad_id").agg(F.min("run_id").alias("f"), F.max("run_id").alias("l"), F.min("observed_at").alias("at"))
    shares = [F.round(100.0 * F.avg((F.col("l") - F.col("f") >= d).cast("int")), 4).alias(f"active_{d}d_pct") for d in (1, 3, 7, 14, 30)]
    return ads.groupBy(F.extract(F.lit("YEAROFWEEK"), "at").alias("iso_year"), F.weekofyear("at").alias("iso_week")).agg(F.count("*").alias("ads"), *shares)


@query("daily_dataset", """select o.o_orderkey, o.o_custkey, c.c_mktsegment, l.l_linenumber, l.l_extendedprice from orders o join customer c on c.c_custkey = o.o_custkey
left join (select *, row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) as rn from lineitem) l on l.l_orderkey = o.o_orderkey and l.rn = 1
where o.o_orderdate between timestamp '1997-03-01' and timestamp '1997-03-31'""")
def daily_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderdate between timestamp_ntz'1997-03-01' and timestamp_ntz'1997-03-31'").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    last = P.latest_as_of(lines, "l_orderkey", ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).withColumnRenamed("l_orderkey", "o_orderkey")
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return orders.join(people, "o_custkey").join(last, "o_orderkey", "left").select("o_orderkey", "o_custkey", "c_mktsegment", "l_linenumber", "l_extendedprice")


@query("first_occurrence", """with a as (select *, row_number() over (partition by event_id order by ts) as r1 from events), b as (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as r2 from a where r1 = 1)
select event_id, user_id, event_type from b where r2 = 1""")
def first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("pair", F.concat_ws("|", "user_id", "event_type"))
    return P.first_occurrence(rows, ["event_id", "pair"], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("keyed_upsert", """select o_custkey, o_orderkey, o_orderdate, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderkey desc) as rn from orders) where rn = 1""")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    old, new = rows.where("o_orderdate < timestamp_ntz'1998-01-01'"), rows.where("o_orderdate >= timestamp_ntz'1998-01-01'")
    return P.upsert(old, new, ["o_custkey"], "o_orderkey")


@query("non_null_upsert", """select o_custkey, arg_max(o_orderstatus, o_orderkey) filter (o_orderstatus <> 'P') as status, arg_max(o_totalprice, o_orderkey) filter (o_totalprice > 100000) as price, count(*) as sightings from orders group by o_custkey""")
def non_null_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"))
    return P.upsert_non_null(rows, "o_custkey", ["status", "price"], "o_orderkey")


@query("entity_rollup", """with r as (select *, o_totalprice is distinct from lag(o_totalprice) over w and lag(o_totalprice) over w is not null as changed from (select c_nationkey, o_custkey, o_orderdate, o_orderkey, o_totalprice, o_orderstatus from orders join customer on c_custkey = o_custkey) window w as (partition by o_custkey order by o_orderkey))
select c_nationkey, count(distinct o_custkey) as listings, min(o_orderkey) as first_seen, max(o_orderkey) as last_seen, min(o_totalprice) as value_min, max(o_totalprice) as value_max, sum(changed::int)::bigint as value_changes, arg_max(o_orderstatus, o_orderkey) as last_status from r group by c_nationkey""")
def entity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus").join(people, "o_custkey")
    return P.entity_rollup(rows, "c_nationkey", "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")


@query("chain_deltas", """with r as (select c_nationkey, o_custkey, o_orderkey, o_totalprice from orders join customer on c_custkey = o_custkey)
select c_nationkey, count(distinct o_custkey) as listings, arg_min(o_custkey, o_orderkey) as first_listing, arg_max(o_custkey, o_orderkey) as last_listing, round(arg_max(o_totalprice, o_orderkey) - arg_min(o_totalprice, o_orderkey), 4) as value_delta from r group by c_nationkey having count(distinct o_custkey) > 1""")
def chain_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice").join(people, "o_custkey")
    return P.chain_deltas(rows, "c_nationkey", "o_custkey", "o_orderkey", "o_totalprice")
