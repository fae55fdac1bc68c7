"""Report queries: volumes, outcomes, dictionaries, warnings, sets, sources and page records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import columns as C
from panelspark.operators import features as X
from panelspark.operators import lifecycle as L
from panelspark.operators import pages as G
from panelspark.operators import quality as Q
from panelspark.operators import stats as S
from panelspark.plans import frames
from panelspark.plans.catalogue import query, table
from panelspark.plans.frames import RUNS
from panelspark.sources import io


@query("publication_volume", "select date_trunc('day', o_orderdate)::timestamp as day, count(*) as n from orders group by 1")
def publication_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("n"))


DELAYS = "d as (select o_orderkey, date_diff('day', o_orderdate, (select min(l_shipdate) from lineitem where l_orderkey = o_orderkey))::double as delay from orders)"


def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("seen"))
    return table(spark, sf_dir, "orders").join(first, "o_orderkey", "left").select("o_orderkey", F.datediff("seen", "o_orderdate").cast("double").alias("delay"))


@query("entry_delay_summary", f"with {DELAYS} select count(*) as rows, count(delay) as known, round(median(delay), 4) as median_days, round(quantile_cont(delay, 0.9), 4) as p90_days, max(delay) as max_days from d")
def entry_delay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delays(spark, sf_dir).agg(F.count("*").alias("rows"), F.count("delay").alias("known"), F.round(F.median("delay"), 4).alias("median_days"), F.round(F.percentile("delay", F.lit(0.9)), 4).alias("p90_days"), F.max("delay").alias("max_days"))


@query("entry_delay_bands", f"with {DELAYS} select case when delay <= 1 then '<=1d' when delay <= 7 then '1-7d' when delay <= 30 then '7-30d' else '>30d' end as band, count(*) as n from d where delay is not null group by 1")
def entry_delay_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = C.band(F.col("delay"), [float("-inf"), 1, 7, 30, float("inf")], ["<=1d", "1-7d", "7-30d", ">30d"], right=True)
    return delays(spark, sf_dir).where("delay is not null").groupBy(band.alias("band")).agg(F.count("*").alias("n"))


@query("duration_gate", "select count(*) as eligible, count(*) filter (o_orderstatus = 'F') as events, case when count(*) >= 30 and count(*) filter (o_orderstatus = 'F') >= 1 then 'feasible' else 'not_feasible' end as verdict from orders where o_orderpriority = '1-URGENT'")
def duration_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").agg(F.count("*").alias("eligible"), F.count_if(F.col("o_orderstatus") == "F").alias("events"))
    return one.withColumn("verdict", F.when((F.col("eligible") >= 30) & (F.col("events") >= 1), "feasible").otherwise("not_feasible"))


@query("market_durations", """with s as (select l_orderkey, max(l_shipdate) as seen from lineitem group by 1) select o_orderkey, case when o_orderpriority < '3' then round(greatest(coalesce(epoch(seen), epoch(o_orderdate)) - epoch(o_orderdate), 0) / 86400, 4) end as market_min_days,
  case when o_orderpriority < '3' and o_orderstatus = 'F' and seen is not null then round(greatest(epoch(seen) + 864000 - epoch(o_orderdate), greatest(epoch(seen) - epoch(o_orderdate), 0)) / 86400, 4) end as market_max_days, case when o_orderpriority < '3' and o_orderstatus = 'F' and seen is not null then round(greatest((2 * epoch(seen) + 864000) / 2 - epoch(o_orderdate), 0) / 86400, 4) end as market_estimate_days
from orders left join s on l_orderkey = o_orderkey""")
def market_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("seen"))
    e = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    rows = table(spark, sf_dir, "orders").join(last, "o_orderkey", "left").select("o_orderkey", e("o_orderdate").alias("p"), e("seen").alias("l"), F.when(F.col("o_orderstatus") == "F", e("seen") + 864000).alias("m"), (F.col("o_orderpriority") < "3").alias("ok"))
    return L.market_durations(rows, "p", "l", "m", "ok").select("o_orderkey", "market_min_days", "market_max_days", "market_estimate_days")


@query("detail_outcomes", "select cast(ts as date) as day, count(*) as checks, count(*) filter (event_type <> 'error') as completed, round(count(*) filter (event_type <> 'error') / count(*), 4) as coverage from events group by 1")
def detail_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fine = F.count_if(F.col("event_type") != "error")
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("checks"), fine.alias("completed"), F.round(fine / F.count("*"), 4).alias("coverage"))


@query("error_counts", "select event_type, count(*) as n, count(distinct user_id) as users from events group by event_type")
def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("dictionary", " union all ".join(f"select '{c}' as \"column\", '{t}' as type, count(*) - count({c}) as nulls, count(distinct {c}) as \"distinct\", min({c}::varchar) as example from orders" for c, t in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderpriority", "string"))))
def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column dictionary of a table."""
    from panelspark.operators.profile import long_form

    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    rows = table(spark, sf_dir, "orders")
    types = dict(rows.dtypes)
    got = long_form(rows, columns, kind="string").groupBy(F.col("variable").alias("column")).agg(F.count_if(F.col("value").isNull()).alias("nulls"), F.count_distinct("value").alias("distinct"), F.min("value").alias("example"))
    named = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    return got.select("column", F.element_at(named, F.col("column")).alias("type"), "nulls", "distinct", "example")


@query("limitation_warnings", """with m as (select count(*) as rows, count(*) filter (quality is not null) as labelled, count(distinct lang) as langs from documents left join labels using (doc_id))
select 'few_labels' as warning, labelled / rows < 0.9 as raised from m union all select 'few_languages', langs < 7 from m union all select 'no_rows', rows = 0 from m""")
def limitation_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over one row of aggregates."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    m = rows.agg(F.count("*").alias("rows"), F.count("quality").alias("labelled"), F.count_distinct("lang").alias("langs"))
    rules = [("few_labels", F.col("labelled") / F.col("rows") < 0.9), ("few_languages", F.col("langs") < 7), ("no_rows", F.col("rows") == 0)]
    return m.select(F.explode(F.array(*[F.struct(F.lit(n).alias("warning"), c.alias("raised")) for n, c in rules])).alias("r")).select("r.*")


@query("price_steps", "select format('{:d}-{:d}', (floor(o_totalprice / 25000) * 25000)::bigint, ((floor(o_totalprice / 25000) + 1) * 25000)::bigint) as step, count(*) as n from orders group by 1")
def price_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(C.step_bucket(F.col("o_totalprice"), 25000).alias("step")).agg(F.count("*").alias("n"))


@query("coalesced_sources", """select o_orderkey, coalesce(case when o_orderkey % 3 = 0 then o_totalprice end, case when o_orderkey % 2 = 0 then o_totalprice / 2 end) as price, case when o_orderkey % 3 = 0 then 'detail' when o_orderkey % 2 = 0 then 'card' end as price_source, round(log10(nullif(o_totalprice, 0)), 6) as log_price from orders""")
def coalesced_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2, P4."""
    rows = table(spark, sf_dir, "orders").withColumns({"a": F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")), "b": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice") / 2)})
    return rows.select("o_orderkey", *C.coalesce_with_source([("a", "detail"), ("b", "card")], "price"), F.round(C.guarded_log10(F.col("o_totalprice")), 6).alias("log_price"))


@query("set_operations", """select 'both' as side, count(*) as n from (select c_custkey from customer where c_acctbal > 0 intersect select o_custkey from orders) union all select 'only_first', count(*) from (select c_custkey from customer where c_acctbal > 0 except select o_custkey from orders)""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1, U2."""
    a = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    b = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    n = lambda df, side: df.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
    return reduce(DataFrame.unionByName, [n(a.intersect(b), "both"), n(a.join(b, "c_custkey", "left_anti"), "only_first")])


@query("work_queue", "select o_orderkey, o_orderdate from orders where o_orderstatus <> 'F' and o_orderkey % 4 < 3 order by o_orderkey % 4, o_orderdate, o_orderkey limit 100")
def work_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open items with attempts left, fewest attempts first, limited."""
    rows = table(spark, sf_dir, "orders").withColumn("attempts", F.col("o_orderkey") % 4)
    return rows.where("o_orderstatus <> 'F' and attempts < 3").orderBy("attempts", "o_orderdate", "o_orderkey").limit(100).select("o_orderkey", "o_orderdate")


@query("url_bounds", r"""with q as (select page_id, nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '')::bigint as page from pages) select page_id, page, page is null as unparsed from q""")
def url_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bound from the query string, and whether it is missing."""
    page = F.regexp_extract(F.try_parse_url("url", F.lit("QUERY"), F.lit("page")), r"^(\d+)", 1).try_cast("long")
    return table(spark, sf_dir, "pages").select("page_id", page.alias("page"), page.isNull().alias("unparsed"))


@query("slot_labels", "select event_id, strftime(ts, '%Y-%m-%d %H:%M') as utc, strftime(ts + interval '3 hours 30 minutes', '%Y-%m-%d %H:%M') as local from events")
def slot_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels in a zone that is 3:30 ahead all year."""
    return table(spark, sf_dir, "events").select("event_id", C.labels(F.col("ts").cast("timestamp"), "Asia/Tehran").alias("l")).select("event_id", "l.*")


@query("publication_gate", f"""with recursive {RUNS}, c as (select date_diff('day', date '1970-01-01', cast(ts as date)) as run_id, count(*) as accounted, count(*) filter (event_type = 'error') as retryable, count(*) + (day(cast(ts as date)) % 2) as discovered_count, count(*) filter (value > 300) as refused, min(ts) as started from events group by 1, cast(ts as date)),
g as (select run_id, is_valid as run_status_valid, accounted >= c.discovered_count as all_checked, accounted = c.discovered_count as accounted_equals_discovered, retryable = 0 as no_retryable, run_id > (select min(run_id) from runs) as compared, retryable * 5 < accounted as verified_end, hour(started) < 1 as production, refused = 0 as not_blocked from c join runs r using (run_id))
select *, run_status_valid and all_checked and accounted_equals_discovered and no_retryable and compared and verified_end and production and not_blocked as publishable from g""")
def publication_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day is a run; errors are checks to retry, high values refusals; the first run has nothing to compare with."""
    events = table(spark, sf_dir, "events").select(frames.run_of("ts").alias("run_id"), "ts", "value", F.when(F.col("event_type") == "error", "retryable").otherwise("done").alias("outcome"))
    bad = F.count_if(F.col("outcome") == "retryable")
    days = events.groupBy("run_id").agg((F.count("*") + F.day(F.min("ts")) % 2).alias("discovered_count"), (bad * 5 < F.count("*")).alias("verified_end"), (F.hour(F.min("ts")) < 1).alias("production"), (F.count_if(F.col("value") > 300) > 0).alias("blocked"))
    runs = frames.runs(spark, sf_dir).select("run_id", F.when(F.col("is_valid"), "valid").otherwise("invalid").alias("status"))
    first = runs.agg(F.min("run_id").alias("first_run"))
    whole = days.join(runs, "run_id").crossJoin(F.broadcast(first)).withColumn("comparison_applied", F.col("run_id") > F.col("first_run")).drop("first_run")
    return Q.snapshot_gate(whole, events.select("run_id", "outcome"))


@query("import_counts", "select count(*) filter (not old) as inserted, count(*) filter (old) as present, (select count(*) from lineitem) - count(*) as skipped from (select distinct l_orderkey, l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F') as old from lineitem)")
def import_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5."""
    source = table(spark, sf_dir, "lineitem").select("l_orderkey")
    present = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return io.import_new(source, present, "l_orderkey")[1]


@query("stamped_rows", "select 7 as run_id, o_orderstatus as source_config_hash, 'abc' as config_hash, o_orderkey from orders")
def stamped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column named like a stamp is kept under source_."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("config_hash"), "o_orderkey")
    return io.stamp(rows, {"run_id": F.lit(7), "config_hash": F.lit("abc")})


@query("latest_valid_run", "select max(o_orderkey) as run_id from orders where o_orderstatus = 'F' and o_orderdate = (select max(o_orderdate) from orders where o_orderstatus = 'F')")
def latest_valid_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "valid").otherwise("invalid").alias("status"), F.lit(False).alias("synthetic"), F.struct("o_orderdate", "o_orderkey").alias("finished_at"), F.struct("o_orderdate", "o_orderkey").alias("started_at"))
    return io.latest_valid(rows)


@query("table_hashes")
def table_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and an order-free content hash of each table."""
    names = ("orders", "lineitem", "customer", "documents", "pages")
    return reduce(DataFrame.unionByName, [io.content_hash(table(spark, sf_dir, n)).select(F.lit(n).alias("table"), "rows", "content_hash") for n in names])


@query("page_records", r"select page_id, nullif(regexp_extract(html, '<html lang=\"([^\"]*)\"', 1), '') as lang, len(regexp_extract_all(html, '<script')) as scripts, len(regexp_extract_all(html, '<a [^>]*href=\"[^\"]+\"')) as links from pages")
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.extract(table(spark, sf_dir, "pages"), "page_id", "html").select("page_id", "lang", "scripts", "links")


@query("feature_discovery", """with e as (select o_orderkey::varchar as k, o_orderstatus as deep_status, o_totalprice::varchar as obs_price, case when o_orderkey % 100 = 0 then 'x' end as spec_rare, (o_orderkey % 2)::varchar as events_flag, 'c' as snap_constant from orders),
l as (select unnest(['k', 'deep_status', 'obs_price', 'spec_rare', 'events_flag', 'snap_constant']) as feature, unnest([k, deep_status, obs_price, spec_rare, events_flag, snap_constant]) as value from e),
s as (select feature, count(value) as filled, count(*) as n, count(distinct value) as levels, count(try_cast(value as double)) as numbers, count(*) filter (lower(value) in ('true', 'false', 'yes', 'no', '0', '1')) as flags from l group by feature),
t as (select *, case when filled = 0 then 'empty' when flags = filled then 'boolean' when numbers >= 0.95 * filled then 'numeric' when levels <= 30 then 'categorical' else 'text' end as kind from s)
select feature, kind, case when feature like 'spec\\_%' escape '\\' then 'trim' when feature like 'deep%' or feature like 'snap%' then 'vehicle' when feature like 'obs%' or feature like 'events%' then 'listing' else 'unknown' end as grain, round(filled / n, 4) as coverage, levels,
  filled > 0 and filled / n >= 0.05 and levels > 1 and kind <> 'text' as usable, case when filled = 0 then 'all_null' when filled / n < 0.05 then 'low_coverage' when levels <= 1 then 'constant' when kind = 'text' then 'too_many_levels' end as reason from t""".replace("\\\\", "\\"))
def feature_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), F.col("o_orderstatus").alias("deep_status"), F.col("o_totalprice").alias("obs_price"), F.when(k % 100 == 0, "x").alias("spec_rare"), (k % 2).alias("events_flag"), F.lit("c").alias("snap_constant"))
    return X.discover(rows, rows.columns)


@query("feature_comparison", """with n as (select 'o_totalprice' as feature, o_orderpriority as "group", count(*) as n, round(median(o_totalprice), 4) as median from orders group by all), c as (select o_orderpriority as g, o_orderstatus as v, count(*) as c from orders group by all),
m as (select *, sum(c) over (partition by g) as n, row_number() over (partition by g order by c desc, v) as r from c)
select feature, "group", n, median, null::varchar as mode, null::double as mode_share from n union all select 'o_orderstatus', g, n::bigint, null, v, round(c / n, 4) from m where r = 1""")
def feature_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.compare_groups(table(spark, sf_dir, "orders"), "o_orderpriority", ["o_totalprice"], ["o_orderstatus"])


@query("seeded_sample")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: the same thousand orders every time; a sampling operator."""
    return S.deterministic_sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 1000)


@query("truncation_summary", f"with {DELAYS} select count(*) as rows, count(*) filter (coalesce(delay > 30, true)) as left_truncated, count(*) filter (delay <= 30) as eligible, round(100.0 * count(*) filter (delay <= 30) / count(*), 4) as eligible_pct from d")
def truncation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count_if(F.col("delay") <= 30)
    return delays(spark, sf_dir).agg(F.count("*").alias("rows"), F.count_if(F.coalesce(F.col("delay") > 30, F.lit(True))).alias("left_truncated"), n.alias("eligible"), F.round(100.0 * n / F.count("*"), 4).alias("eligible_pct"))


@query("price_history", """select o_custkey as series, min(o_orderdate) as first_day, max(o_orderdate) as last_day, count(*) as points, round(arg_max(o_totalprice, o_orderkey) - arg_min(o_totalprice, o_orderkey), 4) as change from orders group by o_custkey""")
def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series bounds and change over their points."""
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("series")).agg(F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"), F.count("*").alias("points"), F.round(F.max_by("o_totalprice", "o_orderkey") - F.min_by("o_totalprice", "o_orderkey"), 4).alias("change"))


@query("price_tree", """select 'brand' as level, p_brand as path, count(*) as n from part group by p_brand union all select 'model', p_brand || '/' || p_type, count(*) from part group by p_brand, p_type union all select 'trim', p_brand || '/' || p_type || '/' || p_size, count(*) from part group by p_brand, p_type, p_size""")
def price_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path rows of a three-level hierarchy, in one scan."""
    rows = table(spark, sf_dir, "part").select(F.explode(F.array(F.struct(F.lit("brand").alias("level"), F.col("p_brand").alias("path")), F.struct(F.lit("model").alias("level"), F.concat_ws("/", "p_brand", "p_type").alias("path")), F.struct(F.lit("trim").alias("level"), F.concat_ws("/", "p_brand", "p_type", "p_size").alias("path")))).alias("r"))
    return rows.groupBy("r.level", "r.path").agg(F.count("*").alias("n"))
