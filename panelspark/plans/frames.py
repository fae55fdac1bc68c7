"""The supplied tables in the roles of the domain: a run is a day of `events`, an ad is a user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import panel as P
from panelspark.plans.catalogue import table

#: A run is valid if it has at least this share of the median count of the seven valid runs of its configuration before it; a
#: configuration lasts this many days.
VALID_SHARE, CONFIG_DAYS = 0.97, 20

OBS = """obs as (select ad_id, run_id, price, event_type, n_events, observed_at from (
  select user_id as ad_id, date_diff('day', date '1970-01-01', cast(ts as date)) as run_id, value as price, event_type, ts as observed_at,
    row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) as rn, count(*) over (partition by user_id, cast(ts as date)) as n_events
  from events) where rn = 1)"""
RUNS = f"""{OBS}, counted as (select run_id, count(*) as discovered_count from obs group by run_id),
numbered as (select *, run_id // {CONFIG_DAYS} as config, row_number() over (partition by run_id // {CONFIG_DAYS} order by run_id) as k from counted),
rfold as (select config, k, run_id, discovered_count, null::double as baseline_median, true as is_valid, [discovered_count] as last from numbered where k = 1
  union all select n.config, n.k, n.run_id, n.discovered_count, list_median(f.last), n.discovered_count >= {VALID_SHARE} * list_median(f.last),
    case when n.discovered_count >= {VALID_SHARE} * list_median(f.last) then list_append(f.last, n.discovered_count)[-7:] else f.last end
  from rfold f join numbered n on n.config = f.config and n.k = f.k + 1),
runs as (select run_id, config, discovered_count, baseline_median, is_valid from rfold)"""
PANEL = f"""{RUNS}, panel as (select f.ad_id, r.run_id, o.price, o.event_type, o.n_events, o.observed_at, o.ad_id is not null as was_seen
  from (select ad_id, min(run_id) as first_run from obs group by ad_id) f join runs r on r.run_id >= f.first_run left join obs o on o.ad_id = f.ad_id and o.run_id = r.run_id)"""


def run_of(ts: str):
    return F.unix_date(F.col(ts).cast("date")).cast("long")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ad_id, run_id, price, event_type, n_events, observed_at): the last event of each user and day."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("ad_id"), run_of("ts").alias("run_id"), F.col("value").alias("price"), "event_type", F.col("ts").alias("observed_at"), "event_id")
    last = rows.groupBy("ad_id", "run_id").agg(F.max_by(F.struct("price", "event_type", "observed_at"), F.struct("observed_at", "event_id")).alias("o"), F.count("*").alias("n_events"))
    return last.select("ad_id", "run_id", "o.price", "o.event_type", "n_events", "o.observed_at")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(config, run_id, discovered_count, baseline_median, is_valid): one row a run."""
    counted = observations(spark, sf_dir).groupBy("run_id").agg(F.count("*").alias("discovered_count"))
    return P.run_baseline(counted.withColumn("config", F.floor(F.col("run_id") / CONFIG_DAYS)), "run_id", "discovered_count", ["config"], share=VALID_SHARE)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_absences(observations(spark, sf_dir))
