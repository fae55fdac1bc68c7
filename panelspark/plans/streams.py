"""Streaming operators run to the end over the event table (available-now trigger) and written where all executors see it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.plans.catalogue import query, table
from panelspark.plans.frames import RUNS, VALID_SHARE, runs
from panelspark.sources.work import cut, shared_folder
from panelspark.streaming import streams as T


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("run_id", F.unix_date(F.to_date("ts")).cast("long")).withColumnRenamed("user_id", "ad_id")


def _finish(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there; append mode leaves out windows that the watermark hasn't closed, so none is used here."""
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{folder}/out")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out")

    q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query("stream_daily_volume", "select date_trunc('day', ts)::timestamp as start, count(*) as n from events group by 1")
def stream_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finish(T.volume_by_window(_stream(spark, sf_dir)), "complete").select(F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("stream_distinct_cards", "select distinct user_id as ad_id, date_diff('day', date '1970-01-01', cast(ts as date)) as run_id from events")
def stream_distinct_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finish(T.distinct_cards(_stream(spark, sf_dir)).select("ad_id", "run_id"))


@query("stream_status", """with recursive d as (select distinct user_id as ad_id, date_diff('day', date '1970-01-01', cast(ts as date)) as run_id from events), closed as (select epoch_ms(max(ts)) - 240 * 60000 as mark from events),
panel as (select f.ad_id, r.run_id, d.run_id is not null as seen, row_number() over (partition by f.ad_id order by r.run_id) as k from (select ad_id, min(run_id) as first_run from d group by 1) f join (select unnest(generate_series((select min(run_id) from d), (select max(run_id) from d))) as run_id) r on r.run_id >= f.first_run left join d on d.ad_id = f.ad_id and d.run_id = r.run_id
  where (r.run_id + 1) * 86400000 <= (select mark from closed)),
fold as (select ad_id, k, run_id, 'new' as status, 0 as misses, 1 as seen_runs, 0 as missing_runs, true as told from panel where k = 1
  union all select p.ad_id, p.k, p.run_id, case when p.seen then case when f.status in ('missing_once', 'likely_removed') then 'reappeared' else 'active' end when f.status = 'likely_removed' or f.misses + 1 >= 2 then 'likely_removed' else 'missing_once' end,
    case when p.seen then 0 when f.status = 'likely_removed' then f.misses else f.misses + 1 end, f.seen_runs + p.seen::int, f.missing_runs + (not p.seen and f.status <> 'likely_removed')::int, p.seen or f.status <> 'likely_removed' from fold f join panel p on p.ad_id = f.ad_id and p.k = f.k + 1)
select ad_id, run_id, status, misses, seen_runs, missing_runs from fold where told""")
def stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings alone come in; absences follow from the runs that the watermark closes."""
    return _finish(T.status_by_key(_stream(spark, sf_dir).select("ad_id", "ts")))


@query("stream_baseline", f"with recursive {RUNS} select config, run_id, discovered_count as n, baseline_median, is_valid from runs")
def stream_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of runs as a stream, one row a run."""
    counted = cut(runs(spark, sf_dir).select("config", "run_id", F.col("discovered_count").alias("n")))
    folder = counted.inputFiles()[0].rsplit("/", 1)[0]
    return _finish(T.baseline_by_configuration(spark.readStream.schema(counted.schema).parquet(folder), share=VALID_SHARE))


@query("stream_changes", """with s as (select user_id as ad_id, ts, value, lag(value) over w as previous, row_number() over w as k from events window w as (partition by user_id order by ts))
select ad_id, ts as "at", previous, value, case when previous is null then 'revealed' when value is null then 'hidden' when value > previous then 'increase' else 'decrease' end as change_type from s where k > 1 and value is distinct from previous""")
def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a value against the key's previous sighting, over micro-batches."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = _stream(spark, sf_dir).select("ad_id", "ts", "value")
    T.change_batches(rows, f"{folder}/table", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/table/changes").drop("batch").withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("stream_upsert", "select user_id as ad_id, max(event_id) as event_id from events group by 1")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    T.upsert_batches(_stream(spark, sf_dir).select("ad_id", "event_id"), f"{folder}/table", ["ad_id"], "event_id", f"{folder}/state").awaitTermination()
    return T.read_upserted(spark, f"{folder}/table", ["ad_id"], "event_id")


@query("late_runs", """select event_id, ts > date_trunc('day', ts) + interval 18 hours as late from events""")
def late_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")).withColumn("slot", F.date_trunc("day", "ts"))
    fine, late = T.on_time_and_late(rows, grace_minutes=18 * 60)
    return fine.select("event_id", F.lit(False).alias("late")).unionByName(late.select("event_id", F.lit(True).alias("late")))
