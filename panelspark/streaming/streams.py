"""The discrete-run ideas as Structured Streaming: late runs, status by key, idempotent replay, windows."""

from __future__ import annotations

import statistics
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from panelspark.operators.lifecycle import compare_run
from panelspark.operators.panel import shown_changes

OUT = "ad_id long, run_id long, status string, misses int, seen_runs int, missing_runs int"
OUT_NAMES = ["ad_id", "run_id", "status", "misses", "seen_runs", "missing_runs"]
TERMINAL = ("likely_removed", "likely_sold", "reposted")


def on_time_and_late(events: DataFrame, slot: str = "slot", at: str = "ts", grace_minutes: int = 240) -> tuple[DataFrame, DataFrame]:
    """Rows within their slot and grace, and late ones for a side table: recorded as missed, never made up."""
    late = F.unix_micros(F.col(at)) - F.unix_micros(F.col(slot)) > grace_minutes * 60_000_000
    return events.where(~late), events.where(late).withColumn("missed", F.lit(True))


def volume_by_window(events: DataFrame, at: str = "ts", every: str = "1 day", watermark: str = "240 minutes", keys: list[str] | None = None) -> DataFrame:
    """Counts by tumbling window with a watermark."""
    w = events.withWatermark(at, watermark).groupBy(F.window(at, every), *(keys or [])).agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").alias("start"), *(keys or []), "n")


def sliding_volume(events: DataFrame, at: str = "ts", length: str = "7 days", every: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """Counts and mean value over a sliding window."""
    w = events.withWatermark(at, watermark).groupBy(F.window(at, length, every)).agg(F.count("*").alias("n"), F.avg("value").alias("mean_value"))
    return w.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", "mean_value")


def distinct_cards(events: DataFrame, at: str = "ts", keys: tuple[str, ...] = ("run_id", "ad_id"), watermark: str = "1 day") -> DataFrame:
    """T5: one card a run and key inside the watermark."""
    return events.withWatermark(at, watermark).dropDuplicatesWithinWatermark(list(keys))


def presence_episodes(events: DataFrame, key: str = "ad_id", at: str = "ts", gap: str = "2 days", watermark: str = "1 day") -> DataFrame:
    """Presence of a key as sessions that end after a gap."""
    w = events.withWatermark(at, watermark).groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("sightings"))
    return w.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "sightings")


DAY_MS = 86_400_000


class StatusProcessor(StatefulProcessor):
    """The status machine of one key. Sightings wait in the state until the watermark passes the end of their run; an event-time timer at
    the end of the next run to be judged then takes all closed runs in order, those without a sighting as absences.

    A sighting of a run already judged is late and changes nothing, so a replay is harmless. A terminal status keeps its state, no absence is counted on it, and
    it needs no timer until the key is seen again.
    """

    KEPT = "status string, misses int, seen_runs int, missing_runs int, next_run long, waiting array<long>"

    def __init__(self, confirm: int = 2) -> None:
        self.confirm = confirm

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("status", self.KEPT)

    def _load(self) -> tuple[str | None, int, int, int, int, list[int]]:
        if not self.state.exists():
            return None, 0, 0, 0, -1, []
        status, misses, seen, missing, following, waiting = self.state.get()
        return status, misses, seen, missing, following, list(waiting or [])

    def _judge(self, key: tuple, kept: tuple, watermark: int) -> list[tuple]:
        """Takes every run that has ended by the watermark, keeps what is left, and sets the next timer."""
        (status, misses, seen, missing, run, waiting), out = kept, []
        waiting = sorted(waiting)
        while waiting or (status is not None and status not in TERMINAL):
            if status is None or status in TERMINAL:
                run = max(run, waiting[0]) if waiting else run
            if (run + 1) * DAY_MS > watermark:
                break
            if waiting and waiting[0] == run:
                waiting.pop(0)
                status = "new" if status is None else "reappeared" if status == "missing_once" or status in TERMINAL else "active"
                misses, seen = 0, seen + 1
            else:
                misses, missing = misses + 1, missing + 1
                status = "likely_removed" if misses >= self.confirm else "missing_once"
            out.append((key[0], run, status, misses, seen, missing))
            run += 1
        self.state.update((status, misses, seen, missing, run, waiting))
        if waiting or (status is not None and status not in TERMINAL):
            following = run if status is not None and status not in TERMINAL else waiting[0]
            self.handle.registerTimer(max((following + 1) * DAY_MS, watermark + 1))
        return out

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        kept = self._load()
        seen = {int(r) for frame in rows for r in frame["run_id"] if r >= kept[4]}
        out = self._judge(key, (*kept[:5], sorted(seen.union(kept[5]))), timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame(out, columns=OUT_NAMES)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame(self._judge(key, self._load(), timerValues.getCurrentWatermarkInMs()), columns=OUT_NAMES)

    def close(self) -> None:
        pass


def with_state(rows: DataFrame, keys: list[str], processor: StatefulProcessor, output: str, time_mode: str) -> DataFrame:
    """A stateful processor over a stream; its state is kept by RocksDB, which the session is told here."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return rows.groupBy(*keys).transformWithStateInPandas(processor, output, "append", time_mode)


def status_by_key(sightings: DataFrame, key: str = "ad_id", at: str = "ts", watermark: str = "240 minutes", confirm: int = 2) -> DataFrame:
    """(ad_id, run_id, status, misses, seen_runs, missing_runs) of each key and closed run from sightings alone. A run is a day, UTC; it
    is closed when the watermark passes its end, so each day counts as a valid run."""
    rows = sightings.withWatermark(at, watermark).select(F.col(key).cast("long").alias("ad_id"), F.unix_date(F.to_date(at)).cast("long").alias("run_id"), F.col(at))
    return with_state(rows.where("ad_id is not null and run_id is not null"), ["ad_id"], StatusProcessor(confirm), OUT, "EventTime")


class BaselineProcessor(StatefulProcessor):
    """Of one configuration the counts of its last valid runs, as a ring; a run is valid with at least a share of their median."""

    def __init__(self, share: float, length: int) -> None:
        self.share, self.length = share, length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("counts", "counts array<long>, last_run long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        counts, last = self.state.get() if self.state.exists() else ([], None)
        counts, out = list(counts or []), []
        for run, n in sorted({(int(r), int(n)) for frame in rows for r, n in zip(frame["run_id"], frame["n"], strict=True)}):
            if last is not None and run <= last:
                continue
            last, median = run, statistics.median(counts) if counts else None
            valid = median is None or n >= self.share * median
            counts = [*counts, n][-self.length :] if valid else counts
            out.append((key[0], run, n, None if median is None else float(median), valid))
        self.state.update((counts, last))
        yield pd.DataFrame(out, columns=["config", "run_id", "n", "baseline_median", "is_valid"])

    def close(self) -> None:
        pass


def baseline_by_configuration(runs: DataFrame, config: str = "config", run: str = "run_id", count: str = "n", share: float = 0.97, length: int = 7) -> DataFrame:
    """Each run's baseline, the median of the last valid runs of its configuration before it, and whether it is valid.

    Runs of a configuration come in order over the batches; a run at or before the last one taken changes nothing.
    """
    rows = runs.select(F.col(config).cast("long").alias("config"), F.col(run).cast("long").alias("run_id"), F.col(count).cast("long").alias("n"))
    return with_state(rows, ["config"], BaselineProcessor(share, length), "config long, run_id long, n long, baseline_median double, is_valid boolean", "None")


def upsert_batches(stream: DataFrame, path: str, keys: list[str], version: str, checkpoint: str):
    """Keeps a keyed table current: each micro-batch is one version folder of the table, and reading takes the last row a key.

    A replayed batch overwrites its own folder, so it counts once. Returns the started query, which ends when the source has
    no more data.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        best = batch.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), F.col(version)).alias("r")).select("r.*")
        best.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_upserted(spark, path: str, keys: list[str], version: str) -> DataFrame:
    """The last row of each key over all batches."""
    rows = spark.read.parquet(path).drop("batch")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), F.col(version)).alias("r")).select("r.*")


VERSIONS = "version int, last_run long"


def _state(spark, path: str, schema: str) -> tuple[DataFrame, int, int]:
    """(rows, version, last run applied) of the last whole state under a path; no rows and -1 before the first."""
    done = spark.read.schema(VERSIONS).json(f"{path}/versions") if _there(spark, f"{path}/versions") else spark.createDataFrame([], VERSIONS)
    last = done.orderBy(F.desc("version")).first()
    if last is None:
        return spark.createDataFrame([], schema), -1, -1
    return spark.read.schema(schema).parquet(f"{path}/state-{last.version}"), last.version, last.last_run


def _name(spark, path: str, version: int, last_run: int) -> None:
    """From now on this version is the state."""
    spark.createDataFrame([(version, last_run)], VERSIONS).write.mode("append").json(f"{path}/versions")


def _there(spark, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


STATUS_STATE = "ad_id long, status string, misses int, seen_runs int, missing_runs int, first_seen long, last_seen long, first_missing long, confirmed_removed long, reappeared long"


def fold_runs(cards: DataFrame, path: str, checkpoint: str, key: str = "ad_id", run: str = "run_id", confirm: int = 2):
    """The status of every key kept current under a path, a run comparison in the JVM for each run of a micro-batch.

    cards has the keys seen in each run; all runs count as valid. Each batch writes one whole new state and then names it, so a
    batch that is played again after a failure starts from the state before it. Runs at or before the last one applied change nothing.
    Returns the started query.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state, version, last = _state(spark, path, STATUS_STATE)
        if batch_id <= version:
            return
        rows = batch.select(F.col(key).cast("long").alias("ad_id"), F.col(run).cast("long").alias("run")).distinct()
        for r in rows.select("run").distinct().orderBy("run").collect():  # one number a run
            if r.run > last:
                state, last = compare_run(state, rows.where(F.col("run") == r.run).select("ad_id"), r.run, "ad_id", confirm), r.run
        state.write.mode("overwrite").parquet(f"{path}/state-{batch_id}")
        _name(spark, path, batch_id, last)

    return cards.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_folded(spark, path: str) -> DataFrame:
    """The state that fold_runs left."""
    return _state(spark, path, STATUS_STATE)[0]


PRICE_STATE = "ad_id long, at timestamp, value double"


def change_batches(sightings: DataFrame, path: str, checkpoint: str, key: str = "ad_id", at: str = "ts", value: str = "value"):
    """Changes of a value against the key's previous sighting, across micro-batches: the last sighting of each key is kept under a path.

    Changes are written to path/changes, one folder a batch, so a replayed batch overwrites its own. A sighting without a value hides or
    reveals it. Returns the started query.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state, version, _ = _state(spark, path, PRICE_STATE)
        if batch_id <= version:
            return
        rows = batch.select(F.col(key).cast("long").alias("ad_id"), F.col(at).cast("timestamp").alias("at"), F.col(value).cast("double").alias("value"))
        both = state.unionByName(rows)
        known = state.select("ad_id", "at").withColumn("old", F.lit(True))
        changes = shown_changes(both, "ad_id", "at", "value").join(known, ["ad_id", "at"], "left_anti")
        changes.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")
        both.groupBy("ad_id").agg(F.max_by(F.struct("at", "value"), "at").alias("r")).select("ad_id", "r.*").write.mode("overwrite").parquet(f"{path}/state-{batch_id}")
        _name(spark, path, batch_id, -1)

    return sightings.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
