"""Sources and sinks: scans that tell what they skipped, exports with content hashes, run-partitioned snapshots."""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

STAMP = ("run_id", "run_slot", "config_hash")


def scan(spark: SparkSession, path: str, wanted: list[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns that the table has, and those that it hasn't."""
    rows = spark.read.parquet(path)
    have = [c for c in wanted if c in rows.columns]
    return rows.select(*have), [c for c in wanted if c not in have]


def labelled(df: DataFrame, label: str, text: str) -> tuple[DataFrame, Observation, dict]:
    """The frame with a row counter, the counter (its `get` has the rows once an action ran), and (label, SHA-256 of the query's text)."""
    counter = Observation(label)
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter, {"label": label, "query_sha256": hashlib.sha256(text.encode()).hexdigest()}


def config_fingerprint(config: dict, volatile: tuple[str, ...] = ()) -> str:
    """64 hexadecimal digits of a configuration, whatever the order of its entries and without those that don't change results."""
    kept = {k: v for k, v in config.items() if k not in volatile}
    return hashlib.sha256(json.dumps(kept, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()


def jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int = 8) -> DataFrame:
    """S3: a relational table read in ranges of a key."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=parts)


def import_new(source: DataFrame, present: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key isn't there yet (null keys count as equal), one a key; and (inserted, present, skipped)."""
    first = source.dropDuplicates([key])
    keys = present.select(F.col(key).alias("__k"), F.lit(1).alias("__p")).distinct()
    marked = first.join(keys, F.col(key).eqNullSafe(F.col("__k")), "left")
    new = marked.where("__p is null").drop("__k", "__p")
    total = source.agg(F.count("*").alias("total"))
    counts = marked.agg(F.count_if(F.col("__p").isNull()).alias("inserted"), F.count_if(F.col("__p").isNotNull()).alias("present"))
    both = counts.withColumn("j", F.lit(1)).join(total.withColumn("j", F.lit(1)), "j")
    return new, both.select("inserted", "present", (F.col("total") - F.col("inserted") - F.col("present")).alias("skipped"))


def flat_for_csv(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text."""
    nested = (ArrayType, MapType, StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema])


def write_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    """JSON lines, CSV with a header, or Parquet."""
    if form == "csv":
        flat_for_csv(df).write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").format(form).save(path)


def content_hash(df: DataFrame) -> DataFrame:
    """(rows, content_hash) whatever the order of rows: a sum of row hashes in 38 digits."""
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("content_hash"))


def written(spark: SparkSession, path: str) -> DataFrame:
    """(files, bytes) under a path; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def manifest(sources: dict[str, DataFrame], exclusions: list[tuple[str, str, DataFrame]], warnings: list[str], queries: list[dict]) -> DataFrame:
    """(area, name, reason, n): rows of each source, rows left out by reason, warnings, and the query log with its hashes."""
    spark = next(iter(sources.values())).sparkSession
    rows = [df.agg(F.count("*").alias("n")).select(F.lit("source").alias("area"), F.lit(name).alias("name"), F.lit(None).cast("string").alias("reason"), "n") for name, df in sources.items()]
    rows += [df.agg(F.count("*").alias("n")).select(F.lit("exclusion").alias("area"), F.lit(name).alias("name"), F.lit(reason).alias("reason"), "n") for name, reason, df in exclusions]
    said = [("warning", w, None, None) for w in warnings] + [("query", q["label"], q["query_sha256"], None) for q in queries]
    return reduce(DataFrame.unionByName, [*rows, spark.createDataFrame(said, "area string, name string, reason string, n long")])


def export(tables: dict[str, DataFrame], folder: str, form: str = "parquet") -> DataFrame:
    """Writes each table and gives (table, rows, content_hash, files, bytes). An empty table keeps its schema."""
    out = None
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", form)
        size = written(df.sparkSession, f"{folder}/{name}").withColumn("__j", F.lit(1))
        row = content_hash(df).withColumn("__j", F.lit(1)).join(size, "__j").select(F.lit(name).alias("table"), "rows", "content_hash", "files", "bytes")
        out = row if out is None else out.unionByName(row)
    return out


def first_pages(spark: SparkSession, path: str, key: str, items: str, schema: str) -> DataFrame:
    """A corpus of (gzipped) JSON pages; the first occurrence of each key by page number stays."""
    pages = spark.read.schema(schema).json(path)
    rows = pages.select("page", F.posexplode(items).alias("pos", "item")).select("page", "pos", "item.*")
    first = rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c != key]), F.struct("page", "pos")).alias("r"))
    return first.select(key, "r.*")


def write_snapshot(tables: dict[str, DataFrame], folder: str) -> None:
    """Immutable bundle by run: each table under run_date and run_id, where only the written partitions change. A run counts
    as written once `runs` has its row, which comes last: (run_date, run_id, table, rows, content_hash)."""
    keys = ["run_date", "run_id"]
    rows = []
    for name, df in tables.items():
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(f"{folder}/{name}")
        others = [c for c in df.columns if c not in keys]
        rows.append(df.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum(F.xxhash64(*others).cast("decimal(20,0)")).cast("string").alias("content_hash")).select(*keys, F.lit(name).alias("table"), "rows", "content_hash"))
    reduce(DataFrame.unionByName, rows).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(f"{folder}/runs")


def latest_valid(runs: DataFrame) -> DataFrame:
    """The last valid run that isn't synthetic, by its finish or else its start."""
    fine = runs.where((F.col("status") == "valid") & ~F.coalesce(F.col("synthetic"), F.lit(False)))
    return fine.agg(F.max_by("run_id", F.coalesce("finished_at", "started_at")).alias("run_id")).where("run_id is not null")


def stamp(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Provenance columns in front of every row; a column of the same name becomes source_<name>."""
    renamed = df.withColumnsRenamed({c: f"source_{c}" for c in df.columns if c in values})
    return renamed.select(*[v.alias(k) for k, v in values.items()], *[F.col(c) for c in renamed.columns])


def views(tables: dict[str, DataFrame]) -> None:
    """Exploration views, made anew each time."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
