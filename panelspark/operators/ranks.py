"""Ranks and percentiles of whole columns without a task that holds one.

Values are counted first, and the counts dealt by ranges of (keys, value) and sorted: each partition adds up its own counts in one stream, and
what stands in the partitions before it, and before each key, is one number a partition and one a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from panelspark.sources.work import cut


def ranked_counts(counts: DataFrame, keys: list[str], value: str, n: str = "n", few_keys: bool = False) -> DataFrame:
    """counts (keys..., value, n), one row a value, with `below`: the rows of smaller values of the same keys. Keys and values aren't null.

    few_keys says that the keys have a fixed bound (column numbers), so what belongs to a key is broadcast.
    """
    rows = counts.withColumn(n, F.col(n).cast("long")).repartitionByRange(*keys, value).sortWithinPartitions(*keys, value)
    names = [*rows.columns, "__part", "__in"]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            if batch.num_rows:
                here = batch.column(n)
                upto = pc.add(pc.cumulative_sum(here), total)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pc.subtract(upto, here)], names=names)
                total = upto[-1].as_py()

    placed = cut(rows.mapInArrow(add_up, StructType([*rows.schema.fields, StructField("__part", IntegerType()), StructField("__in", LongType())])))
    parts = placed.groupBy("__part").agg(F.sum(n).alias("__s"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = parts.select("__part", F.coalesce(F.sum("__s").over(earlier), F.lit(0)).alias("__before"))
    sums = placed.join(F.broadcast(offsets), "__part").withColumn("below", F.col("__before") + F.col("__in")).drop("__part", "__in", "__before")
    if not keys:
        return sums
    starts = sums.groupBy(*keys).agg(F.min("below").alias("__start"))
    return sums.join(F.broadcast(starts) if few_keys else starts, keys).withColumn("below", F.col("below") - F.col("__start")).drop("__start")


def value_counts(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys..., value, n) of values that aren't null."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def at_rank(value: str, rank: Column, n: str = "n") -> Column:
    """Aggregate over ranked counts: the value that a rank, from 0, falls on."""
    return F.max(F.when((F.col("below") <= rank) & (rank < F.col("below") + F.col(n)), F.col(value)))


def percentile_at(value: str, p: float, total: Column, n: str = "n") -> Column:
    """Aggregate over ranked counts: the percentile, interpolated between neighbours."""
    place = (total - 1) * F.lit(float(p))
    low, high = at_rank(value, F.floor(place), n), at_rank(value, F.ceil(place), n)
    return low + (high - low) * (F.first(place) - F.floor(F.first(place)))


def percentiles(rows: DataFrame, keys: list[str], value: str, ps: tuple[float, ...]) -> DataFrame:
    """(keys..., n, q): exact percentiles of a value by keys, as an array; one row in all without keys, none without values."""
    ranked = ranked_counts(value_counts(rows, keys, value), keys, value)
    totals = ranked.groupBy(*keys).agg(F.sum("n").alias("__n"))
    joined = ranked.join(totals, keys) if keys else ranked.crossJoin(F.broadcast(totals))
    out = joined.groupBy(*keys).agg(F.first("__n").alias("n"), F.array(*[percentile_at(value, p, F.col("__n")) for p in ps]).alias("q"))
    return out.where("n is not null")
