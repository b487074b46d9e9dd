"""Range-partition layout of event tables: counts, pruning, sliding window, archive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import scratch_path
from lakeops.sources.landing import by_folder


def month_starts(first: dt.date, count: int) -> list[dt.date]:
    """First days of ``count`` consecutive months."""
    months = [first.year * 12 + first.month - 1 + i for i in range(count)]
    return [dt.date(m // 12, m % 12 + 1, 1) for m in months]


def partition_number(day: Column, bounds: Sequence[dt.date]) -> Column:
    """1-based partition; each boundary belongs to the partition on its right."""
    array = F.array(*[F.lit(b) for b in bounds])
    return F.when(day.isNotNull(), F.size(F.filter(array, lambda b: b <= day)) + 1)


def rows_per_partition(df: DataFrame, day: str, bounds: Sequence[dt.date]) -> DataFrame:
    """Every partition with its lower boundary and row count, empty ones too."""
    counted = df.groupBy(partition_number(F.col(day), bounds).alias("partition_number")).agg(F.count(F.lit(1)).alias("_n"))
    frame = df.sparkSession.createDataFrame(
        [(i + 1, b) for i, b in enumerate([None, *bounds])], "partition_number int, lower_boundary date")
    return frame.join(counted, "partition_number", "left").select(
        "partition_number", "lower_boundary", F.coalesce("_n", F.lit(0)).alias("rows"))


def write_monthly(df: DataFrame, ts: str, path: str) -> None:
    """Write by month. A month gets as many tasks as its size asks for, and small months share one."""
    out = by_folder(df.withColumn("event_month", F.trunc(F.to_date(ts), "MM")), "event_month")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_month").parquet(path)


def read_months(spark: SparkSession, path: str, start: dt.date, end: dt.date) -> DataFrame:
    """Months in ``[start, end)``; only their folders are listed and read."""
    return spark.read.parquet(path).where((F.col("event_month") >= F.lit(start)) & (F.col("event_month") < F.lit(end)))


@dataclass(frozen=True)
class Manifest:
    """Which months of which monthly folders make up a table: (folder, first month, month after the last).

    Months come and go by changing the manifest, so no row of another month is written again.
    """

    spans: tuple[tuple[str, dt.date, dt.date], ...]

    def read(self, spark: SparkSession) -> DataFrame:
        parts = [read_months(spark, *span) for span in self.spans if span[1] < span[2]]
        return reduce(lambda a, b: a.unionByName(b), parts)


def slide_window(table: Manifest, incoming: DataFrame, ts: str, oldest_kept: dt.date, target: str, newest: dt.date) -> Manifest:
    """Write the incoming rows, of months before ``newest``, to ``target``; months before ``oldest_kept`` leave the manifest."""
    write_monthly(incoming, ts, target)
    kept = [(path, max(start, oldest_kept), end) for path, start, end in table.spans if end > oldest_kept]
    return Manifest((*kept, (target, oldest_kept, newest)))


def archive_month(spark: SparkSession, table: Manifest, month: dt.date, archive: str) -> Manifest:
    """Copy one month to the archive folder and take it out of the manifest."""
    after = month_starts(month, 2)[1]
    own = Manifest(tuple((path, max(start, month), min(end, after)) for path, start, end in table.spans))
    by_folder(own.read(spark), "event_month").write.partitionBy("event_month").parquet(archive)
    left = [(path, start, min(end, month)) for path, start, end in table.spans] + [(path, max(start, after), end) for path, start, end in table.spans]
    return Manifest(tuple(span for span in left if span[1] < span[2]))


def monthly_table(df: DataFrame, ts: str, name: str = "monthly") -> str:
    """Write ``df`` by month under the shared folder and return the path."""
    path = scratch_path(df.sparkSession, name)
    write_monthly(df, ts, path)
    return path
