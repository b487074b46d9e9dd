"""Percentiles from quantile sketches that are kept per day and merged over days.

A sketch is some kilobytes whatever it has seen, so a day is read once; percentiles over any days, of
any group, merge the sketches of those days. Ranks are off by about ``1.7 / k``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 400


def daily_sketches(df: DataFrame, group: Sequence[str], ts: str, value: str, k: int = K) -> DataFrame:
    """``group``, ``day``, ``n`` and ``sketch`` of the values; nulls are not counted. New days are appended to what is there."""
    return df.where(F.col(value).isNotNull()).groupBy(*group, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged(sketches: DataFrame, group: Sequence[str], days: Column | None = None, k: int = K) -> DataFrame:
    """One sketch per group over the days that ``days`` selects. Merging the same days in any grouping gives the same bounds."""
    rows = sketches if days is None else sketches.where(days)
    return rows.groupBy(*group).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def percentiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share`` and ``percentile`` for each of ``shares`` and every row."""
    asked = F.array(*[F.struct(F.lit(float(p)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("percentile")) for p in shares])
    return sketches.select("*", F.explode(asked).alias("_p")).select("*", "_p.*").drop("_p", "sketch")


def rank_errors(found: DataFrame, df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """How far each percentile's share lies from the shares of rows below it and up to it, by a scan of all rows; 0 where it is between them."""
    rows = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v"))
    counts = rows.join(found.select(*group, "share", "percentile"), list(group)).groupBy(*group, "share", "percentile").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_v") < F.col("percentile")).alias("_below"), F.count_if(F.col("_v") <= F.col("percentile")).alias("_to"))
    error = F.greatest(F.col("_below") / F.col("_n") - F.col("share"), F.col("share") - F.col("_to") / F.col("_n"), F.lit(0.0))
    return counts.select(*group, "share", "percentile", error.alias("rank_error"))
