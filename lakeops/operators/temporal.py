"""Version tables: validity intervals, state at a time, as-of joins, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.skew import carried_forward, neighbour
from lakeops.session import materialize

OPEN_END = "9999-12-31 00:00:00"


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def validity_intervals(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Each version is valid from its own time to the next version's; the last stays open."""
    linked = neighbour(materialize(df, "versions"), keys, [ts], [ts], None, "_next")
    return (
        linked.withColumn("valid_from", F.col(ts))
        .withColumn("valid_to", F.coalesce(F.col(f"_next.{ts}"), open_end()))
        .drop("_next")
    )


def as_of(versions: DataFrame, moment: Column) -> DataFrame:
    """Versions valid at ``moment`` (start inclusive, end exclusive)."""
    return versions.where((F.col("valid_from") <= moment) & (moment < F.col("valid_to")))


def versions_between(versions: DataFrame, start: Column, end: Column) -> DataFrame:
    """Versions whose validity overlaps ``[start, end]``."""
    return versions.where((F.col("valid_from") <= end) & (F.col("valid_to") > start))


def history_retention(versions: DataFrame, now: Column, years: int = 2) -> DataFrame:
    """Drop closed versions that ended before the retention limit."""
    return versions.where(F.col("valid_to") >= now - F.make_interval(years=F.lit(years)))


def asof_join(
    facts: DataFrame, versions: DataFrame, keys: Sequence[str], fact_ts: str, version_ts: str,
    columns: Sequence[str],
) -> DataFrame:
    """Attach to each fact the version of its key in force at the fact's time.

    Facts and versions are merged into one time line per key and the last version is carried
    forward, so a key with many facts and versions never multiplies into pairs.
    """
    line = facts.select("*", F.col(fact_ts).alias("_ts"), F.lit(1).alias("_kind"),
                        F.lit(None).cast(_struct_type(versions, columns)).alias("_version"))
    marks = versions.select(*keys, F.col(version_ts).alias("_ts"), F.lit(0).alias("_kind"),
                            F.struct(*columns).alias("_version"))
    merged = line.unionByName(marks, allowMissingColumns=True)
    filled = carried_forward(merged, keys, ["_ts", "_kind"], "_version", None, "_current")
    return filled.where("_kind = 1").select(*facts.columns, "_current.*")


def _struct_type(df: DataFrame, columns: Sequence[str]) -> str:
    return df.select(F.struct(*columns).alias("s")).schema["s"].dataType.simpleString()
