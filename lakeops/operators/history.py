"""A version table that is kept up to date by batches of changes, late ones included.

Rows are versions with the interval in which they hold. A change splits the interval that holds its
time, wherever in the key's history that is; all other intervals stay as they are. Versions are stored
in buckets of their key, and a batch writes the buckets of its keys anew, under a folder of its own,
and no others. Whatever the order of the batches, the table is the one that all changes at once give.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.skew import neighbour
from lakeops.operators.temporal import asof_join, open_end, validity_intervals
from lakeops.session import materialize, scratch_path

BUCKETS = 64


def _same(keys: Sequence[str], other: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{i}")) for i, k in enumerate(keys)])


@dataclass(frozen=True)
class HistoryTable:
    """``folders[b]`` holds bucket b, None as long as it is empty. ``schema`` is that of the rows with ``valid_from`` and ``valid_to``."""

    keys: tuple[str, ...]
    schema: str
    folders: tuple[str | None, ...]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(len(self.folders))).cast("int")

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """All versions, or those of some buckets; only their folders are read."""
        wanted = range(len(self.folders)) if buckets is None else buckets
        paths = [self.folders[b] for b in wanted if self.folders[b]]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)


def empty_history(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> HistoryTable:
    """A table without versions for changes like those of ``df``."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    fields = [f"`{c}` {kinds[c]}" for c in (*keys, *columns)]
    return HistoryTable(tuple(keys), ", ".join([*fields, "valid_from timestamp_ntz", "valid_to timestamp_ntz"]), (None,) * buckets)


def split_intervals(versions: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str]) -> DataFrame:
    """``versions`` (keys, columns, ``valid_from``, ``valid_to``) after ``changes``.

    Of several changes of a key at one time, the one with the greatest columns holds, whether it is
    stored already or comes now. A change before the first version opens a first interval up to it.
    """
    names, keys = [*keys, *columns], list(keys)
    content = F.struct(*columns)
    met = asof_join(changes.select(*keys, F.col(ts).alias("_at"), *columns), versions.withColumn("_from", F.col("valid_from")), keys, "_at", "_from", ["valid_from"])
    met = materialize(met.withColumnRenamed("valid_from", "_base"), "held_by")
    split = met.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], F.col("_base").alias("_sb")).where("_sb IS NOT NULL").distinct()
    inside = _same(keys, "_s") & (F.col("valid_from") == F.col("_sb"))
    held = versions.join(split, inside, "left_semi")
    # Where a key's history begins; a new key has none.
    starts = versions.groupBy(*[F.col(k).alias(f"_f{i}") for i, k in enumerate(keys)]).agg(F.min("valid_from").alias("_first"))
    pieces = met.select(*keys, "_base", "_at", content.alias("_content")).unionByName(
        held.select(*keys, F.col("valid_from").alias("_base"), F.col("valid_from").alias("_at"), content.alias("_content")))
    pieces = pieces.groupBy(*keys, "_base", "_at").agg(F.max("_content").alias("_content"))
    linked = neighbour(materialize(pieces, "pieces"), [*keys, "_base"], ["_at"], ["_at"], None, "_next")
    ends = held.select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)], F.col("valid_from").alias("_eb"), F.col("valid_to").alias("_end"))
    linked = linked.join(ends, _same(keys, "_e") & (F.col("_base") == F.col("_eb")), "left").join(starts, _same(keys, "_f"), "left")
    last = F.when(F.col("_base").isNotNull(), F.col("_end")).otherwise(F.coalesce("_first", open_end()))
    fresh = linked.select(*keys, "_content.*", F.col("_at").alias("valid_from"), F.coalesce("_next._at", last).alias("valid_to"))
    return versions.join(split, inside, "left_anti").select(*names, "valid_from", "valid_to").unionByName(fresh)


def apply_changes(table: HistoryTable, changes: DataFrame, ts: str) -> HistoryTable:
    """The table after a batch of ``changes``; the buckets of keys without a change keep their folders."""
    spark = changes.sparkSession
    names = [f.name for f in table.read(spark, ()).schema.fields]
    columns = [n for n in names if n not in (*table.keys, "valid_from", "valid_to")]
    changes = materialize(changes.select(*table.keys, ts, *columns), "changes")
    touched = [r[0] for r in changes.select(table.bucket()).distinct().collect()]  # at most the number of buckets
    if not touched:
        return table
    state = split_intervals(table.read(spark, touched), changes, table.keys, ts, columns).withColumn("_bucket", table.bucket())
    folder = scratch_path(spark, "history")
    state.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(folder)
    return replace(table, folders=tuple(f"{folder}/_bucket={b}" if b in touched else old for b, old in enumerate(table.folders)))


def collapsed(versions: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Type-2 rows: neighbouring versions with equal ``columns`` become one, valid from the first of them on."""
    stored = materialize(versions.select(*keys, *columns, "valid_from"), "versions")
    before = neighbour(stored, list(keys), ["valid_from"], list(columns), None, "_before", step=-1)
    differs = reduce(lambda a, b: a | b, [~F.col(f"_before.{c}").eqNullSafe(F.col(c)) for c in columns], F.col("_before").isNull())
    opened = before.where(differs).select(*keys, *columns, F.col("valid_from").alias("_from"))
    return validity_intervals(opened, list(keys), "_from").drop("_from").withColumn("is_current", F.year("valid_to") == 9999)
