"""Snapshot comparison, change logs, merges and stale flags.

Parquet tables are not updated in place: every operator returns the new state or the rows to
append, and the caller writes them to a new path.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def price_audit(before: DataFrame, after: DataFrame, key: str, price: str) -> DataFrame:
    """Old and new price of rows whose price really changed; NULL prices never count as changed."""
    old = before.select(key, F.col(price).alias("old_price"))
    new = after.select(key, F.col(price).alias("new_price"))
    return new.join(old, key).where("new_price <> old_price")


def touch_modified(rows: DataFrame, updates: DataFrame, key: str, stamp: str, now: Column) -> DataFrame:
    """Apply updates. Where ``updates`` has no ``stamp`` column, or no value in it, the stamp becomes ``now``."""
    changed = [c for c in updates.columns if c != key]
    incoming = updates.select(key, F.struct(*changed, F.lit(True).alias("_there")).alias("_u"))
    joined = rows.join(incoming, key, "left")
    out = []
    for name in rows.columns:
        new = F.col(f"_u.{name}") if name in changed else F.col(name)
        if name == stamp:
            new = F.coalesce(F.col(f"_u.{stamp}"), now) if stamp in changed else now
        out.append(F.when(F.col("_u").isNull(), F.col(name)).otherwise(new).alias(name))
    return joined.select(*out)


def soft_delete(rows: DataFrame, deleted: DataFrame, key: str, flag: str = "is_active") -> DataFrame:
    """Deleted keys stay in the table with the flag off."""
    marks = deleted.select(key).distinct().withColumn("_gone", F.lit(True))
    return rows.join(marks, key, "left").withColumn(
        flag, F.when(F.col("_gone"), F.lit(False)).otherwise(F.col(flag))).select(*rows.columns)


def merge_reference(target: DataFrame, source: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """Update rows that differ in ``compare``, insert new ones, never delete; with the action taken.

    A NULL on either side does not count as a difference. Running it again yields only ``keep``.
    """
    values = [c for c in target.columns if c != key]
    old = target.select(key, F.struct(*values).alias("_old"))
    new = source.select(key, F.struct(*values).alias("_new"))
    joined = old.join(new, key, "full")
    differs = F.lit(False)
    for name in compare:
        differs = differs | F.coalesce(F.col(f"_old.{name}") != F.col(f"_new.{name}"), F.lit(False))
    action = (
        F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "keep").when(differs, "update").otherwise("keep")
    )
    row = F.when(action == "keep", F.col("_old")).otherwise(F.col("_new"))
    return joined.select(key, row.alias("_row"), action.alias("action")).select(key, "_row.*", "action")


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per changed key: ``op`` I/U/D, both images, and the names of changed columns."""
    old = before.select(key, F.struct(key, *columns).alias("before"))
    new = after.select(key, F.struct(key, *columns).alias("after"))
    changed = F.array_compact(F.array(*[
        F.when(~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")), F.lit(c)) for c in columns]))
    op = F.when(F.col("before").isNull(), "I").when(F.col("after").isNull(), "D").otherwise("U")
    return (
        old.join(new, key, "full").select(key, "before", "after", op.alias("op"), changed.alias("changed_columns"))
        .where((F.col("op") != "U") | (F.size("changed_columns") > 0))
    )


def cdc_all_changes(diff: DataFrame) -> DataFrame:
    """Row images with operation codes: 1 delete, 2 insert, 3 update before, 4 update after."""
    def image(code, column):
        return F.struct(F.lit(code).alias("operation"), F.col(column).alias("image"))

    images = (
        F.when(F.col("op") == "D", F.array(image(1, "before")))
        .when(F.col("op") == "I", F.array(image(2, "after")))
        .otherwise(F.array(image(3, "before"), image(4, "after")))
    )
    return diff.select(F.explode(images).alias("_i")).select("_i.operation", "_i.image.*")


def net_changes(log: DataFrame, key: str, version: str = "version", op: str = "op") -> DataFrame:
    """One net operation per key; a key inserted and deleted inside the range disappears.

    First and last operation are aggregates, so a key with many changes is reduced before the shuffle.
    """
    ends = log.groupBy(key).agg(
        F.min_by(op, version).alias("_first"), F.max_by(op, version).alias("_last"), F.max(version).alias(version))
    net = F.when(F.col("_last") == "D", "D").when(F.col("_first") == "I", "I").otherwise("U")
    return ends.where(~((F.col("_first") == "I") & (F.col("_last") == "D"))).select(key, net.alias(op), version)


def changes_since(log: DataFrame, key: str, last: int, min_valid: int, base: DataFrame | None = None) -> DataFrame:
    """Keys changed after version ``last``: net operation ``op``, newest ``version``, all ``changed_columns``.

    When ``last`` is older than the log reaches, what changed is unknown: every key of ``base``, the
    table that the log is about, comes back with operation ``R`` and the log's newest version.
    """
    if last < min_valid:
        if base is None:
            raise ValueError("the log does not reach back that far; a full refresh needs the base table")
        newest = log.agg(F.max("version").alias("version"))  # one row
        return base.select(key).distinct().crossJoin(F.broadcast(newest)).select(
            key, F.lit("R").alias("op"), "version", F.lit(None).cast("array<string>").alias("changed_columns"))
    newer = log.where(F.col("version") > last)
    ends = newer.groupBy(key).agg(
        F.min_by("op", "version").alias("_first"), F.max_by("op", "version").alias("_last"), F.max("version").alias("version"),
        F.array_distinct(F.flatten(F.collect_set("changed_columns"))).alias("changed_columns"))
    op = F.when(F.col("_last") == "D", "D").when(F.col("_first") == "I", "I").otherwise("U")
    return ends.select(key, op.alias("op"), "version", "changed_columns")


class CompactLog(NamedTuple):
    """What is left of a log, and the oldest version that a reader may ask from."""

    log: DataFrame
    min_valid: int


def compact_log(log: DataFrame, key: str, consumers: DataFrame, last_sync: str = "last_sync", min_valid: int = 0) -> CompactLog:
    """The log without what no consumer needs: every consumer reads the same changes from it as before.

    Rows up to the oldest sync go, and that becomes the oldest valid version. Between two syncs, and
    after the last, a key keeps its first and its last row, with all columns changed in between on the
    last. Consumers that never synced (null) keep everything from ``min_valid`` on.
    """
    syncs = sorted({max(min_valid, r[0] or min_valid) for r in consumers.select(last_sync).distinct().collect()})  # one number per consumer at most
    if not syncs:
        return CompactLog(log, min_valid)
    points = F.array(*[F.lit(s) for s in syncs])
    newer = log.where(F.col("version") > syncs[0]).withColumn("_span", F.size(F.filter(points, lambda p: p < F.col("version"))))
    ends = newer.groupBy(key, "_span").agg(
        F.min("version").alias("_low"), F.max("version").alias("_high"), F.min_by("op", "version").alias("_first"), F.max_by("op", "version").alias("_last"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("changed_columns")))).alias("_columns"))
    none = F.array().cast("array<string>")
    first = F.struct(F.col("_low").alias("version"), F.col("_first").alias("op"), none.alias("changed_columns"))
    last = F.struct(F.col("_high").alias("version"), F.col("_last").alias("op"), F.col("_columns").alias("changed_columns"))
    rows = ends.select(key, F.explode(F.when(F.col("_low") == F.col("_high"), F.array(last)).otherwise(F.array(first, last))).alias("_r"))
    return CompactLog(rows.select(key, "_r.*"), syncs[0])


def touching(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Updates that changed one of ``columns``, all deletes, and keys of a full refresh; others need no re-embedding."""
    wanted = F.arrays_overlap("changed_columns", F.array(*[F.lit(c) for c in columns]))
    return changes.where(F.col("op").isin("D", "R") | ((F.col("op") == "U") & wanted))


def flag_stale_chunks(chunks: DataFrame, changes: DataFrame, source_type: str, key: str, columns: Sequence[str]) -> DataFrame:
    """Mark chunks of sources whose text columns changed or that were deleted; inserts have no chunks yet."""
    hit = touching(changes, columns).select(F.col(key).alias("source_id")).distinct().select(
        "source_id", F.lit(source_type).alias("source_type"), F.lit(True).alias("_hit"))
    return chunks.join(hit, ["source_type", "source_id"], "left").withColumn(
        "is_stale", F.col("is_stale") | F.coalesce("_hit", F.lit(False))).drop("_hit")


def change_events(diff: DataFrame, key: str, source: str, time: Column) -> DataFrame:
    """Each change as a JSON event envelope."""
    kind = F.when(F.col("op") == "I", "insert").when(F.col("op") == "D", "delete").otherwise("update")
    envelope = F.struct(
        F.lit("1.0").alias("specversion"), F.concat(F.col(key).cast("string"), F.lit("-"), F.col("op")).alias("id"),
        F.concat(F.lit(source + "."), kind).alias("type"), time.alias("time"),
        F.struct("before", "after").alias("data"))
    return diff.select(key, F.to_json(envelope).alias("event"))


def cascade_delete(lines: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Lines whose parent was not deleted."""
    return lines.join(deleted.select(key), key, "left_anti")
