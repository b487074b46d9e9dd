"""Structured Streaming counterparts: deduplication, late rows, upserts, alerts, events."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops.functions.embedding import toy_embedding
from lakeops.functions.scalars import concat_nulls_empty
from lakeops.operators import changes
from lakeops.operators.documents import MODEL_NAME
from lakeops.operators.skew import latest_per_key


# ---- sources and sinks -------------------------------------------------------------------------

def file_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet", files: str | None = None,
                max_files: int | None = None, **options) -> DataFrame:
    """Streaming read of a folder; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def start_append(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None) -> StreamingQuery:
    """Append to files; once over what is there, or continuously with ``every`` as processing time."""
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(writer, every).start(path)


def start_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` per micro-batch."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def _trigger(writer, every):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def write_batch(rows: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """One folder per micro-batch: a replayed batch overwrites its own folder, nothing else."""
    rows.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")


def replay_source(df: DataFrame, ts: str, path: str, events_per_file: int = 50_000, max_events: int | None = None) -> None:
    """Write events as time-ordered JSON Lines files for a replay; their number follows from the number of events."""
    ordered = df if max_events is None else df.orderBy(ts).limit(max_events)
    files = max(1, -(-ordered.count() // events_per_file))
    ordered.repartitionByRange(files, ts).sortWithinPartitions(ts).write.json(path)


# ---- transformations ---------------------------------------------------------------------------

def dedup_events(stream: DataFrame, key: str, ts: str, lateness: str) -> DataFrame:
    """Drop repeated ids; state is kept for the lateness bound only."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])


class BatchAccount(NamedTuple):
    """Rows of one micro-batch: what came, what went on, what the watermark dropped, and repeated rows."""

    batch_id: int
    came: int
    accepted: int
    dropped_late: int
    repeated: int


def accounts(running: StreamingQuery) -> list[BatchAccount]:
    """Where the rows of a deduplicated stream went, batch by batch; ``accepted``, ``dropped_late`` and ``repeated`` add up to ``came``.

    What the watermark drops is counted by the stateful operator; nothing leaves unseen. The stream
    writes one sink and was started in this session.
    """
    found: dict[int, BatchAccount] = {}
    for progress in running.recentProgress:
        step = json.loads(progress.json) if hasattr(progress, "json") else progress
        states = step.get("stateOperators", [])
        if not states or not step.get("numInputRows"):
            continue
        late = sum(s.get("numRowsDroppedByWatermark", 0) for s in states)
        repeated = sum(s.get("customMetrics", {}).get("numDroppedDuplicateRows", 0) for s in states)
        came = step["numInputRows"]
        accepted = sum(s.get("numRowsUpdated", 0) for s in states)
        found[step["batchId"]] = BatchAccount(step["batchId"], came, accepted, late, repeated)
    return [found[b] for b in sorted(found)]


class LateSplit(NamedTuple):
    accepted: DataFrame
    late: DataFrame


def split_late(rows: DataFrame, arrived: str, ts: str, bound: Column) -> LateSplit:
    """Rows within the lateness bound and rows beyond it; none is lost."""
    late = F.col(arrived) > F.col(ts) + bound
    return LateSplit(rows.where(~late), rows.where(late))


def late_by_folder(folder_date: str, ts: str, days: int = 0) -> Column:
    """Whether a row landed in the folder of a day more than ``days`` after its own."""
    return F.date_diff(F.col(folder_date), F.to_date(ts)) > days


def once(handle: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Keep a micro-batch while a handler reads it several times."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            handle(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def late_router(arrived: str, ts: str, bound: Column, accepted: str, late: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler that writes accepted and late rows to their own folders."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        split = split_late(batch, arrived, ts, bound)
        write_batch(split.accepted, accepted, batch_id)
        write_batch(split.late, late, batch_id)

    return once(handle)


def newest_per_key(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Newest row per key of a stream, in the state store: late and repeated rows change nothing.

    Every micro-batch reads and writes the state of its own keys only.
    """
    rest = [c for c in stream.columns if c != key]
    newest = stream.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(key, "_row.*").select(*stream.columns)


def start_updates(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the keys whose row changed, a folder per micro-batch; a replayed batch writes the same again."""
    writer = stream.writeStream.outputMode("update").foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


def updated_state(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """Current row per key from the update folders."""
    return latest_per_key(spark.read.parquet(path).drop("batch_id"), [key], order)


COMPACT_EVERY = 20


def upsert_handler(path: str, key: str, order: list[str], every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """Keep the newest row per key of each micro-batch; every so many batches the state is compacted."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        _compact_before(batch.sparkSession, path, key, order, batch_id, every)
        write_batch(latest_per_key(batch, [key], order), path, batch_id)

    return handle


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the finished sub-folders ``prefix=number``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    names = [status.getPath().getName() for status in system.listStatus(root)]
    done = [n for n in names if n.startswith(f"{prefix}=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]
    return sorted(int(n.partition("=")[2]) for n in done)


def _expire(spark: SparkSession, path: str, batch_id: int, every: int) -> None:
    """Remove what stands behind the last base that an earlier batch finished; no replay reads it."""
    base = ((batch_id - 1) // every) * every if batch_id else 0
    for folder, prefix in ((path, "batch_id"), (f"{path}_base", "upto")):
        for number in _numbers(spark, folder, prefix):
            if number < base:
                old = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}={number}")
                old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def _state_folders(path: str, batch_id: int, every: int) -> list[str]:
    """Folders holding the state before ``batch_id``: the last compaction and the batches since."""
    base = (batch_id // every) * every
    compacted = [f"{path}_base/upto={base}"] if base else []
    return compacted + [f"{path}/batch_id={i}" for i in range(base, batch_id)]


def _compact_before(spark: SparkSession, path: str, key: str, order: list[str], batch_id: int, every: int) -> None:
    """At every ``every``-th batch, merge all earlier ones; reads only older folders, so a replay writes the same.

    Folders that a base of an earlier batch holds are removed.
    """
    _expire(spark, path, batch_id, every)
    if batch_id and batch_id % every == 0:
        older = _state_folders(path, batch_id - 1, every) + [f"{path}/batch_id={batch_id - 1}"]
        latest_per_key(spark.read.parquet(*older), [key], order).write.mode("overwrite").parquet(f"{path}_base/upto={batch_id}")


def state_before(spark: SparkSession, path: str, key: str, order: list[str], batch_id: int, every: int = COMPACT_EVERY) -> DataFrame | None:
    """State left by all batches before ``batch_id``; None before the first one."""
    folders = _state_folders(path, batch_id, every)
    return latest_per_key(spark.read.parquet(*folders), [key], order) if folders else None


def upserted_state(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """Current row per key: the newest base and the batches since; out-of-order rows give the same result."""
    bases = _numbers(spark, f"{path}_base", "upto")
    start = bases[-1] if bases else 0
    folders = [f"{path}_base/upto={start}"] if bases else []
    folders += [f"{path}/batch_id={n}" for n in _numbers(spark, path, "batch_id") if n >= start]
    return latest_per_key(spark.read.parquet(*folders), [key], order)


def change_event_handler(state: str, events: str, key: str, order: list[str], columns: list[str], source: str,
                         time: Column | None = None, every: int = COMPACT_EVERY, deleted: str | None = None) -> Callable[[DataFrame, int], None]:
    """Upsert a micro-batch and write its changes against the earlier state as JSON events.

    A newest row with a true ``deleted`` column takes its key out: a delete event if it was there, and
    none if not; the mark stays in the state, so an older row that comes late does not bring it back.
    ``time`` is the events' time as text; by default the moment at which the batch is handled.

    The earlier state is read from older folders only, so replaying a batch gives the same events.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _compact_before(spark, state, key, order, batch_id, every)
        newest = latest_per_key(batch, [key], order)
        older = state_before(spark, state, key, order, batch_id, every)
        before = newest.where(F.lit(False)) if older is None else older.join(newest.select(key), key, "left_semi")
        current = latest_per_key(before.unionByName(newest), [key], order)
        write_batch(newest, state, batch_id)
        if deleted:
            before, current = (rows.where(~F.coalesce(F.col(deleted), F.lit(False))) for rows in (before, current))
        diff = changes.snapshot_diff(before, current, key, columns)
        stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if time is None else time
        write_batch(changes.change_events(diff, key, source, stamp).select("event"), events, batch_id, "text")

    return once(handle)


def review_embedding_handler(staged: str, deleted: str) -> Callable[[DataFrame, int], None]:
    """Change batches ``(Operation, Item)``: inserts and updates are embedded as whole texts and staged, deletes routed.

    What is staged and deleted fits ``documents.merge_staged_vectors``.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        item = batch.select("Operation", "Item.*")
        upserts = item.where(F.col("Operation").isin(0, 1))
        text = concat_nulls_empty(
            F.lit("Review ("), F.col("Rating"), F.lit("/5): "), F.col("Title"), F.lit(". "), F.col("ReviewText"))
        write_batch(upserts.select(F.col("ReviewID").alias("review_id"), text.alias("chunk_text")).select(
            "review_id", "chunk_text", F.to_json(toy_embedding(F.col("chunk_text"))).alias("embedding_json"),
            F.lit(MODEL_NAME).alias("model"), F.lit(batch_id).alias("staged_at")), staged, batch_id)
        write_batch(item.where("Operation = 2").select(F.col("ReviewID").alias("review_id")), deleted, batch_id)

    return once(handle)


def negative_review_alerts(stream: DataFrame, limit: int = 2) -> DataFrame:
    """One alert row per review rated at or below the limit."""
    return stream.where(F.col("rating") <= limit).select(
        "review_id", "rating", F.concat(F.lit("negative review "), F.col("review_id").cast("string")).alias("alert"))


def sustained_alert(events: DataFrame, ts: str, value: str, threshold: float, lateness: str = "10 minutes",
                    length: str = "15 minutes", slide: str = "5 minutes") -> DataFrame:
    """Sliding windows whose average stays above the threshold; pass decimals for exact averages."""
    marked = events.withWatermark(ts, lateness) if events.isStreaming else events
    return marked.groupBy(F.window(ts, length, slide)).agg(
        F.avg(value).alias("average"), F.count(F.lit(1)).alias("events")
    ).where(F.col("average") > threshold).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), "average", "events")


def delay_profile(events: DataFrame, ts: str, sent: str, lateness: str = "1 day", length: str = "1 hour") -> DataFrame:
    """Average and largest delay between event and arrival per window."""
    marked = events.withWatermark(ts, lateness) if events.isStreaming else events
    delay = F.timestamp_diff("SECOND", F.col(ts), F.col(sent))
    return marked.groupBy(F.window(ts, length)).agg(
        F.avg(delay.cast("decimal(18,2)")).alias("avg_delay"), F.max(delay).alias("max_delay"), F.count(F.lit(1)).alias("events")
    ).select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "avg_delay", "max_delay", "events")
