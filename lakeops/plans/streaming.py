"""Streams over the supplied tables, run until everything available is processed."""

from pyspark.sql import functions as F

from lakeops.operators import documents
from lakeops.plans.cleaning import SQL_EXTRACT, order_extract
from lakeops.plans.registry import query
from lakeops.plans.scalars import SQL_BUCKET, sql_words
from lakeops.session import scratch_path
from lakeops.sources import landing
from lakeops.streaming import streams
from lakeops.tables import SQL_REVIEWS

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE"


def written(t, rows, name):
    """Rows as a landing folder of parquet files; plain timestamps, because watermarks need them."""
    path = scratch_path(t.spark, name)
    rows.write.parquet(path)
    return streams.file_stream(t.spark, path, rows.schema)


def in_steps(t, parts, name, start):
    """Rows land part by part, and the stream goes on after each: one micro-batch or more for every part."""
    path = scratch_path(t.spark, name)
    for part in parts:
        part.write.mode("append").parquet(path)
        finish(start(streams.file_stream(t.spark, path, part.schema)))


def timed_events(t):
    return t.events.withColumn("ts", F.col("ts").cast("timestamp")).drop("props")


def finish(running):
    running.awaitTermination()


def appended(t, stream, name, fmt="parquet"):
    """Run to the end, then read the sink."""
    path = scratch_path(t.spark, name)
    finish(streams.start_append(stream, path, scratch_path(t.spark, name + "_checkpoint"), fmt))
    return t.spark.read.schema(stream.schema).format(fmt).load(path)


@query("replay_stream_source", "SELECT event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY 1")
def replay_stream_source(t):
    path = scratch_path(t.spark, "replay")
    streams.replay_source(timed_events(t), "ts", path)
    stream = streams.file_stream(t.spark, path, EVENT_SCHEMA, "json", max_files=8)
    return appended(t, stream, "replayed").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 4).alias("total"))


@query("stream_dedup_events", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup_events(t):
    events = timed_events(t)
    stream = written(t, events.unionByName(events.where("event_type = 'click'")), "duplicated")
    return appended(t, streams.dedup_events(stream, "event_id", "ts", "1 day").select("event_id", "user_id", "event_type"), "deduped")


@query("stream_accounts", """SELECT count(*) + count(*) FILTER (WHERE event_type = 'click') AS came, count(*) AS kept, count(*) FILTER (WHERE event_type = 'click') AS repeated,
  TRUE AS all_accounted FROM events""")
def stream_accounts(t):
    """Every row of a stream with repeated clicks is accepted, repeated or dropped as late, in every micro-batch."""
    events = timed_events(t)
    stream = written(t, events.unionByName(events.where("event_type = 'click'")), "duplicated")
    running = streams.start_append(streams.dedup_events(stream, "event_id", "ts", "1 day"), scratch_path(t.spark, "kept"), scratch_path(t.spark, "kept_checkpoint"))
    finish(running)
    rows = t.spark.createDataFrame(streams.accounts(running), "batch_id bigint, came bigint, accepted bigint, dropped_late bigint, repeated bigint")
    whole = F.bool_and(F.col("came") == F.col("accepted") + F.col("dropped_late") + F.col("repeated"))
    return rows.agg(F.sum("came").alias("came"), F.sum("accepted").alias("kept"), F.sum("repeated").alias("repeated"), whole.alias("all_accounted"))


@query("stream_late_events", """SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 'late' ELSE 'accepted' END AS route FROM events""")
def stream_late_events(t):
    """Errors arrive a day late, views some minutes; the bound is ten minutes."""
    delay = F.when(F.col("event_type") == "error", F.expr("INTERVAL 1 DAY")).when(
        F.col("event_type") == "view", F.expr("INTERVAL 5 MINUTE")).otherwise(F.expr("INTERVAL 1 SECOND"))
    stream = written(t, timed_events(t).withColumn("arrived", F.col("ts") + delay), "arrivals")
    accepted, late = scratch_path(t.spark, "accepted"), scratch_path(t.spark, "late")
    router = streams.late_router("arrived", "ts", F.expr("INTERVAL 10 MINUTE"), accepted, late)
    finish(streams.start_batches(stream, router, scratch_path(t.spark, "late_checkpoint")))

    def routed(name, path):
        return t.spark.read.parquet(path).select("event_id", "event_type", F.lit(name).alias("route"))

    return routed("accepted", accepted).unionByName(routed("late", late))


SQL_LATEST = f"""{SQL_EXTRACT}, latest AS (SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY order_id
  ORDER BY modified_at DESC, load_date DESC) AS n FROM extract_rows) WHERE n = 1)"""


@query("stream_order_upsert", f"WITH {SQL_LATEST} SELECT order_id, status, modified_at, load_date FROM latest")
def stream_order_upsert(t):
    """The newest loads come first; one stream takes a few files a micro-batch and keeps the newest row per order in its state store."""
    rows = order_extract(t).select("order_id", "status", "modified_at", "load_date")
    feed, path, order = scratch_path(t.spark, "order_feed"), scratch_path(t.spark, "order_state"), ["modified_at", "load_date"]
    for part in (rows.where("load_date >= DATE '1998-01-01'"), rows.where("load_date < DATE '1998-01-01'")):
        part.write.mode("append").parquet(feed)
    files = len(t.spark.read.schema(rows.schema).parquet(feed).inputFiles())
    stream = streams.newest_per_key(streams.file_stream(t.spark, feed, rows.schema, max_files=-(-files // 2)), "order_id", order)
    finish(streams.start_updates(stream, path, scratch_path(t.spark, "upsert_checkpoint")))
    return streams.updated_state(t.spark, path, "order_id", order)


STEPS = ("1996-01-01", "1998-01-01", "2000-01-01")


def by_load_date(rows):
    """Four parts of the feed."""
    edges = [F.col("load_date") >= F.lit(day).cast("date") for day in STEPS]
    return [rows.where(~edges[0]), rows.where(edges[0] & ~edges[1]), rows.where(edges[1] & ~edges[2]), rows.where(edges[2])]


@query("stream_change_events", f"""WITH {SQL_EXTRACT}, parts AS (SELECT *, {' + '.join(f"CAST(load_date >= DATE '{day}' AS INTEGER)" for day in STEPS)} AS part FROM extract_rows),
newest AS (SELECT order_id, part, last(status ORDER BY modified_at, load_date) AS status FROM parts GROUP BY 1, 2),
steps AS (SELECT order_id, status, lag(status) OVER (PARTITION BY order_id ORDER BY part) AS before FROM newest)
SELECT '{{"specversion":"1.0","id":"' || order_id || CASE WHEN before IS NULL THEN '-I' ELSE '-U' END || '","type":"sales.order.' || CASE WHEN before IS NULL THEN 'insert' ELSE 'update' END
  || '","time":"2002-01-01T00:00:00Z","data":{{' || CASE WHEN before IS NULL THEN '' ELSE '"before":{{"order_id":' || order_id || ',"status":"' || before || '"}},' END
  || '"after":{{"order_id":' || order_id || ',"status":"' || status || '"}}}}}}' AS event FROM steps WHERE before IS DISTINCT FROM status""")
def stream_change_events(t):
    rows = order_extract(t).select("order_id", "status", "modified_at", "load_date")
    state, events = scratch_path(t.spark, "event_state"), scratch_path(t.spark, "events")
    handler = streams.change_event_handler(
        state, events, "order_id", ["modified_at", "load_date"], ["status"], "sales.order", F.lit("2002-01-01T00:00:00Z"), every=2)
    checkpoint = scratch_path(t.spark, "event_checkpoint")
    in_steps(t, by_load_date(rows), "event_feed", lambda stream: streams.start_batches(stream, handler, checkpoint))
    return t.spark.read.text(events).select(F.col("value").alias("event"))


@query("stream_delete_events", f"""WITH {SQL_EXTRACT}, parts AS (SELECT *, {' + '.join(f"CAST(load_date >= DATE '{day}' AS INTEGER)" for day in STEPS)} AS part FROM extract_rows),
newest AS (SELECT order_id, part, last(status ORDER BY modified_at, load_date) AS status FROM parts GROUP BY 1, 2),
steps AS (SELECT order_id, CASE WHEN part = 3 AND order_id % 2 = 0 THEN NULL ELSE status END AS status, lag(status) OVER (PARTITION BY order_id ORDER BY part) AS before FROM newest),
kinds AS (SELECT order_id, CASE WHEN before IS NULL THEN 'insert' WHEN status IS NULL THEN 'delete' ELSE 'update' END AS kind FROM steps WHERE before IS DISTINCT FROM status)
SELECT kind, count(*) AS events, CAST(sum(order_id) AS BIGINT) AS orders FROM kinds GROUP BY 1""")
def stream_delete_events(t):
    """In the last part of the feed orders with even numbers are deleted."""
    rows = order_extract(t).select("order_id", "status", "modified_at", "load_date")
    gone = (F.col("load_date") >= F.lit(STEPS[-1]).cast("date")) & (F.col("order_id") % 2 == 0)
    state, events = scratch_path(t.spark, "event_state"), scratch_path(t.spark, "events")
    handler = streams.change_event_handler(state, events, "order_id", ["modified_at", "load_date"], ["status"], "sales.order",
                                           F.lit("2002-01-01T00:00:00Z"), every=2, deleted="gone")
    checkpoint = scratch_path(t.spark, "event_checkpoint")
    in_steps(t, by_load_date(rows.withColumn("gone", gone)), "event_feed", lambda stream: streams.start_batches(stream, handler, checkpoint))
    event = F.from_json("value", "type STRING, data STRUCT<before: STRUCT<order_id: BIGINT>, after: STRUCT<order_id: BIGINT>>")
    found = t.spark.read.text(events).select(event.alias("e")).select(F.substring_index("e.type", ".", -1).alias("kind"), F.coalesce("e.data.after.order_id", "e.data.before.order_id").alias("id"))
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("events"), F.sum("id").alias("orders"))


SQL_FEED = f"""feed AS (SELECT doc_id AS id, lang, concat('Review (', 2 + 3 * quality - toxic, '/5): ', lang, '. ', text) AS text
  FROM documents LEFT JOIN labels USING (doc_id)),
staged AS (SELECT id, text FROM feed WHERE lang IN ('en', 'fr')), fw AS {sql_words('staged', 'id', 'text')},
fb AS (SELECT id, bucket, count(*) AS n FROM fw JOIN (SELECT word, {SQL_BUCKET} AS bucket FROM (SELECT DISTINCT word FROM fw)) USING (word) GROUP BY 1, 2),
vectors AS (SELECT id, string_agg(bucket || ':' || n, ',' ORDER BY bucket) AS vector FROM fb GROUP BY 1)"""


def review_feed(t):
    """Documents as a change feed in three steps: English inserted, French updated, others deleted. Gives the sinks' folders."""
    operation = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1).otherwise(2)
    feed = t.documents.join(t.labels, "doc_id", "left").select(operation.alias("Operation"), F.struct(
        F.col("doc_id").alias("ReviewID"), (F.lit(2) + 3 * F.col("quality") - F.col("toxic")).alias("Rating"), F.col("lang").alias("Title"),
        F.col("text").alias("ReviewText")).alias("Item"))
    staged, deleted, checkpoint = (scratch_path(t.spark, n) for n in ("staged", "deleted", "review_checkpoint"))
    handler = streams.review_embedding_handler(staged, deleted)
    parts = [feed.where(F.col("Item.ReviewID") % 3 == i) for i in range(3)]
    in_steps(t, parts, "review_feed", lambda stream: streams.start_batches(stream, handler, checkpoint))
    return t.spark.read.parquet(staged).drop("batch_id"), t.spark.read.parquet(deleted).drop("batch_id")


def vector_text(vector):
    """The non-zero components as position:value."""
    numbered = F.transform(vector, lambda x, i: F.struct(i.alias("i"), x.cast("int").alias("x")))
    return F.array_join(F.transform(F.filter(numbered, lambda c: c["x"] != 0), lambda c: F.concat_ws(":", c["i"].cast("string"), c["x"].cast("string"))), ",")


@query("stream_review_embeddings", f"""WITH {SQL_FEED} SELECT id AS review_id, CASE WHEN lang IN ('en', 'fr') THEN 'staged' ELSE 'deleted' END AS route,
  CASE WHEN lang IN ('en', 'fr') THEN md5(text) END AS text_md5, CASE WHEN lang IN ('en', 'fr') THEN coalesce(vector, '') END AS vector
FROM feed LEFT JOIN vectors USING (id)""")
def stream_review_embeddings(t):
    staged, deleted = review_feed(t)
    kept = staged.select("review_id", F.lit("staged").alias("route"), F.md5("chunk_text").alias("text_md5"),
                         vector_text(F.from_json("embedding_json", "array<float>")).alias("vector"))
    return kept.unionByName(deleted.select("review_id", F.lit("deleted").alias("route")), allowMissingColumns=True)


@query("staged_reviews_to_chunks", f"""WITH {SQL_FEED} SELECT source_type, source_id, md5(doc_text) AS text_md5, 'toy-hash-768' AS model
FROM (SELECT 'Ticket' AS source_type, conv_id AS source_id, 'ticket ' || conv_id AS doc_text FROM conversations GROUP BY conv_id
UNION ALL SELECT 'Review', id, text FROM staged)""")
def staged_reviews_to_chunks(t):
    """The staged reviews replace all chunks of the old whole reviews, also those of deleted reviews; tickets stay."""
    tickets = t.conversations.select("conv_id").distinct().select(
        F.lit("Ticket").alias("source_type"), F.col("conv_id").alias("source_id"), F.concat(F.lit("ticket "), F.col("conv_id")).alias("doc_text"))
    old = t.documents.select(F.lit("Review").alias("source_type"), F.col("doc_id").alias("source_id"), F.col("text").alias("doc_text"))
    chunks = documents.embed_chunks(documents.content_chunks(tickets.unionByName(old))).withColumn("is_stale", F.lit(False))
    return documents.merge_staged_vectors(chunks, *review_feed(t)).select(
        "source_type", "source_id", F.md5("chunk_text").alias("text_md5"), F.col("embedding_model").alias("model"))


@query("late_by_folder", """SELECT event_id, CAST(ts AS DATE) + CASE WHEN event_type = 'error' THEN 2 ELSE 0 END AS event_date, event_type = 'error' AS late FROM events""")
def late_by_folder(t):
    """Events land in the folder of the day they arrive on; errors two days late."""
    base = scratch_path(t.spark, "late_events")
    late = F.when(F.col("event_type") == "error", 2).otherwise(0)
    landing.write_jsonl(t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"),
                                        F.date_add(F.to_date("ts"), late).alias("event_date")), base, "event_date")
    back = landing.read_jsonl(t.spark, base, "event_id BIGINT, event_time TIMESTAMP_NTZ, event_date DATE")
    return back.select("event_id", "event_date", streams.late_by_folder("event_date", "event_time").alias("late"))


@query("stream_negative_review_alerts", f"""WITH {SQL_REVIEWS} SELECT review_id, rating, 'negative review ' || review_id AS alert FROM reviews WHERE rating <= 2""")
def stream_negative_review_alerts(t):
    stream = written(t, t.reviews.select("review_id", "rating"), "rated")
    return appended(t, streams.negative_review_alerts(stream), "alerts")


SQL_WINDOWS = """w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * i) AS window_start, CAST(round(value * 100) AS BIGINT) AS cents
  FROM events, range(3) r(i)),
g AS (SELECT window_start, CAST(CAST((CAST(sum(cents) AS BIGINT) * 20000 + count(*)) // (2 * count(*)) AS DECIMAL(18,0)) * 0.000001 AS DECIMAL(22,6)) AS average,
  count(*) AS events FROM w GROUP BY 1)"""


def priced_events(t):
    return timed_events(t).withColumn("value", F.col("value").cast("decimal(18,2)"))



@query("stream_sustained_alert", f"""WITH {SQL_WINDOWS} SELECT window_start, average, events FROM g
WHERE average > 60 AND window_start + INTERVAL 15 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 10 MINUTE""")
def stream_sustained_alert(t):
    """Closed windows only: the last ones stay open until the watermark passes them."""
    return appended(t, streams.sustained_alert(written(t, priced_events(t), "metrics"), "ts", "value", 60), "sustained")


@query("sustained_alert", f"WITH {SQL_WINDOWS} SELECT window_start, average, events FROM g WHERE average > 60")
def sustained_alert(t):
    return streams.sustained_alert(priced_events(t), "ts", "value", 60)


@query("stream_delay_profile", """WITH d AS (SELECT date_trunc('hour', ts) AS window_start, date_diff('microsecond', ts, ts + to_seconds(user_id)) // 1000000 AS delay FROM events)
SELECT window_start, CAST(CAST((CAST(sum(delay) AS BIGINT) * 2000000 + count(*)) // (2 * count(*)) AS DECIMAL(18,0)) * 0.000001 AS DECIMAL(22,6)) AS avg_delay, max(delay) AS max_delay, count(*) AS events FROM d GROUP BY 1
HAVING window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 DAY""")
def stream_delay_profile(t):
    sent = timed_events(t).withColumn("sent_at", F.timestamp_add("SECOND", F.col("user_id"), F.col("ts")))
    return appended(t, streams.delay_profile(written(t, sent, "sent"), "ts", "sent_at"), "delays")
