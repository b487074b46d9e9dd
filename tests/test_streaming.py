import json

from pyspark.sql import functions as F

from lakeops.operators import documents
from lakeops.streaming import streams

ORDER_SCHEMA = "order_id long, status string, modified_at int, load_date int"


def feed(spark, folder, *batches, schema=ORDER_SCHEMA):
    """One file per batch, written one after the other; the stream takes one file at a time."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return streams.file_stream(spark, str(folder), schema, max_files=1)


BATCHES = ([(1, "Placed", 1, 1), (2, "Placed", 1, 1), (2, "Placed", 1, 1)], [(1, "Shipped", 5, 3), (3, "Placed", 2, 2)], [(1, "Placed", 2, 4), (2, "Cancelled", 1, 6)])


def test_upsert_over_batches_equals_batch(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", *BATCHES)
    handler = streams.upsert_handler(str(tmp_path / "state"), "order_id", ["modified_at", "load_date"])
    streams.start_batches(stream, handler, str(tmp_path / "cp")).awaitTermination()
    read = lambda: {(r.order_id, r.status) for r in streams.upserted_state(spark, str(tmp_path / "state"), "order_id", ["modified_at", "load_date"]).collect()}
    want = {(1, "Shipped"), (2, "Cancelled"), (3, "Placed")}
    assert read() == want
    handler(spark.createDataFrame(BATCHES[1], ORDER_SCHEMA), 1)  # a replayed batch changes nothing
    assert read() == want


def test_compacted_state_equals_all_batches(spark, tmp_path):
    path, order = str(tmp_path / "state"), ["modified_at", "load_date"]
    handle = streams.upsert_handler(path, "order_id", order, every=2)
    rows = [[(i % 3, f"s{i}", i, i), (9, "x", 1, 1)] for i in range(6)]
    for number, batch in enumerate(rows):
        handle(spark.createDataFrame(batch, ORDER_SCHEMA), number)
    want = {0: "s3", 1: "s4", 2: "s2", 9: "x"}
    assert {r.order_id: r.status for r in streams.state_before(spark, path, "order_id", order, 5, every=2).collect()} == want
    assert spark.read.parquet(path + "_base/upto=4").count() == 4
    assert {r.order_id: r.status for r in streams.upserted_state(spark, path, "order_id", order).collect()} == {0: "s3", 1: "s4", 2: "s5", 9: "x"}
    kept = sorted(p.name for p in tmp_path.glob("state*/*=*"))
    assert kept == ["batch_id=4", "batch_id=5", "upto=4"]  # what a base holds is gone
    handle(spark.createDataFrame(rows[5], ORDER_SCHEMA), 5)  # a replay of the last batch changes nothing
    assert {r.order_id: r.status for r in streams.upserted_state(spark, path, "order_id", order).collect()} == {0: "s3", 1: "s4", 2: "s5", 9: "x"}


def test_change_events_over_batches(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", *BATCHES)
    handler = streams.change_event_handler(str(tmp_path / "state"), str(tmp_path / "events"), "order_id", ["modified_at", "load_date"], ["status"], "sales.order", every=2)
    streams.start_batches(stream, handler, str(tmp_path / "cp")).awaitTermination()
    events = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "events")).collect()]
    kinds = sorted((e["id"], e["type"].rsplit(".", 1)[1], e["data"]["after"]["status"]) for e in events)
    assert kinds == [("1-I", "insert", "Placed"), ("1-U", "update", "Shipped"), ("2-I", "insert", "Placed"), ("2-U", "update", "Cancelled"), ("3-I", "insert", "Placed")]


def test_dedup_across_batches(spark, tmp_path):
    schema = "event_id string, ts timestamp"
    at = lambda m: f"2026-08-01 10:{m:02d}:00"
    rows = [[("a", at(0)), ("b", at(1))], [("a", at(0)), ("c", at(2))], [("b", at(1)), ("d", at(3))]]
    frames = [[(i, __import__("datetime").datetime.fromisoformat(t)) for i, t in part] for part in rows]
    stream = streams.dedup_events(feed(spark, tmp_path / "in", *frames, schema=schema), "event_id", "ts", "1 hour")
    streams.start_append(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c", "d"]


def test_late_rows_are_routed_not_lost(spark, tmp_path):
    schema = "event_id int, ts timestamp_ntz, arrived timestamp_ntz"
    d = __import__("datetime").datetime
    rows = [(1, d(2026, 8, 1, 10), d(2026, 8, 1, 10, 10)), (2, d(2026, 8, 1, 10), d(2026, 8, 1, 10, 11)), (3, d(2026, 8, 1, 10), d(2026, 8, 2, 10))]
    stream = feed(spark, tmp_path / "in", rows[:2], rows[2:], schema=schema)
    router = streams.late_router("arrived", "ts", F.expr("INTERVAL 10 MINUTE"), str(tmp_path / "ok"), str(tmp_path / "late"))
    streams.start_batches(stream, router, str(tmp_path / "cp")).awaitTermination()
    ids = lambda p: sorted(r.event_id for r in spark.read.parquet(str(tmp_path / p)).collect())
    assert ids("ok") == [1] and ids("late") == [2, 3]


def test_change_batches_from_json_arrays(spark, tmp_path):
    folder = tmp_path / "changes"
    folder.mkdir()
    item = lambda i, text: {"ReviewID": i, "Rating": 4, "Title": "T", "ReviewText": text}
    (folder / "b1.json").write_text(json.dumps([{"Operation": 0, "Item": item(1, "x " * 3000 + "waterproof")}, {"Operation": 2, "Item": item(2, "")}]))
    (folder / "b2.json").write_text(json.dumps([{"Operation": 1, "Item": item(3, "dry boots")}]))
    stream = streams.file_stream(spark, str(folder), "Operation INT, Item STRUCT<ReviewID: BIGINT, Rating: INT, Title: STRING, ReviewText: STRING>", "json", max_files=1, multiLine="true")
    handler = streams.review_embedding_handler(str(tmp_path / "staged"), str(tmp_path / "gone"))
    streams.start_batches(stream, handler, str(tmp_path / "cp")).awaitTermination()
    rows = {r.review_id: r for r in spark.read.parquet(str(tmp_path / "staged")).collect()}
    assert rows[1].chunk_text == "Review (4/5): T. " + "x " * 3000 + "waterproof" and rows[3].chunk_text == "Review (4/5): T. dry boots"
    assert json.loads(rows[1].embedding_json)[580] == 1.0  # the last word of a long text counts
    old = spark.createDataFrame([("Review", i, f"old {i}") for i in (1, 2, 9)], "source_type string, source_id long, doc_text string")
    chunks = documents.embed_chunks(documents.content_chunks(old)).withColumn("is_stale", F.lit(False))
    merged = documents.merge_staged_vectors(chunks, spark.read.parquet(str(tmp_path / "staged")).drop("batch_id"), spark.read.parquet(str(tmp_path / "gone")))
    assert {r.source_id: r.chunk_text for r in merged.collect()} == {1: rows[1].chunk_text, 3: rows[3].chunk_text, 9: "old 9"}
    assert [r.review_id for r in spark.read.parquet(str(tmp_path / "gone")).collect()] == [2]


def test_replay_is_bounded_and_ordered(spark, tmp_path, tables):
    streams.replay_source(tables.events, "ts", str(tmp_path / "replay"), 3, max_events=100)
    assert spark.read.json(str(tmp_path / "replay")).agg(F.max("event_id")).first()[0] == 99


def test_the_newest_row_per_key_survives_late_and_repeated_batches(spark, tmp_path):
    from lakeops.streaming import streams

    schema, feed, out, checkpoint = "k int, at int, s string", str(tmp_path / "feed"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for rows in ([(1, 5, "new"), (2, 1, "a")], [(1, 3, "late"), (2, 2, "b")], [(1, 5, "new"), (3, 1, "c")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)
        stream = streams.newest_per_key(streams.file_stream(spark, feed, schema, max_files=1), "k", ["at"])
        streams.start_updates(stream, out, checkpoint).awaitTermination()
    assert sorted(map(tuple, streams.updated_state(spark, out, "k", ["at"]).collect())) == [(1, 5, "new"), (2, 2, "b"), (3, 1, "c")]
    written = spark.read.parquet(out).where("batch_id = 1").collect()
    assert {r.k for r in written} >= {2}
