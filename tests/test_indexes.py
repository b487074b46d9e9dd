"""JSON containment, compacted logs, accounted streams, chunk function and passages."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from lakeops.operators import changes, documents, fulltext, json_index
from lakeops.streaming import streams

DOCS = [(1, '{"colors": ["red", "blue", "red"], "size": 7, "a": {"b": "x"}}'), (2, '{"colors": ["blue"], "size": 7.5, "a": {"b": null}}'), (3, '{"colors": "red", "size": "7"}'),
        (4, "not json"), (5, None), (6, '{"colors": [], "size": true}'), (7, '{"colors": [1, null, "é \\" q"], "size": 7}')]


def test_containment_reads_its_buckets_only(spark):
    df = spark.createDataFrame(DOCS, "id bigint, doc string")
    index = json_index.build_json_index(df, "id", "doc", ["$.colors", "$.size", "$.a.b"])

    def found(*wanted):
        return sorted(r.key for r in json_index.containing(index, spark, wanted).collect())

    assert found(("$.colors", "red")) == [1, 3] and found(("$.colors", "blue")) == [1, 2]
    assert found(("$.size", 7)) == [1, 7] and found(("$.size", "7")) == [3] and found(("$.size", True)) == [6]
    assert found(("$.colors", "red"), ("$.size", 7)) == [1] and found(("$.colors", "red"), ("$.colors", "blue")) == [1]
    assert found(("$.colors", None)) == [7] and found(("$.colors", 'é " q')) == [7] and found(("$.a.b", "x")) == [1] and found(("$.size", 99)) == []
    plan = plan_of(json_index.containing(index, spark, [("$.size", 7)]))
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
    for bad in ([("$.other", 1)], []):
        with pytest.raises(ValueError):
            json_index.containing(index, spark, bad)
    with pytest.raises(ValueError):
        json_index.build_json_index(df, "id", "doc", ["$.a", "$.a.b"])


def test_readers_of_a_compacted_log_see_what_they_saw(spark):
    rng = random.Random(7)
    log = spark.createDataFrame([(rng.randrange(12), v, rng.choice("IUD"), rng.sample(["a", "b", "c"], rng.randrange(3))) for v in range(1, 400)],
                                "k int, version bigint, op string, changed_columns array<string>")
    syncs = [40, 41, 200, 390]
    kept = changes.compact_log(log, "k", spark.createDataFrame([(s,) for s in [*syncs, 200]], "last_sync bigint"))
    assert kept.min_valid == 40 and kept.log.count() <= 2 * 12 * 4 < log.count() and kept.log.agg(F.min("version")).first()[0] > 40

    def seen(source, since):
        rows = changes.changes_since(source, "k", since, kept.min_valid if source is kept.log else 0).collect()
        return sorted((r.k, r.op, r.version, sorted(r.changed_columns)) for r in rows)

    for s in syncs:
        assert seen(kept.log, s) == seen(log, s)
    with pytest.raises(ValueError):
        changes.changes_since(kept.log, "k", 10, kept.min_valid)
    again = changes.compact_log(kept.log, "k", spark.createDataFrame([(200,), (390,)], "last_sync bigint"))
    assert seen(again.log, 200) == seen(log, 200) and again.min_valid == 200
    none = changes.compact_log(log, "k", spark.createDataFrame([(None,)], "last_sync bigint"))
    assert none.min_valid == 0 and seen(none.log, 0) == seen(log, 0)


def test_late_rows_are_counted_when_the_watermark_drops_them(spark, tmp_path):
    schema, feed = "id int, ts timestamp", str(tmp_path / "feed")
    running = None
    batches = [["(1, timestamp'2026-01-10 00:00:00')", "(2, timestamp'2026-01-10 01:00:00')", "(1, timestamp'2026-01-10 00:00:00')"],
               ["(3, timestamp'2026-01-10 02:00:00')"], ["(4, timestamp'2026-01-01 00:00:00')", "(5, timestamp'2026-01-10 03:00:00')", "(2, timestamp'2026-01-10 01:00:00')"]]
    for rows in batches:
        spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS v(id, ts)").coalesce(1).write.mode("append").parquet(feed)
    stream = streams.dedup_events(streams.file_stream(spark, feed, schema, max_files=1), "id", "ts", "1 hour")
    running = streams.start_append(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    running.awaitTermination()
    found = streams.accounts(running)
    assert [a.came for a in found] == [3, 1, 3] and all(a.came == a.accepted + a.dropped_late + a.repeated for a in found)
    assert sum(a.dropped_late for a in found) == 1 and sum(a.repeated for a in found) == 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == sum(a.accepted for a in found) == 4


def test_deleted_keys_give_delete_events(spark, tmp_path):
    schema, feed, out = "k int, at int, s string, gone boolean", str(tmp_path / "feed"), str(tmp_path / "events")
    handler = streams.change_event_handler(str(tmp_path / "state"), out, "k", ["at"], ["s"], "t", F.lit("now"), every=2, deleted="gone")
    for rows in ([(1, 1, "a", False), (2, 1, "b", None)], [(1, 5, "a", True), (3, 1, "c", True)], [(1, 3, "late", False), (2, 2, "b2", False)], [(1, 6, "back", False)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)
        streams.start_batches(streams.file_stream(spark, feed, schema, max_files=1), handler, str(tmp_path / "checkpoint")).awaitTermination()
    events = spark.read.text(out).select(F.get_json_object("value", "$.id").alias("id"), F.col("batch_id")).collect()
    assert sorted((r.batch_id, r.id) for r in events) == [(0, "1-I"), (0, "2-I"), (1, "1-D"), (2, "2-U"), (3, "1-I")]


def test_the_chunk_function_gives_the_chunks_of_the_operator(spark):
    rows = [(i, None if i == 0 else "é" * 3 * i + "x" * (i * 37 % 300)) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, body string")
    documents.register_chunk_function(spark, "chunk_test")
    df.createOrReplaceTempView("chunk_test_rows")
    got = spark.sql("SELECT id, c.* FROM chunk_test_rows, LATERAL chunk_test(body, 40, 25) AS c")
    want = documents.chunk_fixed(df, "body", 40, 25).select("id", "chunk_order", "chunk_offset", "chunk_text", "chunk_length")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "Python" not in plan_of(got) and "Join" not in plan_of(got)


def test_passages_of_any_length_are_found_in_one_scan(spark):
    docs = [(1, "the quick brown fox jumps over the lazy dog"), (2, "quick"), (3, "a quick-brown fox"), (4, None), (5, ""), (6, "xquick brown foxx jumps")]
    items = [(1, "quick brown fox"), (2, "fox"), (3, "quick brown fox jumps over the lazy"), (4, ""), (5, None), (6, "k"), (7, "own f"), (8, "own fox j"), (9, "ick brown foxx jum")]
    got = fulltext.contains_passage(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, got.collect())) == sorted((i, d) for i, p in items for d, t in docs if p and t and p in t)
    assert fulltext.contains_passage(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")).collect() == []
