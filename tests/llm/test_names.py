"""Columns of the user's that are named like those an operator or stage makes itself."""

import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import awkward, prose, table  # noqa: F401
from pyspark.sql import functions as F

from lakeops.llm import decontaminate, packing, secrets, shingles, simhash, toxicity

NAMES = ["_by_id", "_by_text", "by_id", "by_text", "_hit_id", "_hit_hash", "hit_id", "hit_hash", "hash", "row", "_id", "_hash", "_text", "_whole", "node",
         "root", "key", "keys", "size", "counts", "text_hash", "item_id", "start", "end", "score", "sentences", "fingerprint", "component_id", "spans", "place", "length",
         "sequence_id", "offset", "_order", "_bucket", "_number", "_n", "_l", "_b", "_before", "_length", "_low", "_high", "piece", "ids", "n_words", "prints"]


@pytest.fixture()
def docs(table, awkward):  # noqa: F811
    frame = table(awkward + [(i, prose(i, 40)) for i in range(100, 110)])
    return frame.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in NAMES])


def kept_as_they_are(before, after):
    assert after.columns == before.columns
    for r in after.where("doc_id IS NOT NULL").collect():
        assert all(r[n] == f"{n}{r.doc_id}" for n in NAMES)


def test_stages_keep_such_columns(spark, docs, tmp_path):
    pq.write_table(pa.table({"item_id": [1], "text": [prose(100, 12)]}), tmp_path / "benchmark.parquet")
    pq.write_table(pa.table({"doc_id": [100], "quality": pa.array([1], pa.int32()), "toxic": pa.array([1], pa.int32())}), tmp_path / "labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept_as_they_are(docs, stage(spark, docs, str(tmp_path)))
    kept_as_they_are(docs, simhash.keep_one(docs))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.select("sequence_id").distinct().count() > 0


def test_packing_carries_such_columns(docs):
    names = [n for n in NAMES if n not in ("length", "sequence_id", "offset")]
    rows = docs.where("doc_id IS NOT NULL").withColumn("length", F.lit(100))
    got = packing.pack(rows).collect()
    assert len(got) == rows.count() and all(r[n] == f"{n}{r.doc_id}" for r in got for n in names)
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_operators_do_not_read_such_columns(docs, spark):
    from test_spelling import brute_counts

    from lakeops.llm import licenses, quality, spelling, substring

    model = toxicity.Model(toxicity.np.empty(0, toxicity.np.uint64), toxicity.np.empty(0), -1.0)
    items = spark.createDataFrame([(1, prose(101, 12))], "item_id bigint, text string")
    for made in (secrets.find_secrets(docs), toxicity.score_documents(docs, model), simhash.near_duplicates(docs), quality.quality(docs), licenses.scan_licenses(docs),
                 decontaminate.benchmark_hits(docs, items)[0]):
        assert made.count() == docs.count()
    assert {r.doc_id for r in decontaminate.benchmark_hits(docs, items)[1].collect()} == {101}
    assert substring.repeated_passages(docs).count() > 0
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r.word: r.n for r in spelling.word_counts(docs).collect()} == dict(brute_counts(rows))
    assert shingles.keep_one(docs).count() < docs.count()
