import json
import math
import random
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeops.functions import embedding, vectors
from lakeops.functions.similarity import _jaro_winkler, fuzzy_search, similar_members, similar_names
from lakeops.operators import documents as docs
from lakeops.operators import fulltext, hybrid, nearest, rag
from lakeops.plans import search as plans


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def array(*values):
    return F.array(*[F.lit(float(v)) for v in values])


def test_vector_literals(spark):
    a, b, c = array(1, 2, 2), array(2, 4, 4), array(-1, 0, 3)
    row = one(spark, ab=vectors.cosine_distance(a, b), e=vectors.euclidean_distance(a, b), d=vectors.negative_dot(a, b),
              ac=vectors.cosine_distance(a, c), n=vectors.normalize(b), z=vectors.normalize(array(0, 0)))
    assert row.ab == pytest.approx(0) and row.e == 3 and row.d == -18 and row.ac == pytest.approx(0.472954, abs=1e-6)
    assert [round(x, 3) for x in row.n] == [0.333, 0.667, 0.667] and row.z is None


def test_hash_buckets(spark):
    words = ["leak", "waterproof", "boot", "wet", "trail", ""]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(embedding.bucket_of(F.col("w")).alias("b")).collect()
    assert [r.b for r in rows] == [435, 580, 422, 44, 487, 578]


def test_toy_embedding(spark):
    row = one(spark, v=embedding.toy_embedding(F.lit("waterproof boots for wet trails")), n=embedding.toy_embedding(F.lit(None).cast("string")))
    assert {i: x for i, x in enumerate(row.v) if x} == {580: 1.0, 422: 1.0, 44: 1.0, 487: 1.0}
    assert len(row.n) == 768 and not any(row.n)


def test_chunks_rebuild_the_text(spark):
    rng = random.Random(3)
    texts = [(i, "".join(rng.choice("abc é\n") for _ in range(n))) for i, n in enumerate([0, 1, 499, 500, 501, 950, 951, 4321])]
    rows = docs.chunk_fixed(spark.createDataFrame(texts, "id int, t string"), "t").orderBy("id", "chunk_order").collect()
    for i, text in texts:
        parts = [r for r in rows if r.id == i]
        assert [r.chunk_order for r in parts] == list(range(1, len(parts) + 1))
        assert [r.chunk_offset for r in parts] == [450 * j + 1 for j in range(len(parts))]
        rebuilt = "".join(r.chunk_text[:450] for r in parts[:-1]) + (parts[-1].chunk_text if parts else "")
        assert rebuilt == text
    assert docs.chunk_step(150, 10) == 135


def test_refresh_is_idempotent(spark):
    sources = spark.createDataFrame([("Review", 1, "new text"), ("Review", 2, "same"), ("Product", 1, "boots")], "source_type string, source_id long, doc_text string")
    old = spark.createDataFrame([("Review", 1, "old text"), ("Review", 2, "same"), ("Ticket", 9, "gone")], "source_type string, source_id long, doc_text string")
    chunks = docs.embed_chunks(docs.content_chunks(old)).withColumn("is_stale", (F.col("source_id") == 1))
    first = docs.refresh_chunks(chunks, sources)
    second = docs.refresh_chunks(first, sources)
    texts = {r.chunk_text for r in first.collect()}
    assert texts == {"new text", "same", "boots"}
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))
    actions = {(r.source_type, r.source_id): r.action for r in docs.refresh_actions(chunks, sources).collect()}
    assert actions == {("Review", 1): "stale", ("Review", 2): "kept", ("Product", 1): "new", ("Ticket", 9): "orphan"}


def brute(stored, asked, k):
    out = {}
    for q, v in asked:
        d = [(round(1 - float(np.dot(v, x)) / (np.linalg.norm(v) * np.linalg.norm(x)), 6), i) for i, x in stored]
        out[q] = [i for _, i in sorted(d)[:k]]
    return out


def test_knn_equals_brute_force_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    stored = [(i, rng.integers(0, 4, 8).astype(float).tolist()) for i in range(400)]
    stored = [(i, v) for i, v in stored if any(v)] + [(1000 + j, [1.0] * 8) for j in range(200)]  # a third are copies
    asked = [(q, rng.normal(size=8).tolist()) for q in range(9)]
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 4)
    frame = spark.createDataFrame(stored, "id long, embedding array<float>").repartition(3)
    queries = spark.createDataFrame(asked, "query_id long, query_vector array<double>")
    rows = nearest.knn_exact(frame, queries, 5).collect()
    got = {q: [r.id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] for q, _ in asked}
    assert got == brute(stored, asked, 5)


def test_ann_recall_and_filter(spark, tables):
    stored, centres = plans.stored_vectors(tables), plans.label_centres(tables)
    index = nearest.build_cell_index(stored, keep=("label",))
    found = nearest.ann_search(index, centres, 10)
    recall = nearest.recall_at_k(nearest.knn_exact(stored, centres, 10), found, 10).agg(F.avg("recall")).first()[0]
    assert recall >= 0.95
    limited = nearest.ann_search(index, centres, 10, nprobe=1, condition=F.col("label") == 3)
    assert {r["count"] for r in limited.groupBy("query_id").count().collect()} == {10}
    assert limited.join(stored, "id").select("label").distinct().collect()[0].label == 3


def test_clustered_vectors_are_pruned(spark):
    """With real clusters a small share of the cells reaches nearly all neighbours."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16)) * 4
    vectors = [(i, (centres[i % 40] + rng.normal(size=16) * 0.3).tolist()) for i in range(4000)]
    stored = spark.createDataFrame(vectors, "id long, embedding array<float>").repartition(4)
    queries = spark.createDataFrame([(q, vectors[q][1]) for q in range(0, 4000, 100)], "query_id long, query_vector array<double>")
    index = nearest.build_cell_index(stored)
    found = nearest.ann_search(index, queries, 10)
    recall = nearest.recall_at_k(nearest.knn_exact(stored, queries, 10), found, 10).agg(F.avg("recall")).first()[0]
    assert recall >= 0.95 and index.nprobe <= 0.3 * len(index.centers), (recall, index.nprobe, len(index.centers))


def test_small_table_uses_exact_search(spark):
    stored = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 20)], "id long, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 1.0])], "query_id long, query_vector array<double>")
    index = nearest.build_cell_index(stored)
    assert index.rows < nearest.MIN_INDEX_ROWS
    assert nearest.ann_search(index, queries, 3).count() == 3


def words_of(text):
    return [w for w in "".join(c if unicodedata.category(c)[0] in "LMN" else " " for c in text.lower()).split() if w]


def brute_bm25(corpus, asked, k):
    split = {i: words_of(t) for i, t in corpus}
    avg = sum(map(len, split.values())) / len(split)
    df = Counter(w for ws in split.values() for w in set(ws))
    out = {}
    for q, t in asked:
        scores = {}
        for i, ws in split.items():
            tf = Counter(ws)
            terms = [w for w in set(words_of(t)) if tf[w]]
            if terms:
                scores[i] = round(sum(math.log(1 + (len(split) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2
                                      / (tf[w] + 1.2 * (0.25 + 0.75 * len(ws) / avg)) for w in terms), 6)
        out[q] = [i for i, _ in sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]]
    return out


def test_bm25_equals_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    corpus = [(i, " ".join(rng.choice(["tent", "wind", "boot", "Leak", "rain", "the"]) for _ in range(rng.randint(0, 12)))) for i in range(150)]
    corpus += [(1000 + i, "tent wind") for i in range(75)]
    asked = [(1, "tent strong wind"), (2, "the boot"), (3, "nothing here"), (4, "rain rain")]
    monkeypatch.setattr(fulltext, "QUERY_BLOCK", 3)
    monkeypatch.setattr(fulltext, "QUERY_SLICE", 1)
    monkeypatch.setattr(fulltext, "BLOCK_CELLS", 40)
    got = fulltext.bm25(spark.createDataFrame(corpus, "id long, text string").repartition(3),
                        spark.createDataFrame(asked, "query_id long, query_text string"), 7).collect()
    want = brute_bm25(corpus, asked, 7)
    for q, _ in asked:
        assert [r.id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == want[q]


def test_word_predicates(spark):
    text = "The tents leaked; zipper was jammed and later broke. Headlamp fine"
    w = fulltext.tokens(F.lit(text))
    row = one(spark, inflection=fulltext.has_inflection(w, "leak"), prefix=fulltext.has_prefix(w, "head"), word=fulltext.has_word(w, "Zipper"),
              close=fulltext.near(w, "zipper", "jammed", 1), far=fulltext.near(w, "broke", "zipper", 3), ok=fulltext.near(w, "broke", "zipper", 4),
              none=fulltext.near(w, "zipper", "absent", 50))
    assert (row.inflection, row.prefix, row.word, row.close, row.far, row.ok, row.none) == (True, True, True, True, False, True, False)


def test_contains_passage(spark):
    documents = spark.createDataFrame([(1, "xx the quick brown fox jumps over the lazy dog yy"), (2, "the quick brown fox jumps over a lazy dog"), (3, "big red barn")], "doc_id long, text string")
    passages = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (2, "ig red bar"), (3, "absent words are here"), (4, "brown fox"),
                                      (5, "d b"), (6, "--"), (7, ""), (8, None), (9, "x")], "item_id long, text string")
    assert {(r.item_id, r.doc_id) for r in fulltext.contains_passage(documents, passages).collect()} == {
        (1, 1), (2, 3), (4, 1), (4, 2), (5, 3), (9, 1), (9, 2)}


@pytest.mark.parametrize("text", ["Größe über Maß, Äpfel-Öl", "L'été déjà où naïve cœur", "El niño comió ¿qué? año", "Привет, мир! Ёлка", "東京 タワー 2024", "e\u0301te\u0301 x"])
def test_words_of_every_script(spark, text):
    assert one(spark, w=fulltext.tokens(F.lit(text))).w == words_of(text)


def test_bm25_finds_words_outside_ascii(spark):
    corpus = spark.createDataFrame([(1, "Die Größe zählt"), (2, "Die Grosse zahlt"), (3, "Привет мир")], "id long, text string")
    asked = spark.createDataFrame([(1, "größe"), (2, "МИР")], "query_id long, query_text string")
    assert {(r.query_id, r.id) for r in fulltext.bm25(corpus, asked, 5).collect()} == {(1, 1), (2, 3)}


def test_rrf_values(spark):
    keyword = spark.createDataFrame([(1, 10, 1), (1, 20, 2)], "query_id long, id long, keyword_rank long")
    semantic = spark.createDataFrame([(1, 20, 1), (1, 30, 2)], "query_id long, id long, semantic_rank long")
    rows = hybrid.best(hybrid.fuse(keyword, semantic), 5).orderBy("position").collect()
    assert [(r.id, str(r.rrf_score)) for r in rows] == [(20, "0.032522"), (10, "0.016393"), (30, "0.016129")]
    both = spark.createDataFrame([(1, 10, 1)], "query_id long, id long, semantic_rank long")
    assert str(hybrid.best(hybrid.fuse(keyword.where("id = 10"), both), 1).first().rrf_score) == "0.032787"


def test_payload_is_grounded_json(spark):
    questions = spark.createDataFrame([(1, 'Which "tent"?'), (2, "No hits")], "query_id long, query_text string")
    context = spark.createDataFrame([(1, 7, "Product", 3, 1, 'Ridge tent\n"light"'), (1, 8, "Review", 4, 2, "Windy")],
                                    "query_id long, id long, source_type string, source_id long, position long, text string")
    products = spark.sql("SELECT 3L product_id, 'Ridge' product_name, 'Tents' category, CAST(99.5 AS DECIMAL(10,2)) list_price, '{\"season\":3}' attributes")
    reviews = spark.createDataFrame([(4, 3, 5), (5, 3, 4)], "review_id long, product_id long, rating int")
    facts = rag.product_facts(context, products, reviews)
    rows = {r.query_id: r for r in rag.payloads(questions, context, facts).collect()}
    body = json.loads(rows[1].payload)
    user = body["messages"][1]["content"]
    fact = json.loads(user.split("Product facts (JSON): ")[1].split("\nSources")[0])[0]
    assert fact == {"productId": 3, "name": "Ridge", "category": "Tents", "priceEur": 99.5, "attributes": {"season": 3}, "avgRating": 4.5, "reviewCount": 2}
    sources = json.loads(user.split("Sources (JSON): ")[1])
    assert [s["id"] for s in sources] == [7, 8] and sources[0]["text"] == 'Ridge tent\n"light"'
    assert body["response_format"]["json_schema"]["schema"]["required"] == ["answer", "source_ids", "confidence"]
    assert rows[1].rough_tokens == len(rows[1].payload) // 4
    assert "Sources (JSON): []" in json.loads(rows[2].payload)["messages"][1]["content"]


def test_bad_model_responses(spark):
    good = {"response": {"status": {"http": {"code": 200}}}, "result": {"choices": [{"message": {"content": json.dumps(
        {"answer": "yes", "source_ids": [7, 99], "confidence": "high"})}}], "usage": {"prompt_tokens": 10, "completion_tokens": 3}}}
    rows = [(1, json.dumps(good)), (2, json.dumps({"response": {"status": {"http": {"code": 429}}}})), (3, "not json")]
    parsed = rag.parse_responses(spark.createDataFrame(rows, "query_id long, response string")).orderBy("query_id").collect()
    assert (parsed[0].answer, parsed[0].source_ids, parsed[0].prompt_tokens, parsed[0].error) == ("yes", [7, 99], 10, None)
    assert parsed[1].http_status == 429 and parsed[1].answer is None and "429" in parsed[1].error
    assert parsed[2].http_status is None and parsed[2].error
    context = spark.createDataFrame([(1, 7, "text")], "query_id long, id long, text string")
    frame = spark.createDataFrame([(1, [7, 99])], "query_id long, source_ids array<long>")
    assert [r.id for r in rag.resolve_citations(frame, context).collect()] == [7]


def test_context_budget(spark):
    context = spark.createDataFrame([(1, i, i, "x" * 40) for i in range(1, 6)], "query_id long, id long, position long, text string")
    assert rag.context_budget(context, 35).count() == 3


def test_similar_names(spark):
    people = [(1, "Riga", "Anna Berg"), (2, "Riga", "Anan Berg"), (3, "Riga", "Anna Brg"), (4, "Oslo", "Anna Berg"), (5, "Riga", "Bert Olsen")]
    people += [(100 + i, "Riga", "Anna Berg") for i in range(300)]
    pairs = similar_names(spark.createDataFrame(people, "id long, city string, name string"), ["city"], "name", "id").collect()
    assert {(r.name_a, r.name_b, r.members_a, r.members_b) for r in pairs} == {("Anan Berg", "Anna Berg", 1, 301), ("Anna Berg", "Anna Brg", 301, 1)}
    everyone = similar_members(spark.createDataFrame(people, "id long, city string, name string"), ["city"], "name", "id").collect()
    berg = {1, *range(100, 400)}
    assert {(r.id_a, r.id_b) for r in everyone} == {(min(2, i), max(2, i)) for i in berg} | {(min(3, i), max(3, i)) for i in berg}


def test_fuzzy_search(spark):
    products = spark.createDataFrame([(1, "Trail Headlamp"), (2, "Lamp Oil"), (3, "Tent")], "id long, name string")
    assert [r.id for r in fuzzy_search(products, "id", "name", "hedlamp", 2).collect()] == [1, 2]
    assert _jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6) and _jaro_winkler("", "a") == 0.0


def test_many_query_blocks_keep_the_plan_small(spark, monkeypatch):
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 2)
    stored = spark.createDataFrame([(i, [float(i % 7 + 1), float(i % 3)]) for i in range(50)], "id long, embedding array<float>")
    queries = spark.createDataFrame([(q, [1.0, float(q)]) for q in range(12)], "query_id long, query_vector array<double>")
    found = nearest.knn_exact(stored, queries, 3)
    assert found.groupBy("query_id").count().where("count = 3").count() == 12
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()  # the hits of the blocks are read, not made again


def test_words_hashed_once_a_batch_give_the_same_vectors(spark):
    from lakeops.functions import embedding

    texts = [None, "", "the THE tent", "Running runs RUN seas sing ed ing s", "Ünder naïve café's x1y2 tent-tent", "as is us bed beds bedes\nsings", " a  b " * 50 + "leaks"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    rows = df.select(embedding.toy_embedding(F.col("t")).alias("a"), embedding.dense(embedding.buckets(F.col("t"))).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and any(sum(r.a) for r in rows)


def test_scans_hold_what_they_score_and_not_a_cell_per_word_and_text():
    import tracemalloc

    n, terms = 4000, [f"w{i}" for i in range(1000)]
    texts = pa.array([[terms[(7 * i + k) % 1000] for k in range(5)] for i in range(n)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), texts], ["id", "words"])
    asked = {q: terms[5 * q:5 * q + 5] for q in range(200)}
    task = fulltext._word_scores(asked, dict.fromkeys(terms, 1.0), 5.0, 3)
    tracemalloc.start()
    found = list(task(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 200 and most < 8 * n * 1000  # one number per word and text would be this much


def test_bucket_counts_are_made_after_rows_are_dealt_out(spark, monkeypatch):
    """A task holds the counts of its own rows only; keys that repeat or are null are added up."""
    from conftest import plan_of

    monkeypatch.setattr(embedding, "ROWS_PER_TASK", 5)
    rows = [(None if i % 10 == 0 else i // 2, None if i == 7 else f"waterproof boots number{'abc'[i % 3]} trails trails") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, t string")
    got = embedding.bucket_counts(df, 60, "id", "t")
    plain = Counter((r.id, b) for r in df.select("id", embedding.buckets(F.col("t")).alias("b")).collect() for b in r.b or [])
    assert {(r.id, r.bucket): r.hits for r in got.collect()} == plain
    assert got.rdd.getNumPartitions() == 12 and "Exchange" in plan_of(got)


def test_chunk_profile_sorts_no_vectors(spark):
    from conftest import plan_of

    rows = [("a", "xy ", "m2", [1.0, 2.0]), ("a", "xyz", "m1", [1.0]), ("b", None, None, [1.0]), (None, "q", "m1", [1.0, 1.0, 1.0])]
    profile = docs.chunk_profile(spark.createDataFrame(rows, "source_type string, chunk_text string, embedding_model string, embedding array<float>"), "source_type")
    assert {tuple(r) for r in profile.collect()} == {("a", 2, 2, "m1", 1, 12), ("b", 1, None, None, 1, 4), (None, 1, 1, "m1", 3, 12)}
    assert not any("SortAggregate" in line and "size(embedding" in line for line in plan_of(profile).splitlines())


def test_a_scan_makes_vectors_once(spark):
    texts = spark.createDataFrame([(i, f"word{'abcdefg'[i % 7]} other{'xyz'[i % 3]}") for i in range(30)], "id long, text string")
    asked = spark.createDataFrame([(9, "wordd othery")], "query_id long, query_text string")
    found = nearest.knn_exact(texts.withColumn("embedding", embedding.toy_embedding(F.col("text"))), hybrid.embed_queries(asked), 2)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("EvalPython") == 1
    assert found.orderBy("rank").first().id == 10


def test_rows_without_a_vector_are_no_neighbours(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [0.6, 0.8])], "id long, embedding array<float>")
    asked = spark.createDataFrame([(9, [1.0, 0.1])], "query_id long, query_vector array<float>")
    assert [(r.id, r.rank) for r in nearest.knn_exact(rows, asked, 5).orderBy("rank").collect()] == [(1, 1), (4, 2)]


def test_cells_are_learned_and_given_in_two_steps(spark, monkeypatch):
    """Beyond ``GROUP_CELLS`` cells a vector is compared with the groups and the cells of one group, not with all cells."""
    monkeypatch.setattr(nearest, "GROUP_CELLS", 8)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 16)) * 4
    rows = [(i, (centres[i % 60] + rng.normal(size=16) * 0.3).tolist(), i % 7) for i in range(6000)]
    rows += [(6000 + i, [0.0] * 16, 0) for i in range(5)] + [(7000 + i, None, 0) for i in range(5)] + [(8000 + i, [1.0] * 16, 0) for i in range(500)]
    stored = spark.createDataFrame(rows, "id long, embedding array<float>, label int").repartition(4)
    index = nearest.build_cell_index(stored, keep=("label",))
    assert index.rows == 6505 and 20 <= len(index.centers) <= 60
    kept = {r.id: (list(r.embedding), r.label) for r in index.cells.collect()}
    assert set(kept) == {i for i, v, _ in rows if v and any(v)}
    assert all(kept[i] == (pytest.approx(v, rel=1e-6), label) for i, v, label in rows[::500] if v and any(v))
    assert index.cells.agg(F.count_distinct("cell"), F.max("cell")).first()[1] < len(index.centers)
    queries = spark.createDataFrame([(q, rows[q][1]) for q in range(0, 6000, 150)], "query_id long, query_vector array<double>")
    found = nearest.ann_search(index, queries, 10)
    recall = nearest.recall_at_k(nearest.knn_exact(stored, queries, 10), found, 10).agg(F.avg("recall")).first()[0]
    assert recall >= 0.95 and index.nprobe <= 0.4 * len(index.centers), (recall, index.nprobe, len(index.centers))
    coarse, fine = nearest._train(stored.where("embedding IS NOT NULL").select("id", "embedding"), 40, 7, 256)
    assert len(fine) == len(coarse) > 1 and max(map(len, fine)) <= 16


def test_vectors_without_a_length_are_searched_exactly(spark):
    stored = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(200)], "id long, embedding array<float>")
    index = nearest.build_cell_index(stored)
    queries = spark.createDataFrame([(1, [1.0, 1.0])], "query_id long, query_vector array<double>")
    assert index.rows == 200 and nearest.ann_search(index, queries, 3).count() == 0
