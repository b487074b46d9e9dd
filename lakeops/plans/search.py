"""Documents, chunks, vector search, full-text search, hybrid retrieval and grounded prompts."""

from pyspark.sql import functions as F

from lakeops.functions import embedding, scalars
from lakeops.functions.vectors import cosine_distance, mean_vectors
from lakeops.operators import documents as docs
from lakeops.operators import fulltext, hybrid, hyperplanes, nearest, postings, rag
from lakeops.plans.registry import query
from lakeops.plans.scalars import PHONES, SQL_BUCKET, SQL_DOT, sql_words
from lakeops.session import materialize, scratch_path, spread


# ---- source documents --------------------------------------------------------------------------


def catalog(t):
    """Products with the JSON attributes the document and fact templates read."""
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").cast("decimal(10,2)").alias("list_price"),
        F.concat(F.lit("Size "), F.col("p_size").cast("string"), F.lit(".")).alias("description"),
        F.to_json(F.struct(F.col("p_size").alias("size"), (F.col("p_size") >= 25).alias("waterproof"))).alias("attributes"),
        (F.col("p_size") <= 45).alias("is_active"),
    )


def article_reviews(t):
    """Every document is a review of the product its source number names; the label gives the rating."""
    return spread(t.documents).join(t.labels, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"), F.expr("CAST(substring(source, 4) AS BIGINT)").alias("product_id"),
        (F.lit(2) + 3 * F.col("quality") - F.col("toxic")).alias("rating"),
        F.col("lang").alias("title"), F.col("text").alias("review_text"),
    )


def tickets(t):
    """Every turn is a ticket, numbered by conversation and turn. The turns get as many digits as the longest conversation needs, three at least."""
    longest = t.conversations.agg(F.max("turn")).first()[0] or 0
    width = 10 ** max(3, len(str(longest)))
    return t.conversations.select(
        (F.col("conv_id") * F.lit(width) + F.col("turn")).cast("bigint").alias("ticket_id"), F.col("role").alias("subject"), F.col("text").alias("body"))


def sources(t):
    body = scalars.redact(F.col("body"), phone_pattern=PHONES)
    return (
        docs.product_documents(catalog(t))
        .unionByName(docs.review_documents(article_reviews(t), catalog(t)))
        .unionByName(docs.ticket_documents(tickets(t), body))
    )


# The wording of the document templates.
SQL_SOURCES = rf"""catalog AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand, p_size,
  CAST(p_retailprice AS DECIMAL(10,2)) AS list_price FROM part),
article_reviews AS (SELECT d.doc_id AS review_id, CAST(substr(source, 4) AS BIGINT) AS product_id, 2 + 3 * quality - toxic AS rating,
  lang, text FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
sources AS (SELECT 'Product' AS source_type, product_id AS source_id, product_name || '. Category: ' || category || '. Brand: ' || brand
  || '. Size ' || p_size || '.' || CASE WHEN p_size >= 25 THEN ' Waterproof.' ELSE '' END AS doc_text FROM catalog WHERE p_size <= 45
UNION ALL SELECT 'Review', review_id, concat('Review of ', product_name, ' (', rating, '/5): ', lang, '. ', text)
  FROM article_reviews JOIN catalog USING (product_id)
UNION ALL SELECT 'Ticket', conv_id * (SELECT CAST(10 ** greatest(3, length(CAST(max(turn) AS VARCHAR))) AS BIGINT) FROM conversations) + turn, role || '. ' || regexp_replace(regexp_replace(text,
  '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}', '[email]', 'g'), '{PHONES}', '[phone]', 'g') FROM conversations)"""


@query("source_documents", f"WITH {SQL_SOURCES} SELECT * FROM sources")
def source_documents(t):
    return sources(t)


def sql_chunks(source, key, text, size, step):
    """Chunk rows of a text column, as SQL."""
    return f"""(SELECT {key}, i AS chunk_order, (i - 1) * {step} + 1 AS chunk_offset,
      substr({text}, (i - 1) * {step} + 1, {size}) AS chunk_text
      FROM (SELECT *, unnest(range(1, 2 + greatest(0, CAST(ceil((length({text}) - {size}) / {step}.0) AS BIGINT)))) AS i
            FROM {source} WHERE length({text}) > 0))"""


@query("chunk_fixed", f"""SELECT doc_id, chunk_order, chunk_offset, chunk_text, length(chunk_text) AS chunk_length
FROM {sql_chunks('documents', 'doc_id', 'text', 500, 450)}""")
def chunk_fixed(t):
    return docs.chunk_fixed(spread(t.documents.select("doc_id", "text")), "text").select(
        "doc_id", F.col("chunk_order").cast("bigint"), F.col("chunk_offset").cast("bigint"), "chunk_text",
        F.col("chunk_length").cast("bigint"))


@query("chunk_fixed_small", f"""SELECT doc_id, chunk_order, chunk_offset, chunk_text, length(chunk_text) AS chunk_length
FROM {sql_chunks('documents', 'doc_id', 'text', 150, 135)}""")
def chunk_fixed_small(t):
    return docs.chunk_fixed(spread(t.documents.select("doc_id", "text")), "text", 150, 10).select(
        "doc_id", F.col("chunk_order").cast("bigint"), F.col("chunk_offset").cast("bigint"), "chunk_text",
        F.col("chunk_length").cast("bigint"))


@query("chunk_function", f"""SELECT doc_id, chunk_order, chunk_offset, md5(chunk_text) AS text_md5
FROM {sql_chunks('documents', 'doc_id', 'text', 500, 450)}""")
def chunk_function(t):
    """Chunks by a table function that SQL calls for each row."""
    docs.register_chunk_function(t.spark)
    spread(t.documents.select("doc_id", "text")).createOrReplaceTempView("lakeops_chunk_texts")
    return t.spark.sql("""SELECT doc_id, CAST(c.chunk_order AS BIGINT) AS chunk_order, CAST(c.chunk_offset AS BIGINT) AS chunk_offset, md5(c.chunk_text) AS text_md5
      FROM lakeops_chunk_texts, LATERAL lakeops_chunks(text, 500, 10) AS c""")


SQL_CHUNKS = f"""{SQL_SOURCES}, chunks AS (SELECT CASE source_type WHEN 'Product' THEN 1 WHEN 'Review' THEN 2 ELSE 3 END
  * 1000000000000000000 + source_id * 1000000 + chunk_order AS id, source_type, source_id, chunk_order, chunk_text AS text
  FROM {sql_chunks('sources', 'source_type, source_id', 'doc_text', 500, 450)})"""


@query("chunk_profile", f"""WITH {SQL_CHUNKS} SELECT source_type, count(*) AS chunks, CAST(sum(length(rtrim(text))) // count(*) AS BIGINT) AS avg_chars,
  'toy-hash-768' AS model, 768 AS dims, 4 * 768 * count(*) AS vector_bytes FROM chunks GROUP BY 1""")
def chunk_profile(t):
    return docs.chunk_profile(docs.embed_chunks(docs.content_chunks(sources(t))), "source_type")


def old_chunk_table(t):
    """A chunk table to refresh: built from an earlier state of the sources.

    English reviews, all products (inactive ones too) and tickets by users and assistants have
    chunks; chunks of toxic reviews are stale.
    """
    products = docs.product_documents(catalog(t).withColumn("is_active", F.lit(True)))
    reviews = docs.review_documents(article_reviews(t).where("title = 'en'"), catalog(t))
    closed = docs.ticket_documents(tickets(t).where("subject <> 'system'"), F.col("body"))
    toxic = t.labels.where("toxic = 1").select(F.lit("Review").alias("source_type"), F.col("doc_id").alias("source_id"),
                                              F.lit(True).alias("_toxic"))
    chunks = docs.embed_chunks(docs.content_chunks(products.unionByName(reviews).unionByName(closed)))
    return chunks.join(toxic, ["source_type", "source_id"], "left").withColumn(
        "is_stale", F.coalesce("_toxic", F.lit(False))).drop("_toxic")


@query("refresh_chunks", f"""WITH {SQL_CHUNKS}, cw AS {sql_words('chunks', 'id', 'text')}
SELECT c.id AS chunk_id, source_type, source_id, chunk_order, md5(text) AS text_md5, CAST(coalesce(n, 0) AS BIGINT) AS vector_sum, FALSE AS is_stale
FROM chunks c LEFT JOIN (SELECT id, count(*) AS n FROM cw GROUP BY 1) w ON w.id = c.id""")
def refresh_chunks(t):
    stored = materialize(old_chunk_table(t), "chunk_table")
    return docs.refresh_chunks(stored, sources(t)).select(
        "chunk_id", "source_type", "source_id", F.col("chunk_order").cast("bigint"), F.md5("chunk_text").alias("text_md5"), vector_sum().alias("vector_sum"), "is_stale")


@query("refresh_actions", f"""WITH {SQL_SOURCES}, have AS (
  SELECT 'Product' AS source_type, product_id AS source_id, FALSE AS stale FROM catalog
  UNION ALL SELECT 'Review', review_id, review_id IN (SELECT doc_id FROM labels WHERE toxic = 1) FROM article_reviews
    JOIN catalog USING (product_id) WHERE lang = 'en'
  UNION ALL SELECT 'Ticket', conv_id * (SELECT CAST(10 ** greatest(3, length(CAST(max(turn) AS VARCHAR))) AS BIGINT) FROM conversations) + turn, FALSE FROM conversations WHERE role <> 'system')
SELECT coalesce(h.source_type, s.source_type) AS source_type, CASE WHEN s.source_id IS NULL THEN 'orphan' WHEN h.source_id IS NULL THEN 'new'
  WHEN stale THEN 'stale' ELSE 'kept' END AS action, count(*) AS sources
FROM have h FULL JOIN (SELECT source_type, source_id FROM sources) s USING (source_type, source_id) GROUP BY 1, 2""")
def refresh_actions(t):
    return docs.refresh_actions(old_chunk_table(t), sources(t)).groupBy("source_type", "action").agg(
        F.count(F.lit(1)).alias("sources"))


@query("merge_staged_vectors", f"""WITH {SQL_CHUNKS}, m AS (SELECT id, source_type, source_id, chunk_order, text FROM chunks
  WHERE NOT (source_type = 'Review' AND source_id IN (SELECT doc_id FROM labels WHERE quality = 0 OR toxic = 1))
UNION ALL SELECT 2000000000000000001 + doc_id * 1000000, 'Review', doc_id, 1, text FROM documents JOIN labels USING (doc_id) WHERE quality = 0 AND toxic = 0),
mw AS {sql_words('m', 'id', 'text')}
SELECT m.id AS chunk_id, source_type, source_id, chunk_order, md5(text) AS text_md5, CAST(coalesce(n, 0) AS BIGINT) AS vector_sum
FROM m LEFT JOIN (SELECT id, count(*) AS n FROM mw GROUP BY 1) w ON w.id = m.id""")
def merge_staged_vectors(t):
    """Poor reviews come back staged as a whole, toxic ones are deleted."""
    chunks = docs.embed_chunks(docs.content_chunks(sources(t))).withColumn("is_stale", F.lit(False))
    staged = t.documents.join(t.labels.where("quality = 0 AND toxic = 0"), "doc_id").select(
        F.col("doc_id").alias("review_id"), F.col("text").alias("chunk_text"),
        F.to_json(embedding.toy_embedding(F.col("text"))).alias("embedding_json"), F.lit("staged").alias("model"))
    deleted = t.labels.where("toxic = 1").select(F.col("doc_id").alias("review_id"))
    return docs.merge_staged_vectors(chunks, staged, deleted).select(
        "chunk_id", "source_type", "source_id", F.col("chunk_order").cast("bigint"), F.md5("chunk_text").alias("text_md5"), vector_sum().alias("vector_sum"))


def vector_sum():
    """The sum of a chunk's vector: how many words it counts."""
    return F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x).cast("bigint")


# ---- vector search -----------------------------------------------------------------------------

def label_centres(t):
    """One query vector per label: the mean of its vectors, of whatever length."""
    return mean_vectors(t.embeddings.select(F.col("label").cast("bigint").alias("query_id"), "embedding"), "query_id", "embedding", "query_vector")


def stored_vectors(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), "embedding", "label")


SQL_CENTRES = """centres AS (SELECT query_id, list(part ORDER BY pos) AS q FROM (SELECT query_id, pos, avg(CAST(x AS DOUBLE)) AS part
  FROM (SELECT label AS query_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2) GROUP BY 1)"""


def sql_knn(where, k):
    return f"""WITH {SQL_CENTRES}, d AS (SELECT CAST(query_id AS BIGINT) AS query_id, vec_id AS id, round(1 - {SQL_DOT.format('embedding', 'q')}
  / (sqrt({SQL_DOT.format('embedding', 'embedding')}) * sqrt({SQL_DOT.format('q', 'q')})), 6) AS distance FROM embeddings, centres {where})
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d) WHERE rank <= {k}"""


@query("knn_exact", sql_knn("", 10))
def knn_exact(t):
    return nearest.knn_exact(stored_vectors(t), label_centres(t), 10)


@query("knn_filtered", sql_knn("WHERE vec_id IN (SELECT doc_id FROM labels WHERE quality = 0)", 5))
def knn_filtered(t):
    poor = t.labels.where("quality = 0").select(F.col("doc_id").alias("id"))
    return nearest.knn_exact(stored_vectors(t).join(poor, "id", "left_semi"), label_centres(t), 5)


@query("ann_search")
def ann_search(t):
    index = nearest.build_cell_index(stored_vectors(t), keep=("label",))
    return nearest.ann_search(index, label_centres(t), 10)


@query("ann_search_filtered")
def ann_search_filtered(t):
    """The label filter applies while cells are scanned, so each query still gets its full list."""
    index = nearest.build_cell_index(stored_vectors(t), keep=("label",))
    return nearest.ann_search(index, label_centres(t), 10, condition=F.col("label") < 5)


SQL_LISTS_FINE = "SELECT DISTINCT CAST(label AS BIGINT) AS query_id, 10 AS neighbours, TRUE AS distances_exact, TRUE AS filter_kept FROM embeddings"


def list_check(t, found, allowed):
    """Per query: the length of its list, whether each distance is the exact one for its id, whether each row may be there."""
    vectors = stored_vectors(t)
    true = cosine_distance(F.col("embedding"), F.col("query_vector"))
    rows = found.join(vectors, "id").join(label_centres(t), "query_id")
    return rows.groupBy("query_id").agg(
        F.count(F.lit(1)).cast("int").alias("neighbours"), F.bool_and(F.abs(true - F.col("distance")) < 1e-5).alias("distances_exact"),
        F.bool_and(allowed).alias("filter_kept"))


@query("ann_lists_check", SQL_LISTS_FINE)
def ann_lists_check(t):
    return list_check(t, ann_search(t), F.lit(True))


@query("ann_filtered_lists_check", SQL_LISTS_FINE)
def ann_filtered_lists_check(t):
    return list_check(t, ann_search_filtered(t), F.col("label") < 5)


@query("recall_at_k")
def recall_at_k(t):
    vectors = stored_vectors(t)
    index = nearest.build_cell_index(vectors)
    exact = nearest.knn_exact(vectors, label_centres(t), 10)
    return nearest.recall_at_k(exact, nearest.ann_search(index, label_centres(t), 10), 10)


@query("recall_check", "SELECT count(DISTINCT label) AS queries, TRUE AS average_reached FROM embeddings")
def recall_check(t):
    """The average recall over all queries is 0.95 or more."""
    return recall_at_k(t).agg(F.count(F.lit(1)).alias("queries"), (F.avg("recall") >= 0.95).alias("average_reached"))


@query("hyperplane_lists_check", SQL_LISTS_FINE)
def hyperplane_lists_check(t):
    index = hyperplanes.build(stored_vectors(t), keep=("label",))
    return list_check(t, hyperplanes.search(index, label_centres(t), 10, condition=F.col("label") < 5), F.col("label") < 5)


@query("hyperplane_recall_check", "SELECT count(*) AS queries, TRUE AS average_reached FROM embeddings WHERE vec_id % 50 = 0")
def hyperplane_recall_check(t):
    """Every vector whose id is divisible by 50 as a query: the average recall of its ten nearest is 0.95 or more."""
    asked = t.embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    index = hyperplanes.build(stored_vectors(t))
    found = nearest.recall_at_k(nearest.knn_exact(stored_vectors(t), asked, 10), hyperplanes.search(index, asked, 10), 10)
    return found.agg(F.count(F.lit(1)).alias("queries"), (F.avg("recall") >= 0.95).alias("average_reached"))


@query("stored_index_check", SQL_LISTS_FINE)
def stored_index_check(t):
    """Cells that one step writes and another loads."""
    folder = scratch_path(t.spark, "kept_cells")
    nearest.build_cell_index(stored_vectors(t), keep=("label",), folder=folder)
    return list_check(t, nearest.ann_search(nearest.load_cell_index(t.spark, folder), label_centres(t), 10), F.lit(True))


@query("model_dimension_check", """SELECT label AS model, count(*) AS vectors, CAST(min(len(embedding)) AS INTEGER) AS min_dims,
  CAST(max(len(embedding)) AS INTEGER) AS max_dims, min(len(embedding)) = max(len(embedding)) AS consistent FROM embeddings GROUP BY 1""")
def model_dimension_check(t):
    return docs.dimension_check(t.embeddings.withColumnRenamed("label", "model"), "model", "embedding")


# ---- full text ---------------------------------------------------------------------------------

SQL_TOKENS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '')"


@query("fulltext_contains", f"""WITH w AS (SELECT doc_id, {SQL_TOKENS} AS words FROM documents),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS at FROM w),
s AS (SELECT *, regexp_replace(word, '(ing|ed|es|s)$', '') AS stem FROM p),
near_hits AS (SELECT DISTINCT a.doc_id FROM (SELECT * FROM p WHERE word = 'ering') a JOIN (SELECT * FROM p WHERE word = 'ation') b
  ON a.doc_id = b.doc_id AND abs(a.at - b.at) - 1 <= 10),
near_small AS (SELECT DISTINCT a.doc_id FROM (SELECT * FROM p WHERE word = 'the') a JOIN (SELECT * FROM p WHERE word = 'with') b
  ON a.doc_id = b.doc_id AND abs(a.at - b.at) - 1 <= 3)
SELECT 'inflections' AS rule, doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM s WHERE stem = 'er')
  AND doc_id IN (SELECT doc_id FROM p WHERE word IN ('that', 'than'))
UNION ALL SELECT 'prefix', doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM p WHERE starts_with(word, 'estion'))
UNION ALL SELECT 'near', doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM near_hits) OR doc_id IN (SELECT doc_id FROM near_small)""")
def fulltext_contains(t):
    words = spread(t.documents).select("doc_id", fulltext.tokens(F.col("text")).alias("words"))
    w = F.col("words")
    rules = F.array(
        F.when(fulltext.has_inflection(w, "ering") & (fulltext.has_word(w, "that") | fulltext.has_word(w, "than")), "inflections"),
        F.when(fulltext.has_prefix(w, "estion"), "prefix"),
        F.when(fulltext.near(w, "ering", "ation", 10) | fulltext.near(w, "the", "with", 3), "near"))
    return words.select("doc_id", F.explode(F.array_compact(rules)).alias("rule"))


def questions(t):
    return t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def sql_bm25(prefix, corpus, top):
    """CTEs ranking ``corpus(id, text)`` for the benchmark texts: {prefix}_hits(query_id, id, score, rank)."""
    return f"""{prefix}_q AS (SELECT DISTINCT item_id AS query_id, unnest({SQL_TOKENS}) AS term FROM benchmark),
{prefix}_w AS (SELECT id, {SQL_TOKENS} AS words FROM {corpus}),
{prefix}_n AS (SELECT count(*) AS docs, avg(len(words)) AS avg_len FROM {prefix}_w),
{prefix}_p AS (SELECT id, len, term, count(*) AS tf FROM (SELECT id, len(words) AS len, unnest(words) AS term FROM {prefix}_w)
  WHERE term IN (SELECT term FROM {prefix}_q) GROUP BY 1, 2, 3),
{prefix}_d AS (SELECT term, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf, avg_len FROM {prefix}_p, {prefix}_n GROUP BY term, docs, avg_len),
{prefix}_s AS (SELECT query_id, id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))), 6) AS score
  FROM {prefix}_p JOIN {prefix}_q USING (term) JOIN {prefix}_d USING (term) GROUP BY 1, 2),
{prefix}_hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM {prefix}_s) WHERE rank <= {top})"""


@query("bm25_rank", f"""WITH corpus AS (SELECT doc_id AS id, text FROM documents), {sql_bm25('k', 'corpus', 10)}
SELECT query_id, id, score, rank FROM k_hits""")
def bm25_rank(t):
    return fulltext.bm25(spread(t.documents).select(F.col("doc_id").alias("id"), "text"), questions(t), 10)


@query("bm25_indexed", f"""WITH corpus AS (SELECT doc_id AS id, text FROM documents), {sql_bm25('k', 'corpus', 10)}
SELECT query_id, id, score, rank FROM k_hits""")
def bm25_indexed(t):
    """The same ranking from posting lists: texts are tokenised once, when the index is built."""
    index = postings.build_index(spread(t.documents).select(F.col("doc_id").alias("id"), "text"))
    return postings.search(index, questions(t), 10)


@query("bm25_refreshed", f"""WITH corpus AS (SELECT doc_id AS id, text FROM documents
  WHERE NOT (lang = 'en' AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 0))), {sql_bm25('k', 'corpus', 10)}
SELECT query_id, id, score, rank FROM k_hits""")
def bm25_refreshed(t):
    """English documents are indexed first; then the poor ones leave and those in other languages come."""
    texts = spread(t.documents).select(F.col("doc_id").alias("id"), "text", "lang")
    index = postings.build_index(texts.where("lang = 'en'"))
    poor = t.labels.where("quality = 0").select(F.col("doc_id").alias("id"))
    index = postings.refresh_index(index, poor, texts.where("lang <> 'en' OR lang IS NULL"))
    return postings.search(index, questions(t), 10)


@query("word_document_counts", f"""SELECT word, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest({SQL_TOKENS}) AS word FROM documents) GROUP BY 1""")
def word_document_counts(t):
    """How many documents hold each word, read off the postings alone."""
    index = postings.build_index(spread(t.documents).select(F.col("doc_id").alias("id"), "text"))
    return index.postings(t.spark, entries=False).groupBy(F.col("term").alias("word")).agg(F.sum("n").alias("n"))


# ---- hybrid ------------------------------------------------------------------------------------

def sql_semantic(prefix, corpus, top, where=""):
    """CTEs ranking ``corpus(id, text)`` by toy-embedding distance: {prefix}_hits(query_id, id, distance, rank)."""
    return f"""{prefix}_cw AS {sql_words(corpus, 'id', 'text')}, {prefix}_qw AS {sql_words('benchmark', 'item_id', 'text')},
{prefix}_h AS (SELECT word, {SQL_BUCKET} AS bucket FROM (SELECT word FROM {prefix}_cw UNION SELECT word FROM {prefix}_qw)),
{prefix}_c AS (SELECT id, bucket, count(*) AS n FROM {prefix}_cw JOIN {prefix}_h USING (word) GROUP BY 1, 2),
{prefix}_q AS (SELECT item_id AS query_id, bucket, count(*) AS n FROM {prefix}_qw JOIN {prefix}_h USING (word) GROUP BY 1, 2),
{prefix}_cn AS (SELECT id, sqrt(sum(n * n)) AS norm FROM {prefix}_c GROUP BY 1),
{prefix}_qn AS (SELECT query_id, sqrt(sum(n * n)) AS norm FROM {prefix}_q GROUP BY 1),
{prefix}_dot AS (SELECT query_id, id, sum(q.n * c.n) AS dot FROM {prefix}_q q JOIN {prefix}_c c USING (bucket) GROUP BY 1, 2),
{prefix}_s AS (SELECT q.query_id, c.id, round(1 - coalesce(dot, 0) / (c.norm * q.norm), 6) + 0.0 AS distance
  FROM {prefix}_qn q CROSS JOIN {prefix}_cn c LEFT JOIN {prefix}_dot d ON d.query_id = q.query_id AND d.id = c.id {where}),
{prefix}_hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM {prefix}_s) WHERE rank <= {top})"""


# Both lists one below the other; a document's score is the sum over the places it has.
SQL_FUSED = """places AS (SELECT query_id, id, rank, 'k' AS list FROM k_hits UNION ALL SELECT query_id, id, rank, 's' FROM s_hits),
fused AS (SELECT query_id, id, max(rank) FILTER (WHERE list = 'k') AS keyword_rank, max(rank) FILTER (WHERE list = 's') AS semantic_rank,
  sum(CAST(1 AS DOUBLE) / (60 + rank) ORDER BY list) AS score FROM places GROUP BY query_id, id)"""


def sql_hybrid(top, only=None):
    where = f"WHERE c.id IN (SELECT id FROM chunks WHERE source_type = '{only}')" if only else ""
    kept = f"WHERE source_type = '{only}'" if only else ""
    return f"""{SQL_CHUNKS}, {sql_bm25('k', 'chunks', 50)}, {sql_semantic('s', 'chunks', 50, where)}, {SQL_FUSED},
hybrid AS (SELECT query_id, id, source_type, source_id, chunk_order, text, keyword_rank, semantic_rank, position,
  CAST(score AS DECIMAL(9,6)) AS rrf_score FROM (SELECT f.*, source_type, source_id, chunk_order, text,
  row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS position FROM fused f JOIN chunks USING (id) {kept}) WHERE position <= {top})"""


def corpus_of(t):
    """Chunks of all sources with vectors, written once because both lists read them."""
    chunks = docs.embed_chunks(docs.content_chunks(sources(t)))
    return materialize(chunks.select(
        F.col("chunk_id").alias("id"), "source_type", "source_id", "chunk_order", F.col("chunk_text").alias("text"), "embedding"), "corpus", small=True)


HYBRID_COLUMNS = ("query_id", "id", "source_type", "source_id", "keyword_rank", "semantic_rank", "position", "rrf_score")


@query("hybrid_rrf", f"WITH {sql_hybrid(10)} SELECT {', '.join(HYBRID_COLUMNS)} FROM hybrid")
def hybrid_rrf(t):
    return hybrid.hybrid_search(corpus_of(t), questions(t)).select(*HYBRID_COLUMNS)


@query("hybrid_rrf_indexed", f"WITH {sql_hybrid(10)} SELECT {', '.join(HYBRID_COLUMNS)} FROM hybrid")
def hybrid_rrf_indexed(t):
    """The keyword list comes from postings; no chunk is tokenised for a question."""
    corpus = corpus_of(t)
    return hybrid.hybrid_search(corpus, questions(t), text_index=postings.build_index(corpus)).select(*HYBRID_COLUMNS)


@query("hybrid_approximate_check", "SELECT count(DISTINCT item_id) AS queries, TRUE AS lists_full, TRUE AS average_reached FROM benchmark")
def hybrid_approximate_check(t):
    """Both indexes: each question has its ten rows, and on average nine of them or more are those of the exact search."""
    corpus = corpus_of(t)
    index, text_index = nearest.build_cell_index(corpus), postings.build_index(corpus)
    found = hybrid.hybrid_search(corpus, questions(t), index=index, text_index=text_index).select("query_id", "id")
    exact = hybrid.hybrid_search(corpus, questions(t), text_index=text_index).select("query_id", "id", F.lit(1).alias("_hit"))
    each = found.join(exact, ["query_id", "id"], "left").groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.count("_hit").alias("hits"))
    return each.agg(F.count(F.lit(1)).alias("queries"), F.bool_and(F.col("n") == 10).alias("lists_full"), (F.avg("hits") >= 9).alias("average_reached"))


@query("hybrid_rrf_tickets", f"WITH {sql_hybrid(5, 'Ticket')} SELECT {', '.join(HYBRID_COLUMNS)} FROM hybrid")
def hybrid_rrf_tickets(t):
    return hybrid.hybrid_search(corpus_of(t), questions(t), top=5, condition=F.col("source_type") == "Ticket").select(*HYBRID_COLUMNS)


GRID = [(10, 1.0, 1.0), (60, 1.0, 1.0), (200, 1.0, 1.0), (60, 0.5, 1.0)]


def document_corpus(t):
    """Whole documents with vectors."""
    texts = spread(t.documents).select(F.col("doc_id").alias("id"), "text")
    return materialize(texts.withColumn("embedding", embedding.toy_embedding(F.col("text"))), "document_corpus")


SQL_DOCUMENT_LISTS = f"corpus AS (SELECT doc_id AS id, text FROM documents), {sql_bm25('k', 'corpus', 50)}, {sql_semantic('s', 'corpus', 50)}, {SQL_FUSED}"


@query("weighted_rrf", f"""WITH {SQL_DOCUMENT_LISTS}, grid AS (SELECT * FROM (VALUES (10, 1.0, 1.0), (60, 1.0, 1.0), (200, 1.0, 1.0), (60, 0.5, 1.0)) g(k, kw, sw)),
w AS (SELECT query_id, id, k, CAST(kw AS DOUBLE) AS keyword_weight, CAST(sw AS DOUBLE) AS semantic_weight,
  sum(CAST(CASE list WHEN 'k' THEN kw ELSE sw END AS DOUBLE) / (k + rank) ORDER BY list) AS score FROM places, grid GROUP BY ALL)
SELECT query_id, k, keyword_weight, semantic_weight, id, position, CAST(score AS DECIMAL(9,6)) AS rrf_score FROM (SELECT *, row_number() OVER
  (PARTITION BY query_id, k, keyword_weight, semantic_weight ORDER BY score DESC, id) AS position FROM w) WHERE position <= 5""")
def weighted_rrf(t):
    keyword, semantic = hybrid.candidate_lists(document_corpus(t), questions(t), 50)
    return hybrid.weighted_grid(keyword, semantic, GRID, 5).select(
        "query_id", "k", "keyword_weight", "semantic_weight", "id", "position", "rrf_score")


SQL_STRATEGIES = f"""{SQL_DOCUMENT_LISTS}, strategies AS (
  SELECT 'keyword' AS strategy, query_id, id, rank AS position FROM k_hits WHERE rank <= 5
  UNION ALL SELECT 'semantic', query_id, id, rank FROM s_hits WHERE rank <= 5
  UNION ALL SELECT 'hybrid', query_id, id, position FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS position
    FROM fused) WHERE position <= 5)"""


def strategies(t):
    """Top five per strategy; the two lists are written once and read by all three strategies."""
    keyword, semantic = hybrid.candidate_lists(document_corpus(t), questions(t), 50)
    keyword, semantic = materialize(keyword, "keyword_list"), materialize(semantic, "semantic_list")
    fused = hybrid.best(hybrid.fuse(keyword, semantic), 5)

    def part(name, df, rank):
        return df.where(F.col(rank) <= 5).select(F.lit(name).alias("strategy"), "query_id", "id", F.col(rank).alias("position"))

    return (part("keyword", keyword, "keyword_rank").unionByName(part("semantic", semantic, "semantic_rank"))
            .unionByName(part("hybrid", fused, "position")))


@query("compare_strategies", f"WITH {SQL_STRATEGIES} SELECT * FROM strategies")
def compare_strategies(t):
    return strategies(t)


@query("strategy_overlaps", f"""WITH {SQL_STRATEGIES}, pairs AS (SELECT x.strategy AS first, y.strategy AS second, x.query_id, count(*) AS shared
  FROM strategies x JOIN strategies y ON x.query_id = y.query_id AND x.id = y.id AND x.strategy < y.strategy GROUP BY ALL)
SELECT first, second, CAST(sum(shared) AS BIGINT) AS shared, count(*) AS queries FROM pairs GROUP BY 1, 2""")
def strategy_overlaps(t):
    """How many results two strategies share, and in how many questions they share any."""
    return hybrid.overlaps(materialize(strategies(t), "strategies"))


SWEEP = (20, 50, 200)


@query("candidate_sweep", f"""WITH corpus AS (SELECT doc_id AS id, text FROM documents), {sql_bm25('k', 'corpus', 200)}, {sql_semantic('s', 'corpus', 200)},
depths AS (SELECT * FROM (VALUES (20), (50), (200)) d(candidates)),
places AS (SELECT query_id, id, rank, 'k' AS list FROM k_hits UNION ALL SELECT query_id, id, rank, 's' FROM s_hits),
scored AS (SELECT candidates, query_id, id, sum(CAST(1 AS DOUBLE) / (60 + rank) ORDER BY list) AS score FROM places, depths WHERE rank <= candidates GROUP BY ALL)
SELECT candidates, query_id, id, position, CAST(score AS DECIMAL(9,6)) AS rrf_score
FROM (SELECT *, row_number() OVER (PARTITION BY candidates, query_id ORDER BY score DESC, id) AS position FROM scored) WHERE position <= 5""")
def candidate_sweep(t):
    keyword, semantic = hybrid.candidate_lists(document_corpus(t), questions(t), max(SWEEP))
    return hybrid.depth_sweep(materialize(keyword, "keyword_list"), materialize(semantic, "semantic_list"), SWEEP, 5).select(
        "candidates", "query_id", "id", "position", "rrf_score")


@query("precision_at_k", f"""WITH {SQL_STRATEGIES}, judged AS (SELECT item_id AS query_id, doc_id AS id FROM benchmark b JOIN documents d ON contains(d.text, b.text))
SELECT strategy, s.query_id, count(j.id) / 5.0 AS precision FROM strategies s LEFT JOIN judged j ON j.query_id = s.query_id AND j.id = s.id GROUP BY 1, 2""")
def precision_at_k(t):
    judged = fulltext.contains_passage(spread(t.documents), t.benchmark).select(
        F.col("item_id").alias("query_id"), F.col("doc_id").alias("id"))
    return hybrid.precision_at_k(strategies(t), judged, 5)


# ---- grounded prompts --------------------------------------------------------------------------

def context_of(t, top):
    return materialize(hybrid.hybrid_search(corpus_of(t), questions(t), top=top), "context")


SQL_FACTS = f"""{sql_hybrid(6)}, wanted AS (SELECT query_id, source_id AS product_id FROM hybrid WHERE source_type = 'Product'
  UNION SELECT query_id, r.product_id FROM hybrid h JOIN article_reviews r ON r.review_id = h.source_id WHERE h.source_type = 'Review'),
rated AS (SELECT product_id, sum(rating) AS total, count(*) AS n FROM article_reviews WHERE rating IS NOT NULL GROUP BY 1)"""


@query("rag_facts", f"""WITH {SQL_FACTS} SELECT query_id, product_id, product_name, category, list_price,
  '{{"size":' || p_size || ',"waterproof":' || CASE WHEN p_size >= 25 THEN 'true' ELSE 'false' END || '}}' AS attributes,
  CAST(CAST((200 * total + n) // (2 * n) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(3,2)) AS avg_rating, coalesce(n, 0) AS review_count
FROM wanted JOIN catalog USING (product_id) LEFT JOIN rated USING (product_id)""")
def rag_facts(t):
    return rag.product_facts(context_of(t, 6), catalog(t), article_reviews(t))


@query("rag_payload", f"""WITH {SQL_FACTS},
f AS (SELECT query_id, string_agg('{{"productId":' || product_id || ',"name":' || to_json(product_name) || ',"category":' || to_json(category) || ',"priceEur":'
  || list_price || ',"attributes":{{"size":' || p_size || ',"waterproof":' || CASE WHEN p_size >= 25 THEN 'true' ELSE 'false' END || '}}'
  || coalesce(',"avgRating":' || CAST(CAST((200 * total + n) // (2 * n) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(3,2)), '') || ',"reviewCount":' || coalesce(n, 0) || '}}',
  ',' ORDER BY product_id) AS facts FROM wanted JOIN catalog USING (product_id) LEFT JOIN rated USING (product_id) GROUP BY 1),
s AS (SELECT query_id, string_agg('{{"id":' || id || ',"type":"' || source_type || '","text":' || to_json(text) || '}}', ',' ORDER BY position) AS found FROM hybrid GROUP BY 1),
u AS (SELECT item_id AS query_id, 'Question: ' || text || chr(10) || 'Product facts (JSON): [' || coalesce(facts, '') || ']' || chr(10)
  || 'Sources (JSON): [' || coalesce(found, '') || ']' AS content FROM benchmark LEFT JOIN f ON f.query_id = item_id LEFT JOIN s ON s.query_id = item_id),
p AS (SELECT query_id, '{{"messages":[{{"role":"system","content":' || to_json('{rag.DEFAULT_RULES}') || '}},{{"role":"user","content":' || to_json(content)
  || '}}],"temperature":0.1,"max_tokens":700,"response_format":{{"type":"json_schema","json_schema":' || '{rag.ANSWER_SCHEMA}' || '}}}}' AS payload FROM u)
SELECT query_id, payload, length(payload) // 4 AS rough_tokens FROM p""")
def rag_payload(t):
    context = context_of(t, 6)
    return rag.payloads(questions(t), context, rag.product_facts(context, catalog(t), article_reviews(t)))


@query("context_budget", f"""WITH {sql_hybrid(10)}, r AS (SELECT query_id, id, position, CAST(sum(length(text) // 4) OVER (PARTITION BY query_id ORDER BY position
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_tokens FROM hybrid) SELECT * FROM r WHERE running_tokens <= 600""")
def context_budget(t):
    return rag.context_budget(context_of(t, 10), 600).select("query_id", "id", "position", "running_tokens")


def model_responses(t):
    """Wrapped model replies built from the conversations: system turns are failed calls."""
    ok = F.col("role") != "system"
    content = F.to_json(F.struct(
        F.col("text").alias("answer"), F.array(F.col("turn"), F.col("turn") + 1).alias("source_ids"),
        F.when(F.col("role") == "user", "low").otherwise("high").alias("confidence")))
    body = F.struct(
        F.struct(F.struct(F.struct(F.when(ok, 200).otherwise(503).alias("code")).alias("http")).alias("status")).alias("response"),
        F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices"),
                 F.struct(F.length("text").alias("prompt_tokens"), F.col("turn").alias("completion_tokens")).alias("usage")).alias("result"))
    return t.conversations.select("conv_id", "turn", F.to_json(body).alias("response"))


SQL_PARSED = """parsed AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN 503 ELSE 200 END AS http_status,
  CASE WHEN role <> 'system' THEN text END AS answer, CASE role WHEN 'user' THEN 'low' WHEN 'system' THEN NULL ELSE 'high' END AS confidence,
  CASE WHEN role <> 'system' THEN turn || ',' || (turn + 1) END AS cited,
  CASE WHEN role <> 'system' THEN CAST(length(text) AS INTEGER) END AS prompt_tokens,
  CASE WHEN role <> 'system' THEN CAST(turn AS INTEGER) END AS completion_tokens,
  CASE WHEN role = 'system' THEN 'Model call failed (HTTP 503)' END AS error FROM conversations)"""


@query("parse_model_responses", f"WITH {SQL_PARSED} SELECT * FROM parsed")
def parse_model_responses(t):
    parsed = rag.parse_responses(model_responses(t)).drop("response")
    cited = F.concat_ws(",", F.transform("source_ids", lambda i: i.cast("string")))
    return parsed.withColumn("cited", F.when(F.col("source_ids").isNotNull(), cited)).drop("source_ids")


@query("resolve_citations", """SELECT a.conv_id AS query_id, b.turn AS id, count(*) AS times, any_value(b.role) AS role FROM conversations a
JOIN conversations b ON b.conv_id = a.conv_id AND b.turn IN (a.turn, a.turn + 1) WHERE a.role <> 'system' GROUP BY 1, 2""")
def resolve_citations(t):
    context = t.conversations.select(F.col("conv_id").alias("query_id"), F.col("turn").alias("id"), "role")
    parsed = rag.parse_responses(model_responses(t).withColumnRenamed("conv_id", "query_id").withColumnRenamed("turn", "asked"))
    cited = parsed.select("query_id", "asked", F.explode("source_ids").alias("id"))
    return cited.join(context, ["query_id", "id"]).groupBy("query_id", "id").agg(
        F.count(F.lit(1)).alias("times"), F.min("role").alias("role"))


@query("chat_log_stats", f"""WITH {SQL_PARSED} SELECT http_status, confidence, count(*) AS questions, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
  CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, max(prompt_tokens) AS largest_prompt,
  CAST(sum(duration_ms) AS BIGINT) AS total_ms, max(duration_ms) AS longest_ms
FROM (SELECT *, 40 * turn + coalesce(length(answer), 0) AS duration_ms FROM parsed) GROUP BY 1, 2""")
def chat_log_stats(t):
    """The time a call took is the time between asking and answering."""
    asked = F.timestamp_seconds(F.lit(1_000_000_000) + F.col("conv_id"))
    took = 40 * F.col("turn") + F.coalesce(F.length("answer"), F.lit(0))
    logged = rag.parse_responses(model_responses(t)).withColumn("asked_at", asked).withColumn(
        "answered_at", F.timestamp_add("MILLISECOND", took, F.col("asked_at")))
    return rag.log_stats(logged, ["http_status", "confidence"], "asked_at", "answered_at")
