"""Scalar function library over the supplied tables."""

from pyspark.sql import functions as F

from lakeops.functions import embedding, scalars, vectors
from lakeops.operators import json_index
from lakeops.plans.registry import query
from lakeops.session import spread

PHONES = r"\+[0-9] \([0-9]{3}\) [0-9]{3}-[0-9]{4}|" + scalars.PHONE_PATTERN


@query("string_functions", """SELECT c_custkey, concat(c_name, NULL, '/', c_mktsegment) AS joined, left(c_name, 8) AS head,
  right(c_name, 4) AS tail, substr(c_mktsegment, 2, 3) AS middle, length(rtrim(c_mktsegment || '  ')) AS trimmed,
  octet_length(encode(c_name)) AS bytes, lower(c_mktsegment) AS low, lower(c_mktsegment) LIKE 'b%' AS starts_b,
  lower(c_mktsegment) = 'household' AS same_ci, regexp_replace(c_name, '[0-9]+', '#', 'g') AS digits_out,
  coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment, TRY_CAST(c_mktsegment AS INTEGER) AS bad_number,
  levenshtein(c_mktsegment, 'BUILDING') AS edits, c_custkey // 7 AS whole, c_custkey % 7 AS rest FROM customer""")
def string_functions(t):
    segment, name = F.col("c_mktsegment"), F.col("c_name")
    return t.customer.select(
        "c_custkey",
        scalars.concat_nulls_empty(name, F.lit(None), F.lit("/"), segment).alias("joined"),
        F.left(name, F.lit(8)).alias("head"), F.right(name, F.lit(4)).alias("tail"),
        F.substring(segment, 2, 3).alias("middle"),
        scalars.trimmed_length(F.concat(segment, F.lit("  "))).cast("bigint").alias("trimmed"),
        F.octet_length(name).cast("bigint").alias("bytes"), F.lower(segment).alias("low"),
        F.lower(segment).like("b%").alias("starts_b"),
        F.expr("c_mktsegment COLLATE UTF8_LCASE = 'household'").alias("same_ci"),
        F.regexp_replace(name, "[0-9]+", "#").alias("digits_out"),
        F.coalesce(F.nullif(segment, F.lit("BUILDING")), F.lit("none")).alias("segment"),
        segment.try_cast("int").alias("bad_number"),
        F.levenshtein(segment, F.lit("BUILDING")).cast("bigint").alias("edits"),
        F.expr("c_custkey DIV 7").alias("whole"), (F.col("c_custkey") % 7).alias("rest"),
    )


@query("date_functions", """SELECT event_id, ts + INTERVAL 90 SECOND AS plus_90s, date_diff('day', ts, ts + INTERVAL 90 SECOND) AS days_crossed,
  date_sub('hour', TIMESTAMP '2024-01-01', ts) AS whole_hours, CAST(ts AS DATE) AS day, year(ts) AS y, month(ts) AS m,
  CAST(date_trunc('month', ts) AS DATE) AS month_start FROM events""")
def date_functions(t):
    ts = F.col("ts")
    later = F.timestamp_add("SECOND", F.lit(90), ts)
    return t.events.select(
        "event_id", later.alias("plus_90s"), scalars.boundaries_crossed("day", ts, later).alias("days_crossed"),
        F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"), ts).alias("whole_hours"),
        F.to_date(ts).alias("day"), F.year(ts).cast("bigint").alias("y"), F.month(ts).cast("bigint").alias("m"),
        F.trunc(F.to_date(ts), "MM").alias("month_start"),
    )


@query("json_extract", """SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(props->>'$.k' AS INTEGER) AS k,
  json_extract_string(props, '$.missing') AS missing, TRUE AS is_object, FALSE AS is_array,
  '{"id":' || event_id || ',"attributes":{"k":' || (props->>'$.k') || '}}' AS nested,
  '{"id":' || event_id || ',"note":null}' AS with_null, '{"id":' || event_id || '}' AS without_null,
  list_contains([event_type, 'view'], 'click') AS has_click FROM events""")
def json_extract(t):
    props = F.from_json("props", "k INT")
    key = F.col("event_id").alias("id")
    note = F.lit(None).cast("string").alias("note")
    tags = F.from_json(F.to_json(F.array("event_type", F.lit("view"))), "array<string>")
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").alias("k_text"), props["k"].alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"),
        F.schema_of_variant(F.try_parse_json("props")).startswith("OBJECT").alias("is_object"),
        scalars.is_json_array(F.col("props")).alias("is_array"),
        F.to_json(F.struct(key, props.alias("attributes"))).alias("nested"),
        F.to_json(F.struct(key, note), {"ignoreNullFields": "false"}).alias("with_null"),
        F.to_json(F.struct(key, note)).alias("without_null"),
        F.array_contains(tags, "click").alias("has_click"),
    )


@query("json_containing", """SELECT event_id FROM events WHERE CAST(props->>'$.k' AS INTEGER) = 7""")
def json_containing(t):
    """Events whose properties hold k = 7, from the index: one bucket is read."""
    index = json_index.build_json_index(t.events, "event_id", "props", ["$.k"])
    return json_index.containing(index, t.spark, [("$.k", 7)]).select(F.col("key").alias("event_id"))


@query("regex_matches", r"""SELECT doc_id, unnest(regexp_extract_all(text,
  '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS match_value FROM documents""")
def regex_matches(t):
    found = F.regexp_extract_all("text", F.lit(scalars.EMAIL_PATTERN), F.lit(0))
    return spread(t.documents).select("doc_id", F.explode(found).alias("match_value"))


@query("find_and_mask_phones", rf"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '{PHONES}')) AS phone_found FROM documents)
SELECT doc_id, phone_found, regexp_replace(phone_found[:-5], '[0-9]', '*', 'g') || right(phone_found, 4) AS masked FROM m""")
def find_and_mask_phones(t):
    found = F.regexp_extract_all("text", F.lit(PHONES), F.lit(0))
    return spread(t.documents).select("doc_id", F.explode(found).alias("phone_found")).withColumn(
        "masked", scalars.mask_digits_but_last(F.col("phone_found")))


@query("redact_pii", rf"""SELECT doc_id, regexp_replace(regexp_replace(text,
  '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}', '[email]', 'g'), '{PHONES}', '[phone]', 'g') AS text FROM documents""")
def redact_pii(t):
    return spread(t.documents).select("doc_id", scalars.redact(F.col("text"), phone_pattern=PHONES).alias("text"))


SQL_DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))"


@query("vector_distances", f"""WITH v AS (SELECT vec_id, embedding AS a, list_reverse(embedding) AS b FROM embeddings),
d AS (SELECT vec_id, {SQL_DOT.format('a', 'b')} AS ab, {SQL_DOT.format('a', 'a')} AS aa, {SQL_DOT.format('b', 'b')} AS bb FROM v)
SELECT vec_id, round(1 - ab / (sqrt(aa) * sqrt(bb)), 6) AS cosine, round(sqrt(aa + bb - 2 * ab), 6) AS euclidean,
  round(-ab, 6) AS negative_dot FROM d""")
def vector_distances(t):
    a, b = F.col("embedding"), F.reverse(F.col("embedding"))
    return t.embeddings.select(
        "vec_id", F.round(vectors.cosine_distance(a, b), 6).alias("cosine"),
        F.round(vectors.euclidean_distance(a, b), 6).alias("euclidean"),
        F.round(vectors.negative_dot(a, b), 6).alias("negative_dot"),
    )


@query("vector_normalize", f"""WITH n AS (SELECT vec_id, embedding, sqrt({SQL_DOT.format('embedding', 'embedding')}) AS length FROM embeddings)
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims, 4 * len(embedding) AS bytes, round(length, 6) AS length,
  round(embedding[1] / length, 6) AS first, round(embedding[-1] / length, 6) AS last FROM n""")
def vector_normalize(t):
    unit = vectors.normalize(F.col("embedding"))
    return t.embeddings.select(
        "vec_id", F.size("embedding").alias("dims"), (4 * F.size("embedding")).cast("bigint").alias("bytes"),
        F.round(vectors.norm2(F.col("embedding")), 6).alias("length"),
        F.round(F.element_at(unit, 1), 6).alias("first"), F.round(F.element_at(unit, -1), 6).alias("last"),
    )


# SQL twin of the word list and the bucket hash: UTF-16LE by putting a zero byte after each ASCII byte.
SQL_STOP = ", ".join(f"'{w}'" for w in embedding.STOP_WORDS)


def sql_words(source, key, text):
    return f"""(SELECT {key}, regexp_replace(lower(w), '(ing|ed|es|s)$', '') AS word FROM (SELECT {key},
      unnest(string_split(regexp_replace({text}, '[^A-Za-z]+', ' ', 'g'), ' ')) AS w FROM {source})
      WHERE length(w) > 2 AND lower(w) NOT IN ({SQL_STOP}))"""


SQL_BUCKET = r"CAST(('0x' || substr(sha256(unhex(regexp_replace(hex(word), '(..)', '\100', 'g'))), 1, 8)) AS BIGINT) % 768"


@query("hash_buckets", f"""SELECT DISTINCT word, CAST({SQL_BUCKET} AS INTEGER) AS bucket FROM {sql_words('documents', 'doc_id', 'text')}""")
def hash_buckets(t):
    words = spread(t.documents).select(F.explode(embedding.embedding_words(F.col("text"))).alias("word")).distinct()
    return words.withColumn("bucket", embedding.bucket_of(F.col("word")))


@query("toy_embedding", f"""WITH w AS {sql_words('documents', 'doc_id', 'text')},
h AS (SELECT word, CAST({SQL_BUCKET} AS INTEGER) AS bucket FROM (SELECT DISTINCT word FROM w))
SELECT doc_id, bucket, count(*) AS hits FROM w JOIN h USING (word) GROUP BY 1, 2""")
def toy_embedding(t):
    return embedding.bucket_counts(spread(t.documents), t.documents.count(), "doc_id", "text")


@query("toy_embedding_dense", f"""WITH w AS {sql_words('documents', 'doc_id', 'text')},
h AS (SELECT word, CAST({SQL_BUCKET} AS INTEGER) AS bucket FROM (SELECT DISTINCT word FROM w)),
c AS (SELECT doc_id, bucket, count(*) AS hits FROM w JOIN h USING (word) GROUP BY 1, 2),
s AS (SELECT doc_id, CAST(sum(hits) AS DOUBLE) AS total, CAST(sum(hits * hits) AS DOUBLE) AS squares, CAST(max(hits) AS DOUBLE) AS largest FROM c GROUP BY 1)
SELECT doc_id, 768 AS dims, coalesce(total, 0) AS total, coalesce(squares, 0) AS squares, coalesce(largest, 0) AS largest
FROM documents LEFT JOIN s USING (doc_id)""")
def toy_embedding_dense(t):
    vector = spread(t.documents).select("doc_id", embedding.toy_embedding(F.col("text")).alias("v"))
    return vector.select(
        "doc_id", F.size("v").alias("dims"),
        F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double")).alias("total"),
        vectors.dot(F.col("v"), F.col("v")).alias("squares"), F.array_max("v").cast("double").alias("largest"),
    )
