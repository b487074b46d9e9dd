"""Source documents, fixed-size chunks and the chunk table refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.embedding import toy_embedding
from lakeops.functions.scalars import concat_nulls_empty
from lakeops.operators.skew import latest_per_key

MODEL_NAME = "toy-hash-768"
# The number of each source type, and below the wording of the document templates.
SOURCE_NUMBER = {"Product": 1, "Review": 2, "Ticket": 3}


def product_documents(products: DataFrame) -> DataFrame:
    """Name, category, brand and description of active products; volatile values stay out."""
    text = concat_nulls_empty(
        F.col("product_name"), F.lit(". Category: "), F.col("category"), F.lit(". Brand: "), F.col("brand"), F.lit(". "),
        F.col("description"), F.when(F.get_json_object("attributes", "$.waterproof") == "true", " Waterproof.").otherwise(""),
    )
    return products.where("is_active").select(
        F.lit("Product").alias("source_type"), F.col("product_id").alias("source_id"), text.alias("doc_text"))


def review_documents(reviews: DataFrame, products: DataFrame) -> DataFrame:
    text = concat_nulls_empty(
        F.lit("Review of "), F.col("product_name"), F.lit(" ("), F.col("rating"), F.lit("/5): "),
        F.col("title"), F.lit(". "), F.col("review_text"),
    )
    return reviews.join(products.select("product_id", "product_name"), "product_id").select(
        F.lit("Review").alias("source_type"), F.col("review_id").alias("source_id"), text.alias("doc_text"))


def ticket_documents(tickets: DataFrame, redact: Column) -> DataFrame:
    """Subject plus body with personal data removed; ``redact`` is the cleaned body expression."""
    return tickets.select(
        F.lit("Ticket").alias("source_type"), F.col("ticket_id").alias("source_id"),
        concat_nulls_empty(F.col("subject"), F.lit(". "), redact).alias("doc_text"))


def chunk_step(size: int, overlap_percent: int) -> int:
    return size - size * overlap_percent // 100


def chunk_fixed(df: DataFrame, text: str, size: int = 500, overlap_percent: int = 10) -> DataFrame:
    """Fixed-length character chunks; order and offset start at 1 and the last chunk reaches the end."""
    step = chunk_step(size, overlap_percent)
    length = F.length(text)
    count = F.greatest(F.ceil((length - F.lit(size)) / F.lit(step)), F.lit(0)).cast("int") + 1
    starts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: i * step + 1)
    return (
        df.where(length > 0)
        .select("*", F.posexplode(starts).alias("_pos", "chunk_offset"))
        .withColumn("chunk_order", F.col("_pos") + 1)
        .withColumn("chunk_text", F.substring(F.col(text), F.col("chunk_offset"), F.lit(size)))
        .withColumn("chunk_length", F.length("chunk_text"))
        .drop("_pos")
    )


def register_chunk_function(spark: SparkSession, name: str = "lakeops_chunks") -> None:
    """A SQL table function ``name(text, size, overlap_percent)`` with the chunks of ``chunk_fixed``, for LATERAL calls; it runs without Python."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(content STRING, size INT, overlap_percent INT)
      RETURNS TABLE (chunk_order INT, chunk_offset INT, chunk_text STRING, chunk_length INT)
      RETURN SELECT i + 1, i * (size - size * overlap_percent div 100) + 1,
        substring(content, CAST(i * (size - size * overlap_percent div 100) + 1 AS INT), size),
        length(substring(content, CAST(i * (size - size * overlap_percent div 100) + 1 AS INT), size))
      FROM explode(CASE WHEN length(content) > 0 THEN
        sequence(0, CAST(greatest(ceil((length(content) - size) / (size - size * overlap_percent div 100)), 0) AS INT)) END) AS e(i)""")


def chunk_id() -> Column:
    """One integer from source type, source key and chunk order; keys that do not fit are an error, not a collision."""
    number = F.create_map(*[F.lit(x) for pair in SOURCE_NUMBER.items() for x in pair])[F.col("source_type")]
    fits = F.col("source_id").between(0, 10**12 - 1) & F.col("chunk_order").between(0, 10**6 - 1)
    value = number * F.lit(10**18) + F.col("source_id") * F.lit(10**6) + F.col("chunk_order")
    return F.when(fits, value).otherwise(F.raise_error(F.lit("source or chunk number out of range for a chunk id")).cast("bigint"))


def content_chunks(sources: DataFrame, size: int = 500, overlap_percent: int = 10) -> DataFrame:
    """Chunk table rows (without vectors) for source documents."""
    return chunk_fixed(sources, "doc_text", size, overlap_percent).select(
        chunk_id().alias("chunk_id"), "source_type", "source_id", "chunk_order", "chunk_text")


def embed_chunks(chunks: DataFrame) -> DataFrame:
    """Add the embedding and the model that produced it."""
    return chunks.withColumn("embedding", toy_embedding(F.col("chunk_text"))).withColumn(
        "embedding_model", F.lit(MODEL_NAME))


def refresh_actions(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: what a refresh does (``kept``, ``stale``, ``orphan`` or ``new``)."""
    keys = ["source_type", "source_id"]
    have = chunks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("chunks"), F.max("is_stale").alias("_stale"), F.lit(True).alias("_has"))
    want = sources.select(*keys).withColumn("_wanted", F.lit(True))
    return have.join(want, keys, "full").select(
        *keys, F.coalesce("chunks", F.lit(0)).alias("chunks"),
        F.when(F.col("_wanted").isNull(), "orphan").when(F.col("_has").isNull(), "new")
        .when(F.col("_stale"), "stale").otherwise("kept").alias("action"),
    )


def refresh_chunks(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """New chunk table: stale and orphaned chunks leave, sources without chunks are chunked and embedded.

    Vectors of kept chunks are reused; running it again changes nothing.
    """
    keys = ["source_type", "source_id"]
    kept = chunks.where(~F.col("is_stale")).join(sources.select(*keys), keys, "left_semi")
    missing = sources.join(kept.select(*keys).distinct(), keys, "left_anti")
    added = embed_chunks(content_chunks(missing)).withColumn("is_stale", F.lit(False))
    have_vector = kept.where(F.col("embedding").isNotNull())
    late = embed_chunks(kept.where(F.col("embedding").isNull()).drop("embedding", "embedding_model"))
    return have_vector.unionByName(late.select(*kept.columns)).unionByName(added.select(*kept.columns))


def merge_staged_vectors(chunks: DataFrame, staged: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """Replace every chunk of the staged reviews by their one staged chunk, and drop those of ``deleted`` reviews.

    Texts stay whole. A review staged several times keeps one of its newest rows, by ``staged_at`` where that is there.
    """
    if "staged_at" in staged.columns:
        staged = latest_per_key(staged, ["review_id"], ["staged_at", "chunk_text"]).drop("staged_at")
    left = staged.select("review_id")
    gone = left if deleted is None else left.union(deleted.select("review_id"))
    gone = gone.distinct().select(F.lit("Review").alias("source_type"), F.col("review_id").alias("source_id"))
    kept = chunks.join(gone, ["source_type", "source_id"], "left_anti")
    fresh = (
        staged.withColumn("source_type", F.lit("Review"))
        .withColumn("source_id", F.col("review_id"))
        .withColumn("chunk_order", F.lit(1))
        .withColumn("chunk_id", chunk_id())
        .withColumn("embedding", F.from_json("embedding_json", "array<float>"))
        .withColumn("embedding_model", F.col("model"))
        .withColumn("is_stale", F.lit(False))
    )
    return kept.unionByName(fresh.select(*chunks.columns))


def chunk_profile(chunks: DataFrame, by: str) -> DataFrame:
    """Chunk count, whole-number average length, model, dimensions and vector bytes per group.

    Numbers are summed up per group and model first: a least text would make Spark sort all chunks with their vectors.
    """
    per_model = chunks.groupBy(by, "embedding_model").agg(
        F.count(F.lit(1)).alias("_chunks"), F.sum(F.length(F.rtrim("chunk_text"))).alias("_chars"),
        F.min(F.size("embedding")).alias("_dims"), F.sum(F.size("embedding") * 4).alias("_bytes"))
    return per_model.groupBy(by).agg(
        F.sum("_chunks").alias("chunks"),
        F.floor(F.sum("_chars") / F.sum("_chunks")).cast("bigint").alias("avg_chars"),
        F.min("embedding_model").alias("model"),
        F.min("_dims").alias("dims"),
        F.sum("_bytes").cast("bigint").alias("vector_bytes"),
    )


def dimension_check(vectors: DataFrame, model: str, column: str) -> DataFrame:
    """Per model: how many different dimensions occur; more than one is an error."""
    return vectors.groupBy(model).agg(
        F.count(F.lit(1)).alias("vectors"), F.min(F.size(column)).alias("min_dims"), F.max(F.size(column)).alias("max_dims"),
        (F.min(F.size(column)) == F.max(F.size(column))).alias("consistent"))
