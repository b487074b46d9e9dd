"""Feature-hashing text embedding: words are stemmed, hashed to buckets and counted."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from lakeops.session import tasks_for

DIMENSIONS = 768

# Words that carry no meaning for the embedding.
STOP_WORDS = (
    "the", "and", "for", "with", "this", "that", "but", "was", "are", "after",
    "from", "very", "its", "not", "you", "your", "had", "has", "have", "all",
    "one", "out", "into", "over", "built", "review", "category", "brand",
)
# Fixed value: endings removed by the crude stemmer.
SUFFIX_PATTERN = "(ing|ed|es|s)$"
_SUFFIX = re.compile(SUFFIX_PATTERN)


def stem(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), SUFFIX_PATTERN, "")


def embedding_words(text: Column) -> Column:
    """Stemmed words longer than two letters; stop words and length are judged before stemming."""
    words = F.split(F.regexp_replace(text, "[^A-Za-z]+", " "), " ")
    kept = F.filter(words, lambda w: (F.length(w) > 2) & ~F.lower(w).isin(*STOP_WORDS))
    return F.transform(kept, stem)


def bucket_of(word: Column, dims: int = DIMENSIONS) -> Column:
    """First four bytes of SHA-256 over the UTF-16LE word, big-endian, modulo ``dims``."""
    digest = F.sha2(F.encode(word, "UTF-16LE"), 256)
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % dims).cast("int")


def buckets(text: Column, dims: int = DIMENSIONS) -> Column:
    return F.transform(embedding_words(text), lambda w: bucket_of(w, dims))


ROWS_PER_TASK = 4096


def bucket_counts(rows: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """Hits by ``key`` and bucket of the ``n`` ``rows``.

    Rows are dealt out by key before their words are counted, ``ROWS_PER_TASK`` a task, so a task holds counts of
    those rows only, at most one per row and dimension.
    """
    dealt = rows.select(key, buckets(F.col(text)).alias("_buckets")).repartition(tasks_for(rows.sparkSession, n, ROWS_PER_TASK), key)
    hits = dealt.select(key, F.explode_outer("_buckets").alias("bucket")).where("bucket IS NOT NULL")  # explode would have the words made twice, to filter rows
    return hits.groupBy(key, "bucket").agg(F.count(F.lit(1)).alias("hits"))


def dense(bucket_array: Column, dims: int = DIMENSIONS) -> Column:
    """Bucket counts as a dense float vector; a whole Arrow batch is counted at once."""

    @F.arrow_udf(ArrayType(FloatType()))
    def count(batch: pa.Array) -> pa.Array:
        rows = len(batch)
        row = np.repeat(np.arange(rows), batch.value_lengths().to_numpy(zero_copy_only=False))
        cell = row * dims + batch.flatten().to_numpy(zero_copy_only=False)
        counts = np.bincount(cell, minlength=rows * dims).astype(np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, rows * dims + 1, dims, dtype=np.int32)), pa.array(counts))

    return count(F.coalesce(bucket_array, F.array().cast("array<int>")))


def _bucket(word: str, dims: int) -> int:
    """The bucket of one word as it stands, by the rules above; -1 for words that do not count."""
    low = word.lower()
    if len(word) <= 2 or low in STOP_WORDS:
        return -1
    digest = hashlib.sha256(_SUFFIX.sub("", low).encode("utf-16-le")).digest()
    return int.from_bytes(digest[:4], "big") % dims


ROWS_AT_ONCE = 1024


def toy_embedding(text: Column, dims: int = DIMENSIONS) -> Column:
    """The counts of ``dense(buckets(text))``; each distinct word of an Arrow batch is stemmed and hashed once."""

    @F.arrow_udf(ArrayType(FloatType()))
    def count(batch: pa.Array) -> pa.Array:
        rows = len(batch)
        words = batch.flatten().dictionary_encode()
        bucket = np.array([_bucket(w, dims) for w in words.dictionary.to_pylist()], np.int64)
        lengths = pc.fill_null(batch.value_lengths(), 0).to_numpy(zero_copy_only=False)
        found = bucket[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, np.int64)
        counts, ends = np.empty(rows * dims, np.float32), np.concatenate([[0], np.cumsum(lengths)])
        for low in range(0, rows, ROWS_AT_ONCE):
            high = min(low + ROWS_AT_ONCE, rows)
            part = found[ends[low]:ends[high]]
            cell = (np.repeat(np.arange(high - low), lengths[low:high]) * dims + part)[part >= 0]
            counts[low * dims:high * dims] = np.bincount(cell, minlength=(high - low) * dims)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, rows * dims + 1, dims, dtype=np.int32)), pa.array(counts))

    return count(F.coalesce(F.split(F.regexp_replace(text, "[^A-Za-z]+", " "), " "), F.array().cast("array<string>")))
