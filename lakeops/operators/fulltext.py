"""Word predicates and BM25 ranking."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.embedding import stem
from lakeops.operators.nearest import best_rows, gathered

K1 = 1.2
B = 0.75


# Letters with their accents, and digits, of every script.
SEPARATOR = r"[^\p{L}\p{M}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits of any script."""
    return F.filter(F.split(F.lower(text), SEPARATOR), lambda w: w != "")


def has_word(words: Column, word: str) -> Column:
    return F.array_contains(words, word.lower())


def has_prefix(words: Column, prefix: str) -> Column:
    return F.exists(words, lambda w: w.startswith(prefix.lower()))


def has_inflection(words: Column, word: str) -> Column:
    """Any word with the same stem."""
    wanted = stem(F.lit(word))
    return F.exists(words, lambda w: stem(w) == wanted)


def near(words: Column, first: str, second: str, distance: int) -> Column:
    """Both words with at most ``distance`` other words between two of their occurrences.

    Only the matching positions are kept; the closest pair is always two neighbours among them,
    so one pass over the text is enough.
    """
    a, b = first.lower(), second.lower()
    marked = F.filter(
        F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("w"))), lambda m: m["w"].isin(a, b))
    following = F.slice(marked, F.lit(2), F.greatest(F.size(marked) - 1, F.lit(0)))
    gaps = F.zip_with(F.slice(marked, F.lit(1), F.greatest(F.size(marked) - 1, F.lit(0))), following,
                      lambda x, y: F.when(x["w"] != y["w"], y["at"] - x["at"] - 1))
    return F.exists(gaps, lambda gap: F.coalesce(gap <= distance, F.lit(False)))


def bm25(corpus: DataFrame, queries: DataFrame, top: int, key: str = "id", text: str = "text",
         query_key: str = "query_id", query_text: str = "query_text") -> DataFrame:
    """Best ``top`` rows per query by BM25 over whole texts.

    The corpus is scanned once for word statistics and once for scores. Each task scores its texts
    against the query words and keeps ``top`` rows per query, so (query, text) pairs are never
    shuffled. Queries are handled in blocks of bounded size.
    """
    split = corpus.select(F.col(key).cast("bigint").alias("id"), tokens(F.coalesce(F.col(text), F.lit(""))).alias("words"))

    def scored() -> Iterator[DataFrame]:
        for asked in _query_terms(queries, query_key, query_text):
            vocabulary = sorted({term for terms in asked.values() for term in terms})
            counted = split.select("words").mapInArrow(_word_statistics(vocabulary), "item int, n bigint")
            totals = {r["item"]: r["n"] for r in counted.groupBy("item").agg(F.sum("n").alias("n")).collect()}  # one row per query word
            docs, length = totals.get(_DOCS, 0), totals.get(_LENGTH, 0)
            if docs:
                df = np.array([totals.get(i, 0) for i in range(len(vocabulary))], np.float64)
                idf = dict(zip(vocabulary, np.log(1 + (docs - df + 0.5) / (df + 0.5))))
                yield split.mapInArrow(_word_scores(asked, idf, max(length / docs, 1e-9), top), SCORE_SCHEMA)

    found = gathered(corpus.sparkSession, scored(), SCORE_SCHEMA)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("bigint"))


SCORE_SCHEMA = "query_id bigint, id bigint, score double"
QUERY_BLOCK = 8192
QUERY_SLICE = 256
BLOCK_CELLS = 8_000_000
_DOCS, _LENGTH = -1, -2


def _query_terms(queries: DataFrame, key: str, text: str) -> Iterator[dict[int, list[str]]]:
    """Distinct words per query, in blocks of about ``QUERY_BLOCK`` queries."""
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    cut = queries.select(F.col(key).cast("bigint").alias("q"), F.array_distinct(tokens(F.col(text))).alias("terms"))
    for block in range(blocks):
        part = cut if blocks == 1 else cut.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == block)
        asked = {r["q"]: r["terms"] for r in part.where("terms IS NOT NULL").collect() if r["terms"]}
        if asked:
            yield asked


def _known_words(words: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and vocabulary position of every word that some query asks for, and the length of each row."""
    lengths = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(words)), lengths)
    position = pc.index_in(words.flatten(), value_set=vocabulary)
    known = position.is_valid().to_numpy(zero_copy_only=False)
    return rows[known], position.drop_null().to_numpy(zero_copy_only=False).astype(np.int64), lengths


def _word_statistics(vocabulary: list[str]):
    """Arrow task: text count, total length and document frequency of each query word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(vocabulary, pa.string())
        df = np.zeros(len(vocabulary), np.int64)
        docs = length = 0
        for batch in batches:
            rows, position, lengths = _known_words(batch.column(0), terms)
            pairs = np.unique(rows * len(vocabulary) + position)
            df += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
            docs += len(lengths)
            length += int(lengths.sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([seen, [_DOCS, _LENGTH]]).astype(np.int32)), pa.array(np.concatenate([df[seen], [docs, length]]).astype(np.int64))],
            names=["item", "n"])

    return run


def _word_scores(asked: dict[int, list[str]], idf: dict[str, float], average: float, top: int):
    """Arrow task: BM25 of every text for every query, ``top`` rows kept per query.

    Queries are scored in slices against blocks of texts; only words that stand in a text take room.
    """
    def slices() -> Iterator[tuple[pa.Array, np.ndarray, dict[int, np.ndarray]]]:
        keys = sorted(asked)
        for start in range(0, len(keys), QUERY_SLICE):
            part = keys[start:start + QUERY_SLICE]
            words = sorted({w for q in part for w in asked[q]})
            at = {w: i for i, w in enumerate(words)}
            yield pa.array(words, pa.string()), np.array([idf[w] for w in words]), {q: np.array(sorted(at[w] for w in asked[q])) for q in part}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = list(slices())
        best = {}
        for whole in batches:
            for words, weights, wanted in blocks:
                step = max(1, BLOCK_CELLS // len(words))
                for start in range(0, whole.num_rows, step):
                    batch = whole.slice(start, step)
                    ids = batch.column(0).to_numpy(zero_copy_only=False)
                    rows, position, lengths = _known_words(batch.column(1), words)
                    n = len(ids)
                    # Words that stand in a text, by word; adding them up takes a query's words in this order.
                    pairs, tf = np.unique(position * n + rows, return_counts=True)
                    position, rows = np.divmod(pairs, max(n, 1))
                    weight = weights[position] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[rows] / average))
                    edges = np.searchsorted(position, np.arange(len(words) + 1))
                    for q, at in wanted.items():
                        span = np.concatenate([np.arange(edges[w], edges[w + 1]) for w in at])
                        hit = np.zeros(n, bool)
                        hit[rows[span]] = True
                        negative = -np.round(np.bincount(rows[span], weight[span], n), 6)
                        old_ids, old = best.get(q, (np.empty(0, np.int64), np.empty(0)))
                        if len(old) == top:  # sorted, so the last is the worst kept
                            hit &= ~(negative > old[-1])
                        hit = np.flatnonzero(hit)
                        best[q] = best_rows(np.concatenate([old_ids, ids[hit]]), np.concatenate([old, negative[hit]]), top)
        for q, (ids, negative) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), q, np.int64)), pa.array(ids.astype(np.int64)), pa.array(-negative)],
                names=["query_id", "id", "score"])

    return run


def contains_passage(documents: DataFrame, passages: DataFrame, window: int = 6) -> DataFrame:
    """Documents holding a passage verbatim; an empty passage is held by none.

    A run of inner words of the passage, whose first and last word may be cut in the document, is
    looked up among the document's runs. Passages of one or two words have no inner word; they are
    looked up among the document's runs of characters. The text decides about each candidate.
    """
    cut = passages.where(F.length("text") > 0).select("item_id", F.col("text").alias("passage"), tokens(F.col("text")).alias("_w"))
    short = F.size("_w") < 3
    wanted = cut.select(
        "item_id", "passage", F.when(short, -F.length("passage")).otherwise(F.least(F.size("_w") - 2, F.lit(window))).alias("size"),
        F.xxhash64(F.when(short, _letters(F.col("passage"))).otherwise(F.slice("_w", F.lit(2), F.least(F.size("_w") - 2, F.lit(window))))).alias("run"))
    # As many sizes as there are short lengths: at most ``window``, and the lengths of passages of two words (below zero).
    sizes = sorted(r["size"] for r in wanted.select("size").distinct().collect())
    if not sizes:
        return documents.sparkSession.createDataFrame([], "item_id bigint, doc_id bigint")
    parts = [F.struct(F.lit(n).alias("size"), _run_hashes(F.col("_words") if n > 0 else F.col("_letters"), abs(n)).alias("runs")) for n in sizes]
    read = documents.select("doc_id", tokens(F.col("text")).alias("_words"), (_letters(F.col("text")) if sizes[0] < 0 else F.array()).alias("_letters"))
    found = read.select("doc_id", F.explode(F.array(*parts)).alias("p")).select("doc_id", "p.size", F.explode(F.array_distinct("p.runs")).alias("run"))
    candidates = found.join(wanted, ["size", "run"]).select("doc_id", "item_id", "passage").distinct()
    return candidates.join(documents.select("doc_id", "text"), "doc_id").where(F.contains(F.col("text"), F.col("passage"))).select("item_id", "doc_id")


def _letters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _run_hashes(parts: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` neighbours; none where there are fewer."""
    starts = F.when(F.size(parts) >= size, F.sequence(F.lit(1), F.size(parts) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(parts, i, F.lit(size))))


def matches_all(conditions: Sequence[Column]) -> Column:
    """Every predicate holds."""
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result
