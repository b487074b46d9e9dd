"""Benchmark passages in training texts, found with winnowed k-gram fingerprints.

Every window of ``window`` consecutive words keeps the least hash among its k-grams (the last of
equal ones). Two equal windows keep the same k-gram at the same place, so any span of ``window`` or
more shared words has a shared fingerprint. Training and test fingerprints are joined, and each match
is extended over its neighbouring words, compared word by word.

Items shorter than a window are winnowed with one window of their own length.

Before the join, training fingerprints pass a bit table of fixed size made from all test
fingerprints; it can only let too many through. What passes carries the few words that a window
around it can reach, so texts are never joined. The test side is never broadcast by this code; Spark
may do so by its own size check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.blocks import WORD, Block, blocks, lists, mix
from lakeops.session import materialize

KGRAM = 5
FILTER_BITS = 24
_PRINTS = "array<struct<hash:bigint,start:int,words:array<string>>>"


class Winnower:
    """Fingerprints of texts. ``lengths`` are the item lengths below ``window`` to look for as a whole."""

    def __init__(self, window: int, kgram: int, lengths: tuple[int, ...], pad: str, table: np.ndarray | None = None):
        self.window, self.kgram, self.lengths, self.pad, self.table = window, kgram, lengths, pad, table

    def _passes(self, hashes: np.ndarray) -> np.ndarray:
        if self.table is None:
            return np.ones(len(hashes), bool)
        slot = hashes >> np.uint64(64 - FILTER_BITS)
        return (self.table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def _grams(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n words from each position on; the length is part of it."""
        count = len(hashes) - n + 1
        found = np.full(max(count, 0), n, np.uint64)
        for j in range(n):
            found = mix(found * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + count]) if count > 0 else found
        return found

    def of_block(self, block: Block) -> tuple[np.ndarray, pa.Array]:
        """Words per text, and per text its fingerprints with the words around them."""
        block = block.lowered()
        starts, ends = block.runs(WORD)
        first = np.searchsorted(starts, block.bounds)  # of each text, the first word's number
        counts = np.diff(first)
        owner = np.repeat(np.arange(len(block)), counts)
        hashes = block.hashes(starts, ends)
        prints: list[tuple[int, int, int, int, int]] = []  # text, place, hash, first and last word of the context
        reach = self.window - self.kgram
        grams = self._grams(hashes, self.kgram)
        windows = len(hashes) - self.window + 1
        if windows > 0:
            best, least = grams[:windows].copy(), np.zeros(windows, np.int64)
            for j in range(1, reach + 1):
                later = grams[j:j + windows]
                lower = later <= best
                best[lower], least[lower] = later[lower], j
            whole = owner[:windows] == owner[self.window - 1:]
            place = np.unique((np.arange(windows) + least)[whole & self._passes(best)])
            prints += [(owner[p], p, grams[p], p - reach, p + self.window) for p in place]
        for n in self.lengths:
            if len(hashes) >= n:
                short = self._grams(hashes, n)
                inside = owner[:len(short)] == owner[n - 1:]
                if self.table is None:  # an item
                    inside &= counts[owner[:len(short)]] == n
                found = np.flatnonzero(inside & self._passes(short))
                prints += [(owner[p], p, short[p], p, p + n) for p in found]
        prints.sort()
        raw = block.data.tobytes()
        words, sizes, numbers, where, per_text = [], [], [], [], np.zeros(len(block), np.int64)
        for text, _, value, low, high in prints:
            start, end = first[text], first[text + 1]
            words += [self.pad] * max(0, start - low)
            words += [raw[starts[w]:ends[w]].decode() for w in range(max(low, start), min(high, end))]
            words += [self.pad] * max(0, high - end)
            sizes.append(high - low)
            numbers.append(value)
            where.append(low - start)
            per_text[text] += 1
        column = pa.StructArray.from_arrays(
            [pa.array(np.array(numbers, np.uint64).view(np.int64)), pa.array(where, pa.int32()),
             lists(np.array(sizes, np.int64), pa.array(words, pa.string()))], ["hash", "start", "words"])
        return counts, lists(per_text, column)


def _printed(frame: DataFrame, keys: str, table=None, **options) -> DataFrame:
    """The key columns of ``frame`` (all but the last, its text), word counts and fingerprints; ``table`` is a broadcast bit table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Winnower(**options, table=None if table is None else table.value)
        for batch in batches:
            for low, high, block in blocks(batch.column(batch.num_columns - 1)):
                counts, prints = own.of_block(block)
                kept = [c.slice(low, high - low) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(counts), prints], [*batch.schema.names[:-1], "n_words", "prints"])

    return frame.mapInArrow(run, f"{keys}, n_words bigint, prints {_PRINTS}")


def item_prints(items: DataFrame, item_id: str, text: str, window: int, kgram: int) -> DataFrame:
    """Fingerprints of the test items; an item shorter than a window has one, of all its words."""
    base = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    kind = dict(base.dtypes)["item_id"]
    everything = _printed(base, f"item_id {kind}", window=window, kgram=kgram, lengths=tuple(range(1, window)), pad=" ")
    prints = everything.select("item_id", "n_words", F.explode("prints").alias("p")).select("item_id", "n_words", "p.*")
    full = F.col("n_words") >= window
    wanted = F.when(full, F.size("words") == 2 * window - kgram).otherwise(F.size("words") == F.col("n_words"))
    return prints.where(wanted).select("item_id", "hash", F.col("words").alias("item_words")).distinct()


def _bit_table(prints: DataFrame) -> np.ndarray:
    """2**FILTER_BITS bits, set where a fingerprint has its slot: 2 MB however many fingerprints there are."""
    slot = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    rows = prints.select(slot.alias("slot")).selectExpr("slot >> 3 AS byte", "shiftleft(1, cast(slot & 7 AS int)) AS bit")
    table = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for byte, bits in rows.groupBy("byte").agg(F.bit_or("bit")).toLocalIterator():
        table[byte] = bits
    return table


def benchmark_hits(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 10, kgram: int = KGRAM,
) -> tuple[DataFrame, DataFrame]:
    """Documents (``doc_id``, ``text_hash``, ``n_words``) and hits (the first two, ``item_id``, ``start``, ``end``).

    A hit is a run of the document's words, numbered from 0, that stands in the item too: ``window``
    words or more, or a whole item of fewer words. Hits may overlap. Words are runs of ASCII letters,
    digits and characters outside ASCII, with A-Z in lower case. Null and empty texts have no words;
    items without words are never hit; equal rows of documents have their hits once; an item with a null id hits
    under the id null. Other columns are not read.
    """
    spark = docs.sparkSession
    prints = materialize(item_prints(items, item_id, item_text, window, kgram), "item_prints")
    lengths = tuple(sorted(r[0] for r in prints.select(F.size("item_words")).distinct().collect() if r[0] < window))
    bits = spark.sparkContext.broadcast(_bit_table(prints))
    base = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").cast("string").alias("_text"))
    kind = dict(base.dtypes)["doc_id"]
    marked = materialize(_printed(base, f"doc_id {kind}, text_hash bigint", bits, window=window, kgram=kgram, lengths=lengths, pad=""), "doc_prints")
    found = marked.select("doc_id", "text_hash", F.explode("prints").alias("p")).select("doc_id", "text_hash", "p.*").distinct()
    width = F.when(F.size("words") < window, F.size("words")).otherwise(F.lit(window))
    same = found.join(prints, "hash").withColumn("_width", width).withColumn("_at", F.expr(
        "filter(sequence(0, size(words) - _width), s -> slice(words, s + 1, _width) = slice(item_words, s + 1, _width))"))
    hits = same.where(F.size("_at") > 0).select(
        "doc_id", "text_hash", "item_id", (F.col("start") + F.array_min("_at")).alias("start"),
        (F.col("start") + F.array_max("_at") + F.col("_width")).alias("end"))
    return marked.select("doc_id", "text_hash", "n_words"), materialize(hits.distinct(), "hits")


def contaminated(hits: DataFrame) -> DataFrame:
    """Per document with hits: ``n_hit`` words under any hit, ``n_items`` and the sorted item ids as strings."""
    key = ["doc_id", "text_hash"]
    before = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select(*key, "start", "end").distinct()
    covered = spans.withColumn("_from", F.greatest("start", F.coalesce(F.max("end").over(before), F.col("start"))))
    words = covered.groupBy(*key).agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.col("_from"))).alias("n_hit"))
    items = hits.select(*key, "item_id").distinct().groupBy(*key).agg(
        F.count("item_id").alias("n_items"), F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    pairs = items.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_items", "items")
    return words.join(pairs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))).drop("_id", "_hash")


def without_benchmarks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without any hit; the columns stay as they are."""
    _, hits = benchmark_hits(docs, items, doc_id, text, **options)
    flagged = hits.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(f"`{text}`").alias("hash"))
    same = F.col("row").getField(doc_id).eqNullSafe(F.col("hit_id")) & (F.col("hash") == F.col("hit_hash"))
    return rows.join(flagged, same, "left_anti").select("row.*")
