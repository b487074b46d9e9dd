"""Repeated passages, found with content-defined chunks.

A gear hash rolls over the bytes of a text: each step doubles it and adds a number that belongs to
the byte, so in 16 bits it depends on the last 16 bytes only. A chunk ends where the hash is below a
threshold and the chunk has a least size. Boundaries follow the content, so a passage that is inserted elsewhere
is cut into the same chunks again after at most a few boundaries. Chunks are compared by digest;
runs of consecutive chunks that also occur in another document are repeated passages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.blocks import Block, blocks, mix
from lakeops.session import materialize

GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)
LEAST_BYTES = 16
ONE_IN = 16
LEAST_CHARS = 80
NO_ID = 2**63 - 1


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after every byte, by doubling: sums over 1, 2, 4, 8 and 16 bytes."""
    rolled = GEAR[data]
    for shift in (1, 2, 4, 8):
        shifted = np.zeros_like(rolled)
        shifted[shift:] = rolled[:-shift] << np.uint16(shift) if len(rolled) > shift else 0
        rolled = rolled + shifted
    return rolled


def cuts(block: Block, least: int = LEAST_BYTES, one_in: int = ONE_IN) -> list[np.ndarray]:
    """Chunk bounds of every text, its first and last byte among them; a text without bytes has none."""
    found = []
    for i in range(len(block)):
        low, high = int(block.bounds[i]), int(block.bounds[i + 1])
        if low == high:
            found.append(np.empty(0, np.int64))
            continue
        data = block.data[low:high]
        ends = np.flatnonzero(gear(data) < 65536 // one_in) + 1
        chosen, last = [0], 0
        for end in ends.tolist():
            if end - last >= least:
                chosen.append(end)
                last = end
        if last != high - low:
            chosen.append(high - low)
        found.append(np.array(chosen, np.int64) + low)
    return found


def chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_BYTES, one_in: int = ONE_IN) -> DataFrame:
    """One row per chunk: ``doc`` (the id as a whole number), ``hash`` (of the text), ``digest`` (8 bytes of BLAKE2b) and ``place``.

    ``place`` is the start in code points times 2**32 plus the end. Four numbers a row keep the
    shuffles small. Null and empty texts have no chunks; rows with a null id have the number ``NO_ID``.
    """
    schema = "doc bigint, hash bigint, digest bigint, place bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, block in blocks(batch.column(2)):
                bounds = cuts(block, least, one_in)
                raw = block.data.tobytes()
                counts = np.array([max(0, len(b) - 1) for b in bounds])
                if not counts.sum():
                    continue
                low = np.concatenate([b[:-1] for b in bounds])
                high = np.concatenate([b[1:] for b in bounds])
                digests = b"".join(hashlib.blake2b(raw[s:e], digest_size=8).digest() for s, e in zip(low.tolist(), high.tolist(), strict=True))
                points = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
                owner = np.repeat(np.arange(len(block)), counts)
                origin = points[block.bounds[owner]]
                place = ((points[low] - origin) << 32) + (points[high] - origin)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).take(pa.array(owner + first)) for i in (0, 1)), pa.array(np.frombuffer(digests, "<i8")), pa.array(place)],
                    ["doc", "hash", "digest", "place"])

    whole = F.col(f"`{text}`").cast("string")
    chosen = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(whole).alias("hash"), whole.alias("_text"))
    return chosen.mapInArrow(run, schema)


def repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
    least: int = LEAST_BYTES, one_in: int = ONE_IN,
) -> DataFrame:
    """Passages that also stand in another document: runs of chunks, each of which occurs in two or more documents.

    One row per run of ``least_chars`` or more: ``doc_id``, ``start`` and ``end`` (code points),
    ``n_chunks``, ``n_repeats``, how many of its chunks a document with a smaller id has already, and
    ``text_hash``, the xxhash64 of the text that is meant. Ids are whole numbers. A document is an id
    and a text: different texts of one id, or without an id, are documents of their own, none of them
    earlier than the other; null ids come last. Equal rows are one document and give their passages
    once. Null and empty texts, and an empty table, give none.
    """
    cut = materialize(chunks(docs, doc_id, text, least, one_in), "chunks")
    known = cut.groupBy("digest").agg(*(f(c).alias(f"{n}{c}") for c in ("doc", "hash") for f, n in ((F.min, "least_"), (F.max, "most_"))))
    shared = known.where("least_doc <> most_doc OR least_hash <> most_hash").withColumnRenamed("least_doc", "first").select(F.col("digest").alias("_digest"), "first")
    found = cut.join(shared, F.col("digest") == F.col("_digest"))
    rows = found.groupBy("doc", "hash", "place").agg(F.max((F.col("first") != F.col("doc")).cast("int")).alias("late"))
    rows = rows.select("doc", "hash", F.expr("place >> 32").alias("start"), F.expr("place & 4294967295L").alias("end"), "late")
    # A run goes on where a chunk starts at the end of the one before.
    order = Window.partitionBy("doc", "hash").orderBy("start", "end")
    fresh = F.coalesce((F.lag("end").over(order) != F.col("start")).cast("int"), F.lit(1))
    numbered = rows.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(order))
    runs = numbered.groupBy("doc", "hash", "_run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_chunks"), F.sum("late").cast("long").alias("n_repeats"))
    kind = docs.schema[doc_id].dataType
    return runs.where(F.col("end") - F.col("start") >= least_chars).select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).cast(kind).alias("doc_id"), "start", "end", "n_chunks", "n_repeats", F.col("hash").alias("text_hash"))


def without_repeats(docs: DataFrame, passages: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` of every document without the passages that documents with smaller ids have whole.

    A passage goes if all its chunks are in earlier documents; the earliest holder keeps it. Texts
    without an id, texts whose id another text has too, and null texts stay as they are.
    """
    late = passages.where("n_repeats = n_chunks AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cut"))
    base = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    hashed = F.xxhash64(F.col("text").cast("string"))
    clear = base.groupBy(F.col("doc_id").alias("_id")).agg((F.min(hashed) == F.max(hashed)).alias("_one")).where("_one")
    joined = base.join(late.join(clear, "_id"), (F.col("doc_id") == F.col("_id")) & (hashed == F.col("_hash")), "left")
    # What stands before each passage, then what follows the last.
    kept = F.expr("""concat(
        array_join(transform(cut, (c, i) -> substring(text, CAST(CASE WHEN i = 0 THEN 1 ELSE cut[i - 1].end + 1 END AS int),
          CAST(c.start - CASE WHEN i = 0 THEN 0 ELSE cut[i - 1].end END AS int))), ''),
        substring(text, CAST(element_at(cut, -1).end + 1 AS int), length(text)))""")
    return joined.select("doc_id", F.when(F.col("cut").isNull(), F.col("text")).otherwise(kept).alias("text"))
