"""Near-duplicates by SimHash fingerprints, linked with multi-index hashing.

A fingerprint of 64 bits has two segments of 32. Where two fingerprints differ in at most two bits,
one of their segments differs in at most one. So every fingerprint is stored under each of its
segments and looked up under each segment's Hamming ball of radius one; what is fetched is verified
on all 64 bits. A differing bit is 0 on one side, so only that side looks the other up.

Copies are collapsed to distinct fingerprints first. A table entry is then a set of distinct
fingerprints that share 32 bits; entries larger than a ball are searched by enumerating the ball of
the other segment, so the work per fingerprint has a fixed bound, and only a spanning tree of links
leaves an entry, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.blocks import blocks
from lakeops.llm.components import components
from lakeops.session import materialize

SEED = 42
HALF = 32
RADIUS = 2
_ROWS = 4096  # shingles whose bits are counted at once


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of the word shingles of a UTF-8 text; 0 for a text without words."""
    words = text.lower().split()  # on bytes both know ASCII only
    if not words:
        return 0
    if len(words) < width:
        shingles, count = iter([b" ".join(words)]), 1
    else:
        shingles, count = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)), len(words) - width + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for low in range(0, count, _ROWS):
        bits = np.unpackbits(hashes[low:low + _ROWS].view(np.uint8)).reshape(-1, 64)
        ones += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > count).view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, keep: list[str], text: str = "text", width: int = 3, out: str = "fingerprint") -> DataFrame:
    """The columns ``keep`` and a signed 64-bit fingerprint of the whole text (null text: 0)."""
    position = len(keep)
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(block.text(i), width) for _, _, block in blocks(batch.column(position)) for i in range(len(block))]
            column = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:position], column], [*batch.schema.names[:position], out])

    chosen = [F.col(f"`{c}`") for c in keep]
    return docs.select(*chosen, F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(run, schema)


def _probes(fingerprint: str) -> Column:
    """Both table entries and the look-ups of the segments' balls, as an array of (key, probe)."""
    return F.expr(f"""
        flatten(transform(array(0, 1), s -> concat(
          array(struct(shiftleft(cast(s AS bigint), {HALF}) + (shiftrightunsigned({fingerprint}, {HALF} * s) & 4294967295L) AS key, false AS probe)),
          transform(
            filter(sequence(0, {HALF - 1}), i -> (shiftrightunsigned({fingerprint}, {HALF} * s + i) & 1L) = 0L),
            i -> struct(shiftleft(cast(s AS bigint), {HALF}) + ((shiftrightunsigned({fingerprint}, {HALF} * s) & 4294967295L) | shiftleft(1L, i)) AS key, true AS probe)))))""")


def _ball(radius: int) -> np.ndarray:
    """All differences of one segment within ``radius`` bits."""
    return np.array([sum(1 << i for i in bits) for r in range(radius + 1) for bits in combinations(range(HALF), r)], np.uint64)


class _Forest:
    """Union-find over array positions that merges many links at once."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            left, right = self.root[a], self.root[b]
            open_ = left != right
            if not open_.any():
                return
            a, b, left, right = a[open_], b[open_], left[open_], right[open_]
            np.minimum.at(self.root, np.maximum(left, right), np.minimum(left, right))
            while True:
                jumped = self.root[self.root]
                if (jumped == self.root).all():
                    break
                self.root = jumped


def _linked(stored: np.ndarray, probes: np.ndarray, other: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one table entry: stored fingerprints share a segment, probes differ in one of its bits.

    ``other`` is the shift of the segment that the entry does not fix.
    """
    nodes = np.concatenate([stored, probes])
    forest = _Forest(len(nodes))
    for first, group, radius in ((0, stored, RADIUS), (len(stored), probes, RADIUS - 1)):
        ball = _ball(radius)
        if len(stored) <= len(ball):
            step = max(1, (1 << 20) // max(1, len(stored)))
            for low in range(0, len(group), step):
                near = np.bitwise_count(group[low:low + step, None] ^ stored[None, :]) <= RADIUS
                a, b = np.nonzero(near)
                forest.merge(a + first + low, b)
        else:
            order = np.argsort(stored)
            ranked = stored[order]
            segment = np.uint64((1 << HALF) - 1) << np.uint64(other)
            fixed = ranked[0] & ~segment
            for difference in ball:
                wanted = ((group & segment) ^ (difference << np.uint64(other))) | fixed
                at = np.minimum(np.searchsorted(ranked, wanted), len(ranked) - 1)
                hit = np.flatnonzero(ranked[at] == wanted)
                forest.merge(hit + first, order[at[hit]])
    away = np.flatnonzero(forest.root != np.arange(len(nodes)))
    return nodes[away], nodes[forest.root[away]]


def _links_of_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; an entry may go on over several batches."""
    held: list[tuple[np.ndarray, ...]] = []

    def solve(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, value, probe = (np.concatenate(x) for x in zip(*parts, strict=True))
        edges = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        found = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if high - low > 1 and not probe[low:high].all():
                stored = value[low:high][~probe[low:high]]
                found.append(_linked(stored, value[low:high][probe[low:high]], 0 if key[low] >> HALF else HALF))
        a = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.uint64)
        b = np.concatenate([x for _, x in found]) if found else np.empty(0, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy(zero_copy_only=False)
        value = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        probe = batch.column(2).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(key, key[-1]))
        if cut or (held and held[-1][0][-1] != key[0]):
            if cut:
                held.append((key[:cut], value[:cut], probe[:cut]))
            yield solve(held)
            held = []
        held.append((key[cut:], value[cut:], probe[cut:]))
    if held:
        yield solve(held)


def fingerprint_links(fingerprints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints at most two bits apart, without listing all pairs."""
    column = fingerprints.columns[0]
    entries = fingerprints.select(F.col(column), F.explode(_probes(column)).alias("entry")).select(
        F.col("entry.key").alias("key"), F.col(column), F.col("entry.probe").alias("probe"))
    # A key without a second row, or without a table entry, has nothing to fetch.
    return entries.repartition("key").sortWithinPartitions("key").mapInArrow(_links_of_entries, "a bigint, b bigint")


def _classes(docs: DataFrame, doc_id: str, text: str, width: int) -> tuple[DataFrame, DataFrame]:
    """Per row its id, text hash and fingerprint; per fingerprint the least row of its component."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.xxhash64(f"`{text}`").alias("_hash"), F.col(f"`{text}`").alias("_whole"))
    marked = materialize(with_fingerprint(rows, ["_id", "_hash"], "_whole", width), "fingerprints")
    least = marked.groupBy("fingerprint").agg(F.min(F.struct(F.isnull("_id").alias("_none"), "_id", "_hash")).alias("_least"))
    roots = components(fingerprint_links(least.select("fingerprint")))
    grouped = least.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("root"))
    firsts = grouped.groupBy("root").agg(F.min("_least").alias("_first"))
    return marked, materialize(grouped.join(firsts, "root").select("fingerprint", "_first"), "classes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``doc_id``, its ``fingerprint`` as 16 hex digits, and ``component_id``: the smallest id reachable over links.

    One row per input row. Null and empty texts, and texts of white space, have fingerprint zero and
    are linked like any other. Repeated rows share a component; a component whose ids are all null
    has the id null. An empty table gives no rows. Other columns are not read.
    """
    marked, classes = _classes(docs, doc_id, text, width)
    return marked.join(classes, "fingerprint").select(
        F.col("_id").alias(doc_id), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("_first._id").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id (null ids last).

    Of equal rows one stays. The columns are those of ``docs``.
    """
    _, classes = _classes(docs, doc_id, text, width)
    kept = classes.select(F.xxhash64("_first._id").alias("_by_id"), F.col("_first._hash").alias("_by_text")).distinct()
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64(f"`{doc_id}`").alias("_by_id"), F.xxhash64(f"`{text}`").alias("_by_text"))
    # Both steps need rows of one key together, so the texts are shuffled once.
    return keyed.join(kept, ["_by_id", "_by_text"], "left_semi").dropDuplicates(["_by_id", "_by_text"]).select("row.*")
