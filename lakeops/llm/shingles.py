"""Near-duplicates by the Jaccard similarity of their sets of word shingles.

Texts with one set of shingles are collapsed first. Sets whose SimHash fingerprints of the same
shingles differ in at most two bits are found by multi-index hashing (``simhash.fingerprint_links``).
Fingerprints of sets at the least similarity differ in more bits than that, so what they give is
compared shingle by shingle and the rest is found by MinHash: sets are stored under a key per band
of ``ROWS`` minima; two sets of similarity s share a key with probability
1 - (1 - s ** ROWS) ** BANDS, which is over 0.99999 at 0.8. What shares a key is compared shingle by
shingle, so no pair below ``least`` is linked.

A key is never listed pair by pair. Its sets are first compared with the least one among them. Where
the links found leave a key in several parts, some of its sets are pivots of a round: they are
compared with all other sets of the key, in tasks that hold the pivots and see the sets go by, and
only links that connect two parts leave a task, so no more than one a set. Pivots are then done with,
those outside a key's largest part come first, and rounds go on while a key has parts that were not
compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm import simhash
from lakeops.llm.blocks import SPACE, Block, blocks, lists, mix
from lakeops.llm.components import components
from lakeops.session import materialize

WIDTH, LEAST = 5, 0.8
ROWS, BANDS = 4, 24
BUCKETS, CHUNK = 256, 4096
PIVOTS, PIVOT_BYTES = 1024, 16 << 20
_FACTORS = mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SHIFTS = mix(_FACTORS)


def shingle_sets(block: Block, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every text, sorted within it, and how many each text has.

    Words are what white space parts, in lower case (ASCII); a text of fewer than ``width`` words is one shingle.
    """
    low = block.lowered()
    starts, ends = low.runs(~SPACE)
    words, owner = low.hashes(starts, ends), low.owner(starts)
    n_words = np.bincount(owner, minlength=len(block)) if len(owner) else np.zeros(len(block), np.int64)
    firsts = np.cumsum(n_words) - n_words
    found, text = [], []
    for n in range(1, width + 1):
        at = firsts[n_words == n] if n < width else np.flatnonzero(owner[:-n + 1 or None] == owner[n - 1:])
        total = np.full(len(at), n, np.uint64)
        for i in range(n):
            total = mix(total + words[at + i])
        found.append(total)
        text.append(owner[at])
    hashes, own = np.concatenate(found), np.concatenate(text)
    order = np.lexsort((hashes, own))
    hashes, own = hashes[order], own[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (own[1:] != own[:-1])
    return hashes[new], np.bincount(own[new], minlength=len(block))


def signed(block: Block, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Per text a hash of its whole set (0 for an empty one) and its keys, one per band."""
    hashes, sizes = shingle_sets(block, width)
    nodes, keys = np.zeros(len(block), np.uint64), np.zeros((len(block), BANDS), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        nodes[full] = mix(np.add.reduceat(mix(hashes), starts) + sizes[full].astype(np.uint64))
        for band in range(BANDS):
            key = np.full(len(full), band, np.uint64)
            for j in range(band * ROWS, (band + 1) * ROWS):
                key = mix(key + np.minimum.reduceat(hashes * _FACTORS[j] + _SHIFTS[j], starts))
            keys[full, band] = key
    return nodes, keys


def _marked(docs: DataFrame, width: int) -> DataFrame:
    """``_id``, ``_hash``, ``node``, ``keys`` and SimHash ``fingerprint`` of rows with ``_id``, ``_hash`` and ``_whole``."""
    schema = T.StructType([*docs.schema.fields[:2], T.StructField("node", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())),
                           T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, block in blocks(batch.column(2)):
                nodes, keys = signed(block, width)
                values = lists(np.full(high - low, BANDS), pa.array(keys.view(np.int64).ravel()))
                prints = np.array([simhash.fingerprint(block.text(i), width) for i in range(len(block))], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(low, high - low) for i in (0, 1)), pa.array(nodes.view(np.int64)), values, pa.array(prints.view(np.int64))],
                    schema.names)

    return docs.mapInArrow(run, schema)


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """``node`` and ``shingles`` (8 bytes each, sorted) of rows with ``node`` and ``_whole``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, block in blocks(batch.column(1)):
                hashes, sizes = shingle_sets(block, width)
                edges = np.concatenate([[0], np.cumsum(sizes)])
                sets = [hashes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(sets, pa.binary())], ["node", "shingles"])

    return texts.mapInArrow(run, "node bigint, shingles binary")


def similar(a: bytes, b: bytes, least: float = LEAST) -> bool:
    """Whether two sorted sets have at least ``least`` of their union in common."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if min(len(x), len(y)) < least * max(len(x), len(y)) - 1e-9:
        return False
    common = len(x) + len(y) - len(np.union1d(x, y))
    return common >= least * (len(x) + len(y) - common) - 1e-9


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = [similar(x[i].as_py(), y[i].as_py(), least) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (sets.select(F.col("node").alias(n), F.col("shingles").alias(f"_{n}")) for n in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "_a", "_b").mapInArrow(run, "a bigint, b bigint")


def _to_least(entries: DataFrame) -> DataFrame:
    """Each set with the least one under the same key."""
    firsts = entries.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("_last")).where("a <> _last").select("key", "a")
    return entries.join(firsts, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """Pairs of sets that connect all whose fingerprints differ in at most two bits; each fingerprint stands for its least set."""
    full = nodes.where("node <> 0").select("node", "fingerprint")
    least = materialize(full.groupBy("fingerprint").agg(F.min("node").alias("first")), "prints")
    same = full.join(least, "fingerprint").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    ends = [least.select(F.col("fingerprint").alias(f"_{n}"), F.col("first").alias(n)) for n in ("x", "y")]
    links = simhash.fingerprint_links(least.select("fingerprint")).select(F.col("a").alias("_x"), F.col("b").alias("_y"))
    near = links.join(ends[0], "_x").join(ends[1], "_y")
    return materialize(same.union(near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct(), "alike")


class _Sets:
    """Sorted sets of shingles, one after the other, with their counts per bucket of the hash."""

    def __init__(self, column: pa.Array):
        raw = [np.frombuffer(x.as_buffer(), np.uint64) for x in column]
        self.sizes = np.array([len(x) for x in raw], np.int64)
        self.hashes = np.concatenate([np.empty(0, np.uint64), *raw])
        self.starts = np.cumsum(self.sizes) - self.sizes
        bucket = np.repeat(np.arange(len(raw)) * BUCKETS, self.sizes) + (self.hashes % np.uint64(BUCKETS)).astype(np.int64)
        counts = np.bincount(bucket, minlength=len(raw) * BUCKETS).reshape(len(raw), BUCKETS)
        self.counts = np.minimum(counts, 255).astype(np.int16)

    def one(self, i: int) -> np.ndarray:
        return self.hashes[self.starts[i]:self.starts[i] + self.sizes[i]]

    def similar(self, chosen: np.ndarray, other: _Sets, i: int, least: float) -> np.ndarray:
        """Those of ``chosen`` that are similar to set ``i`` of ``other``. Sets differ in at least what their counts do, which rules most out."""
        size = other.sizes[i]
        chosen = chosen[np.minimum(self.sizes[chosen], size) >= least * np.maximum(self.sizes[chosen], size) - 1e-9]
        apart = np.abs(self.counts[chosen] - other.counts[i]).sum(1, dtype=np.int64)
        chosen = chosen[apart <= (1 - least) / (1 + least) * (self.sizes[chosen] + size) + 1e-6]
        if not len(chosen):
            return chosen
        ranked, sizes = other.one(i), self.sizes[chosen]
        first = np.cumsum(sizes) - sizes
        values = self.hashes[np.repeat(self.starts[chosen] - first, sizes) + np.arange(sizes.sum())]
        hit = ranked[np.minimum(np.searchsorted(ranked, values), size - 1)] == values
        common = np.add.reduceat(hit.astype(np.int64), first)
        return chosen[common >= least * (sizes + size - common) - 1e-9]


def _compared(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Links of rows ``key``, ``chunk``, ``pivot``, ``node``, ``root``, ``shingles``, sorted by place, pivots first. A link connects two parts of its place."""
    place, pivots, ids, part = None, [], [], {}

    def of(roots: list[int]) -> np.ndarray:
        """The part of each set: a number per root, the same once a link connects two."""
        return np.array([part.setdefault(r, len(part)) for r in roots], np.int64)

    held, labels, merged = None, np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        keys, chunks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(keys) != 0) | (np.diff(chunks) != 0)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if low == high:
                continue
            if place != (keys[low], chunks[low]):
                place, pivots, ids, part, held = (keys[low], chunks[low]), [], [], {}, None
                labels, merged = np.empty(0, np.int64), np.empty(0, np.int64)
            first = low + int(np.sum(batch.column(2).slice(low, high - low).to_numpy(zero_copy_only=False)))
            if first > low:  # pivots; they come before all others of a place
                pivots.append(batch.column(5).slice(low, first - low))
                ids += batch.column(3).slice(low, first - low).to_pylist()
                labels = np.concatenate([labels, of(batch.column(4).slice(low, first - low).to_pylist())])
            if first == high:
                continue
            if held is None:
                held = _Sets(pa.concat_arrays(pivots)) if pivots else _Sets(pa.array([], pa.binary()))
            sets, nodes = _Sets(batch.column(5).slice(first, high - first)), batch.column(3).slice(first, high - first).to_numpy()
            own = of(batch.column(4).slice(first, high - first).to_pylist())
            merged = np.concatenate([merged, np.arange(len(merged), len(part))])
            found: list[tuple[int, int]] = []
            for i in range(len(ids)):
                label = merged[labels[i]]
                near = sets.similar(np.flatnonzero(merged[own] != label), held, i, least)
                new, at = np.unique(merged[own[near]], return_index=True)
                if len(new):
                    found += [(ids[i], int(nodes[near[k]])) for k in at]
                    merged[np.isin(merged, new)] = label
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found]), pa.array([y for _, y in found])], ["a", "b"])


def _rounds(entries: DataFrame, sets: DataFrame, links: DataFrame, least: float) -> DataFrame:
    """All links needed to connect what similarities under one key connect: ``links`` and those that the rounds find."""
    sizes = sets.select("node", F.expr("octet_length(shingles)").alias("bytes"))
    while True:
        placed = entries.join(components(links), "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        parts = placed.join(sizes, "node").groupBy("key", "root").agg(F.count("*").alias("n"), F.max("bytes").alias("bytes"))
        open_ = parts.groupBy("key").agg(
            F.max(F.struct("n", "root")).alias("major"), F.count("*").alias("_parts"), F.sum("n").alias("n"), F.max("bytes").alias("bytes")).where("_parts > 1")
        open_ = open_.select("key", F.col("major.root").alias("major"), F.ceil(F.col("n") / CHUNK).alias("chunks"),
                             F.greatest(F.lit(1), F.expr(f"{PIVOT_BYTES} div bytes")).alias("most"))
        rows = materialize(placed.join(open_, "key"), "open")
        if rows.isEmpty():
            return links
        order = Window.partitionBy("key").orderBy(F.col("root") == F.col("major"), F.xxhash64("node"), "node")
        chosen = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PIVOTS).where("rank <= most")
        chosen = materialize(chosen.select("key", "node", "root", "chunks"), "pivots")
        everywhere = chosen.select("key", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"), F.lit(True).alias("pivot"), "node", "root")
        once = rows.select("key", F.expr("pmod(xxhash64(node), chunks)").alias("chunk"), F.lit(False).alias("pivot"), "node", "root")
        met = everywhere.union(once).join(sets, "node").select("key", "chunk", "pivot", "node", "root", "shingles")
        found = met.repartition("key", "chunk").sortWithinPartitions("key", "chunk", F.desc("pivot")).mapInArrow(
            lambda batches: _compared(batches, least), "a bigint, b bigint")
        links = materialize(links.union(found), "similar")
        entries = rows.select("key", "node").join(chosen.select("key", "node"), ["key", "node"], "left_anti")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id (null ids last).

    Two texts are linked where their sets of ``width``-word shingles have a Jaccard similarity of ``least``
    or more; a group is what links connect. Texts without words are one group, of equal rows one
    stays. The columns are those of ``docs``.
    """
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(f"`{doc_id}`").alias("by_id"), F.xxhash64(f"`{text}`").alias("by_text"))
    whole = F.col("row").getField(text).cast("string").alias("_whole")
    marked = materialize(_marked(rows.select(F.col("row").getField(doc_id).alias("_id"), F.col("by_text").alias("_hash"), whole), width), "signed")
    nodes = materialize(marked.groupBy("node").agg(
        F.min(F.struct(F.isnull("_id").alias("_none"), "_id", "_hash")).alias("_least"), F.first("keys").alias("keys"),
        F.min("fingerprint").alias("fingerprint")), "nodes")
    alike = _by_fingerprint(nodes)
    entries = nodes.where("node <> 0").select("node", F.explode("keys").alias("key"))
    # Keys under which a set stands alone have nothing to compare.
    shared = entries.groupBy("key").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).where("_low <> _high").select("key")
    entries = materialize(entries.join(shared, "key", "left_semi"), "entries")
    met = entries.select("node").union(alike.select("a")).union(alike.select("b")).distinct()
    involved = nodes.join(met, "node", "left_semi").select(
        "node", F.xxhash64("_least._id").alias("by_id"), F.col("_least._hash").alias("by_text"))
    texts = rows.select("by_id", "by_text", whole).join(involved, ["by_id", "by_text"]).select("node", "_whole")
    sets = materialize(_sets(texts, width).dropDuplicates(["node"]), "sets")
    links = materialize(_verified(alike.union(_to_least(entries)).distinct(), sets, least), "similar")
    roots = components(_rounds(entries, sets, links, least))
    grouped = nodes.join(roots, "node", "left").select("_least", F.coalesce("root", "node").alias("root"))
    firsts = grouped.groupBy("root").agg(F.min("_least").alias("_first"))
    kept = firsts.select(F.xxhash64("_first._id").alias("by_id"), F.col("_first._hash").alias("by_text")).distinct()
    # Both steps need rows of one key together, so the texts are shuffled once.
    return rows.join(kept, ["by_id", "by_text"], "left_semi").dropDuplicates(["by_id", "by_text"]).select("row.*")
