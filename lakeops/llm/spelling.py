"""Spelling variants: the words of a corpus that are one inserted, deleted or replaced code point apart.

The vocabulary's forward trie (nodes are prefixes) and reversed trie (nodes are suffixes) are
numbered. A word with position i skipped is the integer pair (node of what stands before i, node of
what stands after i); a word with something inserted at i is the pair (node before i, node from i on).
Two words with one skipped pair differ in that position only, and a word whose inserted pair equals
another's skipped pair lacks just that one character. So a join on integer pairs finds all near words,
and nothing else. The words of one pair number no more than the alphabet and one, and a repeated
character is skipped for an insertion at its first place only, so each near word is met once.

Nodes are numbered in sorted order: a word makes new nodes below the prefix that it shares with the
word before it. Tasks number ranges of the order on their own; one row per task, its last word's
nodes, carries the numbers over to the next range.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.blocks import Block, blocks, kept
from lakeops.session import materialize

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
HELD_BYTES = 32 << 20
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
_ONE = np.arange(256) == 1
_TABLED = 64


def letter_runs(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of A-Z, a-z and U+00C0 to U+00FF; the latter are all characters that begin with byte C3."""
    lead = block.data == 0xC3
    inside = _LETTER[block.data] | lead
    inside[1:] |= lead[:-1]
    return Block(inside.astype(np.uint8), block.bounds).runs(_ONE)


def _moved(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What each checksum becomes when ``lengths`` bytes follow it, to be combined with theirs by exclusive or."""
    tables = kept("crc moves", dict)
    out = np.empty(len(crc), np.uint32)
    for n in np.unique(lengths):
        if n not in tables:
            zeros = b"\0" * int(n)
            none = zlib.crc32(zeros)
            tables[n] = np.array([[zlib.crc32(zeros, b << 8 * k) ^ none for b in range(256)] for k in range(4)], np.uint32)
        own, at = tables[n], np.flatnonzero(lengths == n)
        c = crc[at]
        out[at] = own[0][c & 255] ^ own[1][c >> 8 & 255] ^ own[2][c >> 16 & 255] ^ own[3][c >> 24]
    return out


def _words_of(block: Block, prefixes: list[bytes], min_length: int, slip: int | None) -> Iterator[tuple[bytes, int]]:
    """Words of a block, in lower case, and how often they stand there."""
    low = block.lowered()
    starts, ends = letter_runs(low)
    inner = np.concatenate([[0], np.cumsum((low.data & 0xC0) == 0x80, dtype=np.int64)])
    points = ends - starts - (inner[ends] - inner[starts])
    long = points >= min_length
    starts, ends, points = starts[long], ends[long], points[long]
    if not len(starts):
        return
    raw = low.data.tobytes()
    hashes, first, word, = np.unique(low.hashes(starts, ends), return_index=True, return_inverse=True)
    words = [raw[a:b] for a, b in zip(starts[first], ends[first], strict=True)]
    total = np.bincount(word, minlength=len(words))
    if slip:
        # A word that is in a text more than once has one checksum there.
        pair, n = np.unique(low.owner(starts) * len(words) + word, return_counts=True)
        text, word = pair // len(words), pair % len(words)
        size = (ends - starts)[first][word]
        crc = np.array([zlib.crc32(w) for w in words], np.uint32)[word]
        short = size <= _TABLED
        before = np.array([zlib.crc32(p) for p in prefixes], np.uint32)[text]
        crc[short] ^= _moved(before[short], size[short])
        crc[~short] = [zlib.crc32(words[w], int(c)) for w, c in zip(word[~short], before[~short], strict=True)]
        for at in np.flatnonzero(crc % np.uint32(slip) == 0):
            total[word[at]] -= n[at]
            whole = words[word[at]].decode()
            if len(whole) > min_length:
                cut = int(crc[at]) % len(whole)
                yield (whole[:cut] + whole[cut + 1:]).encode(), int(n[at])
    yield from ((w, n) for w, n in zip(words, total.tolist(), strict=True) if n)


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, slip: int | None = None) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts: runs of letters of at least ``min_length`` code points, A-Z in lower case.

    With ``slip``, a word whose crc32 of ``<doc_id>:<word>`` is a multiple of it loses the code point
    at that checksum modulo its length in this document, as a repeatable slip of the pen. Null texts
    have no words, a null id stands as an empty string; repeated rows count as often as they stand.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        size = 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            ids = [b":" if i is None else f"{i}:".encode() for i in batch.column(0).to_pylist()]
            for low, high, block in blocks(batch.column(1)):
                for word, n in _words_of(block, ids[low:high], min_length, slip):
                    if word in held:
                        held[word] += n
                    else:
                        held[word] = n
                        size += 150 + len(word)
                if size > HELD_BYTES:
                    yield batch_of()
                    held, size = {}, 0
        yield batch_of()

    chosen = docs.select(F.col(f"`{doc_id}`").cast("string").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    return chosen.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers within one range of the order: ``part``, ``place`` of the word, the ``nodes`` of its prefixes, shortest first."""
    part, place, made = TaskContext.get().partitionId(), 0, 0
    last, stack = "", np.empty(0, np.int64)
    for batch in batches:
        found = []
        for word in batch.column(0).to_pylist():
            common = _shared(last, word)
            new = len(word) - common
            stack = np.concatenate([stack[:common], np.arange(made, made + new)])
            made, last = made + new, word
            found.append(stack)
        n = len(found)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in found], dtype=np.int64)]).astype(np.int32)
        nodes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*found, np.empty(0, np.int64)])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n)), nodes], ["sorted", "part", "place", "nodes"])
        place += n


def _carried(parts: list) -> list[tuple[int, int, int, int, list[int]]]:
    """Per range: its first place and node, and the numbers that the prefixes of its first word have already, from the range before."""
    rows, places, nodes, before, stack = [], 0, 1, "", []  # node 0 is the root
    for p in sorted(parts, key=lambda p: p.first.encode()):
        common = _shared(before, p.first)
        known = stack[:common]
        rows.append((p.part, places, nodes, common, known))
        stack = [known[x] if x < common else nodes + x for x in p.last.nodes]
        before = p.last.sorted
        places, nodes = places + p.n, nodes + p.made
    return rows


def trie_nodes(words: DataFrame, column: str = "word") -> DataFrame:
    """Distinct words with ``place`` in their order and ``nodes``: the numbers of the trie nodes on the way to each, the root (0) first.

    Equal prefixes have one number and different ones never share one.
    """
    spark = words.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = words.select(F.col(column).alias("sorted")).repartitionByRange(ranges, "sorted").sortWithinPartitions("sorted")
    numbered = materialize(ordered.mapInArrow(_number, "sorted string, part int, place bigint, nodes array<bigint>"), "ranges")
    # One row per task of the range shuffle.
    parts = numbered.groupBy("part").agg(
        F.min("sorted").alias("first"), F.max(F.struct("sorted", "nodes")).alias("last"), F.count("*").alias("n"),
        (F.max(F.array_max("nodes")) + 1).alias("made")).collect()
    carried = spark.createDataFrame(_carried(parts), "part int, places bigint, made bigint, common int, known array<bigint>")
    return numbered.join(F.broadcast(carried), "part").select(
        F.col("sorted").alias(column), (F.col("place") + F.col("places")).alias("place"),
        F.expr("concat(array(0L), transform(nodes, x -> if(x < common, element_at(known, cast(x AS int) + 1), x + made)))").alias("nodes"))


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``place``, ``n_near`` (how many words are near it) and ``best``: n and place of the near word of largest n, the first in order among equals.

    ``words`` has distinct, non-empty ``word`` and its ``n``; words are near at exactly one inserted,
    deleted or replaced code point.
    """
    forward = trie_nodes(words.select("word")).withColumnsRenamed({"nodes": "before"})
    backward = trie_nodes(words.select(F.reverse("word").alias("back")), "back").select(F.reverse("back").alias("word"), F.col("nodes").alias("after"))
    known = materialize(words.select("word", "n").join(forward, "word").join(backward, "word"), "nodes")
    # 0: skipped, 1: skipped at the first of equal neighbours, 2: inserted.
    skipped = """transform(sequence(1, length(word)), i -> struct(
        element_at(before, i) AS p, element_at(after, length(word) - i + 1) AS s,
        if(i > 1 AND element_at(letters, i) = element_at(letters, i - 1), 0, 1) AS kind))"""
    inserted = "transform(sequence(1, length(word) + 1), i -> struct(element_at(before, i) AS p, element_at(after, length(word) - i + 2) AS s, 2 AS kind))"
    keys = known.withColumn("letters", F.expr("split(word, '')")).select("place", "n", F.explode(F.expr(f"concat({skipped}, {inserted})")).alias("key"))
    met = keys.groupBy("key.p", "key.s").agg(F.collect_list(F.struct("place", "n", "key.kind")).alias("met")).where("size(met) > 1")
    near = """filter(met, y -> (x.kind < 2 AND y.kind < 2 AND x.place <> y.place) OR (x.kind = 2 AND y.kind = 1) OR (x.kind = 1 AND y.kind = 2))"""
    pairs = met.select("met", F.explode("met").alias("x")).select("x.place", F.expr(near).alias("near")).where("size(near) > 0")
    best = F.expr("array_max(transform(near, y -> struct(y.n AS n, -y.place AS place)))")
    found = pairs.groupBy("place").agg(F.sum(F.size("near")).alias("n_near"), F.max(best).alias("best"))
    return known.select("word", "n", "place").join(found, "place", "left").select(
        "word", "n", "place", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best").isNotNull(), F.struct(F.col("best.n").alias("n"), (-F.col("best.place")).alias("place"))).alias("best"))


def _roots(links: DataFrame, largest: int, ratio: int) -> DataFrame:
    """``place`` and the ``root`` at the end of its chain. A step multiplies the count by ``ratio`` or more, which bounds the chain."""
    steps, n = 0, 1
    while n * ratio <= largest:
        steps, n = steps + 1, n * ratio
    current, reach = links.select("place", F.col("form").alias("root")), 1
    while reach < steps:
        up = current.select(F.col("place").alias("_at"), F.col("root").alias("_up"))
        current = materialize(current.join(up, F.col("root") == F.col("_at"), "left").select("place", F.coalesce("_up", "root").alias("root")), "roots")
        reach *= 2
    return current


def variants(counts: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word with at least ``min_count`` occurrences.

    ``form`` is the near word of largest n, the first in code-point order among equals, if that n is at
    least ``ratio`` (2 or more) times the word's own; else null. ``root`` is the last word on the way
    from form to form. ``counts`` has distinct words and their ``n``; null and empty words and other
    columns are not read, and no words give no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = materialize(counts.select("word", "n").where(f"n >= {int(min_count)} AND word <> ''"), "vocabulary")
    found = materialize(near_words(words), "near").withColumn("form", F.expr(f"if(best.n >= {int(ratio)} * n, best.place, null)"))
    largest = words.agg(F.max("n")).first()[0] or 0
    links = found.where("form IS NOT NULL").select("place", "form")
    roots = _roots(links, largest, ratio)
    names = found.select(F.col("place").alias("_place"), F.col("word").alias("_word"))
    linked = found.join(roots, "place").join(names, F.col("form") == F.col("_place")).select(
        "place", "root", F.col("_word").alias("form_word"))
    linked = linked.join(names, F.col("root") == F.col("_place")).select(F.col("place").alias("_at"), "form_word", F.col("_word").alias("root_word"))
    return found.join(linked, F.col("place") == F.col("_at"), "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near",
        F.when(F.col("form").isNotNull(), F.col("best.n")).alias("form_n"))
