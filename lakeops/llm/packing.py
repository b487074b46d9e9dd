"""Packing of tokenised documents into sequences of bounded length.

Only the number of pieces of each length matters to the plan, so the plan is made from that
histogram, which has at most ``limit`` rows however many pieces there are. It goes over the lengths
from the longest down, as Martello and Toth's reduction does: where one set with a piece provably
dominates every other set with it, the set is fixed and taken out, which leaves a smaller instance.
What cannot be fixed is placed by best fit, longest first. Pieces of one length are interchangeable,
so they take the planned places in the order of their number within their length.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.tokens import encoder, groups
from lakeops.session import materialize

LIMIT = 1024
ROWS_PER_BUCKET = 200_000


def pieces(docs: DataFrame, path: str, end_id: int, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of every document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (little-endian, unsigned 32 bits).

    A document is its whole text's ids and then ``end_id``, so null and empty texts have one piece of
    one id. Documents longer than ``limit`` are cut from the end, so only the first piece is shorter.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        own, last = encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for low, high in groups([len(t) for t in texts]):
                rows, number, start, length, ids = [], [], [], [], []
                for row, found in enumerate(own.encode(texts[low:high]), low):
                    whole = np.frombuffer(found, own.dtype).astype("<u4").tobytes() + last
                    n, at, k = len(whole) // 4, 0, 0
                    while at < n:
                        size = (n - at) % limit or limit
                        rows.append(row)
                        number.append(k)
                        start.append(at)
                        length.append(size)
                        ids.append(whole[4 * at:4 * (at + size)])
                        at, k = at + size, k + 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())], schema.names)

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(run, schema)


@dataclass
class Plan:
    """``sets``: (number of sequences, their content as (length, how many)); ``fixed``: sequences that a dominance proof placed."""

    limit: int
    sets: list[tuple[int, tuple[tuple[int, int], ...]]] = field(default_factory=list)
    fixed: int = 0

    @property
    def sequences(self) -> int:
        return sum(n for n, _ in self.sets)


class _Histogram:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in counts.items() if n > 0}
        self.lengths = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.lengths.remove(length)

    def put(self, length: int, n: int) -> None:
        if length not in self.counts:
            bisect.insort(self.lengths, length)
        self.counts[length] = self.counts.get(length, 0) + n

    def largest(self, most: int) -> int:
        """The greatest length left that is at most ``most``, or 0."""
        at = bisect.bisect_right(self.lengths, most)
        return self.lengths[at - 1] if at else 0

    def sums(self, room: int) -> int:
        """Bit s is set if some of the pieces left have total length s, up to ``room``."""
        reach, mask = 1, (1 << room + 1) - 1
        for length in self.lengths:
            if length > room:
                break
            n, step = min(self.counts[length], room // length), 1
            while n > 0:  # bounded multiples by doubling
                step = min(step, n)
                reach |= (reach << step * length) & mask
                n -= step
                step *= 2
        return reach


def _dominating(left: _Histogram, longest: int, limit: int) -> tuple[int, ...] | None:
    """Partners of one ``longest`` piece in a set that dominates every feasible set with it, if one is proven."""
    room = limit - longest
    first = left.largest(room)
    if not first:
        return ()
    if first == room:  # an exact fit: whatever else could stand there fits in the partner's place
        return (first,)
    # Every other set's total must fit in the place of the largest partner; then it dominates.
    if not left.sums(room) >> first + 1:
        return (first,)
    smallest = left.lengths[0]
    if 3 * smallest <= room:
        return None
    # At most two partners fit. The pair of the largest and the largest beside it dominates if in
    # every other pair the smaller one fits beside it or both fit in the place of the largest.
    rest = room - first
    second = left.largest(rest)
    if not second or (second == first and left.counts[first] < 2):
        return None
    for p in left.lengths:
        q = left.largest(min(p, room - p))
        if p > room or not q:
            continue
        if q > second and p + q > first:
            return None
    return (first, second)


def plan(counts: dict[int, int], limit: int = LIMIT) -> Plan:
    """Sequences for ``counts`` pieces of each length from 1 to ``limit``.

    A proof that holds for an instance holds for what is left of it, as long as the same partners are
    there; so equal sets are fixed as often as their pieces last. Passes repeat until none fixes a set.
    """
    result, left = Plan(limit), _Histogram(counts)
    changed = True
    while changed:
        changed = False
        for longest in sorted(left.lengths, reverse=True):
            while longest in left.counts:
                available = left.counts[longest]
                left.take(longest, 1)  # its partners come from the others
                partners = _dominating(left, longest, limit)
                if partners is None:
                    left.put(longest, 1)
                    break
                content = {longest: 1}
                for p in partners:
                    content[p] = content.get(p, 0) + 1
                times = min((available if p == longest else left.counts[p]) // n for p, n in content.items())
                left.put(longest, 1)
                for p, n in content.items():
                    left.take(p, n * times)
                result.sets.append((times, tuple(sorted(content.items(), reverse=True))))
                result.fixed += times
                changed = True
    result.sets += _best_fit(left.counts, limit)
    return result


def _best_fit(counts: dict[int, int], limit: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Best fit, longest first, over groups of equally filled sequences."""
    open_: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = {}  # room -> (sequences, content)
    rooms: list[int] = []

    def add(room: int, n: int, content: tuple[tuple[int, int], ...]) -> None:
        if room not in open_:
            bisect.insort(rooms, room)
            open_[room] = []
        open_[room].append((n, content))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = limit // length
                whole, over = divmod(n, each)
                if whole:
                    add(limit - each * length, whole, ((length, each),))
                if over:
                    add(limit - over * length, 1, ((length, over),))
                break
            room = rooms[at]
            number, content = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            each = room // length
            whole = min(number, n // each)
            if whole:
                add(room - each * length, whole, (*content, (length, each)))
                n -= whole * each
            if number > whole:
                if n and n < each:
                    add(room - n * length, 1, (*content, (length, n)))
                    whole, n = whole + 1, 0
                if number > whole:
                    add(room, number - whole, content)
    return [x for group in open_.values() for x in group]


def _places(made: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first number, last number + 1, first sequence, pieces per sequence, offset) that cover all pieces."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for n, content in made.sets:
        offset = 0
        for length, each in content:
            low = used.get(length, 0)
            used[length] = low + n * each
            rows.append((length, low, low + n * each, sequence, each, offset))
            offset += length * each
        sequence += n
    return rows


def pack(found: DataFrame, limit: int = LIMIT, length: str = "length") -> DataFrame:
    """``found`` with ``sequence_id`` and ``offset``: pieces of each sequence stand from 0 on without gaps.

    ``length`` holds whole numbers from 1 to ``limit``; all other columns, whatever their names and
    values, are carried along, but for earlier ``sequence_id`` and ``offset``, which are made anew.
    Equal rows are as many pieces. An empty table gives no rows.
    """
    row = found.drop("sequence_id", "offset")
    # Equal rows are told apart by where they stand, so that they are spread as well.
    place = F.monotonically_increasing_id()
    base = materialize(row.select(F.struct("*").alias("row"), F.col(f"`{length}`").alias("length"), place.alias("place")), "pieces")
    base = base.withColumn("_order", F.xxhash64("place"))
    counts = {r[0]: r[1] for r in base.groupBy("length").count().collect()}  # at most ``limit`` rows
    if any(k is None or not 0 < k <= limit for k in counts):
        raise ValueError(f"lengths must be from 1 to {limit}")
    buckets = math.ceil(sum(counts.values()) / ROWS_PER_BUCKET)
    # The number of a piece within its length, by buckets, so that no length is sorted in one task.
    base = base.withColumn("_bucket", F.pmod("_order", F.lit(max(16, buckets))))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = base.groupBy("length", "_bucket").count().select(
        F.col("length").alias("_l"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    numbered = base.withColumn("_number", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_order")) - 1)
    numbered = numbered.join(starts, (F.col("length") == F.col("_l")) & (F.col("_bucket") == F.col("_b")))
    places = found.sparkSession.createDataFrame(
        _places(plan(counts, limit)), "_length bigint, _low bigint, _high bigint, _first bigint, _each bigint, _offset bigint")
    number = F.col("_number") + F.col("_before")
    # The plan has a few rows per length, so its size is bounded by ``limit``, not by the pieces.
    placed = numbered.withColumn("_n", number.cast("long")).join(
        F.broadcast(places), (F.col("length") == F.col("_length")) & (F.col("_n") >= F.col("_low")) & (F.col("_n") < F.col("_high")))
    return placed.select(
        "row.*", F.expr("_first + (_n - _low) div _each").alias("sequence_id"),
        (F.col("_offset") + F.pmod(F.col("_n") - F.col("_low"), F.col("_each")) * F.col("length")).cast("long").alias("offset"))
