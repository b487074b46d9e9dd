"""Token ids in binary files: frequency ranks in byte-aligned variable length, control bytes apart from data.

Ids are replaced by their rank among all ids of the corpus, so frequent ids are small numbers. Four
numbers share one control byte with two bits each, their length in bytes less one; the 1 to 4 data
bytes of each number, little-endian, stand in a stream of their own. A reader looks a control byte
up in a table of 256 rows to get four lengths and finds every number by running sums.

A file holds blocks of whole documents: a header of little-endian numbers (magic, documents, ids,
control bytes, data bytes), the document ids with a flag for null, their id counts, the control
bytes, the data bytes. Files are numbered in ascending document order, and a manifest names the files
of the attempts that succeeded, so a lost or repeated task leaves nothing that is read twice. The
rank table is stored beside them.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.llm.tokens import encoder, groups
from lakeops.session import materialize, scratch_path

MAGIC = 0x46525642
HEADER = "<IQQQQ"
BLOCK_IDS = 1 << 18
IDS_PER_FILE = 32_000_000
_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)
_LOW = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_numbers(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    values = values.astype("<u4")
    length = (1 + (values > 0xFF) + (values > 0xFFFF) + (values > 0xFFFFFF)).astype(np.uint8)
    codes = np.zeros((len(values) + 3) // 4 * 4, np.uint8)
    codes[:len(values)] = length - 1
    control = codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < length[:, None]]
    return np.bitwise_or.reduce(control, axis=1).astype(np.uint8).tobytes(), data.tobytes()


def decode_numbers(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers, by looking control bytes up in the table of lengths."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(length, dtype=np.int64)
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    at = ends - length
    found = np.zeros(n, np.uint32)
    for i in range(4):
        found |= padded[np.minimum(at + i, len(padded) - 1)].astype(np.uint32) << np.uint32(8 * i)
    return found & _LOW[length]


def tokenize(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` (long), ``width`` (bytes an id) and ``ids``: the whole text's ids and then ``end_id``. Null texts are empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        last = np.array([end_id], own.dtype).tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for low, high in groups([len(t) for t in texts], 4 << 20):
                found = [ids + last for ids in own.encode(texts[low:high])]
                width = pa.array(np.full(high - low, own.dtype.itemsize, np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), width, pa.array(found, pa.binary())], ["doc_id", "width", "ids"])

    chosen = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    return chosen.mapInArrow(run, "doc_id bigint, width int, ids binary")


def _ids(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{width}")


def stored(tokens: DataFrame) -> DataFrame:
    """``tokens`` written once to the shared folder, as they are read twice."""
    path = scratch_path(tokens.sparkSession, "tokens")
    tokens.write.option("compression", "zstd").parquet(path)
    return tokens.sparkSession.read.schema(tokens.schema).parquet(path)


def id_counts(tokens: DataFrame) -> DataFrame:
    """``id`` and its ``count`` over all documents; each task adds its own up before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for width, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = np.bincount(_ids(raw.as_buffer(), width))
                if len(counts) > len(total):
                    total = np.concatenate([total, np.zeros(len(counts) - len(total), np.int64)])
                total[:len(counts)] += counts
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "count"])

    return tokens.select("width", "ids").mapInArrow(run, "id bigint, count bigint").groupBy("id").agg(F.sum("count").alias("count"))


def _rank_table(counts: DataFrame) -> np.ndarray:
    """Ids by falling count, ties by id. One entry per id in use, so the vocabulary bounds it."""
    rows = counts.collect()
    return np.array([r.id for r in sorted(rows, key=lambda r: (-r["count"], r.id))], np.uint32)


def _filesystem(folder: str):
    from pyarrow import fs

    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def _block(numbers: list[int | None], parts: list[np.ndarray]) -> bytes:
    sizes = np.array([len(p) for p in parts], "<u8")
    control, data = encode_numbers(np.concatenate(parts))
    known = np.array([i is not None for i in numbers], np.uint8)
    ids = np.array([i or 0 for i in numbers], "<i8")
    header = struct.pack(HEADER, MAGIC, len(parts), int(sizes.sum()), len(control), len(data))
    return b"".join([header, known.tobytes(), ids.tobytes(), sizes.tobytes(), control, data])


def _read_header(stream, name: str) -> tuple[int, int, int, int] | None:
    """Documents, ids, control bytes and data bytes of the next block, if there is one."""
    head = stream.read(struct.calcsize(HEADER))
    if not head:
        return None
    magic, *rest = struct.unpack(HEADER, head)
    if magic != MAGIC:
        raise ValueError(f"{name} is not a token file")
    return tuple(rest)


def write_files(tokens: DataFrame, folder: str) -> tuple[DataFrame, np.ndarray]:
    """Write ``tokens`` in ascending document order; gives the manifest and the id of each rank.

    ``folder`` must be reachable from all executors. Null ids come first; rows with one id are ordered
    by a hash of their token ids, then by these, so equal tables give equal files. No rows give no
    files. The number of files follows from the number of ids.
    """
    counts = materialize(id_counts(tokens), "id_counts")
    by_rank = _rank_table(counts)
    ranks = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    total = counts.agg(F.sum("count")).first()[0] or 0
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        stream, name, first, held, numbers, size = None, "", None, [], [], 0
        written = docs = 0
        for batch in batches:
            for number, width, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if stream is None:
                    name, first = f"{uuid.uuid4().hex}.ids", number
                    system.create_dir(root, recursive=True)
                    stream = system.open_output_stream(f"{root}/{name}")
                held.append(shared.value[_ids(raw.as_buffer(), width)])
                numbers.append(number)
                size += len(held[-1])
                docs += 1
                if size >= BLOCK_IDS:
                    stream.write(_block(numbers, held))
                    written, size, held, numbers = written + size, 0, [], []
        if stream is not None:
            if held:
                stream.write(_block(numbers, held))
            stream.close()
            from pyspark import TaskContext

            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]), pa.array([first], pa.int64()),
                 pa.array([docs], pa.int64()), pa.array([written + size], pa.int64())], ["number", "name", "first_doc", "n_docs", "n_ids"])

    files = max(1, -(-total // IDS_PER_FILE))
    least = tokens.sparkSession.sparkContext.defaultParallelism
    # Ranges are found from a sample of ids and hashes; with the token ids it would bring whole documents to the driver.
    ordered = tokens.select("doc_id", "width", "ids", F.xxhash64("ids").alias("hash")).repartitionByRange(max(files, least), "doc_id", "hash")
    ordered = ordered.sortWithinPartitions("doc_id", "hash", "ids").select("doc_id", "width", "ids")
    manifest = materialize(ordered.mapInArrow(run, "number int, name string, first_doc bigint, n_docs bigint, n_ids bigint"), "manifest")
    return manifest, by_rank


def read_files(spark: SparkSession, manifest: DataFrame, by_rank: np.ndarray, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids before the document), ``n_tokens`` and ``ids`` (unsigned 32 bits) from the files."""
    shared = spark.sparkContext.broadcast(by_rank)
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    # The manifest has one row per file.
    files = manifest.select("name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_stream(f"{root}/{name}") as stream:
                    while head := _read_header(stream, name):
                        docs, n, controls, size = head
                        known = np.frombuffer(stream.read(docs), np.uint8)
                        numbers = np.frombuffer(stream.read(8 * docs), "<i8")
                        sizes = np.frombuffer(stream.read(8 * docs), "<u8").astype(np.int64)
                        ids = shared.value[decode_numbers(stream.read(controls), stream.read(size), n)].astype("<u4")
                        ends = np.cumsum(sizes)
                        raw = ids.tobytes()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(numbers, mask=known == 0), pa.array(start + ends - sizes), pa.array(sizes),
                             pa.array([raw[4 * (e - s):4 * e] for s, e in zip(sizes, ends, strict=True)], pa.binary())],
                            ["doc_id", "start", "n_tokens", "ids"])
                        start += n

    count = manifest.count()
    spread = files.repartition(max(1, min(count, spark.sparkContext.defaultParallelism * 4)), "name")
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
