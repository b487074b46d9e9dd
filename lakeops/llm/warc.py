"""Web archives of records that are compressed one by one against a dictionary of their own file.

A file begins with a skippable frame that holds a Zstandard dictionary, itself compressed, and goes on
with one frame per record, so a record can be read from its offset with the dictionary alone. The
dictionary is trained on records of that file, in the task that writes it. Pages whose payload stands
elsewhere in the archive become ``revisit`` records, which carry the headers only.

Files are named after their writing attempt, and a manifest names those of the attempts that
succeeded, so a lost or repeated task leaves nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.token_files import _filesystem
from lakeops.session import materialize, scratch_path

MAGIC = 0x184D2A5D  # skippable frame with a dictionary
FRAME = b"\x28\xb5\x2f\xfd"
MIN_REVISIT = 1000
FILE_BYTES = 64 << 20
DICTIONARY_BYTES = 112 << 10
SAMPLE_BYTES = 8 << 20
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def _record_id(page_id: int | None, digest: str) -> str:
    """The id of the response record of a page: the same wherever it is asked for."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id} {digest}'.encode()).digest())}>"


def _header_text(value: str) -> str:
    """Control characters and white space as percent codes, so that a header stays one line."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c in "\x7f\x85  " else c for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, length: int, target: int | None, revisit: bool | None) -> bytes:
    """One record. ``digest``: hexadecimal SHA-1 of the full payload of ``length`` bytes; ``target``: the page a revisit refers to.

    ``revisit`` is null for a response that no revisit refers to: such an id need not be known elsewhere.
    """
    block = _HEAD.format(length).encode() + (b"" if revisit else payload or b"")
    own = _record_id(page_id, digest) if revisit is False else f"<urn:uuid:{uuid.uuid4()}>"
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {own}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header_text(url) if url else f'urn:page:{page_id}'}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(target, digest)}", f"X-Payload-Length: {length}"]
        if target is not None:
            lines.append(f"X-Refers-To-Page: {target}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(records: list[bytes], size: int = DICTIONARY_BYTES, sample: int = SAMPLE_BYTES):
    """A dictionary of at most ``size`` bytes from ``records``, or None if they are too few or too much alike to train one.

    It learns from every k-th record, so many that they come to about ``sample`` bytes, of each at most
    its first ``size`` bytes; all records are compressed with it.
    """
    import zstandard

    step = max(1, -(-sum(map(len, records)) // sample))
    chosen = [r[:size] for r in records[::step]]
    size = min(size, sum(map(len, chosen)) // 8)
    if size < 256:
        return None
    try:
        return zstandard.train_dictionary(size, chosen, k=1024, d=8, level=LEVEL)
    except zstandard.ZstdError:
        return None


def archive_bytes(records: list[bytes]) -> Iterator[bytes]:
    """The parts of one file: the dictionary's frame, if there is one, then a frame per record."""
    import zstandard

    trained = train(records)
    if trained is not None:
        stored = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
        yield struct.pack("<II", MAGIC, len(stored)) + stored
    writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True, write_checksum=True)
    for one in records:
        yield writer.compress(one)


def _marked(pages: DataFrame, page_id: str, url: str, html: str, min_revisit: int) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest``, ``length``, ``target`` and ``revisit`` (null where no other page has the payload) of every page.

    Pages are stored once with a number of their own, so that one of several equal rows can be told
    from the others. Digests are summed up to one row each before they meet the pages, and pages that
    can't be revisits are dealt out by their numbers.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary").alias("html"), F.monotonically_increasing_id().alias("place"))
    path = scratch_path(pages.sparkSession, "pages")
    rows.withColumns({"digest": F.sha1("html"), "length": F.octet_length("html").cast("long")}).write.option("compression", "zstd").parquet(path)
    stored = pages.sparkSession.read.parquet(path)
    large = F.col("length") >= min_revisit
    # The largest id, nulls below all others; of equal ids one row.
    tops = stored.where(large).groupBy("digest").agg(F.max(F.struct("page_id", "place")).alias("top"), F.count("*").alias("_n")).where("_n > 1")
    key = F.when(large, F.col("digest")).otherwise(F.col("place").cast("string"))
    met = stored.withColumn("_key", key).join(tops.select(F.col("digest").alias("_key"), "top"), "_key", "left")
    return met.select("page_id", "url", "html", "digest", "length", F.col("top.page_id").alias("target"),
                      (F.col("place") != F.col("top.place")).alias("revisit"))


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` under ``folder`` and give the manifest: ``name``, ``records``, ``plain_bytes``, ``bytes``.

    The payload is ``html`` in UTF-8, null as empty. Of equal payloads of ``min_revisit`` bytes or more
    the one of the largest id is a response and the others are revisits of it; rows that are equal in
    id as well are one response and revisits of their own id. Null ids come last and stay null, a null
    or empty url is written as ``urn:page:<id>``. ``folder`` must be reachable from all executors;
    a file holds about ``file_bytes`` of records, a larger record stands in a file of its own. No rows
    give no files. Other columns are not written.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        held: list[bytes] = []
        size = 0

        def write() -> pa.RecordBatch:
            name, written = f"{uuid.uuid4().hex}.warc.zst", 0
            system.create_dir(root, recursive=True)
            with system.open_output_stream(f"{root}/{name}") as stream:
                for part in archive_bytes(held):
                    stream.write(part)
                    written += len(part)
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), *(pa.array([x], pa.int64()) for x in (len(held), size, written))], ["name", "records", "plain_bytes", "bytes"])

        for batch in batches:
            columns = [batch.column(i) for i in range(7)]
            for i in range(batch.num_rows):
                page, link, payload, digest, length, target, again = (c[i].as_py() for c in columns)
                one = record(page, link, payload, digest, length, target, again)
                if held and size + len(one) > file_bytes:
                    yield write()
                    held, size = [], 0
                held.append(one)
                size += len(one)
        if held:
            yield write()

    marked = _marked(pages, page_id, url, html, min_revisit)
    # A revisit needs its digest only.
    lean = marked.withColumn("html", F.when(~F.coalesce("revisit", F.lit(False)), F.col("html")))
    return materialize(lean.mapInArrow(run, "name string, records bigint, plain_bytes bigint, bytes bigint"), "manifest")


def _frames(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The records of an open file, one at a time."""
    import zstandard

    data, dictionary = b"", None
    while len(data) < 8 and (more := stream.read(size)):
        data += more
    if data[:4] == struct.pack("<I", MAGIC):
        length = struct.unpack("<I", data[4:8])[0]
        while len(data) < 8 + length and (more := stream.read(size)):
            data += more
        stored, data = data[8:8 + length], data[8 + length:]
        plain = zstandard.ZstdDecompressor().decompress(stored) if stored[:4] == FRAME else stored
        dictionary = zstandard.ZstdCompressionDict(plain)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while data or (data := stream.read(size)):
        one, parts = reader.decompressobj(), []
        while True:
            parts.append(one.decompress(data))
            if one.eof:
                data = one.unused_data
                break
            data = stream.read(size)
            if not data:
                raise ValueError("the file ends within a record")
        yield b"".join(parts)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name and the content block of one record."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    length = int(headers["content-length"])
    if not found or not version.startswith("WARC/") or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, rest[:length]


def _row(raw: bytes) -> tuple:
    headers, block = parse(raw)
    kind = headers["warc-type"]
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {headers['warc-record-id']} is not what its digest says")
    number = lambda name: int(headers[name]) if name in headers else None
    length = number("x-payload-length") if payload is None else len(payload)
    return (number("x-page-id"), headers["warc-target-uri"], headers["warc-record-id"], kind, length, digest,
            number("x-refers-to-page"), headers.get("warc-refers-to"), payload)


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the files in ``manifest``; digests of responses are checked against their payloads."""
    schema = ("page_id bigint, url string, record_id string, record_type string, payload_bytes bigint, payload_digest string, "
              "refers_to bigint, refers_to_record string, payload binary")
    names = ["page_id", "url", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "refers_to_record", "payload"]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{root}/{name}") as stream:
                    for raw in _frames(stream):
                        rows.append(_row(raw))
                        size += len(raw) + 500
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    count = manifest.count()
    spread = manifest.select("name").repartition(max(1, min(count, spark.sparkContext.defaultParallelism * 4)), "name")
    return spread.mapInArrow(run, schema)
