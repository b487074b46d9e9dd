import hashlib
import io
from collections import Counter

import pytest
from helpers import prose, words  # noqa: F401
from pyspark.sql import functions as F

from lakeops.llm import warc
from lakeops.session import scratch_path

LONG = "<html>" + prose(5, 400) + "</html>"


def page(i, text):
    return (i, None if i == 3 else f"http://x.example/{i}?a b\r\nX-Page-Id: 9 é", text)


ROWS = [page(i, t) for i, t in [
    (1, LONG), (2, LONG), (3, LONG), (4, LONG + "x"), (5, None), (6, ""), (7, "short"), (8, "short"), (None, LONG), (None, "short"), (8, "short"), (None, LONG + "null"),
    (None, LONG + "null"), (9, LONG + "twice"), (9, LONG + "twice"), (9, LONG + "twice"), (10, "é" * 500), (11, "é" * 500), (12, "a" * 999), (13, "a" * 999),
    (14, "\r\n\r\nWARC/1.1\r\n" + prose(7, 300)), (15, prose(8, 60000)), (16, prose(8, 60000))]] + [page(100 + i, f"<p>{prose(100 + i, 200)}</p><div class='footer'>") for i in range(80)]


def want(rows):
    best, done, found = {}, set(), []
    for i, _, text in rows:
        raw = (text or "").encode()
        if len(raw) >= 1000:
            best[raw] = max([best.get(raw), i], key=lambda x: (x is not None, x or 0)) if raw in best else i
    for i, _, text in rows:
        raw = (text or "").encode()
        first = raw not in best or (best[raw] == i and raw not in done)
        if first and raw in best:
            done.add(raw)
        found.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if first else "revisit", None if first else best[raw]))
    return Counter(found)


def pages(spark, rows, clash=()):
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return frame.selectExpr("*", *[f"'own' AS {c}" for c in clash])


def digest_rows(back):
    return Counter(tuple(r) for r in back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


@pytest.mark.parametrize("file_bytes", [1, 20_000, 64 << 20])
def test_archives_give_back_every_page(spark, file_bytes):
    place = scratch_path(spark, "archives")
    manifest = warc.write_archives(pages(spark, ROWS, ["place", "digest", "length", "top", "_key", "revisit"]), place, file_bytes=file_bytes)
    back = warc.read_archives(spark, manifest, place)
    assert digest_rows(back) == want(ROWS)
    texts = Counter((r.page_id, r.payload.decode()) for r in back.where("record_type = 'response'").collect())
    assert all((i, t or "") in {(a, c or "") for a, _, c in ROWS} for i, t in texts)
    assert sum(r.records for r in manifest.collect()) == len(ROWS)
    responses = {r.record_id: r for r in back.where("record_type = 'response' AND payload_bytes >= 1000").collect()}
    for r in back.where("record_type = 'revisit'").collect():
        assert responses[r.refers_to_record].payload_digest == r.payload_digest and r.payload is None
    assert back.select("record_id").distinct().count() == len(ROWS)


def test_the_dictionary_pays_and_stands_in_front():
    records = [warc.record(i, f"http://x.example/{i}", f"<html><head><title>{prose(i, 4)}</title></head><body>{prose(i, 30)}</body></html>".encode(),
                           hashlib.sha1(str(i).encode()).hexdigest(), 10, None, False) for i in range(2000)]
    import zstandard

    parts = list(warc.archive_bytes(records))
    assert parts[0][:4] == b"\x5d\x2a\x4d\x18" and len(parts) == 2001 and all(p[:4] == warc.FRAME for p in parts[1:])
    alone = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in records)
    assert sum(map(len, parts)) < 0.8 * alone
    assert list(warc._frames(io.BytesIO(b"".join(parts)))) == records
    assert list(warc._frames(io.BytesIO(b"".join(parts)), size=7)) == records
    with pytest.raises(ValueError):
        list(warc._frames(io.BytesIO(b"".join(parts)[:-3])))


def test_few_or_equal_records_need_no_dictionary():
    for records in ([], [b"x"], [b"same" * 100] * 50, [bytes(2000)]):
        assert list(warc._frames(io.BytesIO(b"".join(warc.archive_bytes(records))))) == records


def test_a_changed_payload_is_found_out(spark):
    raw = warc.record(1, "http://x", b"payload", hashlib.sha1(b"payload").hexdigest(), 7, None, False)
    assert warc._row(raw)[-1] == b"payload"
    with pytest.raises(ValueError):
        warc._row(raw.replace(b"payload\r", b"Payload\r"))


def test_files_of_lost_attempts_and_no_pages(spark):
    place = scratch_path(spark, "archives")
    manifest = warc.write_archives(pages(spark, ROWS), place)
    warc.write_archives(pages(spark, ROWS), place)
    assert digest_rows(warc.read_archives(spark, manifest, place)) == want(ROWS)
    empty = warc.write_archives(pages(spark, ROWS).where(F.lit(False)), place)
    assert warc.read_archives(spark, empty, place).collect() == []


def test_the_registered_query(spark, tmp_path):
    from lakeops.llm.queries import QUERIES

    pages(spark, ROWS).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    assert digest_rows(QUERIES["op12_warc_archive"](spark, str(tmp_path))) == want(ROWS)
