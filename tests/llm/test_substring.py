import numpy as np
import pyarrow as pa
from helpers import awkward, prose, table  # noqa: F401

from lakeops.llm import substring
from lakeops.llm.blocks import blocks


def slow_gear(data):
    out = []
    for i in range(len(data)):
        h = 0
        for b in data[max(0, i - 15):i + 1]:
            h = (h * 2 + int(substring.GEAR[b])) & 0xFFFF
        out.append(h)
    return out


def test_gear_hash_rolls_over_sixteen_bytes():
    data = np.frombuffer(prose(1, 30).encode(), np.uint8)
    assert substring.gear(data).tolist() == slow_gear(data)
    assert substring.gear(data[:3]).tolist() == slow_gear(data[:3]) and substring.gear(data[:0]).tolist() == []


def test_chunks_cover_texts_and_survive_insertions():
    text = prose(2, 400)
    moved = prose(3, 3) + " " + text[:900] + prose(4, 5) + text[900:]
    block = next(blocks(pa.array([text, moved, "", "x"])))[2]
    bounds = substring.cuts(block)
    parts = [[block.data[a:b].tobytes() for a, b in zip(x[:-1], x[1:], strict=True)] for x in bounds]
    assert b"".join(parts[0]).decode() == text and b"".join(parts[1]).decode() == moved
    assert parts[2] == [] and parts[3] == [b"x"]
    assert len(set(parts[0]) - set(parts[1])) <= 8


def test_passages_are_caught_and_clean_documents_are_not(spark, table, awkward):
    passages = [prose(1000 + i, 55) for i in range(40)]
    holders = [(2 * i + k + 1000, f"{prose(3000 + 2 * i + k, 60)} {p} {prose(5000 + 2 * i + k, 60)}") for i, p in enumerate(passages) for k in (0, 1)]
    clean = [(9000 + i, prose(9000 + i, 200)) for i in range(60)]
    rest = [r for r in awkward if r[0] not in (6, 7)]
    docs = table(holders + clean + rest + [(20, "again and again. " * 200)], ["at", "start"])
    found = substring.repeated_passages(docs)
    rows = found.collect()
    caught = {r.doc_id for r in rows}
    assert len(caught & {i for i, _ in holders}) >= 78 and not caught & {i for i, _ in clean + rest} and 20 not in caught
    texts = dict(holders)
    for r in rows:
        own = passages[(r.doc_id - 1000) // 2]
        body = texts[r.doc_id][r.start:r.end]
        assert body.strip() in own and r.end - r.start >= 80
    late = {r.doc_id for r in rows if r.n_repeats == r.n_chunks}
    assert late and all(i % 2 for i in late) and not any(r.n_repeats for r in rows if r.doc_id % 2 == 0)
    cut = {r.doc_id: r.text for r in substring.without_repeats(docs, found).collect() if r.doc_id is not None}
    for i, t in holders + clean + [x for x in rest if x[0] is not None]:
        spans = sorted((r.start, r.end) for r in rows if r.doc_id == i and i in late)
        want, last = "", 0
        for s, e in spans:
            want, last = want + t[last:s], e
        assert cut[i] == (None if t is None else want + t[last:])


def test_copies_and_empty_tables(spark, table):
    text = prose(1, 100)
    rows = substring.repeated_passages(table([(1, text), (2, text), (2, text), (None, text), (3, None)])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.start, r.end, r.n_repeats == r.n_chunks) for r in rows) == [
        (False, 1, 0, len(text), False), (False, 2, 0, len(text), True), (True, 0, 0, len(text), True)]
    assert substring.repeated_passages(table([])).collect() == []


def test_texts_that_share_an_id_are_not_cut(spark, table):
    text, other = prose(1, 100), prose(2, 100)
    docs = table([(1, text), (2, text), (2, other), (3, text + " " + other)])
    found = substring.repeated_passages(docs)
    cut = sorted((r.doc_id, r.text) for r in substring.without_repeats(docs, found).collect())
    assert cut[:3] == sorted([(1, text), (2, text), (2, other)]) and len(cut[3][1]) < 60


def test_texts_without_an_id_or_with_a_shared_one_are_documents_of_their_own(spark, table):
    import xxhash

    passage = prose(50, 60)
    for a, b in ((None, None), (7, 7)):
        texts = [f"{prose(51, 60)} {passage} {prose(52, 60)}", f"{prose(53, 60)} {passage} {prose(54, 60)}"]
        rows = substring.repeated_passages(table([(a, texts[0]), (b, texts[1]), (9, prose(55, 90))])).collect()
        by_hash = {r.text_hash: r for r in rows}
        assert len(rows) == 2 and all(r.doc_id == a and r.n_repeats == 0 for r in rows)
        for t in texts:
            h = xxhash.xxh64_intdigest(t.encode(), 42)
            r = by_hash[h - (1 << 64) if h >> 63 else h]
            assert t[r.start:r.end].strip() in passage


def test_the_registered_query(spark, table, tmp_path, awkward):
    from lakeops.llm.queries import QUERIES

    passage = prose(60, 60)
    rows = awkward + [(100 + i, f"{prose(61 + i, 40)} {passage}") for i in range(3)]
    table(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id for r in QUERIES["op8_substring_dedup"](spark, str(tmp_path)).collect()}
    assert got >= {100, 101, 102, 6, 7} and not got & {1, 2, 3, 4, 5, 8, 9}
