import zlib

import numpy as np
import public_tokenizers
import xxhash
from helpers import awkward, table  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import token_files
from lakeops.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_numbers_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        for top in (1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1):
            values = np.append(rng.integers(0, top + 1, n), [0, top][:min(n, 2)]).astype(np.uint32)
            control, data = token_files.encode_numbers(values)
            assert len(control) == -(-len(values) // 4)
            assert token_files.decode_numbers(control, data, len(values)).tolist() == values.tolist()


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def want(rows):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    found, start = [], 0
    ids = [(doc, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u2")) for doc, t in rows]
    for doc, one in sorted(ids, key=lambda x: (x[0] is not None, x[0] or 0, signed(xxhash.xxh64_intdigest(x[1].tobytes(), 42)), x[1].tobytes())):
        found.append((doc if doc is not None else -1, start, len(one), zlib.crc32(one.astype("<u4").tobytes())))
        start += len(one)
    return found


def write_and_read(spark, docs):
    tokens = token_files.stored(token_files.tokenize(docs, PATH, 1))
    folder = scratch_path(spark, "files")
    manifest, by_rank = token_files.write_files(tokens, folder)
    back = token_files.read_files(spark, manifest, by_rank, folder)
    rows = back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens, r.crc) for r in rows), manifest, by_rank


def test_files_give_back_every_document(spark, table, awkward, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 500)
    got, manifest, by_rank = write_and_read(spark, table(awkward, ["ids", "width"]))
    assert got == sorted(want(awkward))
    assert sum(r.n_docs for r in manifest.collect()) == len(awkward)


def test_ranks_fall_with_frequency(spark, table):
    docs = table([(1, "the the the the cat"), (2, "the dog cat")])
    counts = {r.id: r["count"] for r in token_files.id_counts(token_files.tokenize(docs, PATH, 1)).collect()}
    _, _, by_rank = write_and_read(spark, docs)
    assert sorted(by_rank.tolist()) == sorted(counts)
    assert [counts[i] for i in by_rank.tolist()] == sorted(counts.values(), reverse=True)


def test_no_documents(spark, table):
    assert write_and_read(spark, table([]))[0] == []


def test_files_of_lost_attempts_are_not_read(spark, table):
    tokens = token_files.stored(token_files.tokenize(table([(1, "one two"), (2, "three")]), PATH, 1))
    folder = scratch_path(spark, "files")
    manifest, by_rank = token_files.write_files(tokens, folder)
    token_files.write_files(tokens, folder)  # a second writer's files stand in the same folder
    assert token_files.read_files(spark, manifest, by_rank, folder).count() == 2
