"""The pipeline on a small folder against a brute-force version of every stage."""

import importlib.util
import os
import random
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import awkward, prose  # noqa: F401
from test_decontaminate import brute as hits_of
from test_shingles import brute_groups
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline

from lakeops.llm import secrets


@pytest.fixture(scope="module")
def folder(tmp_path_factory, awkward):  # noqa: F811
    rng, place = random.Random(8), tmp_path_factory.mktemp("sf")
    items = [(i, prose(40000 + i, 25)) for i in range(6)] + [(None, None)]
    docs, labels = [], []
    for i in range(300):
        text = ". ".join(prose(50000 + 50 * i + j, rng.randint(5, 12)).capitalize() for j in range(rng.randint(2, 40))) + "."
        if i % 4 == 0:
            text = text.replace(". ", rng.choice([" vileword. ", " badtalk. "]), 2)
        if i % 30 == 7:
            text += " " + items[i % 6][1]
        if i % 30 == 11:
            text += ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
        docs.append((i + 100, text))
        labels.append((i + 100, 1, int(i % 4 == 0)))
    docs += [(1000 + i, docs[i][1] + " end") for i in range(1, 40, 3)] + [(2000 + i, docs[i][1]) for i in range(1, 40, 4)] + awkward
    types = {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64()}
    columns = [[d for d, _ in docs], [t for _, t in docs], ["en"] * len(docs), [None] * len(docs), [None if t is None else len(t) for _, t in docs]]
    pq.write_table(pa.table([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], list(types)), place / "documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()), "text": pa.array([t for _, t in items])}), place / "benchmark.parquet")
    pq.write_table(pa.table({"doc_id": [d for d, _, _ in labels], "quality": pa.array([q for _, q, _ in labels], pa.int32()),
                             "toxic": pa.array([t for _, _, t in labels], pa.int32())}), place / "labels.parquet")
    return str(place), docs, items


def order(doc):
    return (doc is None, doc or 0)


def test_pipeline_against_brute_force(spark, folder):
    place, docs, items = folder
    got = corpus_pipeline.run(spark, place).collect()

    kept = [(d, t) for d, t in docs if not re.search("vileword|badtalk", t or "")]
    groups = brute_groups(kept)
    assert len(groups) < len(kept) - 20
    kept = [min(rows, key=lambda r: order(r[0])) for rows in groups.values()]
    bench = hits_of(kept, items)
    clean = [d for d, _, n, _ in bench if n == 0]
    kept = [(d, t) for d, t in kept if (-1 if d is None else d) in clean]
    scanner = secrets.Scanner()
    cleaned = []
    for d, t in kept:
        for start, end, kind in reversed([s for s in scanner.spans(t or "") if s[2] == "assign"]):
            t = t[:start] + "[ASSIGN]" + t[end:]
        cleaned.append((d, t))
    tokenizer, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    tokenizer.encode_special_tokens = True
    for d, t in cleaned:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)]
        want += [(order(d), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
    assert sorted((order(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    total = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) <= -(-total // 1024) + 2


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").selectExpr("*", "1 AS fingerprint", "2 AS hash", "3 AS start")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).columns == docs.columns


def test_the_entry_works_without_this_subpackage(monkeypatch):
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in ("lakeops.llm", "corpus_pipeline") else find(name, *a))
    spec = find("__spark_entry__")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    assert "pipeline" not in entry.queries() and not [n for n in entry.queries() if re.match(r"op\d+_", n)] and "order_summary" in entry.queries()


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
