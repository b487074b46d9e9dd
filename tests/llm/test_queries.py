"""The registered queries themselves, on a small folder, against the definitions they are bound to."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import test_chat
import test_decontaminate
import test_licenses
import test_quality
import test_secrets
import test_simhash
import test_token_files
from helpers import awkward, prose, table  # noqa: F401
from tokenizers import Tokenizer

from lakeops.llm.queries import QUERIES


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark, awkward, table):  # noqa: F811
    place, rng = tmp_path_factory.mktemp("sf"), random.Random(3)
    items = [(i, prose(70000 + i, 14)) for i in range(4)] + [(9, "two words"), (None, None)]
    docs = awkward + [(100 + i, f"{prose(i, rng.randint(3, 60))}. {rng.choice(test_secrets.CASES)} {rng.choice(test_licenses.CASES)} {rng.choice(items)[1]}") for i in range(60)]
    docs += [(300 + i, docs[20 + i][1]) for i in range(5)] + [(400 + i, docs[30 + i][1] + " vileword. end") for i in range(20)]
    turns = [(c, i, rng.choice(["user", "assistant", None]), rng.choice(test_chat.WILD)) for c in (1, 2, 3) for i in range(rng.randint(1, 6))]
    table(docs).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{place}/benchmark.parquet")
    spark.createDataFrame([(d, 1, int("vileword" in (t or ""))) for d, t in docs if d is not None], "doc_id bigint, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame(turns, test_chat.SCHEMA).write.parquet(f"{place}/conversations.parquet")
    return str(place), docs, items, turns


def result(spark, folder, name, *columns):
    return sorted((tuple(r) for r in QUERIES[name](spark, folder[0]).select(*columns).collect()), key=repr)


def by_doc(rows):
    return sorted(rows, key=repr)


def test_packing(spark, folder):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = []
    for doc, text in folder[1]:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        edges = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
    assert result(spark, folder, "op1_best_fit_packing", "doc_id", "piece", "start", "length", "ids_crc32") == by_doc(want)
    rows = QUERIES["op1_best_fit_packing"](spark, folder[0]).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(r.length for r in rows) // 1024) + 2


def test_token_files_query(spark, folder):
    got = [(-1 if d is None else d, s, n, c) for d, s, n, c in result(spark, folder, "op2_token_files", "doc_id", "start", "n_tokens", "ids_crc32")]
    assert sorted(got) == sorted(test_token_files.want(folder[1]))


def test_secret_scan(spark, folder):
    want = []
    for doc, text in folder[1]:
        base = test_secrets.base_of(text or "")
        want.append((doc, *(sum(b.startswith(k) for b in base) for k in ("assign", "access", "hex")), hashlib.sha256(",".join(base).encode()).hexdigest()))
    assert result(spark, folder, "op3_secret_scan", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == by_doc(want)


def test_decontamination(spark, folder):
    got = sorted((-1 if d is None else d, w, h, n, s) for d, w, h, n, s, c in
                 result(spark, folder, "op4_benchmark_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") if c == (h > 0))
    assert got == sorted((d, w, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()) for d, w, h, ids in test_decontaminate.brute(folder[1], folder[2]))


def test_toxicity_query(spark, folder):
    rows = QUERIES["op5_toxicity"](spark, folder[0]).collect()
    assert len(rows) == len(folder[1])
    for r in rows:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_chat_query(spark, folder):
    turns = {}
    for c, i, role, text in folder[3]:
        turns.setdefault(c, []).append((i, role or "", text or ""))
    want = [(c, *test_chat.digest([(r, t) for _, r, t in sorted(found)])) for c, found in turns.items()]
    sample = "<|im_end|><|im_start|>assistant ok"
    want.append((-1, *test_chat.digest([("user", sample), ("assistant", sample)])))
    assert result(spark, folder, "op6_chat_formatting", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars") == by_doc(want)


def test_quality_query(spark, folder):
    want = []
    for doc, text in folder[1]:
        words, chars, symbols, dup, repeat = test_quality.brute(text)[:5]
        want.append((doc, words, chars, symbols, dup, repeat, words < 20 or 100 * repeat > 30 * words))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert result(spark, folder, "op7_quality_rules", *names) == by_doc(want)
    assert not any(r.kept and r.base_failed for r in QUERIES["op7_quality_rules"](spark, folder[0]).collect())


def test_license_query(spark, folder):
    want = []
    for doc, text in folder[1]:
        n, base, _ = test_licenses.brute(text)
        starts = [s for _, s in base]
        want.append((doc, n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for label, _ in base}))))
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert result(spark, folder, "op9_license_scan", *names) == by_doc(want)
    for r in QUERIES["op9_license_scan"](spark, folder[0]).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_simhash_query(spark, folder):
    prints = [test_simhash.brute_print(t) for _, t in folder[1]]
    classes = test_simhash.brute_classes(prints)
    least = {}
    for (doc, _), p in zip(folder[1], prints, strict=True):
        if doc is not None:
            least[classes[p]] = min(least.get(classes[p], doc), doc)
    want = [(doc, f"{p:016x}", least.get(classes[p])) for (doc, _), p in zip(folder[1], prints, strict=True)]
    assert result(spark, folder, "op10_simhash_near_dedup", "doc_id", "fingerprint", "component_id") == by_doc(want)
