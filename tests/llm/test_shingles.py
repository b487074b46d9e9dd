import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, prose, table, words  # noqa: F401
from pyspark.sql import functions as F

from lakeops.llm import shingles, simhash
from lakeops.llm.blocks import blocks


def brute_set(text, width=5):
    found = (text or "").encode().lower().split()
    return frozenset(tuple(found[i:i + width]) for i in range(max(1, len(found) - width + 1))) if found else frozenset()


def brute_groups(rows, least=0.8):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= least * len(a | b) - 1e-9:
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[find(i)].append(row)
    return groups


def families(seed, n, copies, edits):
    """``n`` texts and ``copies`` of each with up to ``edits`` words changed."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        base = words(seed * 1000 + i, rng.randint(30, 200))
        rows.append(base)
        for _ in range(copies):
            copy = list(base)
            for at in rng.sample(range(len(copy)), rng.randint(1, edits)):
                copy[at] = f"edit{rng.randrange(10**6)}"
            rows.append(copy[rng.randint(0, 3):])
    return [" ".join(r) for r in rows]


def kept_ids(docs):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect())


def test_one_of_each_group_stays_as_by_brute_force(spark, table, awkward):  # noqa: F811
    rows = awkward + [(100 + i, t) for i, t in enumerate(families(3, 25, 6, 6))]
    want = sorted(min((d is None, d or 0) for d, _ in group) for group in brute_groups(rows).values())
    docs = table(rows, ["node", "root", "key", "keys", "row", "by_id", "_by_id", "_by_text", "_whole", "_id"])
    kept = shingles.keep_one(docs)
    assert kept.columns == docs.columns and kept_ids(kept) == want
    assert len(want) < len(rows) - 50


@pytest.mark.parametrize("chunk, pivots, size", [(7, 30, 1 << 20), (1000, 200, 30_000)])
def test_a_large_family_in_small_rounds(spark, table, monkeypatch, chunk, pivots, size):  # noqa: F811
    monkeypatch.setattr(shingles, "CHUNK", chunk)
    monkeypatch.setattr(shingles, "PIVOTS", pivots)
    monkeypatch.setattr(shingles, "PIVOT_BYTES", size)
    rows = list(enumerate(families(5, 2, 90, 9) + families(6, 20, 1, 2)))
    want = sorted((False, min(d for d, _ in group)) for group in brute_groups(rows).values())
    assert kept_ids(shingles.keep_one(table(rows))) == want


def test_copies_with_one_changed_word_go_that_two_bits_leave(spark, table):  # noqa: F811
    rows = []
    for i in range(40):
        text = words(900 + i, 200)
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join([*text[:100], "changed", *text[101:]]))]
    assert kept_ids(shingles.keep_one(table(rows))) == [(False, 2 * i) for i in range(40)]
    assert simhash.keep_one(table(rows)).count() > 40


def test_no_more_rows_leave_a_task_than_sets_come_in():
    base = words(77, 120)
    rng, texts = random.Random(78), []
    for i in range(5000):
        copy = list(base)
        for at in rng.sample(range(120), 4):
            copy[at] = f"edit{i}{at}"
        texts.append(" ".join(copy))
    rows = []
    for _, _, block in blocks(pa.array(texts)):
        hashes, sizes = shingles.shingle_sets(block)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        rows += [hashes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    n = len(rows)
    order = [*range(1000), *range(n)]
    whole = pa.RecordBatch.from_arrays(
        [pa.array([1] * len(order)), pa.array([0] * len(order)), pa.array([True] * 1000 + [False] * n), pa.array(order), pa.array(order),
         pa.array([rows[i] for i in order], pa.binary())], ["key", "chunk", "pivot", "node", "root", "shingles"])
    found = [b for low in range(0, len(order), 1500) for b in [whole.slice(low, 1500)]]
    links = [(x, y) for b in shingles._compared(iter(found), 0.8) for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    sets = [frozenset(np.frombuffer(r, np.uint64).tolist()) for r in rows]
    assert len(links) < n and all(len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]) - 1e-9 for x, y in links)

    def groups(pairs):
        root = list(range(n))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for x, y in pairs:
            root[max(find(x), find(y))] = min(find(x), find(y))
        return [find(i) for i in range(n)]

    some = [(x, y) for x in range(0, 1000, 25) for y in range(n) if x != y and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]) - 1e-9]
    assert groups(links) == groups(links + some)


def test_sets_and_counts_are_those_of_brute_force(awkward):  # noqa: F811
    texts = [t for _, t in awkward] + ["a b c d", "a b c d e", "A b  c\td e f", "x " * 9]
    for _, _, block in blocks(pa.array(texts)):
        hashes, sizes = shingles.shingle_sets(block)
        assert sizes.tolist() == [len(brute_set(t)) for t in texts] and len(hashes) == sizes.sum()
        nodes, keys = shingles.signed(block)
        assert len(np.unique(nodes)) == len({brute_set(t) for t in texts}) and keys.shape == (len(texts), shingles.BANDS)


def test_no_documents(spark, table):  # noqa: F811
    assert shingles.keep_one(table([])).collect() == []
    assert shingles.keep_one(table([(1, "a")]).where(F.lit(False))).collect() == []


def test_fingerprints_find_copies_without_any_minhash_key(spark, table, monkeypatch):  # noqa: F811
    rows = []
    for i in range(12):
        text = words(1700 + i, 1500)
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join([*text, "more"]))]
    prints = [simhash.fingerprint(t.encode(), shingles.WIDTH) for _, t in rows]
    close = [i for i in range(12) if (prints[2 * i] ^ prints[2 * i + 1]).bit_count() <= 2]
    assert len(close) > 6
    monkeypatch.setattr(shingles, "_to_least", lambda entries: entries.select(F.col("node").alias("a"), F.col("node").alias("b")).where("1 = 0"))
    monkeypatch.setattr(shingles, "_rounds", lambda entries, sets, links, least: links)
    gone = {2 * i + 1 for i in close}
    assert kept_ids(shingles.keep_one(table(rows))) == [(False, d) for d, _ in rows if d not in gone]


def test_fingerprints_alone_link_nothing_below_the_similarity(spark, table, monkeypatch):  # noqa: F811
    a, b = words(1800, 60), words(1801, 60)
    rows = [(1, " ".join(a)), (2, " ".join([*a[:20], *b[:20], *a[40:]])), (3, " ".join(b))]
    monkeypatch.setattr(shingles.simhash, "fingerprint_links", lambda prints: prints.toDF("a").crossJoin(prints.toDF("b")).where("a < b"))
    assert kept_ids(shingles.keep_one(table(rows))) == [(False, 1), (False, 2), (False, 3)]
