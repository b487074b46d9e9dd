import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from helpers import awkward, table  # noqa: F401
from pyspark.sql import functions as F

from lakeops.llm import simhash
from lakeops.llm.components import components


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in distinct}


def test_documents_against_brute_force(spark, table, awkward):
    rows = [r for r in awkward if r[0] != 9] + [(20 + i, t) for i, t in enumerate(["a b c d e f", "a b c d e f", "A B C d e f g"])]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id)
                 for r in simhash.near_duplicates(table(rows, ["fingerprint", "component_id", "root", "_id"])).collect())
    prints = [brute_print(t) for _, t in rows]
    classes = brute_classes(prints)
    least = defaultdict(list)
    for (doc, _), p in zip(rows, prints, strict=True):
        if doc is not None:
            least[classes[p]].append(doc)
    want = sorted((-1 if doc is None else doc, f"{p:016x}", min(least[classes[p]], default=None)) for (doc, _), p in zip(rows, prints, strict=True))
    assert got == want


@pytest.mark.parametrize("limit", [600, 4])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, limit):
    """Families of near copies around a centre; a small limit takes the path of large table entries."""
    if limit < 100:
        balls = {2: simhash._ball(2), 1: simhash._ball(1)}
        monkeypatch.setattr(simhash, "_ball", lambda r: type("Few", (), {"__len__": lambda s: 2, "__iter__": lambda s: iter(balls[r])})())
    rng = random.Random(limit)
    prints = {rng.getrandbits(64) for _ in range(50)}
    for centre in list(prints)[:4]:
        for _ in range(150):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4]))))
    keys = []
    for p in prints:
        for s in (0, 1):
            value = p >> 32 * s & 0xFFFFFFFF
            keys.append(((s << 32) + value, p, False))
            keys += [((s << 32) + (value | 1 << i), p, True) for i in range(32) if not value >> i & 1]
    keys.sort()
    links, at = [], 0
    while at < len(keys):
        end = at
        while end < len(keys) and keys[end][0] == keys[at][0]:
            end += 1
        stored = np.array([p for _, p, probe in keys[at:end] if not probe], np.uint64)
        probes = np.array([p for _, p, probe in keys[at:end] if probe], np.uint64)
        if len(stored) and end - at > 1:
            a, b = simhash._linked(stored, probes, 0 if keys[at][0] >> 32 else 32)
            links += list(zip(a.tolist(), b.tolist(), strict=True))
        at = end
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {p: find(p) for p in prints} == brute_classes(prints)


def test_spark_links_match_brute_force(spark):
    rng = random.Random(5)
    prints = {0, 2**64 - 1} | {rng.getrandbits(64) for _ in range(30)}
    for centre in list(prints)[:5]:
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3]))) for _ in range(60)}
    signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fingerprint bigint"))
    found = {r.node: r.root for r in components(links).collect()}
    by_root = defaultdict(set)
    for (p,) in signed:
        by_root[found.get(p, p)].add(p % 2**64)
    want = defaultdict(set)
    for p, root in brute_classes(prints).items():
        want[root].add(p)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path_and_a_star(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 50)}


def test_one_document_of_each_group_stays(spark, table, awkward):
    rows = [r for r in awkward if r[0] != 9]
    docs = table(rows, ["fingerprint"])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # 1, 2 and 3 have no words; 6, 6 and 7 are equal.
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == sorted(
        [(False, 0), *[(True, i) for i in (1, 4, 5, 6, 8, 10, 11, 12)]])


def test_no_documents(spark, table):
    assert simhash.near_duplicates(table([])).collect() == []
    assert simhash.keep_one(table([(1, "a")]).where(F.lit(False))).collect() == []
