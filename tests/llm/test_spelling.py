import random
import re
import zlib
from collections import Counter

import pytest
from helpers import awkward, prose, table, words  # noqa: F401
from pyspark.sql import functions as F

from lakeops.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, min_length=6, slip=None):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            crc = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and crc % slip == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= min_length:
                found[run] += 1
    return found


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts, min_count=5, ratio=5):
    counts = {w: n for w, n in counts.items() if n >= min_count}
    beside = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(beside[w]), counts.get(form[w])))
    return sorted(rows)


def found(counts, **options):
    return sorted(tuple(r) for r in spelling.variants(counts, **options).select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_counts_are_those_of_brute_force(spark, table, awkward):  # noqa: F811
    rng = random.Random(4)
    rows = awkward + [(50 + i, prose(i, 300)) for i in range(20)] + [
        (None, "Ärgern ärgern ÄRGERN ×÷÷××÷ aþÿÀabc naïveté"), (80, "x" * 200 + " " + "é" * 70 + "\0zzzzzzz\0"), (81, "ABCDEF" * 3 + "-abcdef_ABCDEFĀabcdef")]
    rows += [(100 + i, " ".join(rng.choice(["ÀÉÎõü", "abcdefg", "ABCDEFG", "straße"]) + rng.choice(["", "s", "é"]) for _ in range(50))) for i in range(60)]
    for slip in (None, 199, 3):
        got = spelling.word_counts(table(rows, ["word", "n", "_id", "_text"]), slip=slip).collect()
        assert {r.word: r.n for r in got} == dict(brute_counts(rows, slip=slip))


@pytest.mark.parametrize("alphabet", ["ab", "aéа", "abcdefgh"])
def test_variants_are_those_of_brute_force(spark, alphabet):
    rng = random.Random(len(alphabet))
    counts = {}
    for _ in range(250):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7)))
        counts[w] = rng.choice([1, 4, 5, 6, 25, 30, 125, 150, 700, 5000, 10**6])
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint").selectExpr("*", "1 AS place", "'x' AS form", "2 AS best")
    assert found(frame) == brute_variants(counts)
    assert found(frame, min_count=1, ratio=2) == brute_variants(counts, 1, 2)


def test_nodes_are_prefixes(spark):
    rng = random.Random(9)
    vocabulary = sorted({"".join(rng.choice("abü") for _ in range(rng.randint(1, 9))) for _ in range(400)})
    frame = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    numbers, by_number = {}, {}
    for r in spelling.trie_nodes(frame).collect():
        assert vocabulary[r.place] == r.word and len(r.nodes) == len(r.word) + 1 and r.nodes[0] == 0
        for i, node in enumerate(r.nodes):
            assert numbers.setdefault(r.word[:i], node) == node and by_number.setdefault(node, r.word[:i]) == r.word[:i]


def test_long_words_and_long_chains(spark):
    counts = {"x" * 5000: 5, "x" * 5001: 40, "x" * 2500 + "y" + "x" * 2500: 300}
    counts |= {"abcdef" + "g" * k: 5 ** (k + 1) for k in range(11)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert found(frame) == brute_variants(counts)
    assert {r[2] for r in found(frame) if r[0].startswith("abc")} == {"abcdef" + "g" * 10}


def test_no_words(spark, table):  # noqa: F811
    assert found(spelling.word_counts(table([]))) == []
    assert found(spelling.word_counts(table([(1, None), (2, ""), (3, "a b")]))) == []
    odd = spark.createDataFrame([(None, 9), ("", 9), ("word", None), ("lonely", 7)], "word string, n bigint")
    assert found(odd) == [("lonely", None, "lonely", 7, 0, None)]


def test_the_registered_query(spark, tmp_path, table, awkward):  # noqa: F811
    from lakeops.llm.queries import QUERIES

    base = words(1, 60)
    rng = random.Random(2)
    rows = awkward + [(10 * i, " ".join(rng.choices(base, range(1, 61), k=400)).replace("a", rng.choice(["a", "a", "a", "aé"]))) for i in range(60)]
    table(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_spelling_variants"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()) == brute_variants(brute_counts(rows, slip=199))
    assert got.where(F.col("form").isNotNull()).count() > 0
