import hashlib
import re

from helpers import awkward, prose, table  # noqa: F401

from lakeops.llm import decontaminate


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(docs, items):
    found = []
    for doc, text in docs:
        words, hit, ids = words_of(text), set(), set()
        for item, other in items:
            test = words_of(other)
            n = min(10, len(test))
            windows = {tuple(test[i:i + n]) for i in range(len(test) - n + 1)} if n else set()
            for i in range(len(words) - n + 1 if n else 0):
                if tuple(words[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    ids.add(item)
        names = sorted(str(i) for i in ids if i is not None)
        found.append((-1 if doc is None else doc, len(words), len(hit), names))
    return sorted(found)


def run(docs, items):
    base, hits = decontaminate.benchmark_hits(docs, items)
    flagged = {(r.doc_id, r.text_hash): (r.n_hit, r.items) for r in decontaminate.contaminated(hits).collect()}
    out = []
    for r in base.collect():
        n, ids = flagged.get((r.doc_id, r.text_hash), (0, []))
        out.append((-1 if r.doc_id is None else r.doc_id, r.n_words, n, list(ids)))
    return sorted(out)


def test_hits_match_brute_force(spark, table, awkward):
    test = prose(77, 40).split()
    items = [(1, " ".join(test)), (2, prose(78, 25)), (3, None), (4, "--"), (5, "Only five words; here"), (None, prose(79, 12)),
             (6, " ".join(test[5:30])), (6, " ".join(test[5:30])), (7, "same same same same same same same same same same same")]
    docs = awkward + [
        (20, f"{prose(20, 30)}, {' '.join(test).upper()}! {prose(21, 8)}"), (21, " ".join(test[3:13])), (22, " ".join(test[3:12])),
        (23, " ".join(test[:12] + ["other"] + test[12:23])), (24, "say: ONLY five/words here."), (25, prose(78, 25) + " " + prose(79, 12)),
        (26, " ".join(test[:15] + test[:15])), (27, " ".join(test[-10:])), (28, " ".join(test[:10]) + " É")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'own' AS doc_id", "1 AS hash")
    frame = table(docs, ["item_id", "hash", "prints", "text_hash"])
    got = run(frame, bench)
    assert got == brute(docs, items)
    kept = decontaminate.without_benchmarks(frame, bench)
    assert kept.columns == frame.columns
    clean = sorted(d for d, _, n, _ in got if n == 0)
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == clean


def test_every_window_of_an_item_is_found(spark, table):
    """The guarantee: each span of ten words is found wherever it starts, and none of nine."""
    test = prose(5, 60).split()
    docs = [(i, f"{prose(100 + i, 7)} {' '.join(test[i:i + 10])} {prose(200 + i, 7)}") for i in range(51)]
    docs += [(100 + i, f"{prose(100 + i, 7)} {' '.join(test[i:i + 9])} {prose(200 + i, 7)}") for i in range(51)]
    bench = spark.createDataFrame([(1, " ".join(test))], "item_id bigint, text string")
    assert [(d, n) for d, _, n, _ in run(table(docs), bench)] == [(i, 10) for i in range(51)] + [(100 + i, 0) for i in range(51)]


def test_empty_tables(spark, table, awkward):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r[2] for r in run(table(awkward), none)} == {0}
    assert run(table([]), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")) == []


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
