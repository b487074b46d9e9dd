import random
import zlib

import numpy as np
import pyarrow as pa
from helpers import awkward, prose, table  # noqa: F401

from lakeops.llm import toxicity
from lakeops.llm.blocks import blocks


def corpus(n=400):
    rng, rows, labels = random.Random(4), [], []
    for i in range(n):
        sentences = [prose(1000 * i + j, rng.randint(5, 14)).capitalize() + "." for j in range(rng.randint(3, 12))]
        toxic = i % 4 == 0
        if toxic:
            at = rng.randrange(len(sentences))
            words = sentences[at].split()
            words.insert(1, rng.choice(["vileword", "badtalk" + rng.choice(["ing", "er", "ed"])]))
            sentences[at] = " ".join(words)
        rows.append((i, " ".join(sentences)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def model_of(spark, table, rows, labels):
    return toxicity.fit(table(rows, ["score", "toxic"]), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_documents_and_sentences(spark, table, awkward):
    rows, labels = corpus()
    wild = [(5000 + (i or 0), t) for i, t in awkward] + [(None, "badtalking you. Fine.")]
    model = model_of(spark, table, rows + wild, labels + [(None, 1, 1), (3, 1, None)])
    found = {r.doc_id: r for r in toxicity.score_documents(table(rows + wild, ["score"]), model).collect()}
    tested = [(i, t) for i, _, t in labels if held_out(i)]
    right = sum((found[i].score >= 0.5) == bool(t) for i, t in tested)
    assert right >= 0.95 * len(tested)
    assert len(found) == len({i for i, _ in rows + wild})
    assert all(0 <= r.score <= 1 for r in found.values())
    texts = dict(rows)
    for i, t in tested:
        if t and found[i].score >= 0.5:
            raw = texts[i].encode()
            assert any(b"vileword" in raw[s.start:s.end] or b"badtalk" in raw[s.start:s.end] for s in found[i].sentences)
    assert found[None].score > 0.5 and found[5001].score < 0.5 and found[5008].score < 0.5
    kept = toxicity.without_toxic(table(rows + wild, ["score"]), model)
    assert kept.columns == table(rows, ["score"]).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.score < 0.5}


def test_only_rows_that_are_not_held_out_teach(spark, table):
    rows, labels = corpus(200)
    turned = [(i, q, 1 - t if held_out(i) else t) for i, q, t in labels]
    one, other = (model_of(spark, table, rows, x) for x in (labels, turned))
    assert one.keys.tolist() == other.keys.tolist() and np.allclose(one.weights, other.weights) and one.bias == other.bias


def test_noisy_or_joins_sentences():
    block = next(blocks(pa.array(["Aa bb. Cc dd! Ee", "", "Zz"])))[2]
    found = toxicity.sentences(block)
    assert found.text.tolist() == [0, 0, 0, 2]
    model = toxicity.Model(np.empty(0, np.uint64), np.empty(0), -1.0)
    score, _, _ = toxicity._score(model, block)
    p = 1 / (1 + np.exp(1.0))
    assert np.allclose(score, [1 - (1 - p)**3, p, p])


def test_one_class_or_no_labels(spark, table):
    rows, labels = corpus(40)
    for some in ([], [(i, 1, 0) for i, _, _ in labels], [(i, 1, 1) for i, _, _ in labels]):
        model = model_of(spark, table, rows, some)
        assert len({round(r.score, 12) for r in toxicity.score_documents(table([(1, "a b"), (2, "c")]), model).collect()}) == 1
    assert toxicity.score_documents(table([]), model).collect() == []


def test_repeated_ids_teach_once(spark, table):
    rows, labels = corpus(200)
    one, many = model_of(spark, table, rows, labels), model_of(spark, table, rows + rows[:30] * 7, labels)
    assert one.keys.tolist() == many.keys.tolist() and np.allclose(one.weights, many.weights)


def test_a_sample_of_equal_classes_is_screened_like_all_documents():
    """A rare word of toxic texts passes however many clean texts a weight stands for."""
    toxic = [f"Plain words here {i % 7}. {'Rareword' if i < 12 else 'other'} there." for i in range(300)]
    for clean, weight in ((2700, 1.0), (300, 9.0)):
        texts = toxic + [f"Plain words here {i % 7}. Other there." for i in range(clean)]
        labels = np.array([1] * 300 + [0] * clean)
        weights = np.where(labels == 1, 1.0, weight)
        held = [(b, labels[low:high], weights[low:high]) for low, high, b in blocks(pa.array(texts))]
        model = toxicity.train(held)
        with_word = next(blocks(pa.array(["Rareword."])))[2]
        assert any((model.found(k) >= 0).any() for k in toxicity.sentences(with_word).keys), clean


def test_training_holds_counts_and_not_every_word(monkeypatch):
    import tracemalloc

    texts = [" ".join(f"{w}{(7 * i + k) % 900}" for k, w in enumerate(["alpha", "bravo", "charlie", "delta"] * 60)) + (". vileword" if i % 2 else ".") for i in range(12000)]
    held = [(block, (np.arange(low, high) % 2), np.ones(high - low)) for low, high, block in blocks(pa.array(texts))]
    size = sum(len(b.data) for b, _, _ in held)
    tracemalloc.start()
    model = toxicity.train(held)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.keys) and most < 6 * size
