import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, prose, table  # noqa: F401

from lakeops.llm import quality
from lakeops.llm.blocks import blocks


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered |= set(range(i, i + 8))
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered), len(lines), len(set(words)),
            sum(a == b for a, b in zip(words, words[1:], strict=False)))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_stutters")


def test_measures_match_brute_force(spark, table, awkward):
    rng = random.Random(1)
    rows = awkward + [(200 + i, "".join(rng.choice(["a b c d e f g h", "x", "\n", "\n", " ", "#$", "\r\n", "é ü", "A! "]) for _ in range(40))) for i in range(150)]
    got = quality.with_measures(table(rows, ["n_words", "quality"])).collect()
    found = sorted((-1 if r.doc_id is None else r.doc_id, *(r[n] for n in NAMES)) for r in got)
    assert found == sorted((-1 if i is None else i, *brute(t)) for i, t in rows)


def test_texts_of_one_block_do_not_touch():
    texts = ["a b", "a b", "", "\n", "a b\n", "b", "c\nc", "\nc"]
    block = next(blocks(pa.array(texts)))[2]
    found = quality.measure(block)
    assert [tuple(int(found[n][i]) for n in NAMES) for i in range(len(texts))] == [brute(t) for t in texts]


@pytest.mark.parametrize("n, share", [(20_000, 0.8), (2_000_000, 0.8), (2_000_000, 0.95)])
def test_estimation_recovers_accuracies(n, share):
    rng = np.random.default_rng(3)
    truth = rng.random(n) < share
    right = np.array([0.95, 0.9, 0.8, 0.7])
    votes = np.where(rng.random((n, 4)) < right, np.where(truth, 1, 2)[:, None], np.where(truth, 2, 1)[:, None])
    votes[rng.random(votes.shape) < 0.3] = 0
    patterns, counts = np.unique(votes @ 3 ** np.arange(4), return_counts=True)
    found = quality.estimate(patterns, counts.astype(float), 4)
    assert abs(found.good - share) < 0.01
    good = found.chances[1, :, 1] / (found.chances[1, :, 1] + found.chances[1, :, 2])
    assert np.abs(good - right).max() < 0.01
    posterior = dict(zip(patterns.tolist(), found.posterior(patterns).tolist(), strict=True))
    guess = np.array([posterior[p] for p in (votes @ 3 ** np.arange(4)).tolist()]) >= 0.5
    assert (guess == truth).mean() > 0.93


def test_good_texts_stay_and_junk_goes(spark, table):
    clean = [(i, ". ".join(prose(10 * i + j, 12).capitalize() for j in range(5)) + ".") for i in range(60)]
    junk = [(100 + i, " ".join(w + "%$#&"[k % 4] * 3 for k, w in enumerate(prose(500 + i, 60).split()))) for i in range(10)]
    junk += [(120 + i, "\n".join([prose(700 + i, 5).upper() + "!! "] * 12)) for i in range(10)]
    got = {r.doc_id: r.quality for r in quality.quality(table(clean + junk)).collect()}
    assert all(got[i] >= 0.5 for i, _ in clean) and all(got[i] < 0.5 for i, _ in junk)
    assert quality.quality(table([])).collect() == []
