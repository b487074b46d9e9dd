"""Quality rules as weak supervision: rules vote or abstain, and their accuracies are estimated.

Each rule looks at simple measures of a text and votes good, bad or not at all. Nothing says how
often a rule is right; expectation-maximisation over all documents estimates it from how the rules
agree, with a Dawid-Skene model: each rule has its own chance of each vote for good and for bad
texts. Every document then has a posterior probability of being good. Documents enter the
estimate only through their pattern of votes, so what is gathered is one count per pattern (at
most three to the power of the number of rules), over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.blocks import SPACE, Block, blocks, members, mix
from lakeops.session import materialize

WINDOW = 8
PRIOR = 10.0
SYMBOLS = members(b"#*$%&|<>")
_UPPER, _LETTER = members(bytes(range(65, 91))), members(bytes(range(65, 91)) + bytes(range(97, 123)))
_DIGIT, _SHOUT = members(b"0123456789"), members(b"!?")
_ENDS = members(b".!?:;\"')")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_digits",
            "n_shouts", "n_marked", "n_distinct", "n_stutters")


def measure(block: Block) -> dict[str, np.ndarray]:
    """The measures of every text of a block."""
    n, data = len(block), block.data
    starts, ends = block.runs(~SPACE)
    first = np.searchsorted(starts, block.bounds)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(n), n_words)
    hashes = block.hashes(starts, ends)
    found = {"n_words": n_words, "word_chars": block.counted(((data & 0xC0) != 0x80) & ~SPACE[data]), "n_symbols": block.counted(SYMBOLS[data])}

    # Lines with a word that are equal to an earlier line of their text.
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([block.bounds[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_text = block.owner(line_starts)
    following = np.append(line_starts[1:], len(data))[:len(line_starts)]
    at_break = np.zeros(len(line_starts), bool)
    if len(line_starts):
        inside = following < block.bounds[line_text + 1]
        at_break = inside | ((following > line_starts) & (data[np.maximum(following - 1, 0)] == 10))
    line_ends = following - at_break
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_text = line_starts[worded], line_ends[worded], line_text[worded]
    keys = mix(block.hashes(line_starts, line_ends) + mix(line_text.astype(np.uint64)))
    _, once = np.unique(keys, return_index=True)
    found["n_lines"] = np.bincount(line_text, minlength=n)
    found["n_dup_lines"] = found["n_lines"] - np.bincount(line_text[once], minlength=n)

    # Words inside windows that occur twice or more in their text.
    repeated = np.zeros(len(hashes) + 1, np.int64)
    count = len(hashes) - WINDOW + 1
    if count > 0:
        grams = np.zeros(count, np.uint64)
        for j in range(WINDOW):
            grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + count])
        places = np.flatnonzero(owner[:count] == owner[WINDOW - 1:])
        keys = mix(grams[places] + mix(owner[places].astype(np.uint64)))
        _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
        again = places[times[inverse] > 1]
        np.add.at(repeated, again, 1)
        np.add.at(repeated, again + WINDOW, -1)
    covered = np.cumsum(repeated[:-1]) > 0
    found["n_repeat_words"] = np.bincount(owner[covered], minlength=n)

    _, once = np.unique(mix(hashes + mix(owner.astype(np.uint64))), return_index=True)
    found["n_distinct"] = np.bincount(owner[once], minlength=n)
    stutter = np.zeros(len(hashes), bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    found["n_stutters"] = np.bincount(owner[stutter], minlength=n)
    last = data[ends - 1] if len(ends) else data[:0]
    found["n_marked"] = np.bincount(owner[SYMBOLS[last] | _SHOUT[last]], minlength=n)
    for name, kind in (("n_letters", _LETTER), ("n_upper", _UPPER), ("n_digits", _DIGIT), ("n_shouts", _SHOUT)):
        found[name] = block.counted(kind[data])
    return found


def with_measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the measures of every whole text, null texts being empty; one row per row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *[T.StructField(m, T.LongType()) for m in MEASURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, block in blocks(batch.column(1)):
                found = measure(block)
                columns = [pa.array(found[m].astype(np.int64)) for m in MEASURES]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *columns], schema.names)

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("marked words", "5 * n_marked > n_words", "10 * n_marked <= n_words AND n_words >= 20"),
    Rule("capitals", "5 * n_upper > 2 * n_letters AND n_letters >= 40", "10 * n_upper <= n_letters AND n_letters >= 40"),
    Rule("repeated lines", "3 * n_dup_lines > n_lines AND n_lines >= 3", "20 * n_dup_lines <= n_lines"),
    Rule("repeated words", "10 * n_repeat_words > 3 * n_words", "20 * n_repeat_words <= n_words"),
    Rule("stutter", "10 * n_stutters > n_words", "50 * n_stutters <= n_words"),
    Rule("variety", "4 * n_distinct < n_words AND n_words BETWEEN 20 AND 1000", "2 * n_distinct >= n_words"),
    Rule("word length", "word_chars < 2 * n_words OR word_chars > 13 * n_words", "2 * word_chars BETWEEN 6 * n_words AND 22 * n_words"),
    Rule("letters", "2 * n_letters < word_chars AND n_words >= 20", "4 * n_letters >= 3 * word_chars"),
    Rule("digits", "3 * n_digits > word_chars", "50 * n_digits <= word_chars"),
    Rule("exclamations", "10 * n_shouts > n_words", "50 * n_shouts <= n_words"),
)


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The pattern of votes as one number in base three: 0 abstains, 1 is good, 2 is bad."""
    digits = [F.when(F.expr(r.bad), 2).when(F.expr(r.good), 1).otherwise(0) * 3**i for i, r in enumerate(rules)]
    return reduce(lambda a, b: a + b, digits).cast("int")


@dataclass
class Accuracies:
    """``chances[c, r, v]``: how likely rule r votes v for a good (c = 1) or bad (c = 0) text; ``good``: share of good texts."""

    chances: np.ndarray
    good: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        table = _digits(patterns, self.chances.shape[1])
        log = [np.log(share) + np.log(self.chances[c][np.arange(table.shape[1]), table]).sum(axis=1)
               for c, share in ((0, 1 - self.good), (1, self.good))]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def _digits(patterns: np.ndarray, n: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(n) % 3


def estimate(patterns: np.ndarray, counts: np.ndarray, n_rules: int, steps: int = 300) -> Accuracies:
    """Expectation-maximisation over vote patterns, from the number of bad votes on.

    Junk breaks few rules, each kind others, so a bad vote says much and a good vote little. The prior
    says so and counts as ``PRIOR`` documents of each class, however many there are, so that it fades;
    and no rule may come out as voting bad for good texts more than half as often as for bad ones,
    which keeps the classes from changing places.
    """
    table, total = _digits(patterns, n_rules), max(float(counts.sum()), 1.0)
    prior = np.array([[0.1, 0.6, 0.3], [0.1, 0.88, 0.02]]) * PRIOR
    good = 1 / (1 + np.exp(2.5 * (table == 2).sum(axis=1) - 3.0))
    for _ in range(steps):
        chances = np.empty((2, n_rules, 3))
        for c, share in ((0, 1 - good), (1, good)):
            for v in range(3):
                chances[c, :, v] = (table == v).T @ (share * counts) + prior[c, v]
        chances /= chances.sum(axis=2, keepdims=True)
        chances[1, :, 2] = np.minimum(chances[1, :, 2], chances[0, :, 2] / 2)
        chances[1] /= chances[1].sum(axis=1, keepdims=True)
        found = Accuracies(chances, float(np.clip((good @ counts + 0.9) / (total + 1), 0.01, 0.99)))
        new = found.posterior(patterns)
        if len(new) == 0 or np.abs(new - good).max() < 1e-9:
            break
        good = new
    return found


def judge(measures: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measures`` with ``quality``, the posterior probability that the text is good.

    The patterns' counts, at most three to the power of the rules, go to the driver; the posterior of
    each pattern comes back by a join with a table of that bound. An empty table gives no rows.
    """
    voted = measures.withColumn("_votes", votes(rules))
    rows = voted.groupBy("_votes").count().collect()
    patterns = np.array([r[0] for r in rows], np.int64)
    found = estimate(patterns, np.array([r[1] for r in rows], np.float64), len(rules))
    quality = found.posterior(patterns) if len(rows) else np.empty(0)
    scored = measures.sparkSession.createDataFrame(
        [(int(p), float(q)) for p, q in zip(patterns, quality, strict=True)], "_pattern int, quality double")
    return voted.join(F.broadcast(scored), F.col("_votes") == F.col("_pattern")).drop("_votes", "_pattern")


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the measures and the posterior ``quality`` of every document."""
    return judge(materialize(with_measures(docs, doc_id, text), "measures"), rules)
