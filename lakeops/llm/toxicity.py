"""Toxicity learned from document labels, as multiple-instance learning over sentences.

A document is a bag of sentences, and it is toxic if any of them is: its score joins the sentence
scores by noisy-or, 1 - prod(1 - p). Only document labels are known, so the likelihood of those
trains the sentence model, a logistic model over hashed words and word beginnings; its scores then
say which sentences gave rise to a document's score.

Training reads a bounded sample of labelled rows (``per_class`` of each class, chosen by a hash of
the id), so the model and its training have a fixed size; scoring reads everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.blocks import Block, blocks, lists, members, mix

PER_CLASS = 3000
FEATURES = 20_000
PREFIXES = (4, 5, 6)
SLOTS = 22
EXCESS = 5.0
LETTERS = ~members(bytes(range(0x41)) + b"[\\]^_`{|}~\x7f")  # A-Z, a-z and characters outside ASCII
STOPS = members(b".!?\n")


@dataclass
class Model:
    """Sorted 64-bit feature keys, their weights, and the weight of a sentence without features."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.slots = np.zeros(1 << SLOTS, bool)
        self.slots[self.keys >> np.uint64(64 - SLOTS)] = True

    def found(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key among the model's, or -1."""
        at = np.full(len(keys), -1, np.int64)
        maybe = np.flatnonzero(self.slots[keys >> np.uint64(64 - SLOTS)])
        if len(maybe):
            place = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
            hit = self.keys[place] == keys[maybe]
            at[maybe[hit]] = place[hit]
        return at


@dataclass
class Sentences:
    """Sentences of a block that have words: their text, first byte and last byte, and the features in them."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    sentence: np.ndarray  # of each word
    keys: list[np.ndarray]  # per feature of a word, the key of each word


def sentences(block: Block) -> Sentences:
    low = block.lowered()
    starts, ends = low.runs(LETTERS)
    owner = low.owner(starts)
    stops = np.cumsum(STOPS[low.data], dtype=np.int64)[starts] if len(starts) else np.empty(0, np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (stops[1:] != stops[:-1])
    sentence = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts))[:len(first)] - 1
    keys = [low.hashes(starts, ends)]
    for n in PREFIXES:
        keys.append(mix(low.hashes(starts, np.minimum(starts + n, ends)) + np.uint64(n)))
    return Sentences(owner[first], starts[first], ends[last] if len(first) else first, sentence, keys)


def _chance(logit: np.ndarray | float) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -logit))


def _document_log(text: np.ndarray, logit: np.ndarray, n: int) -> np.ndarray:
    """log(1 - p) of each document: the sum over its sentences."""
    return -np.bincount(text, np.logaddexp(0, logit), n)


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, each once, and the sums of both counts."""
    keys, place = np.unique(np.concatenate([k for k, _, _ in parts]), return_inverse=True)
    one, other = (np.bincount(place, np.concatenate([p[i] for p in parts]), len(keys)).astype(np.int32) for i in (1, 2))
    return keys, one, other


def _document_counts(texts: list[tuple[Block, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every key and how many toxic and how many other texts have it. Some blocks' counts are held beside the sum, not all occurrences."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for block, labels, _ in texts:
        found, toxic = sentences(block), labels == 1
        word_text = found.text[found.sentence] if len(found.sentence) else found.sentence
        spread = mix(word_text.astype(np.uint64))
        for keys in found.keys:
            _, once = np.unique(mix(keys + spread), return_index=True)  # one of each key in a text
            is_toxic = toxic[word_text[once]]
            held.append((keys[once], is_toxic.astype(np.int32), (~is_toxic).astype(np.int32)))
        held = [held[0], _summed(held[1:])] if len(held) > 1 else held
        if len(held[1][0]) * 4 > len(held[0][0]):
            held = [_summed(held)]
    return _summed(held) if held else (np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32))


def train(texts: list[tuple[Block, np.ndarray, np.ndarray]], features: int = FEATURES, steps: int = 300) -> Model:
    """Fit the sentence model to (block, label of each text, weight of each text).

    Features are first screened: they must occur in toxic documents more often than in others, beyond
    what chance explains. Rates are those of each class, and a feature's rate over all documents takes
    the classes by their weights, so a sample of equal classes is screened as its documents would be.
    At most ``features`` of them, those of most effect, bound the model. The noisy-or likelihood then trains the weights of those that remain, by gradient steps with momentum.
    """
    labels = np.concatenate([y for _, y, _ in texts]) if texts else np.empty(0)
    weight = np.concatenate([w for _, _, w in texts]) if texts else np.empty(0)
    toxic = labels == 1
    if not toxic.any() or toxic.all():
        share = float(toxic.mean()) if len(toxic) else 0.0
        return Model(np.empty(0, np.uint64), np.empty(0), float(np.log(max(share, 1e-4) / max(1 - share, 1e-4))))
    keys, with_toxic, clean = _document_counts(texts)
    lift = np.log(((with_toxic + 0.5) / (toxic.sum() + 1)) / ((clean + 0.5) / ((~toxic).sum() + 1)))
    share = weight[toxic].sum() / weight.sum()
    rate, clean_rate = with_toxic / toxic.sum(), clean / (~toxic).sum()
    spread = (share * rate + (1 - share) * clean_rate) * (1 / toxic.sum() + 1 / (~toxic).sum())
    excess = (rate - clean_rate) / np.sqrt(spread)  # in standard deviations
    usable = np.flatnonzero((with_toxic >= min(5, toxic.sum())) & (lift > 1.0) & (excess > EXCESS))
    usable = usable[np.argsort(-(lift * with_toxic)[usable], kind="stable")[:features]]
    model = Model(np.sort(keys[usable]), np.zeros(len(usable)), -5.0)
    if not len(usable):
        return model
    # Sentences with any feature; all others of a document share one logit, the bias.
    rows, columns, sentence_text, count = [], [], [], 0
    plain = np.zeros(len(labels))
    shift = 0
    for block, _, _ in texts:
        found = sentences(block)
        hit_rows, hit_columns = [], []
        for k in found.keys:
            at = model.found(k)
            hit = np.flatnonzero(at >= 0)
            hit_rows.append(found.sentence[hit])
            hit_columns.append(at[hit])
        r, c = np.concatenate(hit_rows), np.concatenate(hit_columns)
        used, r = np.unique(r, return_inverse=True)
        plain += np.bincount(found.text + shift, minlength=len(labels))[:len(labels)]
        plain -= np.bincount(found.text[used] + shift, minlength=len(labels))[:len(labels)]
        rows.append(r + count)
        columns.append(c)
        sentence_text.append(found.text[used] + shift)
        count += len(used)
        shift += len(block)
    row, column, text = np.concatenate(rows), np.concatenate(columns), np.concatenate(sentence_text)
    n, w, b = len(labels), model.weights, model.bias
    mean, square = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        logit = b + np.bincount(row, w[column], count)
        p, p0 = _chance(logit), _chance(b)
        log_clean = np.minimum(_document_log(text, logit, n) - plain * np.logaddexp(0, b), -1e-9)
        odds = np.exp(log_clean) / -np.expm1(log_clean)
        pull = np.where(toxic, np.minimum(odds, 50), -1.0) * weight
        on_sentence = pull[text] * p
        gradient = np.append(np.bincount(column, on_sentence[row], len(w)) - 0.02 * w, on_sentence.sum() + (pull * plain * p0).sum())
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        w, b = w + move[:-1], b + move[-1]
    return Model(model.keys, w, float(b))


def sentence_logits(model: Model, found: Sentences) -> np.ndarray:
    total = np.full(len(found.text), model.bias)
    for keys in found.keys:
        at = model.found(keys)
        hit = np.flatnonzero(at >= 0)
        if len(hit):
            total += np.bincount(found.sentence[hit], model.weights[at[hit]], len(total))
    return total


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = PER_CLASS) -> Model:
    """Train on labelled rows that are not held out (crc32 of the id as text is not divisible by 5).

    ``per_class`` bounds the rows of each class; they are those with the smallest hashes of the id, so
    the sample is the same on every run. Of several texts of one id the least is used. Rows with a null id or label are not used; of several labels of
    one document the highest counts. Without both classes the model scores every document alike.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_toxic")).dropna()
    known = known.where(F.crc32(F.col("_id").cast("string").cast("binary")) % 5 != 0).groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    counts = {r[0]: r[1] for r in known.where("_toxic IN (0, 1)").groupBy("_toxic").count().collect()}
    spread = F.shiftrightunsigned(F.xxhash64("_id"), 11) / F.lit(float(1 << 53))
    share = F.lit(0.0)
    for kind, n in counts.items():
        share = F.when(F.col("_toxic") == kind, F.lit(min(1.0, per_class / n))).otherwise(share)
    # Twice ``per_class`` rows of a few bytes, which may be broadcast.
    sample = F.broadcast(known.where(spread < share))
    chosen = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text")).join(sample, "_id")
    # One text per id, so that repeated ids don't lift the bound.
    chosen = chosen.groupBy("_id", "_toxic").agg(F.min("_text").alias("_text")).select("_text", "_toxic")
    scale = {kind: max(1.0, n / per_class) for kind, n in counts.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            weight = np.array([scale[t] for t in toxic.tolist()])
            held += [(block, toxic[low:high], weight[low:high]) for low, high, block in blocks(batch.column(0))]
        model = train(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.keys.astype("<u8").tobytes()]), pa.array([model.weights.astype("<f8").tobytes()]), pa.array([model.bias])],
            ["keys", "weights", "bias"])

    rows = chosen.repartition(1).sortWithinPartitions(F.xxhash64("_text")).mapInArrow(run, "keys binary, weights binary, bias double").collect()
    if not rows:
        return Model(np.empty(0, np.uint64), np.empty(0), -5.0)
    return Model(np.frombuffer(rows[0].keys, "<u8"), np.frombuffer(rows[0].weights, "<f8"), rows[0].bias)


def _score(model: Model, block: Block) -> tuple[np.ndarray, Sentences, np.ndarray]:
    found = sentences(block)
    logit = sentence_logits(model, found)
    score = -np.expm1(_document_log(found.text, logit, len(block)))
    empty = np.bincount(found.text, minlength=len(block)) == 0
    score[empty] = _chance(model.bias)
    return np.clip(score, 0.0, 1.0), found, logit


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``doc_id``, ``score`` and the offending ``sentences`` (start, end in UTF-8 bytes, score of ``least`` or more).

    One row per row. Texts without words, null ones included, get the score of one sentence without features.
    """
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("score", T.DoubleType()), T.StructField("sentences", T.ArrayType(
        T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])))])
    shared = docs.sparkSession.sparkContext.broadcast((model.keys, model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for low, high, block in blocks(batch.column(1)):
                score, found, logit = _score(own, block)
                p = _chance(logit)
                bad = np.flatnonzero(p >= least)
                shift = block.bounds[found.text[bad]]
                spans = pa.StructArray.from_arrays(
                    [pa.array(found.start[bad] - shift), pa.array(found.end[bad] - shift), pa.array(p[bad])], ["start", "end", "score"])
                per_text = np.bincount(found.text[bad], minlength=len(block))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(score), lists(per_text, spans)], schema.names)

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, columns as they are."""
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast((model.keys, model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            keep = [_score(own, block)[0] < threshold for _, _, block in blocks(batch.column(at))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
