"""Alignment of two tokenizers' tokens over the bytes of each text, and the counts of aligned id pairs.

The tokens of both are intervals of bytes. Sorted by start, with the running maximum of their ends, a
group of overlapping tokens breaks where a start reaches that maximum, which is where tokens of both
end. Within a group each token of one tokenizer is linked with each of the other.

How many documents hold an id pair is counted over the whole corpus. Documents are stored in blocks of
some megabytes of text: a block names each of its pairs once, and its documents point there. So what
is shuffled for the counts, and brought back, is a row per block and pair, not one per document and
pair, and nothing that grows with the corpus is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.blocks import kept, lists
from lakeops.llm.token_files import decode_numbers, encode_numbers
from lakeops.llm.tokens import Encoder, byte_letters, encoder, groups
from lakeops.session import scratch_path

BLOCK_CHARS = 8 << 20
PART_CHARS = 1 << 20
WIDE = 4096
SPACE = "▁"


@dataclass
class Vocabulary:
    """``pieces``: the bytes of each id; ``lengths``: how many they are; ``digits``, ``widths``: its decimal form."""

    pieces: list[bytes]

    def __post_init__(self):
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        texts = [str(i).encode() for i in range(len(self.pieces))]
        self.widths = np.array([len(t) for t in texts], np.int64)
        most = max(6, int(self.widths.max()))
        self.digits = np.frombuffer(b"".join(t.ljust(most, b" ") for t in texts), np.uint8).reshape(-1, most)


def byte_vocabulary(own: Encoder) -> Vocabulary:
    letters, pieces = byte_letters(), [b""] * own.tokenizer.get_vocab_size()
    for token, number in own.tokenizer.get_vocab().items():
        pieces[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return Vocabulary(pieces)


def piece_vocabulary(model) -> Vocabulary:
    return Vocabulary([bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(SPACE, " ").encode()
                       for i in range(model.get_piece_size())])


class Pair:
    """Both tokenizers: ``a`` a byte-level file of the tokenizers library, ``b`` a sentencepiece model that puts a space in front."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a, self.b = encoder(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.of_a, self.of_b = byte_vocabulary(self.a), piece_vocabulary(self.b)

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for each text with a space in front; none for an empty text and where the tokens' bytes aren't that text."""
        none, found = (np.empty(0, np.int64),) * 2, []
        spaced = [" " + t for t in texts]
        for text, first, second in zip(spaced, self.a.encode(spaced), self.b.encode(texts, num_threads=1), strict=True):
            ids = np.frombuffer(first, self.a.dtype).astype(np.int64)
            raw = text.encode()
            same = len(text) > 1 and b"".join(map(self.of_a.pieces.__getitem__, ids.tolist())) == raw and b"".join(
                map(self.of_b.pieces.__getitem__, second)) == raw
            found.append((ids, np.array(second, np.int64)) if same else none)
        return found


def coalesced(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of each interval: from the least start on, a group breaks where a start reaches the greatest end so far."""
    if not len(starts):
        return np.empty(0, np.int64)
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    group = np.empty(len(starts), np.int64)
    group[order] = np.concatenate([[0], np.cumsum(starts[order][1:] >= reach[:-1])])
    return group


def _links(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
           doc: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, how often) of the linked ids; a pair is ``a * base + b``. ``doc``: of each group.

    Groups of over ``WIDE`` links are multiplied out by distinct ids.
    """
    first_b = np.cumsum(n_b) - n_b
    wide = n_a * n_b > WIDE
    times = np.where(wide, 0, n_b)[group_a]
    at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    pair = np.repeat(a, times) * base + b[np.repeat(first_b[group_a], times) + at]
    own, weight = np.repeat(doc[group_a], times), np.ones(len(pair), np.int64)
    first_a = np.cumsum(n_a) - n_a
    more = [(own, pair, weight)]
    for g in np.flatnonzero(wide):
        x, nx = np.unique(a[first_a[g]:first_a[g] + n_a[g]], return_counts=True)
        y, ny = np.unique(b[first_b[g]:first_b[g] + n_b[g]], return_counts=True)
        more.append((np.full(len(x) * len(y), doc[g]), np.add.outer(x * base, y).ravel(), np.multiply.outer(nx, ny).ravel()))
    own, pair, weight = (np.concatenate(c) for c in zip(*more, strict=True))
    if not len(pair):
        return own, pair, weight
    order = np.lexsort((pair, own))
    own, pair, weight = own[order], pair[order], weight[order]
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (pair[1:] != pair[:-1])]))
    return own[new], pair[new], np.add.reduceat(weight, new)


def _written(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
             last: np.ndarray, of_a: Vocabulary, of_b: Vocabulary) -> tuple[bytes, np.ndarray]:
    """Groups as ``a1,a2|b1;a3|b2,b3``, one document after the other, and where each group ends. ``last``: groups that end a document."""
    place_a = np.arange(len(a)) + (np.cumsum(n_b) - n_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(n_a)[group_b]
    n, most = len(a) + len(b), max(of_a.digits.shape[1], of_b.digits.shape[1]) + 1
    text, width, mark = np.zeros((n, most), np.uint8), np.empty(n, np.int64), np.empty(n, np.uint8)
    for ids, place, group, vocabulary, end in ((a, place_a, group_a, of_a, ord("|")), (b, place_b, group_b, of_b, ord(";"))):
        text[place, :vocabulary.digits.shape[1]] = vocabulary.digits[ids]
        width[place] = vocabulary.widths[ids]
        mark[place] = np.where(np.append(group[1:] != group[:-1], True), end, ord(","))
    text[np.arange(n), width] = mark
    ends = np.cumsum(n_a + n_b) - 1  # the last token of each group
    width += 1
    width[ends[last]] -= 1
    return text[np.arange(most) < width[:, None]].tobytes(), np.cumsum(width)[ends]


@dataclass
class Aligned:
    """Per document of a part; ``doc``, ``pair`` and ``times`` are its links, sorted."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    doc: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def align(found: list[tuple[np.ndarray, np.ndarray]], of_a: Vocabulary, of_b: Vocabulary) -> Aligned:
    """Groups and links of the ids of some documents. The documents' bytes stand one after the other, so no group crosses two of them."""
    docs = len(found)
    n_a, n_b = (np.array([len(f[i]) for f in found], np.int64) for i in (0, 1))
    a, b = (np.concatenate([np.empty(0, np.int64), *(f[i] for f in found)]) for i in (0, 1))
    ends = np.concatenate([np.cumsum(of_a.lengths[a]), np.cumsum(of_b.lengths[b])])
    starts = ends - np.concatenate([of_a.lengths[a], of_b.lengths[b]])
    group = coalesced(starts, ends)
    group_a, group_b = group[:len(a)], group[len(a):]
    count = int(group.max()) + 1 if len(group) else 0
    in_a, in_b = np.bincount(group_a, minlength=count), np.bincount(group_b, minlength=count)
    doc = np.repeat(np.arange(docs), n_a)[np.cumsum(in_a) - in_a]
    n_groups = np.bincount(doc, minlength=docs)
    n_links = np.bincount(doc, weights=in_a * in_b, minlength=docs).astype(np.int64)
    own, pair, times = _links(a, b, group_a, group_b, in_a, in_b, doc, len(of_b.pieces))
    digests = [""] * docs
    if count:
        last = np.flatnonzero(np.append(doc[1:] != doc[:-1], True))
        raw, edges = _written(a, b, group_a, group_b, in_a, in_b, last, of_a, of_b)
        low = 0
        for g in last:
            digests[doc[g]] = hashlib.sha256(raw[low:edges[g]]).hexdigest()
            low = edges[g]
    return Aligned(n_a, n_b, n_groups, n_links, digests, own, pair, times)


def _block(ids: list[pa.Array], parts: list[Aligned], number: int, schema: pa.Schema) -> pa.RecordBatch:
    """One row: the documents of a block, its pairs with their number of documents, and for each document where its pairs stand among these."""
    pairs, at, n_docs = np.unique(np.concatenate([p.pair for p in parts]), return_inverse=True, return_counts=True)
    sizes = np.concatenate([np.bincount(p.doc, minlength=len(p.n_a)) for p in parts])
    steps = np.diff(at, prepend=0)
    firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[firsts] = at[firsts]
    whole = [np.concatenate([getattr(p, name) for p in parts]) for name in ("n_a", "n_b", "n_groups", "n_links")]
    values = [*(lists(np.array([len(c)]), pa.array(c)) for c in (*whole, sizes)), lists(np.array([len(sizes)]), pa.array([d for p in parts for d in p.digests]))]
    coded = [*encode_numbers(steps), *encode_numbers(np.concatenate([p.times for p in parts]))]
    documents = pa.concat_arrays(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), lists(np.array([len(documents)]), documents), *values, pa.array([pairs.astype("<i8").tobytes()]),
         pa.array([n_docs.astype("<i8").tobytes()]), *(pa.array([c], pa.binary()) for c in coded)], schema=schema)


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents aligned and stored block by block, in the shared folder."""
    one = docs.schema[doc_id].dataType
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(one)), *(T.StructField(n, longs) for n in ("n_a", "n_b", "n_groups", "n_links", "sizes")),
        T.StructField("digests", T.ArrayType(T.StringType())),
        *(T.StructField(n, T.BinaryType()) for n in ("pairs", "n_docs", "step_control", "step_data", "times_control", "times_data"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        own = kept(f"pair {path_a} {path_b}", lambda: Pair(path_a, path_b))
        out, number = to_arrow_schema(schema), TaskContext.get().partitionId() << 32
        ids, parts, held = [], [], 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for low, high in groups([len(t) for t in texts], PART_CHARS):
                parts.append(align(own.tokens(texts[low:high]), own.of_a, own.of_b))
                ids.append(batch.column(0).slice(low, high - low))
                held += sum(len(t) + 100 for t in texts[low:high])
                if held >= BLOCK_CHARS:
                    yield _block(ids, parts, number, out)
                    ids, parts, held, number = [], [], 0, number + 1
        if ids:
            yield _block(ids, parts, number, out)

    path = scratch_path(docs.sparkSession, "aligned")
    chosen = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string").alias("_text"))
    chosen.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _pairs(blocks: DataFrame) -> DataFrame:
    """``block``, ``pair`` and ``n`` (the block's documents that hold it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                pairs, n = np.frombuffer(pairs.as_buffer(), "<i8"), np.frombuffer(n.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), block)), pa.array(pairs), pa.array(n)], ["block", "pair", "n"])

    return blocks.select("block", "pairs", "n_docs").mapInArrow(run, "block bigint, pair bigint, n bigint")


def pair_counts(blocks: DataFrame, base: int) -> DataFrame:
    """``pair``, ``count`` (documents of the corpus that hold it linked) and ``best``: no pair of its A id has a higher count."""
    counts = _pairs(blocks).groupBy("pair").agg(F.sum("n").alias("count"))
    path = scratch_path(blocks.sparkSession, "pair_counts")
    counts.write.parquet(path)
    counts = blocks.sparkSession.read.schema(counts.schema).parquet(path)
    a = F.expr(f"pair div {base}")
    # One row per id of A: the vocabulary bounds it.
    most = counts.groupBy(a.alias("a")).agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), a == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every row of ``docs``.

    Tokens are those of the text with a space in front. ``n_best``: links whose id pair is in as many
    documents as any pair of its A id, ties included; ``count_sum``: documents that hold the pair, summed
    over the links. Null and empty texts, and those that the tokens' bytes don't give back, have zeros
    and an empty digest. Repeated rows count as documents of their own, null ids stay null, other
    columns are not read, and an empty table gives no rows.
    """
    import sentencepiece

    blocks = aligned_blocks(docs, path_a, path_b, doc_id, text)
    base = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    answers = _pairs(blocks).drop("n").join(pair_counts(blocks, base), "pair").select(F.col("block").alias("of"), "pair", "count", "best")
    schema = T.StructType([
        T.StructField(doc_id, docs.schema[doc_id].dataType), *(T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
        T.StructField("groups_sha256", T.StringType())])

    def solve(block: pa.Table, answer: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        order = np.argsort(answer["pair"].to_numpy())
        count, best = answer["count"].to_numpy()[order], answer["best"].to_numpy()[order]
        row = {n: block[n][0] for n in block.column_names}
        sizes = row["sizes"].values.to_numpy()
        entries = int(sizes.sum())
        steps, times = (decode_numbers(row[f"{n}_control"].as_buffer().to_pybytes(), row[f"{n}_data"].as_buffer().to_pybytes(), entries).astype(np.int64)
                        for n in ("step", "times"))
        firsts = np.cumsum(sizes) - sizes
        total = np.concatenate([[0], np.cumsum(steps)])
        at = total[1:] - np.repeat(total[firsts], sizes)
        sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times * best[at], times * count[at])]
        found = [pa.array(s[firsts + sizes] - s[firsts]) for s in sums]
        columns = [row["ids"].values, *(row[n].values for n in ("n_a", "n_b", "n_groups", "n_links")), *found, row["digests"].values]
        return pa.table(columns, schema=to_arrow_schema(schema))

    slim = blocks.drop("pairs", "n_docs")
    return slim.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(solve, schema)
