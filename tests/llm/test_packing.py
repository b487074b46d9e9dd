import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, prose, table  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def least_bins(lengths, limit):
    """Fewest sequences, by search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        tried = set()
        for k, room in enumerate(rooms):
            if room >= lengths[i] and room not in tried:
                tried.add(room)
                place(i + 1, rooms[:k] + [room - lengths[i]] + rooms[k + 1:])
        place(i + 1, rooms + [limit - lengths[i]])

    place(0, [])
    return best


def counted(lengths):
    return {n: lengths.count(n) for n in set(lengths)}


def check_plan(made, lengths, limit):
    used = defaultdict(int)
    for n, content in made.sets:
        assert n > 0 and sum(length * each for length, each in content) <= limit
        for length, each in content:
            used[length] += n * each
    assert dict(used) == counted(lengths)


@pytest.mark.parametrize("seed", range(60))
def test_plans_are_valid_and_fixed_sets_are_optimal(seed):
    rng = random.Random(seed)
    limit = rng.choice([10, 20, 30])
    lengths = [rng.randint(1, limit) for _ in range(rng.randint(1, 11))]
    made = packing.plan(counted(lengths), limit)
    check_plan(made, lengths, limit)
    best = least_bins(lengths, limit)
    assert made.sequences <= best + 1
    # What was fixed is part of some best packing: the rest needs exactly the difference.
    rest, fixed = list(lengths), 0
    for n, content in made.sets:
        if fixed < made.fixed:
            fixed += n
            for length, each in content:
                for _ in range(n * each):
                    rest.remove(length)
    assert least_bins(rest, limit) == best - made.fixed


def test_large_histograms_are_packed_near_the_bound():
    rng = random.Random(1)
    for draw in (lambda: rng.randint(1, 1024), lambda: min(1024, int(rng.lognormvariate(5.5, 1)) + 1), lambda: rng.randint(300, 420)):
        lengths = [draw() for _ in range(20000)]
        made = packing.plan(counted(lengths), 1024)
        check_plan(made, lengths, 1024)
        assert len(made.sets) < 5000
        assert made.sequences <= 1.02 * max(-(-sum(lengths) // 1024), sum(n > 512 for n in lengths)) or draw() <= 420


def test_pieces_and_places(spark, table, awkward):
    rows = awkward + [(30, "<|endoftext|> is text"), (31, "a\nb \nc\n\nd  e "), (32, " lead 1234 don't we'll x"), (33, "tail\n")]
    docs = table(rows, ["piece", "ids", "sequence_id"])
    found = packing.pieces(docs, PATH, 2)
    digests = found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("crc"))
    got = packing.pack(digests).collect()
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    want = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            want.append((doc or -1, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.crc) for r in got) == sorted(want)
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_equal_rows_take_different_places(spark):
    rows = spark.createDataFrame([(1, 100)] * 50 + [(None, 100)] * 3, "doc_id bigint, length bigint")
    got = packing.pack(rows, limit=1000).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 53 and len({r.sequence_id for r in got}) == 6


def test_bad_lengths_and_empty_tables(spark, table):
    assert packing.pack(packing.pieces(table([]), PATH, 2).drop("ids")).collect() == []
    for bad in (0, 11, None):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(bad,)], "length bigint"), limit=10)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_remembered_pieces_give_the_ids_of_the_whole_text(name):
    own = tokens.Encoder(public_tokenizers.path(name), memory=50)
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = True
    rng = random.Random(3)
    odd = ["Σίσυφος ΟΔΟΣ", "İstanbul", "é", "ﬁ", "²", "½", "1234", "'s", "foo's", "don't", "a_b", "x--y", "...", "&&&", "漢字", "\U0001f600", " ",
           "\x1c", "\x85", " ", "\t", "\n", "  ", "<|endoftext|>", "K", "ſ", "Ünï", "A1b2", "​", "̀"]
    texts = [prose(i, 40) for i in range(20)] + ["", " ", "\n", "x" * 3000, "a " + " " * 3000 + "b", "\t" * 1500, "ab" * 700 + " c", "\u0870 \ua7ba \u180e"]
    for _ in range(400):
        texts.append("".join(rng.choice(odd + words_and_gaps(rng)) for _ in range(rng.randint(1, 14))))
    for low in range(0, len(texts), 37):
        got = own.encode(texts[low:low + 37])
        for text, ids in zip(texts[low:low + 37], got, strict=True):
            assert np.frombuffer(ids, own.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def words_and_gaps(rng):
    return [" ", " ", " ", "\n"] + prose(rng.randint(0, 9**6), 4).split() + [w.capitalize() + "," for w in prose(rng.randint(0, 9**6), 2).split()]



def test_two_generations_keep_what_is_in_use():
    memory = tokens.Memory(3 * (tokens.ENTRY + 2))
    for i in range(50):
        memory.turn()
        wanted = {"a", f"{i:x}"[-1]}
        for word in memory.missing(wanted):
            assert i == 0 or word != "a"
            memory.put(word, b"1")
        assert wanted <= set(memory.young) and len(memory.young) + len(memory.old) <= 10
