import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from helpers import awkward, prose, table  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import alignment

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_table():
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, extra = {}, 0
    for b in range(256):
        if b in plain:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def brute_groups(text, a, b, letters):
    """Groups of one text by the definition: cut wherever tokens of both end."""
    if not text:
        return []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    raw_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    whole = (" " + text).encode()
    if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
        return []
    ends_a, ends_b = np.cumsum([len(r) for r in raw_a]), np.cumsum([len(r) for r in raw_b])
    cuts = sorted(set(ends_a) & set(ends_b))
    found, i, j = [], 0, 0
    for cut in cuts:
        first_i, first_j = i, j
        while i < len(ids_a) and ends_a[i] <= cut:
            i += 1
        while j < len(ids_b) and ends_b[j] <= cut:
            j += 1
        found.append((ids_a[first_i:i], ids_b[first_j:j]))
    return found


def brute(rows):
    a, b, letters = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B), byte_table()
    a.encode_special_tokens = True
    grouped = [(doc, brute_groups(text, a, b, letters)) for doc, text in rows]
    counts, most = Counter(), defaultdict(int)
    linked = [[(x, y) for xs, ys in groups for x in xs for y in ys] for _, groups in grouped]
    for links in linked:
        counts.update(set(links))
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    found = []
    for (doc, groups), links in zip(grouped, linked, strict=True):
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        found.append((doc, sum(len(xs) for xs, _ in groups), sum(len(ys) for _, ys in groups), len(groups), len(links),
                      sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(found, key=repr)


ODD = ["a", " ", "  ", "\n", " lead", "trail ", "two  spaces   three", "<s> </s> <unk> <|endoftext|> <0x41>", "▁ already", "naïve café 漢字かな \U0001f600\U0001f468‍\U0001f469",
       "ﬁ ½ ² İ ſ", "́e", "=" * 700 + " " * 900 + "-" * 333, "日" * 400, "\0 nul", "\t\ttabs\r\n", "1234567890 3.14159", "​zero⁠width", "x" * 5000, "ࡰ"]


def test_rows_are_those_of_brute_force(spark, table, awkward, monkeypatch):  # noqa: F811
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 3000)
    monkeypatch.setattr(alignment, "PART_CHARS", 700)
    rng = random.Random(1)
    rows = awkward + [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, prose(i, 60)) for i in range(30)]
    rows += [(300 + i, "".join(rng.choice([*ODD[:10], "the ", "of the ", "running", ", "]) for _ in range(20))) for i in range(30)]
    got = alignment.align_tokenizers(table(rows, ["block", "pair", "ids", "best"]), PATH_A, PATH_B).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_wide_groups_are_multiplied_out_by_distinct_ids(monkeypatch):
    own = alignment.Pair(PATH_A, PATH_B)
    found = own.tokens(ODD + [prose(3, 200)])
    usual = alignment.align(found, own.of_a, own.of_b)
    monkeypatch.setattr(alignment, "WIDE", 1)
    other = alignment.align(found, own.of_a, own.of_b)
    usual, other = (Counter(dict(zip(zip(x.doc, x.pair, strict=True), x.times, strict=True))) for x in (usual, other))
    assert usual == other


def test_overlapping_intervals_are_one_group():
    starts = np.array([0, 2, 5, 0, 4, 8])
    ends = np.array([2, 5, 8, 4, 8, 9])
    assert alignment.coalesced(starts, ends).tolist() == [0, 0, 0, 0, 0, 1]
    assert alignment.coalesced(np.array([3, 0]), np.array([4, 3])).tolist() == [1, 0]


def test_the_registered_query_and_no_documents(spark, table, awkward, tmp_path):  # noqa: F811
    from lakeops.llm.queries import QUERIES

    table(awkward).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_tokenizer_alignment"](spark, str(tmp_path)).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(awkward)
    assert alignment.align_tokenizers(table(awkward).where(F.lit(False)), PATH_A, PATH_B).collect() == []
    nothing = alignment.align_tokenizers(table([(1, None), (None, "")]), PATH_A, PATH_B).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in nothing), key=repr) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]
