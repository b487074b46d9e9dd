"""Token ids of whole texts, as the tokenizers library gives them, at less cost.

A byte-level tokenizer whose merges are ranked by the ids they make is handed to tiktoken, built from
the same file. A tokenizer that drops white space and lowers letters splits a text into words before
it merges, so the ids of a word can be remembered. What neither rule covers (characters whose class
changed with Unicode's versions, control characters, runs without a space, other kinds of tokenizer)
is encoded by the tokenizers library as a whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lakeops.llm.blocks import kept

_CONTROL = re.compile(r"[\x1c-\x1f\x85]")
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MEMORY = 96 << 20
ENTRY = 230  # bytes that a remembered word takes besides its letters and ids
LONG = 1000
#: The pattern by which byte-level tokenizers of this family part words.
BYTE_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _unsettled() -> re.Pattern:
    """Characters whose class (letter, number, space, other) is not the same in old and new versions of Unicode."""
    old, ranges, low = unicodedata.ucd_3_2_0, [], None
    for code in range(0x10000):
        c = chr(code)
        settled = old.category(c) not in ("Cn", "Cs") and old.category(c)[0] == unicodedata.category(c)[0] and code not in (0x1C, 0x1D, 0x1E, 0x1F, 0x85)
        if settled and low is None:
            low = code
        elif not settled and low is not None:
            ranges.append((low, code - 1))
            low = None
    if low is not None:
        ranges.append((low, 0xFFFF))
    return re.compile("[^" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges) + "]")


def _long_run(text: str) -> bool:
    """Whether ``LONG`` bytes follow each other without a space, or so many spaces without another byte."""
    if len(text) < LONG // 4:
        return False
    raw = np.frombuffer(text.encode(), np.uint8)
    at = np.concatenate([[-1], np.flatnonzero(raw == 32), [len(raw)]])
    return bool((np.diff(at) > LONG).any() or (len(at) > LONG and (at[LONG:] - at[:-LONG] == LONG).any()))


class Memory:
    """Ids by word in two generations of at most ``most`` bytes each: what is in use moves to the young one, the old one goes when that is full."""

    def __init__(self, most: int):
        self.most, self.size = most, 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        """Between uses only: words that a caller still looks up stay in ``young``."""
        if self.size > self.most:
            self.old, self.young, self.size = self.young, {}, 0

    def put(self, word: str, ids: bytes) -> None:
        self.young[word] = ids
        self.size += ENTRY + len(word) + len(ids)

    def missing(self, words: set[str]) -> list[str]:
        """The words that are not remembered; those that are stand in ``young`` afterwards."""
        found = []
        for word in words.difference(self.young):
            ids = self.old.get(word)
            if ids is None:
                found.append(word)
            else:
                self.put(word, ids)
        return found


class Encoder:
    """Whole texts to ids. ``path`` is a tokenizer file that every machine has; ids are little-endian bytes. ``memory``: bytes of a generation."""

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control strings inside a text are text
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        spec = json.loads(self.tokenizer.to_str())
        self.kind = self._kind(spec)
        self.words = Memory(memory)
        if self.kind == "bytes":
            import tiktoken

            self.fast = tiktoken.Encoding("own", pat_str=BYTE_WORDS, mergeable_ranks=self._ranks(spec), special_tokens={})
            self.unsettled = _unsettled()

    @staticmethod
    def _ranks(spec: dict) -> dict[bytes, int]:
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        made = [*letters, *(a + b for a, b in map(Encoder._pair, spec["model"]["merges"]))]
        return {bytes(letters[c] for c in word): vocab[word] for word in made}

    @staticmethod
    def _pair(merge: str | list[str]) -> list[str]:
        return merge.split(" ") if isinstance(merge, str) else merge

    @staticmethod
    def _kind(spec: dict) -> str:
        """``bytes``: byte-level, merges in the order of their ids; ``words``: white space is dropped, letters are lowered; else ``other``."""
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec.get("normalizer"):
            plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            ids = [model["vocab"].get("".join(Encoder._pair(m)), -1) for m in model["merges"]] if plain else []
            letters = byte_letters()
            ordered = len(ids) > 0 and ids[0] >= 0 and all(a < b for a, b in zip(ids, ids[1:], strict=False))
            return "bytes" if ordered and all(c in model["vocab"] for c in letters) else "other"
        steps = before.get("pretokenizers", [])
        normal = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if steps and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and normal == ["NFC", "Replace", "Lowercase"]:
            return "words"
        return "other"

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _bulk(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only, encoded in one go."""
        if not words:
            return []
        encoded = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        number = np.array(encoded.word_ids, np.int64)
        cuts = (np.flatnonzero(np.diff(number)) + 1) * self.dtype.itemsize
        if len(cuts) + 1 != len(words):
            return [self._whole(w) for w in words]
        ids = np.array(encoded.ids, self.dtype).tobytes()
        edges = [0, *cuts.tolist(), len(ids)]
        return [ids[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def _learn(self, wanted: set[str]) -> None:
        """Remember cores of letters, encoded in bulk, and other words as they are."""
        new = self.words.missing(wanted)
        cores = [w for w in new if w.isalpha()]
        for core, ids in zip(cores, self._bulk(cores), strict=True):
            self.words.put(core, ids)
        for word in new:
            if not word.isalpha():
                self.words.put(word, self._whole(word))

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words: a core of letters, in lower case, and the punctuation behind it apart; else as the word stands."""
        cores, tails = words.copy(), {}
        for i, word in enumerate(words):
            if word.isalpha():
                if not word.islower() and "Σ" not in word:
                    cores[i] = word.lower()
                continue
            core = word.rstrip(PUNCTUATION)
            if core.isalpha():
                cores[i] = core if core.islower() or "Σ" in core else core.lower()
                tails[i] = word[len(core):]
        ends = {t: self._whole(t) for t in set(tails.values())}
        self.words.turn()
        self._learn(set(cores))
        found = list(map(self.words.young.__getitem__, cores))
        for i, tail in tails.items():
            found[i] += ends[tail]
        return found

    def _encode_words(self, texts: list[str]) -> list[bytes]:
        plain = [not _CONTROL.search(t) for t in texts]
        cut = pc.utf8_split_whitespace(pa.array([t if p else "" for t, p in zip(texts, plain, strict=True)], pa.large_string()))
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        empty = words.index("") if "" in words else -1  # what stands around white space at the ends of a text
        ids = self._ids_of([w or "a" for w in words])
        if empty >= 0:
            ids[empty] = b""
        size = np.array([len(i) for i in ids], np.int64) // self.dtype.itemsize
        table = np.frombuffer(b"".join(ids), self.dtype)
        at = coded.indices.to_numpy()
        length, first = size[at], (np.cumsum(size) - size)[at]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        out = table[np.repeat(first - (ends - length), length) + np.arange(total)].tobytes()
        edges = (np.concatenate([[0], ends])[cut.offsets.to_numpy()] * self.dtype.itemsize).tolist()
        return [out[a:b] if p else self._whole(t) for t, p, a, b in zip(texts, plain, edges, edges[1:], strict=False)]

    def _encode_bytes(self, text: str) -> bytes:
        if (not text.isascii() or _CONTROL.search(text)) and self.unsettled.search(text) or _long_run(text):
            return self._whole(text)
        return np.array(self.fast.encode_ordinary(text), self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as the tokenizer gives them for the whole text."""
        if self.kind == "words":
            return self._encode_words(texts)
        return [self._encode_bytes(t) if self.kind == "bytes" else self._whole(t) for t in texts]


def encoder(path: str) -> Encoder:
    """One encoder per worker and file, so that a file is loaded once."""
    return kept(f"encoder {path}", lambda: Encoder(path))


def groups(lengths: list[int], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together are about ``size`` long."""
    low = total = 0
    for at, n in enumerate(lengths):
        if at > low and total + n > size:
            yield low, at
            low, total = at, 0
        total += n
    if lengths:
        yield low, len(lengths)
