"""Secrets in texts: patterns of known kinds, and strings whose characters are too evenly spread.

For the second, a candidate string is cut into runs of each character class. A window of fixed size
slides over a run; the Shannon entropy of its characters is kept up to date from the counts of the
character that enters and the one that leaves. Runs of windows above the class's threshold are a
span. An allow-list suppresses strings that are harmless as a whole, and of others the windows that
touch a part between separators in which a harmless pattern stands.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.tokens import groups

# The base kinds in their order, their patterns and least lengths (of group 2 for assign).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run of hex digits is one match either way

KINDS = ("assign", "access", "hex", "entropy")
_PART = re.compile(r"[^+/_=-]+")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class CharacterClass:
    """Windows of ``size`` characters out of ``characters`` with at least ``bits`` of entropy a character."""

    name: str
    characters: str
    size: int
    bits: float


DIGITS = "0123456789"
SMALL = "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharacterClass("hex", DIGITS + "abcdefABCDEF", 20, 2.9),
    CharacterClass("base32", SMALL.upper() + "234567", 24, 3.6),
    CharacterClass("base64", SMALL + SMALL.upper() + DIGITS + "+/_-", 20, 3.7),
)
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|changeme|redacted|x{6}|0{8}|1234567|wjalrxutnfemi",
    r"(?i)abcdefgh",
    r"[0-9]+",  # a number
    r"[^0-9]+",  # no digit: words, names of functions, long compounds
    r"(?:[A-Za-z]+[_/-])*[A-Za-z]+[_/-]?[0-9]{1,4}",  # words and a short number
    r"[A-Za-z]{2,}(?:[_/=-][A-Za-z]{2,}|[_/=-][0-9]{1,6})+",  # paths and slugs
)


def window_entropies(text: str, size: int) -> Iterator[float]:
    """Entropy in bits a character of every window of ``size`` characters, from counts that change by two each step."""
    if len(text) < size:
        return
    terms = [0.0, *(n * math.log2(n) for n in range(1, size + 2))]
    counts: dict[str, int] = {}
    total = 0.0  # sum of n log n over the window's characters
    for i, character in enumerate(text):
        n = counts.get(character, 0)
        total += terms[n + 1] - terms[n]
        counts[character] = n + 1
        if i >= size:
            gone = text[i - size]
            n = counts[gone]
            total += terms[n - 1] - terms[n]
            counts[gone] = n - 1
        if i >= size - 1:
            yield math.log2(size) - total / size


class Scanner:
    """Finds spans in one text. ``classes`` and ``allowed`` (patterns of whole or, with inline flags, partial strings) may be changed."""

    def __init__(self, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED):
        self.classes = classes
        self.partial = [re.compile(p) for p in allowed if p.startswith("(?i)")]
        self.whole = [re.compile(p) for p in allowed if not p.startswith("(?i)")]
        self.runs = [re.compile("[" + re.escape(c.characters) + "]{" + str(c.size) + ",}") for c in classes]

    def harmless(self, found: str) -> bool:
        return any(p.fullmatch(found) for p in self.whole)

    def harmless_parts(self, found: str) -> list[tuple[int, int]]:
        return [part.span() for part in _PART.finditer(found) if any(p.search(part[0]) for p in self.partial)]

    def base(self, text: str) -> list[tuple[int, int, str]]:
        """The base kinds, leftmost and without overlap within a kind."""
        found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
        found += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]
        return found

    def uneven(self, text: str) -> list[tuple[int, int, str]]:
        """Spans of the entropy windows: per candidate the union of all classes' windows above their threshold."""
        found = []
        for candidate in CANDIDATE.finditer(text):
            string = candidate[0]
            if self.harmless(string.strip("=-_/+")):
                continue
            windows, parts = [], self.harmless_parts(string)
            for kind, runs in zip(self.classes, self.runs, strict=True):
                for run in runs.finditer(string):
                    if self.harmless(run[0].strip("=-_/+")):
                        continue
                    windows += [(run.start() + i, run.start() + i + kind.size)
                                for i, bits in enumerate(window_entropies(run[0], kind.size)) if bits >= kind.bits]
            if parts:
                windows = [(start, end) for start, end in windows if not any(start < b and a < end for a, b in parts)]
            last = -1
            for start, end in sorted(windows):
                start, end = candidate.start() + start, candidate.start() + end
                if start <= last:
                    found[-1] = (found[-1][0], max(end, found[-1][1]), "entropy")
                else:
                    found.append((start, end, "entropy"))
                last = found[-1][1]
        return found

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """All spans by start, then kind in the order of ``KINDS``; the entropy spans leave out what a base span covers."""
        base = self.base(text)
        edges = sorted((s, e) for s, e, _ in base)
        extra, at = [], 0
        for start, end, kind in self.uneven(text):
            while at < len(edges) and edges[at][1] <= start:
                at += 1
            if not any(s <= start and end <= e for s, e in edges[max(0, at - 2):at + 3]):
                extra.append((start, end, kind))
        return sorted(base + extra, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end in code points) of every document's whole text, one row per row.

    Null and empty texts have no spans; equal rows have equal results; an empty table gives no rows.
    """
    own = scanner or Scanner()
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("spans", _SPANS)])
    inner = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 1000):
                part = batch.slice(row, 1000)
                spans = [[{"kind": k, "start": s, "end": e} for s, e, k in own.spans(t or "")] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, inner)], schema.names)

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(run, schema)


def redact(docs: DataFrame, text: str = "text", size: str | None = "n_chars", mark: str = "[{kind}]", scanner: Scanner | None = None) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans become one mark of the first's kind.

    Texts without spans, null texts and all other columns stay; the column ``size``, if it is there,
    holds the new length where the text changed.
    """
    own = scanner or Scanner()
    schema, columns = docs.schema, docs.columns
    at = columns.index(text)
    length = columns.index(size) if size in columns else None

    def cleaned(whole: str | None) -> str | None:
        spans = own.spans(whole) if whole else []
        if not spans:
            return whole
        out, last, kinds = [], 0, []
        merged: list[list] = []
        for start, end, kind in spans:
            if merged and start < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end, kind])
        for start, end, kind in merged:
            out += [whole[last:start], mark.format(kind=kind.upper())]
            last = end
        return "".join([*out, whole[last:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for low, high in groups([len(t or "") for t in texts]):
                arrays = [c.slice(low, high - low) for c in batch.columns]
                new = [cleaned(t) for t in texts[low:high]]
                if length is not None:
                    old = arrays[length].to_pylist()
                    arrays[length] = pa.array([len(n) if n != t else o for n, t, o in zip(new, texts[low:high], old, strict=True)], arrays[length].type)
                arrays[at] = pa.array(new, arrays[at].type)
                yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return docs.mapInArrow(run, schema)
