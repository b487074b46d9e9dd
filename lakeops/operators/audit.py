"""Tamper evidence for append-only tables: a tree of digests, appended to at its edge, and proofs of single rows."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialize


def row_text(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _leaves(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return rows.select(F.col(key).alias("position"), F.sha2(row_text(columns), 256).alias("digest"), F.lit(1).cast("bigint").alias("rows"))


def _parents(level: DataFrame, block: int, number: int) -> DataFrame:
    grouped = level.groupBy(F.floor(F.col("position") / block).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("position", "digest"))).alias("_d"), F.sum("rows").alias("rows"))
    digest = F.sha2(F.array_join(F.transform("_d", lambda d: d["digest"]), ""), 256)
    return materialize(grouped.select(F.lit(number).alias("level"), "block", "rows", digest.alias("digest")), f"digest_{number}")


def digest_tree(rows: DataFrame, key: str, columns: Sequence[str], block: int = 1000) -> DataFrame:
    """Digests of blocks of ``block`` consecutive keys, then of blocks of blocks, until one block is left: the table's digest.

    A row's text is a JSON object with its column names and nulls, so different rows have different
    texts. A block never holds more than ``block`` digests because ``key`` is a unique integer, so no
    task sees more than one block. An empty table has no digest.
    """
    level = _leaves(rows, key, columns)
    tree, number, blocks = None, 0, 2
    while blocks > 1:
        number += 1
        done = _parents(level, block, number)
        tree = done if tree is None else tree.unionByName(done)
        level, blocks = done.select(F.col("block").alias("position"), "digest", "rows"), done.count()
    return tree


def append_tree(tree: DataFrame, table: DataFrame, added: DataFrame, key: str, columns: Sequence[str], block: int = 1000) -> DataFrame:
    """The tree of ``table`` and ``added`` together, from the tree of ``table``: only blocks at its right edge are hashed again.

    Keys of ``added`` are above all of ``table``, whose rows are read from the first changed block on
    only, by a filter on the key. On every level above, the changed blocks take their other digests from the tree.
    """
    first = added.agg(F.min(key)).first()[0]
    if first is None:
        return tree
    if not table.where(F.col(key) >= first).isEmpty():
        raise ValueError("rows are only appended: a key is not above those of the table")
    start = first // block
    leaves = _leaves(table.where(F.col(key) >= start * block), key, columns).unionByName(_leaves(added, key, columns))
    number, changed, kept = 0, None, None
    top = tree.agg(F.max("level")).first()[0] or 0
    while True:
        number += 1
        done = _parents(leaves if changed is None else changed, block, number)
        same = tree.where((F.col("level") == number) & (F.col("block") < start))
        level = same.select(*done.columns).unionByName(done)
        kept = level if kept is None else kept.unionByName(level)
        if number >= top and level.count() <= 1:
            return kept
        start = start // block
        # A level that the tree did not have yet is made of all blocks below it.
        below = level if number >= top else level.where(F.col("block") >= start * block)
        changed = below.select(F.col("block").alias("position"), "digest", "rows")


@dataclass(frozen=True)
class Proof:
    """The digests beside a row's on the way up: per level the row's place in its block and the block's other digests, in order."""

    position: int
    steps: tuple[tuple[int, tuple[str, ...]], ...]


def prove(tree: DataFrame, table: DataFrame, position: int, key: str, columns: Sequence[str], block: int = 1000) -> Proof | None:
    """A proof for the row at ``position``, from one block of the table and one of each level; None if there is no such row."""
    steps, at = [], position
    level = _leaves(table.where((F.col(key) >= at // block * block) & (F.col(key) < (at // block + 1) * block)), key, columns)
    for number in range(1, (tree.agg(F.max("level")).first()[0] or 0) + 1):
        digests = [(r["position"], r["digest"]) for r in level.select("position", "digest").orderBy("position").collect()]  # ``block`` at most
        place = next((i for i, d in enumerate(digests) if d[0] == at), None)
        if place is None:
            return None
        steps.append((place, tuple(d for i, (_, d) in enumerate(digests) if i != place)))
        at //= block
        level = tree.where((F.col("level") == number) & (F.col("block") >= at // block * block) & (F.col("block") < (at // block + 1) * block)).select(
            F.col("block").alias("position"), "digest")
    return Proof(position, tuple(steps))


def verify_proof(text: str, proof: Proof, root: str) -> bool:
    """Whether a row of this text (``row_text``) is in the table whose digest is ``root``; needs no table."""
    digest = hashlib.sha256(text.encode()).hexdigest()
    for place, others in proof.steps:
        if not 0 <= place <= len(others):
            return False
        digest = hashlib.sha256("".join([*others[:place], digest, *others[place:]]).encode()).hexdigest()
    return digest == root


def verify_tree(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Compare a stored digest tree with one computed now; missing or changed blocks are not intact."""
    now = current.select("level", "block", F.col("digest").alias("_now"), F.col("rows").alias("_rows"))
    return stored.join(now, ["level", "block"], "full").select(
        "level", "block", F.coalesce("rows", "_rows").alias("rows"),
        F.coalesce(F.col("digest") == F.col("_now"), F.lit(False)).alias("intact"))
