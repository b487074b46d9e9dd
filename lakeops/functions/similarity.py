"""Edit-distance joins and Jaro-Winkler similarity."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity with the usual prefix bonus (0.1 per shared letter, up to 4, above 0.7)."""
    if not a or not b:
        return 1.0 if a == b else 0.0
    window = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    matched_a = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - window), min(len(b), i + window + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                matched_a.append(ch)
                break
    if not matched_a:
        return 0.0
    matched_b = [ch for ch, used in zip(b, taken) if used]
    m = len(matched_a)
    swaps = sum(x != y for x, y in zip(matched_a, matched_b)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


@F.pandas_udf(DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else _jaro_winkler(a, b) for a, b in zip(left, right)])


def deletion_variants(text: Column) -> Column:
    """The text and every text with one letter removed; two texts one edit apart share a variant."""
    shorter = F.transform(
        F.sequence(F.lit(1), F.length(text)),
        lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))),
    )
    return F.array_distinct(F.concat(F.array(text), F.when(F.length(text) > 0, shorter).otherwise(F.array(text))))


def one_edit_apart(a: Column, b: Column) -> Column:
    """One insertion, removal, replacement, or swap of neighbouring letters."""
    spots = F.filter(F.sequence(F.lit(1), F.length(a)), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))
    first, second = F.try_element_at(spots, F.lit(1)), F.try_element_at(spots, F.lit(2))
    swapped = (
        (F.length(a) == F.length(b)) & (F.size(spots) == 2) & (second == first + 1)
        & (F.substring(a, first, F.lit(1)) == F.substring(b, second, F.lit(1)))
        & (F.substring(a, second, F.lit(1)) == F.substring(b, first, F.lit(1)))
    )
    return (F.levenshtein(a, b, 1) == 1) | F.coalesce(swapped, F.lit(False))


def similar_names(df: DataFrame, block: Sequence[str], name: str, key: str) -> DataFrame:
    """Names one edit apart inside the same block, one row per pair of distinct names.

    Rows with the same (block, name) are first reduced to one with their count, and candidates
    meet on a shared deletion variant, so neither a large block nor a frequent name is paired
    with itself. Nothing that grows with the rows is broadcast.
    """
    names = df.groupBy(*block, name).agg(F.count(F.lit(1)).alias("members"), F.min(key).alias("first_id"))
    variants = names.select("*", F.explode(deletion_variants(F.col(name))).alias("_variant"))
    left = variants.select(*block, "_variant", *[F.col(c).alias(f"{c}_a") for c in (name, "members", "first_id")])
    right = variants.select(*block, "_variant", *[F.col(c).alias(f"{c}_b") for c in (name, "members", "first_id")])
    pairs = (
        left.join(right.hint("merge"), [*block, "_variant"])
        .where(F.col(f"{name}_a") < F.col(f"{name}_b"))
        .drop("_variant")
        .dropDuplicates([*block, f"{name}_a", f"{name}_b"])
    )
    return pairs.where(one_edit_apart(F.col(f"{name}_a"), F.col(f"{name}_b"))).withColumn(
        "similarity", F.round(jaro_winkler(F.col(f"{name}_a"), F.col(f"{name}_b")), 6))


def similar_members(df: DataFrame, block: Sequence[str], name: str, key: str) -> DataFrame:
    """Every two rows whose names are one edit apart inside the same block, as ``id_a`` < ``id_b``.

    Names are matched once per distinct name; their rows are joined back afterwards.
    """
    pairs = similar_names(df, block, name, key).select(*block, f"{name}_a", f"{name}_b")
    left = df.select(*block, F.col(name).alias(f"{name}_a"), F.col(key).alias("_a"))
    right = df.select(*block, F.col(name).alias(f"{name}_b"), F.col(key).alias("_b"))
    both = pairs.join(left.hint("merge"), [*block, f"{name}_a"]).join(right.hint("merge"), [*block, f"{name}_b"])
    return both.select(F.least("_a", "_b").alias("id_a"), F.greatest("_a", "_b").alias("id_b"))


def fuzzy_search(products: DataFrame, key: str, name: str, term: str, top: int | None = 5) -> DataFrame:
    """Best edit distance and Jaro-Winkler similarity of ``term`` against each word of the name."""
    words = products.select(key, name, F.explode(F.split(F.lower(F.col(name)), " ")).alias("word"))
    scored = words.select("word").distinct().select(
        "word",
        F.levenshtein(F.col("word"), F.lit(term)).alias("_distance"),
        jaro_winkler(F.col("word"), F.lit(term)).alias("_similarity"),
    )
    best = words.join(scored, "word").groupBy(key, name).agg(
        F.min("_distance").alias("best_word_distance"),
        F.round(F.max("_similarity"), 6).alias("best_word_similarity"),
    )
    if top is None:
        return best
    return best.orderBy("best_word_distance", F.desc("best_word_similarity"), key).limit(top)
