"""Entities from pairs of records: connected records, the record that survives, and how good the groups are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialize


def entity_of(pairs: DataFrame) -> DataFrame:
    """``node`` and ``entity``, the least node that a chain of pairs reaches, of every node in a pair (two columns, any direction).

    Each round a node takes the least label among its neighbours' and then its label's own label, so
    labels jump ahead and the rounds grow with the logarithm of the longest chain. A round is written
    before the next; minima are summed up before they are shuffled, so a node of many pairs is no hot key.
    Joins merge in tasks: broadcasts of every round would add up on the driver.
    """
    a, b = pairs.columns
    known = pairs.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    edges = materialize(known.unionByName(known.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = materialize(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")).select(F.col("x").alias("node"), "label"), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("y"), "label").hint("merge"), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("_near"))
        moved = materialize(labels.join(near.hint("merge"), "node").select("node", "label", F.least("label", "_near").alias("_new")), "labels")
        jumped = moved.join(moved.select(F.col("node").alias("_at"), F.col("_new").alias("_far")).hint("merge"), F.col("_new") == F.col("_at")).select(
            "node", "label", F.least("_new", "_far").alias("_new"))
        jumped = materialize(jumped, "labels")
        if jumped.where("label <> _new").isEmpty():
            return labels.select("node", F.col("label").alias("entity"))
        labels = jumped.select("node", F.col("_new").alias("label"))


def with_entities(records: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """``records`` with their ``entity``; a record in no pair is its own."""
    found = entity_of(pairs)
    return records.join(found.withColumnRenamed("node", key).hint("merge"), key, "left").withColumn("entity", F.coalesce("entity", key))


def surviving(records: DataFrame, key: str, columns: Sequence[str], newest: str | None = None) -> DataFrame:
    """One record per entity: the one with most of ``columns`` filled, then the newest, then of the least key, its gaps filled from the others in that order.

    ``members`` counts the records; every value is an aggregate, so a large entity is summed up before the shuffle.
    """
    filled = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    order = F.struct(filled, *([F.col(newest)] if newest else []), -F.col(key))
    picked = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    return records.groupBy("entity").agg(F.max_by(F.col(key), order).alias(key), F.count(F.lit(1)).alias("members"), *picked)


def group_quality(records: DataFrame, found: str, truth: str) -> DataFrame:
    """Precision and recall of the groups by the pairs of records they hold, from the counts alone: no pair is listed."""
    def pairs(keys: Sequence[str], name: str) -> DataFrame:
        n = F.col("_n").cast("decimal(38,0)")
        return records.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0)).cast("bigint").alias(name))

    one = pairs([found], "found").crossJoin(pairs([truth], "labelled")).crossJoin(pairs([found, truth], "hits"))  # one row each
    return one.withColumn("precision", F.round(F.col("hits") / F.nullif(F.col("found"), F.lit(0)), 6)).withColumn(
        "recall", F.round(F.col("hits") / F.nullif(F.col("labelled"), F.lit(0)), 6))
