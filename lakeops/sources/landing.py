"""Readers for the daily landing folders, and writers that lay data out the same way."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt"


def read_landing_csv(spark: SparkSession, base: str, schema: str, files: str = "*.csv") -> DataFrame:
    """CSV with header in ``load_date=`` folders; broken rows are kept with their text in ``_corrupt``."""
    return (
        spark.read.schema(f"{schema}, {CORRUPT} STRING").option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).option("escape", '"').option("pathGlobFilter", files).csv(base)
    )


def read_full_and_delta(spark: SparkSession, base: str, schema: str, change: str = "_change") -> DataFrame:
    """Full extracts plus deltas, whose files carry one more column naming the change."""
    full = read_landing_csv(spark, base, schema, "*_full.csv")
    delta = read_landing_csv(spark, base, f"{schema}, {change} STRING", "*_delta.csv")
    return full.unionByName(delta, allowMissingColumns=True)


def read_jsonl(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """JSON Lines; folder columns such as ``event_date`` are added."""
    return spark.read.schema(schema).json(base)


def read_json_array(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """Files holding one JSON array each."""
    return spark.read.schema(schema).option("multiLine", True).json(base)


def by_folder(df: DataFrame, folder: str) -> DataFrame:
    """Rows of a folder together, in as many tasks as their size asks for: large folders are split, small ones share a task."""
    return df.hint("rebalance", F.col(folder))


def write_landing_csv(df: DataFrame, base: str, load_date: Column) -> None:
    out = by_folder(df.withColumn("load_date", load_date), "load_date")
    out.write.partitionBy("load_date").option("header", True).option("escape", '"').csv(base)


def write_jsonl(df: DataFrame, base: str, folder: str) -> None:
    by_folder(df, folder).write.partitionBy(folder).json(base)


def write_json_arrays(df: DataFrame, base: str, rows_per_file: int = 50_000) -> None:
    """Arrays of about ``rows_per_file`` rows; the rows are spread by hash, so no array grows with a key."""
    buckets = max(1, math.ceil(df.count() / rows_per_file))
    arrays = df.groupBy(F.pmod(F.xxhash64(*df.columns), F.lit(buckets)).alias("bucket")).agg(
        F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.repartition("bucket").write.partitionBy("bucket").text(base)
