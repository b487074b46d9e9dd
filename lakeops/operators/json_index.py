"""An index over JSON columns: which rows hold a value at a path, answered without reading a document.

Every value at an indexed path, and every element of an array there, is one row of path, value (as
JSON text) and key, stored under a bucket of path and value. A containment test reads the buckets of
its own pairs and keeps the keys that have them all.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import scratch_path

BUCKETS = 64


@dataclass(frozen=True)
class JsonIndex:
    folder: str
    buckets: int
    schema: str
    paths: tuple[str, ...]

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        rows = spark.read.schema(self.schema).parquet(self.folder)
        return rows if buckets is None else rows.where(F.col("bucket").isin(list(buckets)))


def bucket_of(path: Column, value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(path, value), F.lit(buckets)).cast("int")


def build_json_index(df: DataFrame, key: str, column: str, paths: Sequence[str], folder: str | None = None, buckets: int = BUCKETS) -> JsonIndex:
    """Index the values of ``column`` at ``paths`` (like ``$.colors``), none of which may lie inside another.

    Documents that are not JSON, and paths a document lacks, have no rows; a null at a path is the value ``null``.
    """
    for a in paths:
        if any(a != b and b.startswith((a + ".", a + "[")) for b in paths):
            raise ValueError(f"{a} holds another path")
    folder = folder or scratch_path(df.sparkSession, "json_index")
    parsed = df.select(F.col(key).alias("key"), F.try_parse_json(F.col(column)).alias("v"))
    found = F.array(*[F.struct(F.lit(p).alias("path"), F.variant_get("v", p, "variant").alias("at")) for p in paths])
    rows = parsed.select("key", F.explode(found).alias("f")).select("key", "f.path", "f.at").where("at IS NOT NULL")
    elements = F.when(F.schema_of_variant("at").startswith("ARRAY"), F.expr("transform(try_variant_get(at, '$', 'array<variant>'), x -> to_json(x))")).otherwise(F.array(F.to_json("at")))
    values = rows.select("key", "path", F.explode(F.array_distinct(elements)).alias("value"))
    out = values.withColumn("value", F.coalesce("value", F.lit("null"))).withColumn("bucket", bucket_of(F.col("path"), F.col("value"), buckets))
    # Sorted files let a reader skip row groups by path and value.
    out.hint("rebalance", "bucket").sortWithinPartitions("bucket", "path", "value").write.partitionBy("bucket").parquet(folder)
    kind = dict(df.dtypes)[key]
    return JsonIndex(folder, buckets, f"key {kind}, path string, value string, bucket int", tuple(paths))


def containing(index: JsonIndex, spark: SparkSession, wanted: Sequence[tuple[str, object]]) -> DataFrame:
    """``key`` of the rows that hold every (path, value) of ``wanted``; values as Python gives them to JSON."""
    pairs = {(path, json.dumps(value, ensure_ascii=False, separators=(",", ":"))) for path, value in wanted}
    unknown = {p for p, _ in pairs} - set(index.paths)
    if unknown or not pairs:
        raise ValueError(f"not indexed: {sorted(unknown)}" if unknown else "nothing asked for")
    asked = spark.createDataFrame(sorted(pairs), "path string, value string")
    buckets = [r[0] for r in asked.select(bucket_of(F.col("path"), F.col("value"), index.buckets)).distinct().collect()]
    same = reduce(lambda a, b: a | b, [(F.col("path") == p) & (F.col("value") == v) for p, v in sorted(pairs)])
    held = index.read(spark, buckets).where(same).select("key", "path", "value").distinct()
    return held.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(pairs)).select("key")
