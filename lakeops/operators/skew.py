"""Per-key ordering without putting a whole key in one task.

A window over a key sorts all of that key's rows in one task. These helpers cut each key into
buckets along the sort order, work per (key, bucket), and stitch the buckets together from one
small row per bucket. Where the caller names no bucket, the cuts come from the data: quantiles of the
sort column for each key that has more rows than one task should sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import materialize


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by ``order``; an aggregate, so hot keys are reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return top.select(*keys, "_row.*").select(*df.columns)


def left_join_sparse(left: DataFrame, right: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join on an integer ``key`` that is often NULL.

    NULL keys match nothing but would all be sent to one task; they get stand-in keys, far below
    any real one, that spread them by ``spread_by``.
    """
    stand_in = F.lit(-(2**62)) - F.pmod(F.xxhash64(spread_by), F.lit(4096))
    keyed = left.withColumn("_key", F.coalesce(F.col(key), stand_in))
    return keyed.join(right.withColumnRenamed(key, "_key"), "_key", "left").drop("_key")


RANGE_ROWS = 1_000_000
QUANTILES = 512


def range_cuts(df: DataFrame, keys: Sequence[str], by: str, rows: int = RANGE_ROWS) -> DataFrame | None:
    """Where keys of more than ``rows`` rows are cut into ranges of ``by``: ``_hot_0``, ... (the key) and ``_cuts``; None without such keys.

    Only rows of these keys are sketched, and each task sums its sketches up before the shuffle.
    """
    counts = df.groupBy(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.where(F.col("_rows") > rows)
    if hot.isEmpty():
        return None
    hot = materialize(hot, "hot_keys")
    names = [f"_hot_{i}" for i in range(len(keys))]
    met = df.select(*keys, F.col(by).alias("_by")).join(hot, _same_keys(keys), "inner")
    sketch = F.percentile_approx("_by", [i / QUANTILES for i in range(1, QUANTILES)], 10 * QUANTILES)
    found = met.groupBy(*names, "_rows").agg(sketch.alias("_points"))
    step = F.greatest(F.lit(1), F.floor(F.lit(float(QUANTILES) * rows) / F.col("_rows"))).cast("int")
    return found.select(*names, F.array_distinct(F.filter("_points", lambda p, i: (i + 1) % step == 0)).alias("_cuts"))


def _same_keys(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)])


def with_ranges(df: DataFrame, keys: Sequence[str], by: str, rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` with ``_bucket``: 0 for keys of at most ``rows`` rows, else the number of a range of ``by`` that holds about so many.

    Ranges follow the quantiles of ``by`` within the key and number ``QUANTILES`` at most; equal values
    of ``by`` stay together. ``df`` is read several times, so a costly one should be stored first.
    """
    cuts = range_cuts(df, keys, by, rows)
    return df.withColumn("_bucket", F.lit(0)) if cuts is None else _with_cuts(df, keys, by, cuts)


def _with_cuts(df: DataFrame, keys: Sequence[str], by: str, cuts: DataFrame) -> DataFrame:
    passed = F.size(F.filter("_cuts", lambda p: F.coalesce(p <= F.col(by), F.lit(False))))
    return df.join(cuts, _same_keys(keys), "left").withColumn("_bucket", F.when(F.col("_cuts").isNull(), 0).otherwise(passed)).select(*df.columns, "_bucket")


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | None) -> DataFrame | None:
    """``df`` with ``_bucket``; None where no key needs to be cut."""
    if bucket is not None:
        return df.withColumn("_bucket", bucket)
    cuts = range_cuts(df, keys, order[0])
    return None if cuts is None else _with_cuts(df, keys, order[0], cuts)


def _with_edges(inside: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on the keys, null ones included, and the bucket."""
    columns = [*keys, "_bucket"]
    named = edges.withColumnsRenamed({c: f"_edge_{i}" for i, c in enumerate(columns)})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_edge_{i}")) for i, c in enumerate(columns)])
    return inside.join(named, same, "left").drop(*[f"_edge_{i}" for i in range(len(columns))])


def neighbour(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], bucket: Column | None,
    out: str, step: int = 1,
) -> DataFrame:
    """Struct of ``columns`` of the next (``step=1``) or previous (``-1``) row of the same key.

    ``bucket`` must not decrease along ``order``; with None keys of many rows are cut by the quantiles
    of the first order column. ``out`` is NULL at the end of a key.
    """
    look = F.lead if step == 1 else F.lag
    edge_of = F.min_by if step == 1 else F.max_by
    cut = _cut(df, keys, order, bucket)
    if cut is None:
        return df.withColumn(out, look(F.struct(*columns)).over(Window.partitionBy(*keys).orderBy(*order)))
    inside = cut.withColumn(
        "_inside", look(F.struct(*columns)).over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    )
    edges = (
        cut.groupBy(*keys, "_bucket")
        .agg(edge_of(F.struct(*columns), F.struct(*order)).alias("_edge"))
        .withColumn("_beyond", look("_edge").over(Window.partitionBy(*keys).orderBy("_bucket")))
        .drop("_edge")
    )
    return (
        _with_edges(inside, edges, keys)
        .withColumn(out, F.coalesce("_inside", "_beyond"))
        .drop("_inside", "_beyond", "_bucket")
    )


def carried_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column | None, out: str
) -> DataFrame:
    """Last non-NULL ``value`` at or before each row of the key; ``bucket`` as for ``neighbour``."""
    cut = _cut(df, keys, order, bucket)
    if cut is None:
        all_before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(all_before))
    run = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = cut.withColumn("_inside", F.last(value, ignorenulls=True).over(run))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        cut.groupBy(*keys, "_bucket")
        .agg(F.max_by(F.when(F.col(value).isNotNull(), F.col(value)),
                      F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_edge"))
        .withColumn("_before", F.last("_edge", ignorenulls=True).over(before))
        .drop("_edge")
    )
    return (
        _with_edges(inside, edges, keys)
        .withColumn(out, F.coalesce("_inside", "_before"))
        .drop("_inside", "_before", "_bucket")
    )


def rank_in_group(df: DataFrame, group: Sequence[str], value: str, bucket: Column, out: str) -> DataFrame:
    """RANK by ``value`` descending inside ``group``; ``bucket`` must not decrease with ``value``."""
    cut = df.withColumn("_bucket", bucket)
    higher = Window.partitionBy(*group).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        cut.groupBy(*group, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_above", F.coalesce(F.sum("_n").over(higher), F.lit(0)))
        .drop("_n")
    )
    inside = cut.withColumn("_rank", F.rank().over(Window.partitionBy(*group, "_bucket").orderBy(F.desc(value))))
    return (
        inside.join(sizes, [*group, "_bucket"])
        .withColumn(out, F.col("_rank") + F.col("_above"))
        .drop("_rank", "_above", "_bucket")
    )


def numbered(df: DataFrame, key: str, out: str, width: int = 100_000) -> DataFrame:
    """Dense 1..n numbering by a unique ``key``, however its values are spread.

    Rows are cut into key ranges of about ``width`` rows, written with the number of their range, and
    numbered inside each; only one row per range meets in one task.
    """
    ranges = max(1, -(-df.count() // width))
    cut = materialize(df.repartitionByRange(ranges, key).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = cut.withColumn("_pos", F.row_number().over(Window.partitionBy("_range").orderBy(key)))
    return inside.join(offsets, "_range").withColumn(out, (F.col("_pos") + F.col("_offset")).cast("bigint")).drop("_pos", "_offset", "_range")


def exact_percentile(df: DataFrame, group: str, value: str, p: float, width: float, refine: int = 2, parts: int = 1024) -> DataFrame:
    """Interpolated percentile per group from a histogram of ``width``-wide bins.

    The bins that hold the two neighbouring ranks are cut into ``parts`` finer ones, ``refine`` times;
    only the last ones are expanded, as (value, count) rows.
    """
    rows = df.where(F.col(value).isNotNull()).select(group, value)
    ends = ["_pos", "_low", "_high"]
    wanted = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_total")).withColumn("_pos", (F.col("_total") - 1) * F.lit(p))
    wanted = wanted.select(group, "_pos", F.floor("_pos").alias("_low"), F.ceil("_pos").alias("_high"))
    rows, keys = rows.join(wanted, group).withColumn("_start", F.lit(0).cast("bigint")), [group]
    for level in range(refine + 1):
        bin_ = f"_bin{level}"
        rows = rows.withColumn(bin_, F.floor(F.col(value) / F.lit(width) * F.lit(float(parts**level))))
        before = Window.partitionBy(*keys).orderBy(bin_)
        bins = rows.groupBy(*keys, bin_, "_start", *ends).agg(F.count(F.lit(1)).alias("_n")).withColumn("_to", F.col("_start") + F.sum("_n").over(before))
        bins = bins.withColumn("_from", F.col("_to") - F.col("_n"))
        hit = bins.where((F.col("_low").between(F.col("_from"), F.col("_to") - 1)) | (F.col("_high").between(F.col("_from"), F.col("_to") - 1)))
        keys = [*keys, bin_]
        rows = rows.drop("_start").join(hit.select(*keys, F.col("_from").alias("_start")), keys)
    values = rows.groupBy(*keys, "_start", *ends, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = values.withColumn("_to", F.col("_start") + F.sum("_n").over(Window.partitionBy(*keys).orderBy(value))).withColumn(
        "_from", F.col("_to") - F.col("_n"))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col(rank) >= F.col("_from")) & (F.col(rank) < F.col("_to")), F.col(value)))

    two = placed.groupBy(group).agg(at("_low").alias("_a"), at("_high").alias("_b"), F.max(F.col("_pos") - F.col("_low")).alias("_f"))
    return two.select(group, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).alias("percentile"))
