import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import history, skew, temporal

SCHEMA = "k int, at timestamp_ntz, s string, n int"


def changes(seed, n=60):
    rng = random.Random(seed)
    return [(rng.choice([None, 1, 1, 1, 2, 3]), dt.datetime(2026, 1, 1) + dt.timedelta(hours=rng.randrange(40)), rng.choice("abc"), rng.choice([None, 1, 2])) for _ in range(n)]


def brute(rows):
    found = {}
    for k, at, s, n in rows:
        value = (s, -1 if n is None else n)
        found[k, at] = max(found.get((k, at), value), value)
    out = []
    for (k, at), value in found.items():
        later = [a for (x, a) in found if x == k and a > at]
        out.append((k, *value, at, min(later) if later else dt.datetime(9999, 12, 31)))
    return sorted(out, key=str)


def state(df):
    return sorted(((r.k, r.s, -1 if r.n is None else r.n, r.valid_from, r.valid_to) for r in df.collect()), key=str)


def applied(spark, batches, buckets=4):
    table = history.empty_history(spark.createDataFrame([], SCHEMA), ["k"], ["s", "n"], buckets)
    for batch in batches:
        table = history.apply_changes(table, spark.createDataFrame(batch, SCHEMA), "at")
    return table


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches_gives_the_full_rebuild(spark, seed):
    rows = changes(seed)
    batches = [rows[:25], rows[25:30], rows[30:], []]
    for order in list(itertools.permutations(batches))[:: 12]:
        assert state(applied(spark, order).read(spark)) == brute(rows)


def test_a_batch_writes_the_buckets_of_its_keys_only(spark):
    rows = [(k, dt.datetime(2026, 1, d), "a", k) for k in range(20) for d in (1, 5)]
    table = applied(spark, [rows], buckets=8)
    after = history.apply_changes(table, spark.createDataFrame([(3, dt.datetime(2026, 1, 3), "late", 0)], SCHEMA), "at")
    moved = [b for b, (x, y) in enumerate(zip(table.folders, after.folders, strict=True)) if x != y]
    own = spark.createDataFrame([(3,)], "k int").select(table.bucket()).first()[0]
    assert moved == [own]
    assert state(table.read(spark)) == brute(rows)  # the earlier state is still there
    got = {(r.valid_from.day, r.valid_to.year): r.s for r in after.read(spark).where("k = 3").collect()}
    assert got == {(1, 2026): "a", (3, 2026): "late", (5, 9999): "a"}
    assert all(f"_bucket={own}/" in f for f in after.read(spark, [own]).inputFiles())


def test_collapsed_versions_are_those_of_all_changes(spark):
    rows = changes(5, 80)
    found = history.collapsed(applied(spark, [rows[40:], rows[:40]]).read(spark), ["k"], ["s", "n"])
    want, last = [], {}
    for k, s, n, at, _ in sorted(brute(rows), key=lambda r: (str(r[0]), r[3])):
        if last.get(k) != (s, n):
            want.append((k, s, n, at))
            last[k] = (s, n)
    got = sorted(((r.k, r.s, -1 if r.n is None else r.n, r.valid_from) for r in found.collect()), key=str)
    assert got == sorted(want, key=str)
    current = found.where("is_current").groupBy("k").count().collect()
    assert all(r["count"] == 1 for r in current) and len(current) == len({r[0] for r in rows})


def test_a_hot_key_within_one_year_is_cut_by_its_rows(spark):
    """99 % of the rows are one key's, all within an hour."""
    n = 20_000
    df = spark.range(n).select(F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(F.lit(7)).cast("int").alias("k"),
                               F.expr("timestamp_ntz'2026-03-01 10:00:00' + make_dt_interval(0, 0, 0, id / 10)").alias("at"), F.col("id").alias("v"))
    cut = skew.with_ranges(df, ["k"], "at", rows=1000)
    sizes = [r["count"] for r in cut.where("k = 7").groupBy("_bucket").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 1500
    assert cut.where("k <> 7").select("_bucket").distinct().count() == 1
    order = cut.where("k = 7").orderBy("at").select("_bucket").collect()
    assert all(a[0] <= b[0] for a, b in zip(order, order[1:], strict=False))


@pytest.mark.parametrize("step", [1, -1])
def test_neighbours_by_ranges_equal_a_window(spark, monkeypatch, step):
    monkeypatch.setattr(skew.range_cuts, "__defaults__", (50,))
    rng = random.Random(step)
    rows = [(rng.choice([None, 0, 0, 0, 1, 2]), i, rng.choice([None, 1, 2])) for i in range(1500)]
    df = spark.createDataFrame(rows, "k int, at int, v int")
    got = skew.neighbour(df, ["k"], ["at"], ["at", "v"], None, "n", step).select("k", "at", "n.at", "n.v")
    look = F.lead if step == 1 else F.lag
    w = Window.partitionBy("k").orderBy("at")
    want = df.select("k", "at", look("at").over(w).alias("a"), look("v").over(w).alias("b"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
    got = skew.carried_forward(df, ["k"], ["at"], "v", None, "last").select("k", "at", "last")
    want = df.select("k", "at", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("last"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_asof_join_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(skew.range_cuts, "__defaults__", (40,))
    rng = random.Random(8)
    versions = [(1, dt.datetime(2026, 1, 1) + dt.timedelta(minutes=rng.randrange(5000)), i) for i in range(150)]
    facts = [(rng.choice([1, 1, 2]), dt.datetime(2026, 1, 1) + dt.timedelta(minutes=rng.randrange(5000))) for _ in range(600)]
    versions = list({v[1]: v for v in versions}.values())
    got = temporal.asof_join(spark.createDataFrame(facts, "k int, t timestamp_ntz"), spark.createDataFrame(versions, "k int, s timestamp_ntz, p int"), ["k"], "t", "s", ["p"])
    want = [(k, t, max(((s, p) for x, s, p in versions if x == k and s <= t), default=(None, None))[1]) for k, t in facts]
    assert sorted(map(str, ((r.k, r.t, r.p) for r in got.collect()))) == sorted(map(str, want))
