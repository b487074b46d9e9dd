import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.operators import entities, sketches


def brute(pairs):
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


@pytest.mark.parametrize("pairs", [
    [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(100, 101), (101, 100), (7, 7), (None, 3), (5, None)], [],
    [(random.Random(i).randrange(80), random.Random(i + 900).randrange(80)) for i in range(70)]])
def test_entities_are_connected_records(spark, pairs):
    got = entities.entity_of(spark.createDataFrame(pairs, "a bigint, b bigint"))
    assert {r.node: r.entity for r in got.collect()} == brute(pairs)


def test_the_fullest_record_survives(spark):
    records = spark.createDataFrame(
        [(1, 1, "Ann", None, 3), (2, 1, "Anne", "a@x", 1), (3, 1, None, "b@x", 9), (4, 4, None, None, 1), (6, 5, "Bo", None, 2), (5, 5, "Bob", None, 2)],
        "id int, entity int, name string, mail string, at int")
    got = {r.entity: (r.id, r.members, r.name, r.mail) for r in entities.surviving(records, "id", ["name", "mail"], "at").collect()}
    assert got == {1: (2, 3, "Anne", "a@x"), 4: (4, 1, None, None), 5: (5, 2, "Bob", None)}


def test_quality_counts_pairs_without_listing_them(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(6), rng.randrange(5)) for i in range(80)]
    r = entities.group_quality(spark.createDataFrame(rows, "id int, e int, t int"), "e", "t").first()
    pairs = [(a, b) for a in rows for b in rows if a[0] < b[0]]
    found, labelled = sum(a[1] == b[1] for a, b in pairs), sum(a[2] == b[2] for a, b in pairs)
    hits = sum(a[1] == b[1] and a[2] == b[2] for a, b in pairs)
    assert (r.found, r.labelled, r.hits, r.precision, r.recall) == (found, labelled, hits, round(hits / found, 6), round(hits / labelled, 6))
    assert entities.group_quality(spark.createDataFrame([], "id int, e int, t int"), "e", "t").first().precision is None


def test_merged_days_give_ranks_within_bounds(spark):
    rng = np.random.default_rng(2)
    rows = [(int(g), f"2026-01-{1 + int(d):02d}", None if v < -2 else float(v)) for g, d, v in
            zip(rng.integers(0, 3, 30000), rng.integers(0, 20, 30000), rng.lognormal(0, 2, 30000) - 0.01, strict=True)]
    df = spark.createDataFrame(rows, "g int, day string, v double").withColumn("ts", F.col("day").cast("timestamp"))
    days = sketches.daily_sketches(df, ["g"], "ts", "v").cache()
    assert days.count() == 60
    for only in (None, F.col("day") >= "2026-01-15"):
        found = sketches.percentiles(sketches.merged(days, ["g"], only), [0.01, 0.5, 0.95, 0.999])
        kept = df if only is None else df.where(F.to_date("ts") >= "2026-01-15")
        errors = sketches.rank_errors(found, kept, ["g"], "v").collect()
        assert len(errors) == 12 and all(r.rank_error <= 0.01 for r in errors)
        exact = defaultdict(list)
        for r in kept.collect():
            exact[r.g].append(r.v)
        for r in found.where("share = 0.5").collect():
            assert r.n == len(exact[r.g]) and np.quantile(exact[r.g], 0.48) <= r.percentile <= np.quantile(exact[r.g], 0.52)
    assert days.selectExpr("max(length(sketch))").first()[0] < 20_000


def test_joins_of_entities_are_not_broadcast(spark):
    """Broadcasts go through the driver; with every round they would add up there."""
    from conftest import plan_of

    from lakeops.functions.similarity import similar_members

    people = spark.createDataFrame([(i, "x", f"name{i}") for i in range(12)] + [(20, None, "name1"), (21, "x", None)], "id long, city string, name string")
    pairs = similar_members(people, ["city"], "name", "id")
    grouped = entities.with_entities(people, "id", pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    assert {r.id: r.entity for r in grouped.collect()} == {**{i: 0 for i in range(12)}, 20: 20, 21: 21}
    assert pairs.count() and "Broadcast" not in plan_of(pairs) and "Broadcast" not in plan_of(grouped)
