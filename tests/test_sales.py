import random
from decimal import Decimal

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import sales, skew, temporal
from lakeops.plans.sales import entity_page_of
from lakeops.tables import padded_number


def hot_rows(spark, n=3000, seed=1):
    """A third of all rows share one key; times repeat never, values often."""
    rng = random.Random(seed)
    rows = [(0 if rng.random() < 0.34 else rng.randint(1, 40), i, rng.choice([None, 1, 2, 3]), rng.randint(1, 400) / 4) for i in range(n)]
    return spark.createDataFrame(rows, "k int, at long, v int, amount double")


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_order_number_keeps_the_right_most_digits(spark):
    rows = spark.createDataFrame([(100001,), (123456789012,)], "id long").select(padded_number(F.col("id")).alias("n")).collect()
    assert [r.n for r in rows] == ["TH-00100001", "TH-56789012"]


def test_net_price_function(spark, tables):
    from lakeops.plans import QUERIES

    QUERIES["net_price"](spark, tables.folder)
    row = spark.sql("SELECT lakeops_net_price(100.00, 3, 0.10) AS a, lakeops_net_price(NULL, 1, 0) AS b").first()
    assert row.a == Decimal("270.00") and row.b is None


def test_order_without_lines_and_store(spark):
    orders = spark.sql("SELECT 1L order_id, 'TH-1' order_number, 7L customer_id, CAST(NULL AS BIGINT) store_id, 'Online' channel, timestamp_ntz'2026-08-01 10:00:00' order_date, 'Placed' status")
    customers = spark.sql("SELECT 7L customer_id, 'Ann Lee' customer_name, 'Baltics' region")
    stores = spark.sql("SELECT 1L store_id, 'Harbour' store_name, 'Baltics' region, 'Latvia' country")
    lines = spark.sql("SELECT 2L order_id, 1 line_number, CAST(5 AS DECIMAL(12,2)) line_total")
    row = sales.order_summary(orders, customers, stores, lines).first()
    assert (row.line_count, row.order_total, row.store_name) == (0, None, None)


def test_region_of_order(spark):
    orders = spark.createDataFrame([(1, 1, 10, "Store"), (2, 1, None, "Online"), (3, 2, None, "Online")], "order_id long, customer_id long, store_id long, channel string")
    customers = spark.createDataFrame([(1, "Latvia"), (2, "Atlantis")], "customer_id long, country string")
    stores = spark.createDataFrame([(10, "Sweden", "Nordics"), (11, "Latvia", "Baltics"), (12, "Latvia", "Baltics")], "store_id long, country string, region string")
    found = {r.order_id: r.sales_region for r in sales.region_of_order(orders, customers, stores).collect()}
    assert found == {1: "Nordics", 2: "Baltics", 3: None}


@pytest.mark.parametrize("step", [1, -1])
def test_neighbour_equals_window(spark, step):
    df = hot_rows(spark)
    got = skew.neighbour(df, ["k"], ["at"], ["at", "v"], F.floor(F.col("at") / 100), "n", step).select("k", "at", "n.at", "n.v")
    look = F.lead if step == 1 else F.lag
    w = Window.partitionBy("k").orderBy("at")
    same(got, df.withColumn("n", look(F.struct("at", "v")).over(w)).select("k", "at", "n.at", "n.v"))


def test_carried_forward_equals_window(spark):
    df = hot_rows(spark)
    got = skew.carried_forward(df, ["k"], ["at"], "v", F.floor(F.col("at") / 100), "last")
    w = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    same(got.select("k", "at", "last"), df.withColumn("last", F.last("v", True).over(w)).select("k", "at", "last"))


def test_rank_in_group_equals_window(spark):
    df = hot_rows(spark)
    got = skew.rank_in_group(df, ["k"], "amount", F.floor(F.col("amount") / 8), "r").select("k", "at", "r")
    w = Window.partitionBy("k").orderBy(F.desc("amount"))
    same(got, df.withColumn("r", F.rank().over(w).cast("long")).select("k", "at", "r"))


def test_left_join_sparse_equals_left_join(spark):
    left = spark.createDataFrame([(i, None if i % 3 else i % 7) for i in range(200)], "id long, k long")
    right = spark.createDataFrame([(0, "a"), (3, "b"), (None, "never")], "k long, name string")
    same(skew.left_join_sparse(left, right, "k", "id").select("id", "k", "name"), left.join(right, "k", "left").select("id", "k", "name"))


def test_numbered_is_dense(spark):
    df = spark.range(0, 5000).where("id % 7 <> 3")
    rows = skew.numbered(df, "id", "n", width=100).orderBy("id").collect()
    assert [r.n for r in rows] == list(range(1, len(rows) + 1))
    sparse = spark.range(0, 3000).select(F.xxhash64("id").alias("id"))
    rows = skew.numbered(sparse, "id", "n", width=100).orderBy("id").collect()
    assert [r.n for r in rows] == list(range(1, 3001))


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
def test_exact_percentile_equals_numpy(spark, p):
    df = hot_rows(spark)
    got = {r.k: r.percentile for r in skew.exact_percentile(df, "k", "amount", p, 5.0).collect()}
    rows = df.toPandas()
    for key, group in rows.groupby("k"):
        assert got[key] == pytest.approx(np.percentile(group.amount, p * 100), abs=1e-9)


def test_asof_join_without_pairs(spark):
    facts = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2026-01-05'), (1, timestamp_ntz'2026-03-01'), (1, timestamp_ntz'2025-12-01'), (2, timestamp_ntz'2026-01-01') AS f(k, t)")
    versions = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2026-01-05', 10), (1, timestamp_ntz'2026-02-01', 12) AS v(k, s, price)")
    got = {(r.k, str(r.t)[:10]): r.price for r in temporal.asof_join(facts, versions, ["k"], "t", "s", ["price"]).collect()}
    assert got == {(1, "2026-01-05"): 10, (1, "2026-03-01"): 12, (1, "2025-12-01"): None, (2, "2026-01-01"): None}


def test_as_of_now_is_current(spark):
    changes = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2026-01-05', 'a'), (1, timestamp_ntz'2026-02-01', 'b'), (2, timestamp_ntz'2020-02-01', 'c') AS v(k, t, s)")
    versions = temporal.validity_intervals(changes, ["k"], "t")
    now = temporal.as_of(versions, F.lit("2026-12-01").cast("timestamp_ntz"))
    assert {(r.k, r.s) for r in now.collect()} == {(1, "b"), (2, "c")}
    kept = temporal.history_retention(versions, F.lit("2028-06-01").cast("timestamp_ntz"), 2)
    assert {(r.k, r.s) for r in kept.collect()} == {(1, "b"), (2, "c")}


def test_pages_chain_to_the_whole_table(spark):
    df = spark.range(1, 23)
    seen, cursor = [], None
    while True:
        page = entity_page_of(df, "id", cursor, 5).orderBy("id").collect()
        seen += [r.id for r in page]
        cursor = page[-1].next_cursor
        if cursor is None:
            break
    assert seen == list(range(1, 23))


def test_plans_push_filters_and_limit_groups(spark, tables):
    daily = plan_of(sales.product_sales_daily(tables.sales_orders, tables.order_lines))
    assert "CartesianProduct" not in daily and "BroadcastNestedLoopJoin" not in daily
    assert "l_tax" not in daily and "o_orderpriority" not in daily
    filtered = plan_of(tables.orders.where("o_totalprice > 100000").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,100000.0)" in filtered
    top = plan_of(sales.top_children(tables.sales_orders, "customer_id", [F.desc("order_total")], 3))
    assert "WindowGroupLimit" in top
