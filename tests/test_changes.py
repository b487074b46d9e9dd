import itertools
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeops.operators import audit, changes, documents, hierarchy, ordering


def test_price_audit_ignores_equal_and_null(spark):
    before = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 5)], "id int, p int")
    after = spark.createDataFrame([(1, 10), (2, 25), (3, 7), (5, 9)], "id int, p int")
    assert [tuple(r) for r in changes.price_audit(before, after, "id", "p").select("id", "old_price", "new_price").collect()] == [(2, 20, 25)]


def test_merge_is_idempotent_and_never_deletes(spark):
    target = spark.createDataFrame([(1, "Riga", "A"), (2, "Oslo", None), (3, "Bern", "C")], "id int, city string, code string")
    source = spark.createDataFrame([(1, "Riga", "Z"), (2, "Oslo!", "B"), (4, "Rome", "D")], "id int, city string, code string")
    merged = changes.merge_reference(target, source, "id", ["city"])
    assert {(r.id, r.city, r.code, r.action) for r in merged.collect()} == {
        (1, "Riga", "A", "keep"), (2, "Oslo!", "B", "update"), (3, "Bern", "C", "keep"), (4, "Rome", "D", "insert")}
    again = changes.merge_reference(merged.drop("action"), source, "id", ["city"])
    assert {r.action for r in again.collect()} == {"keep"}


def test_touch_modified(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", 5)], "id int, s string, m int")
    updates = spark.createDataFrame([(1, "x", 5), (2, "y", 9)], "id int, s string, m int")
    got = {tuple(r) for r in changes.touch_modified(rows, updates, "id", "m", F.lit(99)).collect()}
    assert got == {(1, "x", 5), (2, "y", 9), (3, "c", 5)}
    got = {tuple(r) for r in changes.touch_modified(rows, updates.drop("m"), "id", "m", F.lit(99)).collect()}
    assert got == {(1, "x", 99), (2, "y", 99), (3, "c", 5)}


def test_soft_delete(spark):
    rows = spark.createDataFrame([(1, True), (2, True), (3, False)], "id int, is_active boolean")
    gone = spark.createDataFrame([(2,), (2,), (9,)], "id int")
    assert {tuple(r) for r in changes.soft_delete(rows, gone, "id").collect()} == {(1, True), (2, False), (3, False)}


def log(spark):
    rows = [(1, 1, "I", ["name"]), (1, 2, "U", ["price"]), (2, 3, "U", ["description"]), (3, 4, "I", []), (3, 5, "D", []), (4, 6, "D", []), (4, 7, "I", [])]
    return spark.createDataFrame(rows, "id int, version int, op string, changed_columns array<string>")


def test_changes_since_and_net(spark):
    assert {tuple(r) for r in changes.net_changes(log(spark), "id").select("id", "op", "version").collect()} == {(1, "I", 2), (2, "U", 3), (4, "U", 7)}
    assert {tuple(r) for r in changes.changes_since(log(spark), "id", 3, 0).select("id", "op", "version").collect()} == {(3, "D", 5), (4, "U", 7)}
    assert {r.id: r.changed_columns for r in changes.changes_since(log(spark), "id", 1, 0).collect()} == {1: ["price"], 2: ["description"], 3: [], 4: []}
    base = spark.createDataFrame([(1,), (2,), (77,)], "id int")
    refresh = changes.changes_since(log(spark), "id", 0, 1, base=base)
    assert {(r.id, r.op, r.version) for r in refresh.collect()} == {(1, "R", 7), (2, "R", 7), (77, "R", 7)}
    texts = spark.createDataFrame([("Product", i, "t") for i in (1, 2, 77)], "source_type string, source_id long, doc_text string")
    chunks = documents.content_chunks(texts).withColumn("is_stale", F.lit(False))
    assert all(r.is_stale for r in changes.flag_stale_chunks(chunks, refresh, "Product", "id", ["name"]).collect())
    with pytest.raises(ValueError):
        changes.changes_since(log(spark), "id", 0, 1)


def test_price_change_does_not_flag(spark):
    texts = spark.createDataFrame([("Product", i, "t") for i in (1, 2, 4)], "source_type string, source_id long, doc_text string")
    chunks = documents.content_chunks(texts).withColumn("is_stale", F.lit(False))
    flagged = changes.flag_stale_chunks(chunks, log(spark).where("version in (2, 3, 6)"), "Product", "id", ["name", "description"])
    assert {r.source_id: r.is_stale for r in flagged.collect()} == {1: False, 2: True, 4: True}


def test_cdc_images(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, s string")
    after = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "d")], "id int, s string")
    images = changes.cdc_all_changes(changes.snapshot_diff(before, after, "id", ["s"])).collect()
    assert {(r.operation, r.id, r.s) for r in images} == {(3, 2, "b"), (4, 2, "c"), (2, 4, "d")}


def test_digest_finds_changed_missing_and_added_rows(spark):
    rows = spark.range(0, 500).select("id", (F.col("id") * 3).alias("v"))
    tree = audit.digest_tree(rows, "id", ["id", "v"], block=10)
    def broken(other):
        checked = audit.verify_tree(tree, audit.digest_tree(other, "id", ["id", "v"], block=10))
        return sorted(r.block for r in checked.where("level = 1 and not intact").collect()), checked.where("level = 3 and not intact").count()

    assert broken(rows) == ([], 0)
    assert broken(rows.withColumn("v", F.when(F.col("id") == 123, 0).otherwise(F.col("v")))) == ([12], 1)
    assert broken(rows.where("id <> 40")) == ([4], 1)
    assert broken(rows.unionByName(spark.range(500, 501).select("id", F.lit(1).alias("v")))) == ([50], 1)
    assert tree.where("level = 3").count() == 1 and tree.agg(F.max("level")).first()[0] == 3


def test_digests_tell_similar_rows_apart(spark):
    rows = [(1, "a|b", "c"), (1, "a", "b|c"), (1, None, "~"), (1, "~", None), (1, "", None)]
    roots = {audit.digest_tree(spark.createDataFrame([r], "id long, x string, y string"), "id", ["id", "x", "y"]).first().digest for r in rows}
    assert len(roots) == 5
    deep = audit.digest_tree(spark.createDataFrame([(0, "x"), (10**7, "y")], "id long, x string"), "id", ["id", "x"], block=10)
    assert deep.orderBy(F.desc("level")).first().rows == 2 and deep.where(f"level = {deep.agg(F.max('level')).first()[0]}").count() == 1


def orders(spark):
    return spark.createDataFrame([(1, "Placed", 5, 0), (2, "Shipped", 5, 0), (3, "Delivered", 5, 0)], "order_id long, status string, row_ver long, modified_at int")


def test_status_codes_in_order(spark):
    requests = spark.createDataFrame([
        (1, 9, "Delivered", 0), (2, 1, "Delivered", 5), (3, 2, "Delivered", 4), (4, 3, "Returned", 5),
        (5, 1, "Shipped", 5), (6, 1, "Shipped", 5), (7, 1, "Delivered", 5)], "request_id long, order_id long, new_status string, expected_ver long")
    checked = ordering.check_transitions(requests, orders(spark))
    codes = {r.request_id: r.code for r in checked.collect()}
    assert codes == {1: 50020, 2: 50021, 3: 50022, 4: None, 5: None, 6: 50021, 7: 50022}
    state = {r.order_id: (r.status, r.row_ver) for r in ordering.apply_transitions(orders(spark), checked, F.lit(1), 6).collect()}
    assert state == {1: ("Shipped", 6), 2: ("Shipped", 5), 3: ("Returned", 6)}


def placed(spark, *requests):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(requests, 1)], "request_id long, customer_id long, channel string, store_id long, lines string")
    customers = spark.createDataFrame([(1, "Latvia", "Gold"), (2, "Atlantis", "Bronze")], "customer_id long, country string, loyalty_tier string")
    products = spark.sql("SELECT * FROM VALUES (1L, CAST(100 AS DECIMAL(10,2)), true), (2L, CAST(5 AS DECIMAL(10,2)), false) AS p(product_id, list_price, is_active)")
    stores = spark.createDataFrame([(10, "Latvia", "Baltics"), (11, "Latvia", "Baltics")], "store_id long, country string, region string")
    return ordering.place_orders(frame, customers, products, stores, 100000)


def test_order_lifecycle(spark):
    result = placed(spark, (1, "Online", None, '[{"productId":1,"qty":2}]'))
    header, line = result.orders.first(), result.lines.first()
    assert (header.order_id, header.sales_region, header.status) == (100001, "Baltics", "Placed")
    assert line.line_total == Decimal("180.00") and result.rejects.count() == 0


def test_rejects_and_error_log(spark):
    good = '[{"productId":1,"qty":1}]'
    result = placed(spark, (1, "Online", None, "not json"), (9, "Online", None, good), (1, "Online", None, '[{"productId":7,"qty":1}]'),
                    (1, "Online", None, '[{"productId":2,"qty":1}]'), (1, "Online", None, '[{"productId":1,"qty":1},{"productId":1,"qty":0}]'),
                    (2, "Online", None, good), (1, "Store", 10, good), (1, "Online", None, '{"productId":1}'), (1, "Online", None, None),
                    (1, "Online", 10, good), (1, "Fax", None, good), (1, None, None, good))
    assert {r.request_id: r.code for r in result.rejects.collect()} == {
        1: 50010, 2: 50011, 3: 50012, 4: 50012, 5: 547, 6: 515, 8: 50010, 9: 50010, 10: 547, 11: 547, 12: 547}
    logged = {r.request_id: (r.error_number, r.error_message) for r in result.error_log.collect()}
    assert {i: n for i, (n, _) in logged.items()} == {5: 547, 6: 515, 10: 547, 11: 547, 12: 547}
    assert "quantity" in logged[5][1] and "channel" in logged[10][1]
    assert [(r.request_id, r.order_id) for r in result.orders.collect()] == [(7, 100001)]
    assert {r.order_id for r in result.lines.collect()} == {100001}


def test_referral_depths_and_limits(spark):
    chain = spark.createDataFrame([(i, i - 1 if i > 1 else None) for i in range(1, 40)] + [(100, None)] + [(200 + i, 1) for i in range(60)], "id long, parent long")
    roots = {r.id: (r.root_id, r.depth) for r in hierarchy.roots_and_depths(chain, "id", "parent").collect()}
    assert roots[39] == (1, 38) and roots[100] == (100, 0) and roots[230] == (1, 1)
    tree = hierarchy.referral_tree(chain, "id", "parent").collect()
    assert [(r.root_id, r.brought_in, r.deepest_level) for r in tree] == [(1, 98, 38)]
    with pytest.raises(ValueError):
        hierarchy.roots_and_depths(chain, "id", "parent", max_depth=30)
    with pytest.raises(ValueError):
        hierarchy.roots_and_depths(spark.createDataFrame([(1, 2), (2, 1)], "id long, parent long"), "id", "parent")


@pytest.mark.parametrize("chunk, least", [(2, 1), (4, 2), (64, 1)])
def test_bought_with_equals_brute_force(spark, chunk, least):
    rng = random.Random(4)
    rows = [(b, rng.randint(1, 12)) for b in range(60) for _ in range(rng.randint(1, 5))]
    rows += [(1000, i) for i in range(1, 40)] + [(1001, i) for i in range(5, 30, 2)]
    baskets = {}
    for b, i in rows:
        baskets.setdefault(b, set()).add(i)
    counts = Counter(p for items in baskets.values() for p in itertools.combinations(sorted(items), 2))
    want = {(a, b, n) for (a, b), n in counts.items() if n >= least}
    got = hierarchy.bought_with(spark.createDataFrame(rows, "o int, p int"), "o", "p", least, chunk)
    assert {(r.a, r.b, r.times) for r in got.collect()} == want


def test_recommendations_leave_out_owned(spark):
    owned = spark.createDataFrame([(1, 10), (1, 20), (2, 30)], "customer_id long, product_id long")
    edges = spark.createDataFrame([(10, 20, 5), (10, 30, 2), (20, 30, 4), (20, 40, 6)], "a long, b long, times long")
    got = hierarchy.two_hop_recommendations(owned, edges, 2).collect()
    assert {(r.customer_id, r.product_id, r.score, r.position) for r in got} == {(1, 30, 6, 1), (1, 40, 6, 2), (2, 20, 4, 1), (2, 10, 2, 2)}


def test_two_hops_of_large_customers_and_popular_products(spark, monkeypatch):
    import random
    from collections import Counter, defaultdict

    from lakeops.operators import hierarchy

    monkeypatch.setattr(hierarchy, "OWNED_PER_GROUP", 7)
    monkeypatch.setattr(hierarchy, "NEIGHBOURS_PER_ROW", 5)
    rng = random.Random(6)
    owned = {(0 if rng.random() < 0.4 else rng.randint(1, 12), rng.randint(1, 60)) for _ in range(200)}
    edges = {(a, b): rng.randint(1, 4) for a, b in ((1 if rng.random() < 0.3 else rng.randint(1, 60), rng.randint(1, 60)) for _ in range(300)) if a < b}
    scores = defaultdict(Counter)
    for c, p in owned:
        for (a, b), n in edges.items():
            if p in (a, b):
                scores[c][b if p == a else a] += n
    want = []
    for c, found in scores.items():
        left = sorted(((-n, p) for p, n in found.items() if (c, p) not in owned))[:4]
        want += [(c, p, -n, i + 1) for i, (n, p) in enumerate(left)]
    got = hierarchy.two_hop_recommendations(
        spark.createDataFrame(sorted(owned), "customer_id bigint, product_id bigint"),
        spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "a bigint, b bigint, times bigint"), 4)
    assert sorted((r.customer_id, r.product_id, r.score, r.position) for r in got.collect()) == sorted(want)


def test_two_hops_send_a_list_once_per_block_of_customers(spark, monkeypatch, tmp_path):
    """Many owners of the same products: what meets the customers is bounded by blocks, not by owners."""
    from lakeops.operators import sales

    products = list(range(-40, 40)) + [2**40, 2**62]
    owned = [(c, p) for c in range(500) for i, p in enumerate(products) if (c + i) % 2]
    edges = [(a, b, 1 + (a * b) % 3) for i, a in enumerate(products) for b in products[i + 1:] if (a + b) % 3]
    scores = {}
    for c in (7, 8):
        have = {p for x, p in owned if x == c}
        found = Counter()
        for a, b, n in edges:
            for p, q in ((a, b), (b, a)):
                if p in have and q not in have:
                    found[q] += n
        scores[c] = sorted((-n, q) for q, n in found.items())[:3]
    seen = []
    top = sales.top_children
    monkeypatch.setattr(sales, "top_children", lambda df, *rest: seen.append(df) or top(df, *rest))
    monkeypatch.setattr(hierarchy, "SUMS_AT_ONCE", 100)
    monkeypatch.setattr(hierarchy, "ENTRIES_PER_TASK", 2000)
    monkeypatch.setattr(hierarchy, "OWNED_PER_GROUP", 64)
    monkeypatch.setattr(hierarchy, "NEIGHBOURS_PER_ROW", 16)
    got = hierarchy.two_hop_recommendations(
        spark.createDataFrame(owned, "customer_id long, product_id long"), spark.createDataFrame(edges, "a long, b long, times long"), 3).collect()
    assert len(got) == 1500
    for c, want in scores.items():
        assert sorted((r.position, -r.score, r.product_id) for r in got if r.customer_id == c) == [(i + 1, *w) for i, w in enumerate(want)]
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "Join Inner, (product_id" not in plan  # no row per customer and owned product carries a list


def test_bought_with_deals_pairs_to_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "BASKET_ROWS_PER_TASK", 100)
    monkeypatch.setattr(hierarchy, "PAIRS_PER_TASK", 50)
    rows = [(b, (b * 7 + i * i) % 97) for b in range(200) for i in range(4)] + [(1, 1), (1, 1), (None, 3), (None, 4)]
    baskets = {}
    for b, i in rows:
        if b is not None:
            baskets.setdefault(b, set()).add(i)
    counts = Counter(p for items in baskets.values() for p in itertools.combinations(sorted(items), 2))
    got = hierarchy.bought_with(spark.createDataFrame(rows, "o int, p int"), "o", "p")
    assert {(r.a, r.b): r.times for r in got.collect()} == counts
    assert got.rdd.getNumPartitions() == -(-sum(counts.values()) // 50)


def test_two_hops_take_product_blocks_in_passes(spark, monkeypatch):
    """Only the best products go from one pass to the next; rows are those of a single pass."""
    from lakeops.operators import sales

    rng = random.Random(8)
    owned = spark.createDataFrame(sorted({(rng.randint(1, 40), rng.randint(1, 80)) for _ in range(300)}), "customer_id long, product_id long")
    pairs = {tuple(sorted(rng.sample(range(1, 81), 2))): rng.randint(1, 300) for _ in range(600)}
    edges = spark.createDataFrame([(a, b, n) for (a, b), n in pairs.items()], "a long, b long, times long")
    want = sorted(map(tuple, hierarchy.two_hop_recommendations(owned, edges, 4).collect()))
    passes = []
    top = sales.top_children
    monkeypatch.setattr(sales, "top_children", lambda df, *rest: passes.append(df) or top(df, *rest))
    monkeypatch.setattr(hierarchy, "ENTRIES_PER_TASK", 100)
    monkeypatch.setattr(hierarchy, "ENTRIES_PER_PASS", 300)
    assert sorted(map(tuple, hierarchy.two_hop_recommendations(owned, edges, 4).collect())) == want and len(want) > 100
    assert len(passes) >= 4 and all("Union" in p._jdf.queryExecution().optimizedPlan().toString() for p in passes[1:])


def test_pairs_and_baskets_travel_packed(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "PAIRS_PER_JOB", 40)
    monkeypatch.setattr(hierarchy, "ROWS_AT_ONCE", 64)
    rng = random.Random(9)
    rows = [(b, rng.choice([-3, 0, 5, 2**40, 2**62, *range(100, 140)])) for b in range(50) for _ in range(8)]
    rows += [(-7, 10 * i) for i in range(90) for _ in range(3)] + [(2**50, 1), (3, None), (None, 3)]
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    counts = Counter(p for items in baskets.values() for p in itertools.combinations(sorted(items), 2))
    got = hierarchy.bought_with(spark.createDataFrame(rows, "o long, p long"), "o", "p", chunk=16)
    assert {(r.a, r.b): r.times for r in got.collect()} == counts
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Repartition" in line]
    assert dealt and all("block" in line or "job" in line for line in dealt)  # no row per pair or basket item is shuffled


def test_shuffles_leave_the_disk_with_the_table_they_made(spark):
    import os
    import time

    from lakeops.session import CLEANUP_CONF, discard, materialize

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return {f for f in files.split() if "/shuffle_" in f}

    before, set_before = shuffled(), spark.conf.get(CLEANUP_CONF, None)
    table = materialize(spark.range(20_000).selectExpr("id % 5000 AS k", "id").groupBy("k").count(), "counted")
    deadline = time.time() + 20
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before
    assert table.count() == 5000 and spark.conf.get(CLEANUP_CONF, None) == set_before
    discard(table)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in table.inputFiles())
