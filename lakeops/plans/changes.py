"""Change handling: audits, merges, change logs, order entry."""

from functools import reduce

from pyspark.sql import functions as F

from lakeops.operators import audit, changes, documents, ordering
from lakeops.plans.registry import query
from lakeops.session import materialize
from lakeops.tables import SQL_CUSTOMERS, SQL_LINES, SQL_ORDERS, SQL_PRODUCTS, SQL_STORES

# ---- price audit, stamps, soft delete, merge ---------------------------------------------------


def repriced(t):
    """The product table after a price round: promotion parts go up, small ones are written back unchanged."""
    return t.products.withColumn("list_price", F.when(
        F.col("category") == "PROMO", (F.col("list_price") + 5).cast("decimal(10,2)")).otherwise(F.col("list_price")))


@query("price_audit", f"""WITH {SQL_PRODUCTS} SELECT product_id, list_price AS old_price, CAST(list_price + 5 AS DECIMAL(10,2)) AS new_price
FROM products WHERE category = 'PROMO'""")
def price_audit(t):
    return changes.price_audit(t.products, repriced(t), "product_id", "list_price")


@query("touch_modified", f"""WITH {SQL_ORDERS} SELECT order_id, CASE WHEN status = 'Placed' THEN 'Shipped' ELSE status END AS status,
  CASE WHEN status <> 'Placed' THEN order_date WHEN channel = 'Online' THEN order_date + INTERVAL 3 DAY
  ELSE TIMESTAMP '2002-01-01' END AS modified_at FROM sales_orders""")
def touch_modified(t):
    rows = t.sales_orders.select("order_id", "status", F.col("order_date").alias("modified_at"))
    updates = t.sales_orders.where("status = 'Placed'").select(
        "order_id", "channel", F.lit("Shipped").alias("status"), (F.col("order_date") + F.expr("INTERVAL 3 DAY")).alias("modified_at"))
    now = F.lit("2002-01-01").cast("timestamp_ntz")
    stamped = changes.touch_modified(rows, updates.where("channel = 'Online'").drop("channel"), "order_id", "modified_at", now)
    return changes.touch_modified(stamped, updates.where("channel = 'Store'").drop("channel", "modified_at"), "order_id", "modified_at", now)


@query("soft_delete", f"""WITH {SQL_PRODUCTS} SELECT product_id, product_name, is_active AND product_id NOT IN
  (SELECT l_partkey FROM lineitem WHERE l_quantity = 50) AS is_active FROM products""")
def soft_delete(t):
    gone = t.lineitem.where("l_quantity = 50").select(F.col("l_partkey").alias("product_id"))
    return changes.soft_delete(t.products.select("product_id", "product_name", "is_active"), gone, "product_id")


@query("merge_reference", """WITH target AS (SELECT s_suppkey AS store_id, s_name AS store_name, s_nationkey AS nation FROM supplier),
source AS (SELECT c_custkey AS store_id, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE 'Supplier#' || right(c_name, 9) END AS store_name,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS nation FROM customer)
SELECT coalesce(t.store_id, s.store_id) AS store_id,
  CASE WHEN t.store_id IS NULL THEN 'insert' WHEN s.store_id IS NULL THEN 'keep' WHEN t.store_name <> s.store_name OR t.nation <> s.nation THEN 'update' ELSE 'keep' END AS action,
  CASE WHEN t.store_id IS NULL OR t.store_name <> s.store_name OR t.nation <> s.nation THEN s.store_name ELSE t.store_name END AS store_name,
  CASE WHEN t.store_id IS NULL OR t.store_name <> s.store_name OR t.nation <> s.nation THEN s.nation ELSE t.nation END AS nation
FROM target t FULL JOIN source s ON s.store_id = t.store_id""")
def merge_reference(t):
    target = t.supplier.select(F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), F.col("s_nationkey").alias("nation"))
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(F.concat(F.lit("Supplier#"), F.right("c_name", F.lit(9))))
    source = t.customer.select(F.col("c_custkey").alias("store_id"), name.alias("store_name"),
                               F.when(~(F.col("c_acctbal") < 0), F.col("c_nationkey")).alias("nation"))
    return changes.merge_reference(target, source, "store_id", ["store_name", "nation"])


# ---- change log --------------------------------------------------------------------------------
# The event stream is read as a change log of users: signup inserts, error deletes, others update.

def change_log(t):
    return t.events.select(
        F.col("user_id").alias("product_id"), F.col("event_id").alias("version"),
        F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U").alias("op"),
        F.when(F.col("event_type") == "view", F.array(F.lit("description")))
        .when(F.col("event_type") == "click", F.array(F.lit("list_price")))
        .when(F.col("event_type") == "purchase", F.array(F.lit("product_name"), F.lit("list_price")))
        .otherwise(F.array().cast("array<string>")).alias("changed_columns"),
    )


SQL_LOG = """log AS (SELECT user_id AS product_id, event_id AS version, event_type,
  CASE event_type WHEN 'view' THEN ['description'] WHEN 'click' THEN ['list_price'] WHEN 'purchase' THEN ['product_name', 'list_price'] ELSE [] END AS columns,
  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op FROM events)"""


@query("changes_since", f"""WITH {SQL_LOG}, e AS (SELECT product_id, arg_min(op, version) AS f, arg_max(op, version) AS l, max(version) AS version
  FROM log WHERE version > 9800 GROUP BY 1)
SELECT 'since' AS mode, product_id, CASE WHEN l = 'D' THEN 'D' WHEN f = 'I' THEN 'I' ELSE 'U' END AS op, version,
  (SELECT array_to_string(list_sort(list(DISTINCT c)), ',') FROM (SELECT unnest(columns) AS c, product_id AS p FROM log WHERE version > 9800) WHERE p = e.product_id) AS changed FROM e
UNION ALL SELECT 'too old', p_partkey, 'R', (SELECT max(version) FROM log), NULL FROM part""")
def changes_since(t):
    """Products changed since a version, and what a reader gets whose version the log no longer reaches."""
    products = t.part.select(F.col("p_partkey").alias("product_id"))
    recent = changes.changes_since(change_log(t), "product_id", 9800, 0)
    refresh = changes.changes_since(change_log(t), "product_id", 5, 100, base=products)
    both = recent.withColumn("mode", F.lit("since")).unionByName(refresh.withColumn("mode", F.lit("too old")))
    changed = F.nullif(F.array_join(F.array_sort("changed_columns"), ","), F.lit(""))
    return both.select("mode", "product_id", "op", "version", changed.alias("changed"))


SYNCS = (2000, 5000, 9800)


@query("changes_since_compacted", f"""WITH {SQL_LOG}, e AS (SELECT since, product_id, arg_min(op, version) AS f, arg_max(op, version) AS l, max(version) AS version
  FROM log, (VALUES {', '.join(f'({s})' for s in SYNCS)}) s(since) WHERE version > since GROUP BY 1, 2),
c AS (SELECT since, product_id, array_to_string(list_sort(list(DISTINCT name)), ',') AS changed FROM (SELECT product_id, version, unnest(columns) AS name FROM log),
  (VALUES {', '.join(f'({s})' for s in SYNCS)}) s(since) WHERE version > since GROUP BY 1, 2)
SELECT CAST(since AS INTEGER) AS since, e.product_id, CASE WHEN l = 'D' THEN 'D' WHEN f = 'I' THEN 'I' ELSE 'U' END AS op, version, changed FROM e LEFT JOIN c USING (since, product_id)""")
def changes_since_compacted(t):
    """Three readers at different versions read the same changes after the log was compacted for them."""
    readers = t.spark.createDataFrame([(s,) for s in SYNCS], "last_sync int")
    kept = changes.compact_log(change_log(t), "product_id", readers)
    log = materialize(kept.log, "compact_log")
    parts = [changes.changes_since(log, "product_id", s, kept.min_valid).withColumn("since", F.lit(s)) for s in SYNCS]
    changed = F.nullif(F.array_join(F.array_sort("changed_columns"), ","), F.lit(""))
    return reduce(lambda a, b: a.unionByName(b), parts).select("since", "product_id", "op", "version", changed.alias("changed"))


@query("refresh_after_lost_log", """SELECT p_partkey AS source_id, 1 AS chunk_order, TRUE AS is_stale FROM part""")
def refresh_after_lost_log(t):
    """A full refresh marks the chunks of every product."""
    products = t.part.select(F.col("p_partkey").alias("product_id"))
    refresh = changes.changes_since(change_log(t), "product_id", 5, 100, base=products)
    return changes.flag_stale_chunks(part_chunks(t), refresh, "Product", "product_id", ["description"]).select("source_id", "chunk_order", "is_stale")


@query("cdc_net_changes", f"""WITH {SQL_LOG}, e AS (SELECT product_id, arg_min(op, version) AS f, arg_max(op, version) AS l, max(version) AS version
  FROM log GROUP BY 1)
SELECT product_id, CASE WHEN l = 'D' THEN 'D' WHEN f = 'I' THEN 'I' ELSE 'U' END AS op, version FROM e WHERE NOT (f = 'I' AND l = 'D')""")
def cdc_net_changes(t):
    return changes.net_changes(change_log(t), "product_id")


@query("changed_columns_mask", f"""WITH {SQL_LOG} SELECT product_id, version, op FROM log WHERE op = 'D' OR event_type IN ('view', 'purchase')""")
def changed_columns_mask(t):
    return changes.touching(change_log(t), ["description", "product_name"]).select("product_id", "version", "op")


@query("flag_stale_chunks", f"""WITH {SQL_LOG}, hit AS (SELECT DISTINCT product_id FROM log WHERE op = 'D' OR event_type IN ('view', 'purchase'))
SELECT p_partkey AS source_id, 1 AS chunk_order, p_partkey IN (SELECT product_id FROM hit) AS is_stale FROM part""")
def flag_stale_chunks(t):
    return changes.flag_stale_chunks(part_chunks(t), change_log(t), "Product", "product_id", ["description", "product_name"]).select(
        "source_id", "chunk_order", "is_stale")


def part_chunks(t):
    texts = t.part.select(F.lit("Product").alias("source_type"), F.col("p_partkey").alias("source_id"), F.col("p_name").alias("doc_text"))
    return documents.content_chunks(texts).withColumn("is_stale", F.lit(False))


# ---- snapshots ---------------------------------------------------------------------------------

def order_snapshots(t):
    """Orders before and after a batch: urgent placed orders ship, cheap cancelled ones are removed, some are new."""
    before = t.sales_orders.select("order_id", "customer_id", "status", "order_total", "channel", "order_date")
    low = t.orders.where("o_orderpriority = '5-LOW' AND o_orderstatus = 'P'").select(F.col("o_orderkey").alias("order_id"))
    kept = before.join(low, "order_id", "left_anti").withColumn("status", F.when(
        (F.col("status") == "Placed") & (F.col("channel") == "Online"), "Shipped").otherwise(F.col("status")))
    added = before.where("status = 'Delivered' AND channel = 'Online'").withColumn("order_id", F.col("order_id") + 10**9)
    return before, kept.unionByName(added)


CAPTURED = ["customer_id", "status", "order_total"]
SQL_SNAPSHOTS = f"""{SQL_ORDERS}, before AS (SELECT order_id, customer_id, status, order_total FROM sales_orders),
after AS (SELECT order_id, customer_id, CASE WHEN status = 'Placed' AND channel = 'Online' THEN 'Shipped' ELSE status END AS status, order_total
  FROM sales_orders WHERE order_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P')
  UNION ALL SELECT order_id + 1000000000, customer_id, status, order_total FROM sales_orders WHERE status = 'Delivered' AND channel = 'Online'),
diff AS (SELECT b.order_id AS b_id, b.customer_id AS b_customer, b.status AS b_status, b.order_total AS b_total, a.order_id AS a_id,
  a.customer_id AS a_customer, a.status AS a_status, a.order_total AS a_total FROM before b FULL JOIN after a ON a.order_id = b.order_id
  WHERE b.order_id IS NULL OR a.order_id IS NULL OR b.status <> a.status)"""


@query("cdc_all_changes", f"""WITH {SQL_SNAPSHOTS}
SELECT CASE WHEN a_id IS NULL THEN 1 ELSE 3 END AS operation, b_id AS order_id, b_customer AS customer_id, b_status AS status, b_total AS order_total
FROM diff WHERE b_id IS NOT NULL
UNION ALL SELECT CASE WHEN b_id IS NULL THEN 2 ELSE 4 END, a_id, a_customer, a_status, a_total FROM diff WHERE a_id IS NOT NULL""")
def cdc_all_changes(t):
    before, after = order_snapshots(t)
    return changes.cdc_all_changes(changes.snapshot_diff(before, after, "order_id", CAPTURED))


def sql_image(p):
    return f"""CASE WHEN {p}_id IS NULL THEN '' ELSE '"{'before' if p == 'b' else 'after'}":{{"order_id":' || {p}_id || ',"customer_id":' || {p}_customer
      || ',"status":"' || {p}_status || '","order_total":' || {p}_total || '}}' END"""


@query("change_events", f"""WITH {SQL_SNAPSHOTS} SELECT coalesce(b_id, a_id) AS order_id, '{{"specversion":"1.0","id":"' || coalesce(b_id, a_id) || '-' ||
  CASE WHEN b_id IS NULL THEN 'I' WHEN a_id IS NULL THEN 'D' ELSE 'U' END || '","type":"sales.order.' ||
  CASE WHEN b_id IS NULL THEN 'insert' WHEN a_id IS NULL THEN 'delete' ELSE 'update' END || '","time":"2002-01-01T00:00:00Z","data":{{' ||
  {sql_image('b')} || CASE WHEN b_id IS NOT NULL AND a_id IS NOT NULL THEN ',' ELSE '' END || {sql_image('a')} || '}}}}' AS event FROM diff""")
def change_events(t):
    before, after = order_snapshots(t)
    diff = changes.snapshot_diff(before, after, "order_id", CAPTURED)
    return changes.change_events(diff, "order_id", "sales.order", F.lit("2002-01-01T00:00:00Z"))


@query("cascade_delete", f"""WITH {SQL_LINES} SELECT order_id, line_number, line_total FROM order_lines
WHERE order_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def cascade_delete(t):
    gone = t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("order_id"))
    return changes.cascade_delete(t.order_lines, gone, "order_id").select("order_id", "line_number", "line_total")


# ---- tamper evidence ---------------------------------------------------------------------------

AUDIT_COLUMNS = ["order_id", "customer_id", "status", "order_total"]


SQL_LEVELS = (1, 2, 3, 4, 5)


def sql_tree(prefix, source):
    """Levels go on while the one below has more than one block."""
    parts = [f"""{prefix}0 AS (SELECT order_id AS position, 1 AS rows, sha256('{{"order_id":' || order_id || ',"customer_id":' || customer_id
      || ',"status":"' || status || '","order_total":' || order_total || '}}') AS digest FROM {source})"""]
    for n in SQL_LEVELS:
        parts.append(f"""{prefix}{n} AS (SELECT position // 1000 AS position, CAST(sum(rows) AS BIGINT) AS rows,
          sha256(string_agg(digest, '' ORDER BY position)) AS digest FROM {prefix}{n - 1}
          WHERE {n} = 1 OR (SELECT count(*) FROM {prefix}{n - 1}) > 1 GROUP BY position // 1000)""")
    union = " UNION ALL ".join(f"SELECT {n} AS level, position AS block, rows, digest FROM {prefix}{n}" for n in SQL_LEVELS)
    return ", ".join(parts) + f", {prefix} AS ({union})"


@query("audit_digest", f"WITH {SQL_ORDERS}, {sql_tree('tree', 'sales_orders')} SELECT * FROM tree")
def audit_digest(t):
    return audit.digest_tree(t.sales_orders, "order_id", AUDIT_COLUMNS)


@query("audit_digest_verify", f"""WITH {SQL_ORDERS}, altered AS (SELECT order_id, customer_id, status, CASE WHEN order_total =
  (SELECT max(order_total) FROM sales_orders) THEN order_total - 1 ELSE order_total END AS order_total FROM sales_orders),
{sql_tree('a', 'sales_orders')}, {sql_tree('b', 'altered')}
SELECT level, block, a.rows, a.digest = b.digest AS intact FROM a JOIN b USING (level, block)""")
def audit_digest_verify(t):
    largest = t.sales_orders.agg(F.max("order_total").alias("_max"))
    altered = t.sales_orders.crossJoin(F.broadcast(largest)).withColumn("order_total", F.when(
        F.col("order_total") == F.col("_max"), (F.col("order_total") - 1).cast("decimal(12,2)")).otherwise(F.col("order_total")))
    return audit.verify_tree(audit.digest_tree(t.sales_orders, "order_id", AUDIT_COLUMNS),
                             audit.digest_tree(altered, "order_id", AUDIT_COLUMNS))


@query("audit_append", f"WITH {SQL_ORDERS}, {sql_tree('tree', 'sales_orders')} SELECT * FROM tree")
def audit_append(t):
    """The digest tree of all orders from that of the older half and the newer rows."""
    middle = t.sales_orders.agg(F.max("order_id")).first()[0] // 2
    older, newer = t.sales_orders.where(F.col("order_id") <= middle), t.sales_orders.where(F.col("order_id") > middle)
    tree = materialize(audit.digest_tree(older, "order_id", AUDIT_COLUMNS), "audit_tree")
    return audit.append_tree(tree, older, newer, "order_id", AUDIT_COLUMNS)


# ---- order entry -------------------------------------------------------------------------------

SQL_EDGES = ", ".join(f"('{status}', '{after}')" for status, targets in ordering.TRANSITIONS.items() for after in targets)
SQL_CODES = f"""{SQL_ORDERS}, cur AS (SELECT order_id, order_date, status, CASE WHEN order_total > 400000 THEN customer_id + 1 ELSE customer_id END AS row_ver FROM sales_orders),
req AS (SELECT o_orderkey AS request_id, CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey + 1000000000 ELSE o_orderkey END AS order_id, o_custkey AS expected_ver,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Shipped' WHEN '2-HIGH' THEN 'Cancelled' WHEN '3-MEDIUM' THEN 'Returned' ELSE 'Delivered' END AS new_status FROM orders),
edges(status, new_status) AS (VALUES {SQL_EDGES}),
found AS (SELECT request_id, status, row_ver, new_status, expected_ver FROM req JOIN cur USING (order_id)),
off AS (SELECT request_id FROM found ANTI JOIN edges USING (status, new_status)),
stale AS (SELECT request_id FROM found WHERE expected_ver <> row_ver),
codes AS (SELECT request_id, 50020 AS code FROM req ANTI JOIN found USING (request_id) UNION ALL SELECT request_id, 50021 FROM off
  UNION ALL SELECT request_id, 50022 FROM stale ANTI JOIN off USING (request_id))"""


def transition_requests(t):
    current = t.sales_orders.select("order_id", "status", F.when(
        F.col("order_total") > 400000, F.col("customer_id") + 1).otherwise(F.col("customer_id")).alias("row_ver"), F.col("order_date").alias("modified_at"))
    priority = F.col("o_orderpriority")
    requests = t.orders.select(
        F.col("o_orderkey").alias("request_id"),
        F.when(priority == "5-LOW", F.col("o_orderkey") + 10**9).otherwise(F.col("o_orderkey")).alias("order_id"),
        F.col("o_custkey").alias("expected_ver"),
        F.when(priority == "1-URGENT", "Shipped").when(priority == "2-HIGH", "Cancelled").when(priority == "3-MEDIUM", "Returned")
        .otherwise("Delivered").alias("new_status"))
    return requests, current


@query("status_transition_check", f"""WITH {SQL_CODES} SELECT request_id, order_id, new_status, code FROM req LEFT JOIN codes USING (request_id)""")
def status_transition_check(t):
    return ordering.check_transitions(*transition_requests(t))


@query("apply_transitions", f"""WITH {SQL_CODES}, done AS (SELECT order_id, new_status FROM req ANTI JOIN codes USING (request_id))
SELECT order_id, coalesce(new_status, status) AS status, CASE WHEN new_status IS NULL THEN row_ver ELSE 777 END AS row_ver,
  CASE WHEN new_status IS NULL THEN order_date ELSE TIMESTAMP '2002-01-01' END AS modified_at FROM cur LEFT JOIN done USING (order_id)""")
def apply_transitions(t):
    requests, current = transition_requests(t)
    return ordering.apply_transitions(current, ordering.check_transitions(requests, current), F.lit("2002-01-01").cast("timestamp_ntz"), 777)


def placed(t):
    """Order requests built from the event stream."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("bigint")
    lines = F.concat(
        F.lit('[{"productId":'), k.cast("string"), F.lit(',"qty":'), F.when(kind == "error", "0").otherwise("2"),
        F.lit('},{"productId":'), (k * 3).cast("string"), F.lit(',"qty":1}]'))
    requests = t.events.select(
        F.col("event_id").alias("request_id"),
        F.when(kind == "signup", F.col("user_id") + 10**9).otherwise(F.col("user_id")).alias("customer_id"),
        F.when(kind == "click", "Store").when((kind == "purchase") & (F.col("user_id") % 7 == 0), "Fax").otherwise("Online").alias("channel"),
        F.when((kind == "click") | ((kind == "purchase") & (F.col("user_id") % 7 == 1)), F.col("user_id")).alias("store_id"),
        F.when(kind == "view", "not json").otherwise(lines).alias("lines"))
    largest = t.orders.agg(F.max("o_orderkey")).first()[0]
    return ordering.place_orders(requests, t.customers, t.products, t.stores, largest)


SQL_PLACED = f"""{SQL_CUSTOMERS}, {SQL_PRODUCTS}, {SQL_STORES}, cr AS (SELECT country, min(region) AS region FROM stores GROUP BY 1),
req AS (SELECT event_id AS request_id, CASE WHEN event_type = 'signup' THEN user_id + 1000000000 ELSE user_id END AS customer_id, event_type,
  CAST(props->>'$.k' AS BIGINT) AS k, CASE WHEN event_type = 'click' OR (event_type = 'purchase' AND user_id % 7 = 1) THEN user_id END AS store_id,
  event_type = 'purchase' AND user_id % 7 IN (0, 1) AS off FROM events),
items AS (SELECT request_id, 1 AS line_number, k AS product_id, CASE WHEN event_type = 'error' THEN 0 ELSE 2 END AS quantity FROM req WHERE event_type <> 'view'
  UNION ALL SELECT request_id, 2, k * 3, 1 FROM req WHERE event_type <> 'view'),
bad AS (SELECT request_id, bool_or(coalesce(NOT is_active, TRUE)) AS bad_product, bool_or(quantity <= 0) AS bad_quantity FROM items LEFT JOIN products USING (product_id) GROUP BY 1),
judged AS (SELECT r.request_id, r.customer_id, r.store_id, event_type, loyalty_tier, CASE WHEN event_type = 'click' THEN s.region ELSE cr.region END AS sales_region,
  CASE WHEN event_type = 'view' THEN 50010 WHEN c.customer_id IS NULL THEN 50011 WHEN bad_product THEN 50012
    WHEN CASE WHEN event_type = 'click' THEN s.region ELSE cr.region END IS NULL THEN 515 WHEN bad_quantity OR off THEN 547 END AS code, bad_quantity
  FROM req r LEFT JOIN customers c USING (customer_id) LEFT JOIN stores s ON s.store_id = r.store_id LEFT JOIN cr ON cr.country = c.country LEFT JOIN bad USING (request_id)),
headers AS (SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY request_id) AS order_id, * FROM judged WHERE code IS NULL)"""


@query("place_orders_batch", f"""WITH {SQL_PLACED} SELECT order_id, request_id, customer_id, store_id,
  CASE WHEN event_type = 'click' THEN 'Store' ELSE 'Online' END AS channel, sales_region, 'Placed' AS status FROM headers""")
def place_orders_batch(t):
    return placed(t).orders


@query("place_orders_lines", f"""WITH {SQL_PLACED}, l AS (SELECT order_id, line_number, product_id, quantity, list_price AS unit_price,
  CAST(CASE loyalty_tier WHEN 'Gold' THEN 0.10 WHEN 'Silver' THEN 0.05 ELSE 0 END AS DECIMAL(4,2)) AS discount_pct
  FROM headers JOIN items USING (request_id) JOIN products USING (product_id))
SELECT *, CAST(quantity * unit_price * (1 - discount_pct) AS DECIMAL(12,2)) AS line_total FROM l""")
def place_orders_lines(t):
    return placed(t).lines


@query("place_orders_rejects", f"WITH {SQL_PLACED} SELECT request_id, code FROM judged WHERE code IS NOT NULL")
def place_orders_rejects(t):
    return placed(t).rejects


@query("error_log", f"""WITH {SQL_PLACED} SELECT request_id, 'place_orders' AS procedure_name, code AS error_number,
  CASE WHEN code = 547 AND bad_quantity THEN 'quantity must be positive' WHEN code = 547 THEN 'channel and store do not fit'
    ELSE 'a required value is missing' END AS error_message FROM judged WHERE code IN (547, 515)""")
def error_log(t):
    return placed(t).error_log
