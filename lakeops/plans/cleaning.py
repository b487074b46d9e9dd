"""Cleaning queries over extracts derived from the supplied tables, with known faults added."""

from functools import reduce

from pyspark.sql import functions as F

from lakeops.functions.similarity import similar_members
from lakeops.operators import cleaning, entities, history
from lakeops.plans.registry import query
from lakeops.session import materialize
from lakeops.streaming.streams import late_by_folder
from lakeops.tables import SQL_CUSTOMERS, SQL_LINES, SQL_ORDERS, money


@query("dedupe_exact", f"""WITH {SQL_LINES}, raw AS (SELECT * FROM order_lines UNION ALL SELECT * FROM order_lines WHERE quantity > 25)
SELECT DISTINCT order_id, line_number, product_id, store_id, quantity, unit_price, discount_pct FROM raw""")
def dedupe_exact(t):
    columns = ["order_id", "line_number", "product_id", "store_id", "quantity", "unit_price", "discount_pct"]
    raw = t.order_lines.unionByName(t.order_lines.where("quantity > 25")).select(*columns)
    return cleaning.dedupe_exact(raw)


def order_extract(t):
    """Each order lands as Placed the next day (low priority two days late); finished ones land again
    later, urgent ones with the same modification time."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    day = F.col("o_orderdate")
    late = F.when(F.col("o_orderpriority") == "5-LOW", 3).otherwise(1)
    first = t.orders.select(
        F.col("o_orderkey").alias("order_id"), day.alias("order_date"), F.lit("Placed").alias("status"), day.alias("modified_at"),
        F.date_add(F.to_date(day), late).alias("load_date"))
    final = t.orders.where("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("order_id"), day.alias("order_date"),
        F.when(F.col("o_orderstatus") == "F", "Delivered").otherwise("Cancelled").alias("status"),
        F.when(urgent, day).otherwise(day + F.expr("INTERVAL 2 DAY")).alias("modified_at"),
        F.date_add(F.to_date(day), late + 3).alias("load_date"))
    return first.unionByName(final)


SQL_EXTRACT = """extract_rows AS (SELECT o_orderkey AS order_id, o_orderdate AS order_date, 'Placed' AS status, o_orderdate AS modified_at,
  CAST(o_orderdate AS DATE) + CASE WHEN o_orderpriority = '5-LOW' THEN 3 ELSE 1 END AS load_date FROM orders
UNION ALL SELECT o_orderkey, o_orderdate, CASE o_orderstatus WHEN 'F' THEN 'Delivered' ELSE 'Cancelled' END,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate ELSE o_orderdate + INTERVAL 2 DAY END,
  CAST(o_orderdate AS DATE) + CASE WHEN o_orderpriority = '5-LOW' THEN 6 ELSE 4 END FROM orders WHERE o_orderstatus <> 'O')"""


@query("upsert_latest_status", f"""WITH {SQL_EXTRACT} SELECT order_id, order_date, status, modified_at, load_date FROM (SELECT *,
  row_number() OVER (PARTITION BY order_id ORDER BY modified_at DESC, load_date DESC) AS n FROM extract_rows) WHERE n = 1""")
def upsert_latest_status(t):
    return cleaning.upsert_latest_status(order_extract(t))


@query("late_arrival_tag", f"""WITH {SQL_EXTRACT} SELECT order_id, min(load_date) AS first_load, CAST(min(order_date) AS DATE) AS order_date,
  CAST(min(load_date) - CAST(min(order_date) AS DATE) - 1 AS INTEGER) AS days_late FROM extract_rows GROUP BY 1""")
def late_arrival_tag(t):
    return cleaning.late_arrival_tag(order_extract(t))


@query("parse_mixed_dates", """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN date_trunc('minute', ts)
  WHEN 'signup' THEN NULL ELSE date_trunc('second', ts) END AS parsed,
  CASE event_type WHEN 'error' THEN 'unknown date format' WHEN 'signup' THEN 'missing date' END AS reason FROM events""")
def parse_mixed_dates(t):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "signup", F.lit(None).cast("string")).when(kind == "error", F.date_format("ts", "yyyy.MM.dd"))
        .when(kind == "view", F.date_format("ts", cleaning.SHORT_FORMAT)).otherwise(F.date_format("ts", cleaning.ISO_FORMAT))
    )
    parsed, reason = cleaning.parse_mixed_dates(F.col("raw"))
    return t.events.select("event_id", raw.alias("raw")).select("event_id", parsed.alias("parsed"), reason.alias("reason"))


@query("impute_unit_price", """WITH p AS (SELECT l_partkey AS product_id, l_shipdate AS since, max(CAST(l_extendedprice AS DECIMAL(10,2))) AS price
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
l AS (SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id, l_shipdate AS ordered_at,
  CASE WHEN l_quantity <= 45 THEN CAST(l_extendedprice AS DECIMAL(10,2)) END AS unit_price FROM lineitem)
SELECT order_id, line_number, l.product_id, ordered_at, coalesce(unit_price, price) AS unit_price, unit_price IS NULL AND price IS NOT NULL AS price_imputed
FROM l ASOF LEFT JOIN p ON p.product_id = l.product_id AND ordered_at >= since""")
def impute_unit_price(t):
    prices = t.lineitem.where("l_returnflag = 'R'").groupBy(
        F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("_day")
    ).agg(F.max(money("l_extendedprice", 10)).alias("list_price")).withColumn(
        "load_date", F.col("_day") + F.expr("INTERVAL 1 DAY")).drop("_day")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"), F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("ordered_at"), F.when(F.col("l_quantity") <= 45, money("l_extendedprice", 10)).alias("unit_price"))
    return cleaning.impute_unit_price(lines, prices, "ordered_at")


def faulty_lines(t):
    """Returned lines without discount get a negative quantity, lines of 50 pieces an unknown product."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
        F.when(F.col("l_quantity") == 50, F.col("l_partkey") + 10**9).otherwise(F.col("l_partkey")).alias("product_id"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") == 0), -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int").alias("quantity"))


SQL_FAULTY = """faulty AS (SELECT l_orderkey AS order_id, l_linenumber AS line_number,
  CASE WHEN l_quantity = 50 THEN l_partkey + 1000000000 ELSE l_partkey END AS product_id,
  CAST(CASE WHEN l_returnflag = 'R' AND l_discount = 0 THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity FROM lineitem)"""


@query("quarantine_lines", f"""WITH {SQL_FAULTY} SELECT order_id, line_number, product_id, quantity,
  concat_ws('; ', CASE WHEN quantity <= 0 THEN 'quantity not positive' END, CASE WHEN product_id NOT IN (SELECT p_partkey FROM part) THEN 'unknown product' END) AS reasons
FROM faulty""")
def quarantine_lines(t):
    products = t.part.select(F.col("p_partkey").alias("product_id"))
    split = cleaning.quarantine_lines(faulty_lines(t), products)
    return split.good.withColumn("reasons", F.lit("")).unionByName(
        split.rejected.withColumn("reasons", F.concat_ws("; ", "reasons")))


def dirty_customers(t):
    """Customers with dirty contacts: the segment decides the fault."""
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    mail = F.concat(F.lower(segment), F.lit("."), key, F.lit("@Example.com"))
    local = F.right(F.concat(F.lit("00000000"), key), F.lit(8))
    prefix = (300 + F.col("n_nationkey")).cast("string")
    digits = F.concat(prefix, local)
    joined = t.customer.join(t.geography, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(segment == "BUILDING", F.lit(None)).when(segment == "MACHINERY", F.regexp_replace(mail, "@", ".at.")).otherwise(
            F.concat(F.lit(" "), mail)).alias("email"),
        F.when(segment == "FURNITURE", F.concat(F.lower("country"), F.lit(" "))).when(segment == "HOUSEHOLD", "Atlantis").otherwise(
            F.col("country")).alias("country"),
        F.concat(F.lit("+"), prefix).alias("prefix"),
        F.when(segment == "BUILDING", F.concat(F.lit("+"), prefix, F.lit(" "), F.left(local, F.lit(4)), F.lit(" "), F.right(local, F.lit(4))))
        .when(segment == "MACHINERY", F.concat(F.lit("("), F.left(digits, F.lit(3)), F.lit(") "), F.substring(digits, 4, 20)))
        .when(segment == "FURNITURE", F.concat(F.left(local, F.lit(2)), F.lit("-"), F.substring(local, 3, 3), F.lit("-"), F.right(local, F.lit(3))))
        .when(segment == "HOUSEHOLD", F.lit("12-34"))
        .otherwise(F.concat(F.lit("+"), digits)).alias("phone"),
    )


@query("standardize_email", """SELECT c_custkey AS customer_id, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN
  'machinery.' || c_custkey || '.at.example.com' ELSE lower(c_mktsegment) || '.' || c_custkey || '@example.com' END AS email,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'missing' WHEN 'MACHINERY' THEN 'invalid' ELSE 'ok' END AS email_flag FROM customer""")
def standardize_email(t):
    email, flag = cleaning.standardize_email(F.col("email"))
    return dirty_customers(t).select("customer_id", email.alias("email"), flag.alias("email_flag"))


@query("standardize_country", """SELECT c_custkey AS customer_id, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Atlantis' ELSE n_name END AS country,
  c_mktsegment <> 'HOUSEHOLD' AS country_known FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def standardize_country(t):
    return cleaning.standardize_country(dirty_customers(t).select("customer_id", "country"), t.geography)


@query("standardize_phone", """SELECT c_custkey AS customer_id, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN
  '+' || (300 + c_nationkey) || right('00000000' || c_custkey, 8) END AS phone FROM customer""")
def standardize_phone(t):
    return dirty_customers(t).select("customer_id", cleaning.standardize_phone(F.col("phone"), F.col("prefix")).alias("phone"))


@query("inferred_members", f"""WITH {SQL_CUSTOMERS}, known AS (SELECT customer_id, customer_name FROM customers WHERE segment <> 'BUILDING')
SELECT customer_id, customer_name, FALSE AS is_inferred FROM known
UNION ALL SELECT DISTINCT o_custkey, NULL, TRUE FROM orders WHERE o_custkey NOT IN (SELECT customer_id FROM known)""")
def inferred_members(t):
    known = t.customers.where("segment <> 'BUILDING'").select("customer_id", "customer_name")
    return cleaning.inferred_members(t.sales_orders, known, "customer_id")


SQL_CHANGES = f"""{SQL_ORDERS}, chg AS (SELECT customer_id, order_date AS changed_at, max(channel) AS city, max(status) AS tier,
  max('c' || customer_id || '.' || year(order_date) || '@example.com') AS email FROM sales_orders GROUP BY 1, 2)"""


SQL_SCD2 = f"""WITH {SQL_CHANGES}, b AS (SELECT *, lag(city) OVER w AS old_city, lag(tier) OVER w AS old_tier, row_number() OVER w AS n
  FROM chg WINDOW w AS (PARTITION BY customer_id ORDER BY changed_at)),
o AS (SELECT * FROM b WHERE n = 1 OR city <> old_city OR tier <> old_tier),
e AS (SELECT customer_id, arg_max(email, changed_at) AS email FROM chg GROUP BY 1),
v AS (SELECT customer_id, city, tier, changed_at AS valid_from, coalesce(lead(changed_at) OVER (PARTITION BY customer_id ORDER BY changed_at),
  TIMESTAMP '9999-12-31') AS valid_to FROM o)
SELECT {{}} FROM v JOIN e USING (customer_id)"""


def customer_changes(t):
    return t.sales_orders.groupBy("customer_id", F.col("order_date").alias("changed_at")).agg(
        F.max("channel").alias("city"), F.max("status").alias("tier"),
        F.max(F.concat(F.lit("c"), F.col("customer_id").cast("string"), F.lit("."), F.year("order_date").cast("string"),
                       F.lit("@example.com"))).alias("email"))


@query("scd2_customers", SQL_SCD2.format("v.*, year(valid_to) = 9999 AS is_current, email"))
def scd2_customers(t):
    return cleaning.scd2(customer_changes(t), "customer_id", "changed_at", ["city", "tier"], ["email"])


@query("scd2_from_batches", SQL_SCD2.format("v.*, year(valid_to) = 9999 AS is_current"))
def scd2_from_batches(t):
    """Newest changes come first; the older half splits and merges the intervals that are there."""
    changes = customer_changes(t)
    late = F.year("changed_at") < 1995
    table = history.empty_history(changes, ["customer_id"], ["city", "tier"], buckets=16)
    for batch in (changes.where(~late), changes.where(late)):
        table = history.apply_changes(table, batch, "changed_at")
    return history.collapsed(table.read(t.spark), ["customer_id"], ["city", "tier"])


@query("scd1_products", """SELECT l_partkey AS product_id, max(struct_pack(d := l_shipdate, p := CAST(l_extendedprice AS DECIMAL(12,2)))).p AS list_price,
  max(l_shipdate) AS changed_at FROM lineitem GROUP BY 1""")
def scd1_products(t):
    changes = t.lineitem.select(F.col("l_partkey").alias("product_id"), money("l_extendedprice").alias("list_price"), F.col("l_shipdate").alias("changed_at"))
    return cleaning.scd1(changes, "product_id", ["changed_at", "list_price"])


def union_all(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


@query("constraint_report", f"""WITH {SQL_ORDERS}
SELECT 'order key unique' AS rule, count(*) AS violations FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'line key unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'part name unique', count(*) FROM (SELECT 1 FROM part GROUP BY p_name HAVING count(*) > 1)
UNION ALL SELECT 'line has order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'line has part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'order store exists', count(*) FROM sales_orders WHERE store_id IS NOT NULL AND store_id NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'quantity positive', count(*) FILTER (WHERE NOT l_quantity > 0) FROM lineitem
UNION ALL SELECT 'discount in range', count(*) FILTER (WHERE NOT l_discount BETWEEN 0 AND 0.5) FROM lineitem
UNION ALL SELECT 'price present', count(*) FILTER (WHERE l_extendedprice IS NULL) FROM lineitem
UNION ALL SELECT 'balance not negative', count(*) FILTER (WHERE NOT c_acctbal >= 0) FROM customer
UNION ALL SELECT 'store order has store', count(*) FILTER (WHERE NOT ((channel = 'Store') = (store_id IS NOT NULL))) FROM sales_orders""")
def constraint_report(t):
    c = F.col
    store_rule = (c("channel") == "Store") == c("store_id").isNotNull()
    return union_all([
        cleaning.unique_violations(t.orders, "order key unique", ["o_orderkey"]),
        cleaning.unique_violations(t.lineitem, "line key unique", ["l_orderkey", "l_linenumber"]),
        cleaning.unique_violations(t.part, "part name unique", ["p_name"]),
        cleaning.reference_violations(t.lineitem, "line has order", "l_orderkey", t.orders, "o_orderkey"),
        cleaning.reference_violations(t.lineitem, "line has part", "l_partkey", t.part, "p_partkey"),
        cleaning.reference_violations(t.sales_orders, "order store exists", "store_id", t.supplier, "s_suppkey"),
        cleaning.check_violations(t.lineitem, [
            cleaning.Rule("quantity positive", c("l_quantity") > 0),
            cleaning.Rule("discount in range", c("l_discount").between(0, 0.5)),
            cleaning.Rule("price present", c("l_extendedprice").isNotNull())]),
        cleaning.check_violations(t.customer, [cleaning.Rule("balance not negative", c("c_acctbal") >= 0)]),
        cleaning.check_violations(t.sales_orders, [cleaning.Rule("store order has store", store_rule)]),
    ])


@query("issue_counts", f"""WITH {SQL_EXTRACT}, {SQL_FAULTY}, counts AS (SELECT 'orders_status_updates' AS issue, count(*) AS found FROM extract_rows WHERE status <> 'Placed'
UNION ALL SELECT 'orders_late_arriving', count(*) FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT 'lines_negative_quantity', count(*) FROM faulty WHERE quantity <= 0
UNION ALL SELECT 'lines_unknown_product', count(*) FROM faulty WHERE product_id NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'customers_missing_email', count(*) FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'customers_invalid_email', count(*) FROM customer WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT 'customers_dirty_country', count(*) FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'FURNITURE')
UNION ALL SELECT 'lines_missing_unit_price', count(*) FROM lineitem WHERE l_quantity > 45
UNION ALL SELECT 'lines_exact_duplicates', count(*) FROM (SELECT DISTINCT * FROM lineitem) WHERE l_quantity > 25
UNION ALL SELECT 'orders_exact_duplicates', count(*) FROM orders WHERE o_orderpriority = '2-HIGH'
UNION ALL SELECT 'orders_bad_date_format', count(*) FROM orders WHERE o_orderpriority = '3-MEDIUM'
UNION ALL SELECT 'events_late', count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'events_duplicates', count(*) FROM events WHERE event_type = 'click')
SELECT issue, found, found + CASE issue WHEN 'events_late' THEN 1 ELSE 0 END AS expected, issue <> 'events_late' AS as_expected FROM counts""")
def issue_counts(t):
    """Every kind of issue counted by the operator that cleans it, next to the key of what was put in; one key is wrong on purpose."""
    def counted(name, df, condition):
        return df.agg(F.count_if(condition).alias("found")).select(F.lit(name).alias("issue"), "found")

    rejected = cleaning.quarantine_lines(faulty_lines(t), t.part.select(F.col("p_partkey").alias("product_id"))).rejected
    _, flag = cleaning.standardize_email(F.col("email"))
    dirty = dirty_customers(t)
    cleaned = cleaning.standardize_country(dirty.withColumn("raw", F.col("country")), t.geography)
    lines = t.lineitem.distinct()
    day = F.col("o_orderdate")
    raw = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(day, "yyyy.MM.dd")).otherwise(F.date_format(day, cleaning.ISO_FORMAT))
    dated = t.orders.select(cleaning.parse_mixed_dates(raw)[1].alias("reason"))
    landed = t.events.select("ts", F.date_add(F.to_date("ts"), F.when(F.col("event_type") == "error", 2).otherwise(0)).alias("event_date"))
    found = union_all([
        counted("orders_status_updates", order_extract(t), F.col("status") != "Placed"),
        counted("orders_late_arriving", cleaning.late_arrival_tag(order_extract(t)), F.col("days_late") > 0),
        counted("lines_negative_quantity", rejected, F.array_contains("reasons", "quantity not positive")),
        counted("lines_unknown_product", rejected, F.array_contains("reasons", "unknown product")),
        counted("customers_missing_email", dirty, flag == "missing"),
        counted("customers_invalid_email", dirty, flag == "invalid"),
        counted("customers_dirty_country", cleaned, (F.col("raw") != F.col("country")) | ~F.col("country_known")),
        counted("lines_missing_unit_price", t.lineitem.select(F.when(F.col("l_quantity") <= 45, F.col("l_extendedprice")).alias("price")), F.col("price").isNull()),
        cleaning.duplicate_count(lines.unionByName(lines.where("l_quantity > 25")), "lines_exact_duplicates"),
        cleaning.duplicate_count(t.orders.unionByName(t.orders.where("o_orderpriority = '2-HIGH'")), "orders_exact_duplicates"),
        counted("orders_bad_date_format", dated, F.col("reason") == "unknown date format"),
        counted("events_late", landed, late_by_folder("event_date", "ts")),
        cleaning.duplicate_count(t.events.unionByName(t.events.where("event_type = 'click'")), "events_duplicates"),
    ])
    return cleaning.compare_with_keys(found, injected(t))


def injected(t):
    """How many issues of each kind were put in, from the rules that put them in."""
    def key(name, rows):
        return rows.agg(F.count(F.lit(1)).alias("expected")).select(F.lit(name).alias("issue"), "expected")

    segment, priority, kind = F.col("c_mktsegment"), F.col("o_orderpriority"), F.col("event_type")
    keys = union_all([
        key("orders_status_updates", t.orders.where("o_orderstatus <> 'O'")), key("orders_late_arriving", t.orders.where(priority == "5-LOW")),
        key("lines_negative_quantity", t.lineitem.where("l_returnflag = 'R' AND l_discount = 0")), key("lines_unknown_product", t.lineitem.where("l_quantity = 50")),
        key("customers_missing_email", t.customer.where(segment == "BUILDING")), key("customers_invalid_email", t.customer.where(segment == "MACHINERY")),
        key("customers_dirty_country", t.customer.where(segment.isin("HOUSEHOLD", "FURNITURE"))), key("lines_missing_unit_price", t.lineitem.where("l_quantity > 45")),
        key("lines_exact_duplicates", t.lineitem.distinct().where("l_quantity > 25")), key("orders_exact_duplicates", t.orders.where(priority == "2-HIGH")),
        key("orders_bad_date_format", t.orders.where(priority == "3-MEDIUM")), key("events_late", t.events.where(kind == "error")),
        key("events_duplicates", t.events.where(kind == "click"))])
    return keys.withColumn("expected", F.col("expected") + F.when(F.col("issue") == "events_late", 1).otherwise(0))


@query("near_duplicate_eval", f"""WITH {SQL_CUSTOMERS}, people AS (SELECT customer_id, country, segment, customer_name FROM customers
  UNION ALL SELECT customer_id + 1000000000, country, segment, 'Custmoer' || substr(customer_name, 9) FROM customers WHERE segment = 'BUILDING'),
found AS (SELECT least(x.customer_id, y.customer_id) AS a, greatest(x.customer_id, y.customer_id) AS b FROM people x JOIN people y
  ON x.country = y.country AND x.segment = y.segment AND x.customer_name < y.customer_name WHERE damerau_levenshtein(x.customer_name, y.customer_name) = 1),
truth AS (SELECT customer_id AS a, customer_id + 1000000000 AS b FROM customers WHERE segment = 'BUILDING'),
c AS (SELECT (SELECT count(*) FROM found) AS found, (SELECT count(*) FROM truth) AS labelled, (SELECT count(*) FROM found JOIN truth USING (a, b)) AS hits)
SELECT *, round(hits / nullif(found, 0), 6) AS precision, round(hits / nullif(labelled, 0), 6) AS recall FROM c""")
def near_duplicate_eval(t):
    people, found = people_and_pairs(t)
    truth = people.where("segment = 'BUILDING' AND customer_id < 1000000000").select(F.col("customer_id").alias("a"), (F.col("customer_id") + 10**9).alias("b"))
    return cleaning.pair_quality(found, truth, ["a", "b"])


def people_and_pairs(t):
    """Customers with a misspelt copy of those in one segment, and the pairs of similar names. Customers are joined with their countries once."""
    people = materialize(t.customers.select("customer_id", "country", "segment", "customer_name"), "people")
    copies = people.where("segment = 'BUILDING'").withColumn("customer_id", F.col("customer_id") + 10**9).withColumn(
        "customer_name", F.concat(F.lit("Custmoer"), F.substring("customer_name", 9, 100)))
    everyone = people.unionByName(copies)
    pairs = similar_members(everyone, ["country", "segment"], "customer_name", "customer_id")
    return everyone, pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


SQL_ENTITIES = f"""{SQL_CUSTOMERS}, people AS (SELECT customer_id, country, segment, customer_name FROM customers
  UNION ALL SELECT customer_id + 1000000000, country, segment, 'Custmoer' || substr(customer_name, 9) FROM customers WHERE segment = 'BUILDING'),
links AS (SELECT x.customer_id AS a, y.customer_id AS b FROM people x JOIN people y ON x.country = y.country AND x.segment = y.segment
  AND x.customer_name <> y.customer_name WHERE damerau_levenshtein(x.customer_name, y.customer_name) = 1),
reach AS (SELECT customer_id AS node, customer_id AS root FROM people UNION SELECT b, root FROM reach JOIN links ON a = node),
entity AS (SELECT node AS customer_id, min(root) AS entity FROM reach GROUP BY 1)"""


@query("customer_entities", f"""WITH RECURSIVE {SQL_ENTITIES} SELECT entity, min(customer_id) AS customer_id, count(*) AS members,
  arg_min(customer_name, customer_id) AS customer_name, min(country) AS country FROM entity JOIN people USING (customer_id) GROUP BY 1""")
def customer_entities(t):
    """Customers whose names are connected by single edits are one entity; the record of the least id survives."""
    people, pairs = people_and_pairs(t)
    return entities.surviving(entities.with_entities(people, "customer_id", pairs), "customer_id", ["customer_name", "country"])


@query("entity_quality", f"""WITH RECURSIVE {SQL_ENTITIES}, c AS (SELECT entity, customer_id % 1000000000 AS person FROM entity),
n AS (SELECT (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) FROM (SELECT count(*) AS n FROM c GROUP BY entity)) AS found,
  (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) FROM (SELECT count(*) AS n FROM c GROUP BY person)) AS labelled,
  (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) FROM (SELECT count(*) AS n FROM c GROUP BY entity, person)) AS hits)
SELECT *, round(hits / nullif(found, 0), 6) AS precision, round(hits / nullif(labelled, 0), 6) AS recall FROM n""")
def entity_quality(t):
    people, pairs = people_and_pairs(t)
    grouped = entities.with_entities(people, "customer_id", pairs).withColumn("person", F.col("customer_id") % 10**9)
    return entities.group_quality(grouped, "entity", "person")
