"""Sales views, joins, aggregates, rankings and set operations."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import sales, sketches
from lakeops.operators.skew import exact_percentile, left_join_sparse
from lakeops.plans.registry import query
from lakeops.session import materialize
from lakeops.tables import (
    SQL_CUSTOMERS, SQL_GEO, SQL_LINES, SQL_ORDERS, SQL_PRODUCTS, SQL_REVIEWS, SQL_STORES, line_net, money,
)

NET = "quantity * unit_price * (1 - discount_pct)"


# ---- views and reports -------------------------------------------------------------------------

@query("order_summary", f"""WITH {SQL_CUSTOMERS}, {SQL_STORES}, {SQL_ORDERS}, {SQL_LINES}
SELECT o.order_id, o.order_number, CAST(o.order_date AS DATE) AS order_date, o.channel, c.region AS sales_region,
  o.status, o.customer_id, c.customer_name, s.store_name, count(l.line_number) AS line_count,
  CAST(sum(l.line_total) AS DECIMAL(22,2)) AS order_total
FROM sales_orders o JOIN customers c USING (customer_id) LEFT JOIN stores s ON s.store_id = o.store_id
LEFT JOIN order_lines l ON l.order_id = o.order_id GROUP BY ALL""")
def order_summary(t):
    return sales.order_summary(t.sales_orders, t.customers, t.stores, t.order_lines)


@query("product_sales_daily", f"""WITH {SQL_ORDERS}, {SQL_LINES}
SELECT product_id, CAST(order_date AS DATE) AS sales_date, CAST(sum(quantity) AS BIGINT) AS units,
  CAST(sum({NET}) AS DECIMAL(24,4)) AS net_sales, count(*) AS line_count
FROM order_lines JOIN sales_orders USING (order_id) WHERE status <> 'Cancelled' GROUP BY 1, 2""")
def product_sales_daily(t):
    return sales.product_sales_daily(t.sales_orders, t.order_lines)


CUSTOMER_ORDERS_SQL = f"""WITH {SQL_ORDERS}, {SQL_LINES}
SELECT customer_id, order_id, order_number, CAST(order_date AS DATE) AS order_date, status,
  CAST(sum(line_total) AS DECIMAL(22,2)) AS order_total, count(*) AS line_count
FROM sales_orders JOIN order_lines USING (order_id) GROUP BY ALL"""


@query("customer_orders", CUSTOMER_ORDERS_SQL)
def customer_orders(t):
    return sales.customer_orders(t.sales_orders, t.order_lines)


@query("customer_orders_tvf", CUSTOMER_ORDERS_SQL)
def customer_orders_tvf(t):
    sales.customer_orders(t.sales_orders, t.order_lines).createOrReplaceTempView("lakeops_orders_with_totals")
    t.customers.createOrReplaceTempView("lakeops_customers")
    t.spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION lakeops_customer_orders(wanted BIGINT)
      RETURNS TABLE(order_id BIGINT, order_number STRING, order_date DATE, status STRING, order_total DECIMAL(22,2), line_count BIGINT)
      RETURN SELECT order_id, order_number, order_date, status, order_total, line_count
        FROM lakeops_orders_with_totals WHERE customer_id = wanted""")
    return t.spark.sql("""SELECT c.customer_id, f.* FROM lakeops_customers c,
                          LATERAL lakeops_customer_orders(c.customer_id) f""")


@query("net_price", f"""WITH {SQL_LINES}
SELECT order_id, line_number, CAST({NET} AS DECIMAL(12,2)) AS net_price, CAST(NULL AS DECIMAL(12,2)) AS net_of_null
FROM order_lines""")
def net_price(t):
    t.spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION lakeops_net_price(
        price DECIMAL(10,2), quantity INT, discount DECIMAL(4,2)) RETURNS DECIMAL(12,2)
        RETURN CAST(quantity * price * (1 - discount) AS DECIMAL(12,2))""")
    return t.order_lines.select(
        "order_id", "line_number",
        F.expr("lakeops_net_price(unit_price, quantity, discount_pct)").alias("net_price"),
        F.expr("lakeops_net_price(NULL, quantity, discount_pct)").alias("net_of_null"),
    )


@query("top_rated_products", f"""WITH {SQL_PRODUCTS}, {SQL_REVIEWS}
SELECT product_id, product_name, CAST(CAST((200 * sum(rating) + count(*)) // (2 * count(*)) AS DECIMAL(18,0)) * 0.01
  AS DECIMAL(3,2)) AS avg_rating, count(*) AS reviews
FROM products JOIN reviews USING (product_id) GROUP BY 1, 2 HAVING count(*) >= 3""")
def top_rated_products(t):
    return sales.top_rated_products(t.products, t.reviews, 3)


@query("active_product", f"""WITH {SQL_PRODUCTS}
SELECT product_id, product_name, category, brand, list_price FROM products WHERE is_active""")
def active_product(t):
    return t.products.where("is_active").select("product_id", "product_name", "category", "brand", "list_price")


@query("order_number", f"""WITH {SQL_ORDERS} SELECT order_id, order_number FROM sales_orders""")
def order_number(t):
    return t.sales_orders.select("order_id", "order_number")


@query("line_total", f"""WITH {SQL_LINES} SELECT order_id, line_number, line_total FROM order_lines""")
def line_total(t):
    return t.order_lines.select("order_id", "line_number", "line_total")


# ---- projections and predicates ----------------------------------------------------------------

@query("case_and_choose", """SELECT event_id,
  CASE WHEN value >= 100 THEN 'high' WHEN value >= 10 THEN 'middle' ELSE 'low' END AS band,
  CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 0 END AS weight,
  (['mobile', 'desktop', 'tablet'])[1 + user_id % 4] AS device,
  CASE WHEN event_type <> 'error' THEN user_id END AS counted_user FROM events""")
def case_and_choose(t):
    devices = F.array(F.lit("mobile"), F.lit("desktop"), F.lit("tablet"))
    return t.events.select(
        "event_id",
        F.when(F.col("value") >= 100, "high").when(F.col("value") >= 10, "middle").otherwise("low").alias("band"),
        F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "signup", 2).otherwise(0).alias("weight"),
        F.try_element_at(devices, (1 + F.col("user_id") % 4).cast("int")).alias("device"),
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("counted_user"),
    )


@query("predicate_mix", f"""WITH {SQL_CUSTOMERS}
SELECT customer_id, segment, loyalty_tier FROM customers
WHERE (loyalty_tier IN ('Silver', 'Gold') AND segment LIKE 'MACH%' AND referred_by IS NULL)
   OR (customer_id BETWEEN 100 AND 900 AND segment <> 'BUILDING' AND referred_by IS NOT NULL)""")
def predicate_mix(t):
    c = F.col
    return t.customers.where(
        (c("loyalty_tier").isin("Silver", "Gold") & c("segment").like("MACH%") & c("referred_by").isNull())
        | (c("customer_id").between(100, 900) & (c("segment") != "BUILDING") & c("referred_by").isNotNull())
    ).select("customer_id", "segment", "loyalty_tier")


@query("month_filter_equivalence", """SELECT
  (SELECT count(*) FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 8) AS by_function,
  (SELECT count(*) FROM orders WHERE o_orderdate >= '1998-08-01' AND o_orderdate < '1998-09-01') AS by_range""")
def month_filter_equivalence(t):
    day = F.col("o_orderdate")
    in_range = (day >= F.lit("1998-08-01").cast("timestamp_ntz")) & (day < F.lit("1998-09-01").cast("timestamp_ntz"))
    by_range = t.orders.where(in_range).agg(F.count(F.lit(1)).alias("by_range"))
    by_function = t.orders.where((F.year(day) == 1998) & (F.month(day) == 8)).agg(F.count(F.lit(1)).alias("by_function"))
    return by_function.crossJoin(by_range)


@query("optional_filter", """SELECT 'all' AS scope, source, count(*) AS docs FROM documents GROUP BY source
UNION ALL SELECT 'en', source, count(*) FROM documents WHERE lang = 'en' GROUP BY source""")
def optional_filter(t):
    def docs(lang=None):
        found = t.documents if lang is None else t.documents.where(F.col("lang") == lang)
        return found.groupBy("source").agg(F.count(F.lit(1)).alias("docs")).select(
            F.lit(lang or "all").alias("scope"), "source", "docs")

    return docs().unionByName(docs("en"))


@query("typed_literal_filter", """SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#4' AND p_partkey >= 10
  AND p_retailprice < CAST('950' AS DOUBLE)""")
def typed_literal_filter(t):
    return t.part.where(
        (F.col("p_brand") == "Brand#4") & (F.col("p_partkey") >= F.lit("10").cast("bigint"))
        & (F.col("p_retailprice") < F.lit("950").cast("double"))
    ).select("p_partkey", "p_name")


MAX_PAGE = 1000


def entity_page_of(df, key, after=None, first=50, most=MAX_PAGE):
    """Keyset page: rows after the cursor in key order, with the next cursor; asking for more than ``most`` rows is an error."""
    if first > most:
        raise ValueError(f"a page has at most {most} rows")
    if after is not None:
        df = df.where(F.col(key) > F.lit(after))
    size = first
    page = df.orderBy(key).limit(size + 1)
    whole = Window.orderBy(key)
    return (
        page.withColumn("_n", F.row_number().over(whole))
        .withColumn("_more", F.lead(key).over(whole).isNotNull())
        .where(F.col("_n") <= size)
        .withColumn("next_cursor", F.when((F.col("_n") == size) & F.col("_more"), F.col(key)))
        .drop("_n", "_more")
    )


@query("entity_page", f"""WITH {SQL_PRODUCTS}, page AS (SELECT product_id, product_name, list_price FROM products
  WHERE brand = 'Brand#7' AND list_price < 1000 AND product_id > 100 ORDER BY product_id LIMIT 51)
SELECT product_id, product_name, list_price, CASE WHEN n = 50 AND total = 51 THEN product_id END AS next_cursor
FROM (SELECT *, row_number() OVER (ORDER BY product_id) AS n, count(*) OVER () AS total FROM page) WHERE n <= 50""")
def entity_page(t):
    found = t.products.where((F.col("brand") == "Brand#7") & (F.col("list_price") < 1000))
    return entity_page_of(found.select("product_id", "product_name", "list_price"), "product_id", after=100, first=50)


# ---- joins -------------------------------------------------------------------------------------

@query("join_inner", f"""WITH {SQL_ORDERS}, {SQL_LINES} SELECT o.order_id, o.customer_id, l.product_id, l.line_total
FROM sales_orders o JOIN order_lines l ON l.order_id = o.order_id""")
def join_inner(t):
    return t.sales_orders.select("order_id", "customer_id").join(
        t.order_lines.select("order_id", "product_id", "line_total"), "order_id")


@query("join_left", f"""WITH {SQL_GEO}, {SQL_STORES}, {SQL_ORDERS}
SELECT o.order_id, o.channel, s.store_name FROM sales_orders o LEFT JOIN stores s ON s.store_id = o.store_id""")
def join_left(t):
    return left_join_sparse(
        t.sales_orders.select("order_id", "channel", "store_id"), t.stores.select("store_id", "store_name"), "store_id", "order_id"
    ).drop("store_id")


@query("join_full_outer", f"""WITH o AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
e AS (SELECT user_id AS k, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT coalesce(o.k, e.k) AS customer_id, coalesce(o.n, 0) AS delivered, coalesce(e.n, 0) AS purchases,
  coalesce(o.n, 0) + coalesce(e.n, 0) AS score FROM o FULL OUTER JOIN e ON o.k = e.k""")
def join_full_outer(t):
    delivered = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("delivered"))
    bought = t.events.where("event_type = 'purchase'").groupBy(F.col("user_id").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("purchases"))
    joined = delivered.join(bought, "customer_id", "full").na.fill(0, ["delivered", "purchases"])
    return joined.withColumn("score", F.col("delivered") + F.col("purchases"))


@query("join_semi", """SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def join_semi(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return t.customer.select("c_custkey", "c_name").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query("join_anti", """SELECT o_orderkey, o_orderdate FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def join_anti(t):
    return t.orders.select("o_orderkey", "o_orderdate").join(
        t.lineitem.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query("join_cross_single", """SELECT c_custkey, round(c_acctbal - a, 6) AS above_average
FROM customer, (SELECT avg(c_acctbal) AS a FROM customer)""")
def join_cross_single(t):
    average = t.customer.agg(F.avg("c_acctbal").alias("a"))
    return t.customer.crossJoin(F.broadcast(average)).select(
        "c_custkey", F.round(F.col("c_acctbal") - F.col("a"), 6).alias("above_average"))


@query("lateral_aggregate", f"""WITH {SQL_ORDERS}, s AS (SELECT customer_id, count(*) AS n,
  CAST(sum(order_total) * 100 AS BIGINT) AS cents FROM sales_orders GROUP BY 1)
SELECT c_custkey AS customer_id, coalesce(n, 0) AS orders,
  CAST(CAST((2 * cents + n) // (2 * n) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(12,2)) AS avg_total
FROM customer LEFT JOIN s ON s.customer_id = c_custkey""")
def lateral_aggregate(t):
    per_customer = t.sales_orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_total").alias("total"))
    return t.customer.select(F.col("c_custkey").alias("customer_id")).join(per_customer, "customer_id", "left").select(
        "customer_id", F.coalesce("n", F.lit(0)).alias("orders"),
        sales.exact_average(F.col("total"), F.col("n"), 12, 2).alias("avg_total"))


@query("apply_table_function", """SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def apply_table_function(t):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("scalar_subquery", """SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice > (SELECT max(o_totalprice) * 0.95 FROM orders)""")
def scalar_subquery(t):
    t.orders.createOrReplaceTempView("lakeops_orders")
    return t.spark.sql("""SELECT o_orderkey, o_totalprice FROM lakeops_orders
        WHERE o_totalprice > (SELECT max(o_totalprice) * 0.95 FROM lakeops_orders)""")


@query("region_of_order", f"""WITH {SQL_CUSTOMERS}, {SQL_STORES}, {SQL_ORDERS},
cr AS (SELECT country, min(region) AS region FROM stores GROUP BY 1)
SELECT o.order_id, o.channel, CASE WHEN o.channel = 'Store' THEN s.region ELSE cr.region END AS sales_region
FROM sales_orders o LEFT JOIN customers c USING (customer_id) LEFT JOIN stores s ON s.store_id = o.store_id
LEFT JOIN cr ON cr.country = c.country""")
def region_of_order(t):
    return sales.region_of_order(t.sales_orders, t.customers, t.stores).select("order_id", "channel", "sales_region")


@query("join_relationships", f"""WITH {SQL_PRODUCTS}, r AS (SELECT *, row_number() OVER (PARTITION BY category
  ORDER BY list_price DESC, product_id) AS n FROM products)
SELECT category, string_agg(product_id || '=' || list_price, '|' ORDER BY n) AS products FROM r WHERE n <= 3 GROUP BY 1""")
def join_relationships(t):
    top = sales.top_children(t.products, "category", [F.desc("list_price"), F.asc("product_id")], 3)
    nested = top.groupBy("category").agg(
        F.array_sort(F.collect_list(F.struct("position", "product_id", "list_price"))).alias("items"))
    label = F.transform("items", lambda i: F.concat_ws("=", i["product_id"].cast("string"), i["list_price"].cast("string")))
    return nested.select("category", F.array_join(label, "|").alias("products"))


# ---- aggregates --------------------------------------------------------------------------------

@query("conditional_counts", """SELECT event_type AS carrier,
  count(*) FILTER (WHERE json_extract_string(props, '$.k') > '5') AS express,
  count(*) FILTER (WHERE NOT coalesce(json_extract_string(props, '$.k') > '5', FALSE)) AS standard
FROM events GROUP BY 1""")
def conditional_counts(t):
    express = F.get_json_object("props", "$.k") > "5"
    return t.events.groupBy(F.col("event_type").alias("carrier")).agg(
        F.sum(F.when(express, 1).otherwise(0)).alias("express"),
        F.sum(F.when(express, 0).otherwise(1)).alias("standard"))


@query("multi_plan_keys", """SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem
GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1""")
def multi_plan_keys(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("suppliers")).where("suppliers > 1")


@query("string_agg_ordered", """WITH c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, string_agg(o_orderstatus || ':' || n, ',' ORDER BY o_orderstatus) AS statuses FROM c GROUP BY 1""")
def string_agg_ordered(t):
    counted = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    counted.createOrReplaceTempView("lakeops_status_counts")
    return t.spark.sql("""SELECT o_custkey, listagg(o_orderstatus || ':' || n, ',')
        WITHIN GROUP (ORDER BY o_orderstatus || ':' || n) AS statuses FROM lakeops_status_counts GROUP BY 1""")


@query("json_array_agg", f"""WITH {SQL_ORDERS}, r AS (SELECT customer_id, order_id, order_total, row_number() OVER
  (PARTITION BY customer_id ORDER BY order_total DESC, order_id) AS n FROM sales_orders)
SELECT customer_id, '[' || string_agg('{{"id":' || order_id || ',"total":' || order_total || '}}', ',' ORDER BY n) || ']'
  AS best_orders FROM r WHERE n <= 3 GROUP BY 1""")
def json_array_agg(t):
    top = sales.top_children(t.sales_orders, "customer_id", [F.desc("order_total"), F.asc("order_id")], 3)
    ordered = F.array_sort(F.collect_list(F.struct("position", "order_id", "order_total")))
    objects = F.transform(ordered, lambda r: F.struct(r["order_id"].alias("id"), r["order_total"].alias("total")))
    return top.groupBy("customer_id").agg(F.to_json(objects).alias("best_orders"))


@query("gross_by_product", f"""WITH {SQL_LINES}
SELECT product_id, CAST(sum(quantity * unit_price) AS DECIMAL(24,2)) AS gross FROM order_lines GROUP BY 1""")
def gross_by_product(t):
    return t.order_lines.groupBy("product_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).cast("decimal(24,2)").alias("gross"))


@query("latency_percentiles", """SELECT event_type, round(quantile_cont(value, 0.95), 6) AS p95,
  count(*) FILTER (WHERE value > 200) AS slow FROM events GROUP BY 1""")
def latency_percentiles(t):
    slow = t.events.groupBy("event_type").agg(F.count_if(F.col("value") > 200).alias("slow"))
    p95 = exact_percentile(t.events, "event_type", "value", 0.95, 4.0)
    return slow.join(p95, "event_type").select("event_type", F.round("percentile", 6).alias("p95"), "slow")


SHARES = (0.5, 0.95, 0.99)


@query("latency_sketch_check", f"""SELECT event_type, share, count(value) AS events, TRUE AS within_bound
FROM events, (VALUES {', '.join(f'(CAST({p} AS DOUBLE))' for p in SHARES)}) s(share) GROUP BY ALL""")
def latency_sketch_check(t):
    """Percentiles of all days from daily sketches: each rank is within a hundredth of the exact one."""
    days = materialize(sketches.daily_sketches(t.events, ["event_type"], "ts", "value"), "daily_sketches")
    found = materialize(sketches.percentiles(sketches.merged(days, ["event_type"]), SHARES), "percentiles")
    errors = sketches.rank_errors(found, t.events, ["event_type"], "value")
    return errors.join(found, ["event_type", "share"]).select("event_type", "share", F.col("n").alias("events"), (F.col("rank_error") <= 0.01).alias("within_bound"))


@query("top_groups_by_sum", f"""WITH {SQL_LINES} SELECT store_id, CAST(sum(line_total) AS DECIMAL(24,2)) AS sales
FROM order_lines GROUP BY 1 ORDER BY sales DESC, store_id LIMIT 10""")
def top_groups_by_sum(t):
    return t.order_lines.groupBy("store_id").agg(F.sum("line_total").cast("decimal(24,2)").alias("sales")).orderBy(
        F.desc("sales"), "store_id").limit(10)


@query("net_sales_reconciliation", f"""WITH {SQL_CUSTOMERS}, {SQL_ORDERS}, {SQL_LINES},
n AS (SELECT order_id, sum({NET}) AS net, count(*) AS lines FROM order_lines GROUP BY 1),
j AS (SELECT c.region, o.status, net, lines FROM sales_orders o JOIN customers c USING (customer_id) LEFT JOIN n USING (order_id)),
s AS (SELECT 'all' AS scope, * FROM j UNION ALL SELECT 'region:' || region, * FROM j)
SELECT scope, count(*) AS orders, CAST(sum(coalesce(lines, 0)) AS BIGINT) AS lines,
  count(*) FILTER (WHERE status <> 'Cancelled') AS orders_excluding_cancelled,
  CAST(sum(net) FILTER (WHERE status <> 'Cancelled') AS DECIMAL(24,2)) AS net_excluding_cancelled,
  CAST(sum(net) FILTER (WHERE status NOT IN ('Cancelled', 'Placed')) AS DECIMAL(24,2)) AS net_excluding_cancelled_and_returned
FROM s GROUP BY 1""")
def net_sales_reconciliation(t):
    orders = t.sales_orders.join(
        t.customers.select("customer_id", F.col("region").alias("sales_region")), "customer_id")
    return sales.net_sales_reconciliation(orders, t.order_lines, "Cancelled", "Placed")


@query("weighted_duration_totals", """SELECT event_type, CAST(sum(CAST(value AS DECIMAL(12,2)) * user_id) AS DECIMAL(24,2)) AS total,
  max(value) AS largest, count(*) AS executions FROM events GROUP BY 1""")
def weighted_duration_totals(t):
    return t.events.groupBy("event_type").agg(
        F.sum(money("value") * F.col("user_id")).cast("decimal(24,2)").alias("total"),
        F.max("value").alias("largest"), F.count(F.lit(1)).alias("executions"))


@query("safe_ratio", """WITH s AS (SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT))
  FILTER (WHERE event_type = 'purchase') AS BIGINT) AS cents, nullif(count(*) FILTER (WHERE event_type = 'signup'), 0) AS n FROM events GROUP BY 1)
SELECT user_id, CAST(CAST((cents * 20000 + n) // (2 * n) AS DECIMAL(18,0)) * 0.000001 AS DECIMAL(18,6)) AS spend_per_signup FROM s""")
def safe_ratio(t):
    spend = F.sum(F.when(F.col("event_type") == "purchase", money("value")))
    signups = F.nullif(F.count_if(F.col("event_type") == "signup"), F.lit(0))
    return t.events.groupBy("user_id").agg((spend / signups).cast("decimal(18,6)").alias("spend_per_signup"))


# ---- windows, limits, sets ---------------------------------------------------------------------

@query("best_day_per_store", f"""WITH {SQL_GEO}, {SQL_STORES}, {SQL_ORDERS}, {SQL_LINES}, daily AS (
  SELECT l.store_id, CAST(order_date AS DATE) AS sales_date, CAST(sum(line_total) AS DECIMAL(22,2)) AS sales
  FROM order_lines l JOIN sales_orders o USING (order_id) WHERE status <> 'Cancelled' GROUP BY 1, 2),
top AS (SELECT store_id, max(sales) AS sales FROM daily GROUP BY store_id),
best AS (SELECT store_id, sales, min(sales_date) AS sales_date FROM daily JOIN top USING (store_id, sales) GROUP BY ALL)
SELECT store_id, store_name, best.sales_date, best.sales,
  1 + (SELECT count(*) FROM daily other WHERE other.sales_date = best.sales_date AND other.sales > best.sales) AS rank_that_day
FROM best JOIN stores USING (store_id)""")
def best_day_per_store(t):
    return sales.best_day_per_store(t.order_lines, t.sales_orders, t.stores)


@query("rank_candidates", """SELECT vec_rank, o_orderkey, o_totalprice FROM (SELECT row_number() OVER
  (ORDER BY o_totalprice DESC, o_orderkey) AS vec_rank, * FROM orders) WHERE vec_rank <= 50""")
def rank_candidates(t):
    best = t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)
    return best.withColumn("vec_rank", F.row_number().over(Window.orderBy(F.desc("o_totalprice"), "o_orderkey")).cast("bigint"))


@query("top_k_per_group", f"""WITH {SQL_ORDERS} SELECT customer_id, order_id, order_total, position FROM (SELECT *,
  row_number() OVER (PARTITION BY customer_id ORDER BY order_total DESC, order_id) AS position FROM sales_orders) WHERE position <= 3""")
def top_k_per_group(t):
    return sales.top_children(
        t.sales_orders.select("customer_id", "order_id", "order_total"), "customer_id",
        [F.desc("order_total"), F.asc("order_id")], 3)


@query("top_n_orders", f"""WITH {SQL_ORDERS} SELECT order_id, order_total FROM sales_orders ORDER BY order_total DESC, order_id LIMIT 5""")
def top_n_orders(t):
    return t.sales_orders.select("order_id", "order_total").orderBy(F.desc("order_total"), "order_id").limit(5)


@query("union_all_sources", """SELECT 'Product' AS source_type, p_partkey AS source_id, p_name AS label FROM part
UNION ALL SELECT 'Customer', c_custkey, c_name FROM customer UNION ALL SELECT 'Store', s_suppkey, s_name FROM supplier""")
def union_all_sources(t):
    def part(kind, df, key, label):
        return df.select(F.lit(kind).alias("source_type"), F.col(key).alias("source_id"), F.col(label).alias("label"))

    return (part("Product", t.part, "p_partkey", "p_name")
            .unionByName(part("Customer", t.customer, "c_custkey", "c_name"))
            .unionByName(part("Store", t.supplier, "s_suppkey", "s_name")))


@query("union_distinct_keys", """SELECT o_custkey AS customer_id FROM orders WHERE o_orderstatus = 'P'
UNION SELECT user_id FROM events WHERE event_type = 'purchase'""")
def union_distinct_keys(t):
    return t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("customer_id")).union(
        t.events.where("event_type = 'purchase'").select("user_id")).distinct()


@query("intersect_count", """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'),
b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '5-LOW')
SELECT count(*) AS shared, CAST(CAST((count(*) * 2000000 + (SELECT count(*) FROM a)) // (2 * (SELECT count(*) FROM a)) AS DECIMAL(18,0)) * 0.000001 AS DECIMAL(9,6)) AS share FROM a JOIN b USING (k)""")
def intersect_count(t):
    def buyers(priority):
        return t.orders.where(F.col("o_orderpriority") == priority).select("o_custkey").distinct()

    urgent = buyers("1-URGENT")
    flagged = urgent.join(buyers("5-LOW").withColumn("hit", F.lit(1)), "o_custkey", "left")
    return flagged.agg(F.count("hit").alias("shared"), (
        F.count("hit").cast("decimal(18,0)") / F.count(F.lit(1))).cast("decimal(9,6)").alias("share"))


@query("numbered_items", """SELECT p_partkey, i AS line_number, w[i] AS item
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS i FROM part)""")
def numbered_items(t):
    return t.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "item")).select(
        "p_partkey", (F.col("pos") + 1).cast("bigint").alias("line_number"), "item")
