"""Sources, sinks and partition maintenance."""

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from lakeops.operators import partitions
from lakeops.plans.registry import query
from lakeops.session import scratch_path
from lakeops.sources import landing
from lakeops.tables import SQL_CUSTOMERS, SQL_ORDERS, TABLE_NAMES

# ---- landing files -----------------------------------------------------------------------------


@query("read_landing_csv", f"""WITH {SQL_ORDERS} SELECT order_id, customer_id, status, channel AS carrier, order_number AS tracking,
  CAST(order_date AS DATE) AS order_date, CAST(date_trunc('year', order_date) AS DATE) AS load_date FROM sales_orders""")
def read_landing_csv(t):
    """Orders are written as landing CSV with a JSON column and read back."""
    base = scratch_path(t.spark, "landing_orders")
    rows = t.sales_orders.select(
        "order_id", "customer_id", "status",
        F.to_json(F.struct(F.col("channel").alias("carrier"), F.col("order_number").alias("tracking"))).alias("shipping_info"),
        F.to_date("order_date").alias("order_date"))
    landing.write_landing_csv(rows, base, F.trunc("order_date", "YEAR"))
    back = landing.read_landing_csv(t.spark, base, "order_id BIGINT, customer_id BIGINT, status STRING, shipping_info STRING, order_date DATE")
    return back.where(F.col(landing.CORRUPT).isNull()).select(
        "order_id", "customer_id", "status", F.get_json_object("shipping_info", "$.carrier").alias("carrier"),
        F.get_json_object("shipping_info", "$.tracking").alias("tracking"), "order_date", "load_date")


@query("read_jsonl", """SELECT event_id, ts AS event_time, user_id AS customer_id, event_type, value, CAST(ts AS DATE) AS event_date FROM events""")
def read_jsonl(t):
    base = scratch_path(t.spark, "landing_events")
    rows = t.events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"), F.col("user_id").alias("customer_id"),
        "event_type", "value", F.to_date("ts").alias("event_date"))
    landing.write_jsonl(rows, base, "event_date")
    return landing.read_jsonl(
        t.spark, base, "event_id BIGINT, event_time TIMESTAMP_NTZ, customer_id BIGINT, event_type STRING, value DOUBLE, event_date DATE")


@query("read_json_array", "SELECT conv_id, turn, role, text FROM conversations")
def read_json_array(t):
    base = scratch_path(t.spark, "landing_tickets")
    landing.write_json_arrays(t.conversations.select("conv_id", "turn", "role", "text"), base)
    return landing.read_json_array(t.spark, base, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").select(
        "conv_id", "turn", "role", "text")


@query("scan_parquet", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_totalprice > 100000 ORDER BY o_orderkey LIMIT 10")
def scan_parquet(t):
    found = t.spark.read.parquet(f"{t.folder}/order*.parquet")
    return found.where("o_totalprice > 100000").select("o_orderkey", "o_custkey", "o_orderdate").orderBy("o_orderkey").limit(10)


@query("inline_values", f"""WITH {SQL_CUSTOMERS}, m AS (SELECT * FROM (VALUES ('analyst_asia', 'ASIA'), ('analyst_africa', 'AFRICA')) v(user_name, region))
SELECT user_name, region, count(*) AS customers FROM m JOIN customers USING (region) GROUP BY 1, 2""")
def inline_values(t):
    mapping = t.spark.sql("SELECT * FROM VALUES ('analyst_asia', 'ASIA'), ('analyst_africa', 'AFRICA') AS m(user_name, region)")
    return mapping.join(t.customers, "region").groupBy("user_name", "region").agg(F.count(F.lit(1)).alias("customers"))


@query("table_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows_loaded FROM {n}" for n in TABLE_NAMES))
def table_row_counts(t):
    counts = [t.raw(n).agg(F.count(F.lit(1)).alias("rows_loaded")).select(F.lit(n).alias("table_name"), "rows_loaded") for n in TABLE_NAMES]
    return reduce(lambda a, b: a.unionByName(b), counts)


# ---- monthly partitions ------------------------------------------------------------------------

def order_events(t):
    return t.orders.select("o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("event_time"))


ALL_MONTHS = (dt.date(1900, 1, 1), dt.date(2100, 1, 1))


@query("write_monthly_partitions", """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS event_month, count(*) AS rows FROM orders GROUP BY 1""")
def write_monthly_partitions(t):
    path = partitions.monthly_table(order_events(t), "event_time")
    return t.spark.read.parquet(path).groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"))


BOUNDS = partitions.month_starts(dt.date(1994, 10, 1), 92)
SQL_BOUNDS = "b AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-10-01', TIMESTAMP '2002-05-01', INTERVAL 1 MONTH)) AS DATE) AS bound)"


@query("rows_per_partition", f"""WITH {SQL_BOUNDS}, p AS (SELECT row_number() OVER (ORDER BY bound) + 1 AS partition_number, bound AS lower_boundary FROM b
  UNION ALL SELECT 1, NULL),
c AS (SELECT (SELECT count(*) FROM b WHERE bound <= CAST(o_orderdate AS DATE)) + 1 AS partition_number, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(p.partition_number AS INTEGER) AS partition_number, lower_boundary, coalesce(n, 0) AS rows FROM p LEFT JOIN c USING (partition_number)""")
def rows_per_partition(t):
    return partitions.rows_per_partition(t.orders.select(F.to_date("o_orderdate").alias("day")), "day", BOUNDS)


@query("partition_number", f"""WITH {SQL_BOUNDS} SELECT o_orderkey, CAST((SELECT count(*) FROM b WHERE bound <= CAST(o_orderdate AS DATE)) + 1 AS INTEGER) AS partition_number FROM orders""")
def partition_number(t):
    return t.orders.select("o_orderkey", partitions.partition_number(F.to_date("o_orderdate"), BOUNDS).alias("partition_number"))


@query("pruned_event_counts", """SELECT o_orderstatus AS event_type, count(*) AS events FROM orders
WHERE o_orderdate >= '1998-08-01' AND o_orderdate < '1998-09-01' GROUP BY 1""")
def pruned_event_counts(t):
    path = partitions.monthly_table(order_events(t), "event_time")
    month = partitions.read_months(t.spark, path, dt.date(1998, 8, 1), dt.date(1998, 9, 1))
    return month.groupBy(F.col("o_orderstatus").alias("event_type")).agg(F.count(F.lit(1)).alias("events"))


@query("sliding_window", """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS event_month, count(*) AS rows FROM orders
WHERE o_orderdate >= '1996-01-01' GROUP BY 1""")
def sliding_window(t):
    """Months before the newest are loaded, the newest comes in, and 1995 is dropped."""
    rows = order_events(t)
    newest = F.lit("2001-08-01").cast("timestamp_ntz")
    path = partitions.monthly_table(rows.where(F.col("event_time") < newest), "event_time")
    table = partitions.Manifest(((path, *ALL_MONTHS),))
    window = partitions.slide_window(table, rows.where(F.col("event_time") >= newest), "event_time", dt.date(1996, 1, 1),
                                     scratch_path(t.spark, "newest"), ALL_MONTHS[1])
    return window.read(t.spark).groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"))


@query("archive_partition", """SELECT CASE WHEN date_trunc('month', o_orderdate) = TIMESTAMP '1995-01-01' THEN 'archive' ELSE 'remaining' END AS place, count(*) AS rows
FROM orders GROUP BY 1""")
def archive_partition(t):
    path = partitions.monthly_table(order_events(t), "event_time")
    archive = scratch_path(t.spark, "archive")
    remaining = partitions.archive_month(t.spark, partitions.Manifest(((path, *ALL_MONTHS),)), dt.date(1995, 1, 1), archive)

    def counted(place, rows):
        return rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(place).alias("place"), "rows")

    return counted("archive", t.spark.read.parquet(archive)).unionByName(counted("remaining", remaining.read(t.spark)))
