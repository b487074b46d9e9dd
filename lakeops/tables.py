"""Loading the supplied tables and mapping them to the retail model."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def money(column: str | Column, precision: int = 12, scale: int = 2) -> Column:
    """Doubles become exact decimals before any arithmetic."""
    return (F.col(column) if isinstance(column, str) else column).cast(f"decimal({precision},{scale})")


def padded_number(column: Column, prefix: str = "TH-", width: int = 8) -> Column:
    """Prefix plus the right-most ``width`` digits of the zero-padded key."""
    return F.concat(F.lit(prefix), F.right(F.concat(F.lit("0" * width), column.cast("string")), F.lit(width)))


class Tables:
    """Parquet tables of one folder plus the retail entities derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            frame = self.raw(name)
            self.__dict__[name] = frame
            return frame
        raise AttributeError(name)

    @cached_property
    def geography(self) -> DataFrame:
        """Country to region, one row per country."""
        return (
            self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region"))
        )

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.customer.join(self.geography, F.col("c_nationkey") == F.col("n_nationkey")).select(
            key.alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            "country",
            "region",
            loyalty_tier(F.col("c_acctbal")).alias("loyalty_tier"),
            referrer(key).alias("referred_by"),
            F.col("c_mktsegment").alias("segment"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            money("p_retailprice", 10).alias("list_price"),
            (F.col("p_size") <= 45).alias("is_active"),
        )

    @cached_property
    def stores(self) -> DataFrame:
        return self.supplier.join(self.geography, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), "country", "region"
        )

    @cached_property
    def sales_orders(self) -> DataFrame:
        online = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        return self.orders.select(
            F.col("o_orderkey").alias("order_id"),
            padded_number(F.col("o_orderkey")).alias("order_number"),
            F.col("o_custkey").alias("customer_id"),
            F.when(~online, F.col("o_custkey") % 100).alias("store_id"),
            F.when(online, "Online").otherwise("Store").alias("channel"),
            F.col("o_orderdate").alias("order_date"),
            order_status(F.col("o_orderstatus")).alias("status"),
            money("o_totalprice").alias("order_total"),
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        lines = self.lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("store_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money("l_extendedprice", 10).alias("unit_price"),
            money("l_discount", 4).alias("discount_pct"),
            F.col("l_shipdate").alias("ship_date"),
        )
        return lines.withColumn("line_total", line_net().cast("decimal(12,2)"))

    @cached_property
    def reviews(self) -> DataFrame:
        """Documents with a label act as product reviews; the source number is the product."""
        return self.documents.join(self.labels, "doc_id").select(
            F.col("doc_id").alias("review_id"),
            F.expr("CAST(substring(source, 4) AS BIGINT)").alias("product_id"),
            (F.lit(2) + 3 * F.col("quality") - F.col("toxic")).alias("rating"),
            F.col("lang").alias("language"),
            F.col("text").alias("review_text"),
        )


def line_net() -> Column:
    """Unrounded quantity x price x (1 - discount)."""
    return F.col("quantity") * F.col("unit_price") * (F.lit(1) - F.col("discount_pct"))


def loyalty_tier(balance: Column) -> Column:
    return F.when(balance >= 7000, "Gold").when(balance >= 3000, "Silver").otherwise("Bronze")


def referrer(key: Column) -> Column:
    return F.when((key > 20) & (key % 5 == 0), F.floor(key / 7).cast("bigint"))


def order_status(code: Column) -> Column:
    return F.when(code == "P", "Cancelled").when(code == "F", "Delivered").otherwise("Placed")


# The same mapping for the SQL checks, as common table expressions.
SQL_GEO = """geo AS (SELECT n_nationkey, n_name AS country, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
SQL_CUSTOMERS = SQL_GEO + """, customers AS (SELECT c_custkey AS customer_id, c_name AS customer_name, country, region,
  CASE WHEN c_acctbal >= 7000 THEN 'Gold' WHEN c_acctbal >= 3000 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier,
  CASE WHEN c_custkey > 20 AND c_custkey % 5 = 0 THEN c_custkey // 7 END AS referred_by, c_mktsegment AS segment
  FROM customer JOIN geo ON c_nationkey = n_nationkey)"""
SQL_PRODUCTS = """products AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
  p_brand AS brand, CAST(p_retailprice AS DECIMAL(10,2)) AS list_price, p_size <= 45 AS is_active FROM part)"""
SQL_STORES = """stores AS (SELECT s_suppkey AS store_id, s_name AS store_name, country, region
  FROM supplier JOIN geo ON s_nationkey = n_nationkey)"""
SQL_ORDERS = """sales_orders AS (SELECT o_orderkey AS order_id,
  'TH-' || right('00000000' || CAST(o_orderkey AS VARCHAR), 8) AS order_number, o_custkey AS customer_id,
  CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_custkey % 100 END AS store_id,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Online' ELSE 'Store' END AS channel,
  o_orderdate AS order_date,
  CASE o_orderstatus WHEN 'P' THEN 'Cancelled' WHEN 'F' THEN 'Delivered' ELSE 'Placed' END AS status,
  CAST(o_totalprice AS DECIMAL(12,2)) AS order_total FROM orders)"""
SQL_LINES = """order_lines AS (SELECT *, CAST(quantity * unit_price * (1 - discount_pct) AS DECIMAL(12,2)) AS line_total
  FROM (SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id, l_suppkey AS store_id,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
  CAST(l_discount AS DECIMAL(4,2)) AS discount_pct, l_shipdate AS ship_date FROM lineitem))"""
SQL_REVIEWS = """reviews AS (SELECT d.doc_id AS review_id, CAST(substr(source, 4) AS BIGINT) AS product_id,
  2 + 3 * quality - toxic AS rating, lang AS language, text AS review_text
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""
