"""Retail views and reports: order summaries, daily sales, ratings, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.skew import left_join_sparse, rank_in_group
from lakeops.tables import line_net


def exact_average(total: Column, count: Column, precision: int, scale: int) -> Column:
    """Decimal average rounded half up once, from exact sums."""
    return (total / F.nullif(count, F.lit(0))).cast(f"decimal({precision},{scale})")


def order_summary(orders: DataFrame, customers: DataFrame, stores: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per order with customer, optional store, line count and total.

    Lines are reduced to one row per order before any join, so the joins carry orders only.
    """
    totals = lines.groupBy("order_id").agg(
        F.count("line_number").alias("line_count"), F.sum("line_total").alias("order_value")
    )
    named = orders.join(customers.select("customer_id", "customer_name", "region"), "customer_id")
    return (
        left_join_sparse(named, stores.select("store_id", "store_name"), "store_id", "order_id")
        .join(totals, "order_id", "left")
        .select(
            "order_id", "order_number", F.to_date("order_date").alias("order_date"), "channel",
            F.col("region").alias("sales_region"), "status", "customer_id", "customer_name", "store_name",
            F.coalesce("line_count", F.lit(0)).cast("bigint").alias("line_count"),
            F.col("order_value").cast("decimal(22,2)").alias("order_total"),
        )
    )


def product_sales_daily(orders: DataFrame, lines: DataFrame, excluded: str = "Cancelled") -> DataFrame:
    """Units, net sales and line count per product and order day, without cancelled orders."""
    kept = orders.where(F.col("status") != excluded).select("order_id", F.to_date("order_date").alias("sales_date"))
    return (
        lines.select("order_id", "product_id", "quantity", "unit_price", "discount_pct")
        .join(kept, "order_id")
        .groupBy("product_id", "sales_date")
        .agg(
            F.sum("quantity").cast("bigint").alias("units"),
            F.sum(line_net()).cast("decimal(24,4)").alias("net_sales"),
            F.count(F.lit(1)).alias("line_count"),
        )
    )


def customer_orders(orders: DataFrame, lines: DataFrame, customer_id: int | None = None) -> DataFrame:
    """Order totals of one customer, or of every customer."""
    if customer_id is not None:
        orders = orders.where(F.col("customer_id") == customer_id)
    totals = lines.groupBy("order_id").agg(
        F.sum("line_total").cast("decimal(22,2)").alias("order_total"), F.count(F.lit(1)).alias("line_count")
    )
    return orders.select(
        "customer_id", "order_id", "order_number", F.to_date("order_date").alias("order_date"), "status"
    ).join(totals, "order_id")


def top_rated_products(products: DataFrame, reviews: DataFrame, min_reviews: int, category: str | None = None) -> DataFrame:
    """Average rating and review count of products with enough reviews."""
    rated = reviews.groupBy("product_id").agg(F.sum("rating").alias("_sum"), F.count(F.lit(1)).alias("reviews"))
    if category is not None:
        products = products.where(F.col("category") == category)
    return (
        products.select("product_id", "product_name")
        .join(rated.where(F.col("reviews") >= min_reviews), "product_id")
        .select(
            "product_id", "product_name",
            exact_average(F.col("_sum").cast("decimal(20,2)"), F.col("reviews"), 3, 2).alias("avg_rating"), "reviews",
        )
    )


def best_day_per_store(lines: DataFrame, orders: DataFrame, stores: DataFrame, excluded: str = "Cancelled") -> DataFrame:
    """Each store's best sales day and its rank among all stores on that day."""
    kept = orders.where(F.col("status") != excluded).select("order_id", F.to_date("order_date").alias("sales_date"))
    daily = (
        lines.select("order_id", "store_id", "line_total")
        .join(kept, "order_id")
        .groupBy("store_id", "sales_date")
        .agg(F.sum("line_total").cast("decimal(22,2)").alias("sales"))
    )
    size_class = F.floor(F.log(F.greatest(F.col("sales").cast("double"), F.lit(0.01))) * 16)
    ranked = rank_in_group(daily, ["sales_date"], "sales", size_class, "rank_that_day")
    best = ranked.groupBy("store_id").agg(
        F.max_by(F.struct("sales_date", "sales", "rank_that_day"),
                 F.struct(F.col("sales"), -F.unix_date("sales_date"))).alias("_b")
    )
    return best.join(stores.select("store_id", "store_name"), "store_id").select(
        "store_id", "store_name", F.col("_b.sales_date").alias("sales_date"), F.col("_b.sales").alias("sales"),
        F.col("_b.rank_that_day").cast("bigint").alias("rank_that_day"),
    )


def top_children(children: DataFrame, parent: str, order: list[Column], n: int, position: str = "position") -> DataFrame:
    """First ``n`` rows per parent; the rank filter is pushed below the shuffle."""
    w = Window.partitionBy(parent).orderBy(*order)
    return children.withColumn(position, F.row_number().over(w)).where(F.col(position) <= n).withColumn(
        position, F.col(position).cast("bigint"))


def region_of_order(orders: DataFrame, customers: DataFrame, stores: DataFrame) -> DataFrame:
    """Store orders take the store's region, others the region of any store in the customer's country."""
    country_region = stores.groupBy("country").agg(F.min("region").alias("_country_region"))
    by_store = stores.select("store_id", F.col("region").alias("_store_region"))
    placed = orders.join(customers.select("customer_id", "country"), "customer_id", "left")
    return (
        left_join_sparse(placed, by_store, "store_id", "order_id")
        .join(country_region, "country", "left")
        .withColumn("sales_region", F.when(F.col("channel") == "Store", F.col("_store_region"))
                    .otherwise(F.col("_country_region")))
        .drop("_store_region", "_country_region", "country")
    )


def net_sales_reconciliation(orders: DataFrame, lines: DataFrame, excluded: str = "Cancelled", returned: str = "Returned") -> DataFrame:
    """Order counts and unrounded net sales in total and by region, with and without returned orders."""
    net = lines.groupBy("order_id").agg(F.sum(line_net()).alias("net"), F.count(F.lit(1)).alias("lines"))
    joined = orders.select("order_id", "sales_region", "status").join(net, "order_id", "left")
    valid = F.col("status") != excluded
    kept = valid & (F.col("status") != returned)
    by_region = joined.groupBy("sales_region").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("lines").alias("lines"),
        F.count_if(valid).alias("valid_orders"),
        F.sum(F.when(valid, F.col("net"))).alias("valid_net"),
        F.sum(F.when(kept, F.col("net"))).alias("kept_net"),
    )
    scopes = by_region.select(
        F.explode(F.array(F.lit("all"), F.concat(F.lit("region:"), F.coalesce("sales_region", F.lit("none"))))).alias("scope"),
        "orders", "lines", "valid_orders", "valid_net", "kept_net",
    )
    return scopes.groupBy("scope").agg(
        F.sum("orders").cast("bigint").alias("orders"),
        F.coalesce(F.sum("lines"), F.lit(0)).cast("bigint").alias("lines"),
        F.sum("valid_orders").cast("bigint").alias("orders_excluding_cancelled"),
        F.sum("valid_net").cast("decimal(24,2)").alias("net_excluding_cancelled"),
        F.sum("kept_net").cast("decimal(24,2)").alias("net_excluding_cancelled_and_returned"),
    )


def exact_discrepancy(expected: Column, actual: Column) -> Column:
    """NULL-safe difference flag used by reconciliation checks."""
    return ~expected.eqNullSafe(actual)
