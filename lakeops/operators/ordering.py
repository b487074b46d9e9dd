"""Batch order entry and status changes with coded rejects."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.scalars import is_json_array
from lakeops.operators.skew import left_join_sparse, numbered
from lakeops.session import materialize

# Reject codes.
NOT_JSON, UNKNOWN_CUSTOMER, BAD_PRODUCT = 50010, 50011, 50012
NOT_FOUND, BAD_TRANSITION, STALE_VERSION = 50020, 50021, 50022
CHECK_VIOLATION, NULL_VIOLATION = 547, 515

# Discount per loyalty tier and allowed status changes.
TIER_DISCOUNT = {"Gold": "0.10", "Silver": "0.05"}
TRANSITIONS = {"Placed": ("Shipped", "Cancelled"), "Shipped": ("Delivered",), "Delivered": ("Returned",)}


def allowed(current: Column, wanted: Column) -> Column:
    result = F.lit(False)
    for status, targets in TRANSITIONS.items():
        result = result | ((current == status) & wanted.isin(*targets))
    return F.coalesce(result, F.lit(False))


def check_transitions(requests: DataFrame, orders: DataFrame) -> DataFrame:
    """Reject code per request (NULL when accepted): not found, then transition, then stale version.

    Several requests may name one order. The first valid one is applied; it changes the version,
    so later ones are judged against its status and can only fail.
    """
    joined = requests.join(orders.select("order_id", "status", "row_ver"), "order_id", "left")
    fits = allowed(F.col("status"), F.col("new_status")) & (F.col("expected_ver") == F.col("row_ver"))
    valid = joined.withColumn("_valid", F.coalesce(fits, F.lit(False)))
    first = valid.where("_valid").groupBy("order_id").agg(
        F.min("request_id").alias("_first"), F.min_by("new_status", "request_id").alias("_after"))
    judged = valid.join(first, "order_id", "left").withColumn(
        "_now", F.when(F.col("request_id") > F.col("_first"), F.col("_after")).otherwise(F.col("status")))
    code = (
        F.when(F.col("status").isNull(), NOT_FOUND)
        .when(F.col("request_id") == F.col("_first"), F.lit(None))
        .when(~allowed(F.col("_now"), F.col("new_status")), BAD_TRANSITION)
        .otherwise(STALE_VERSION)
    )
    return judged.select("request_id", "order_id", "new_status", code.alias("code"))


def apply_transitions(orders: DataFrame, checked: DataFrame, now: Column, next_version: int) -> DataFrame:
    """New order state with accepted status changes."""
    accepted = checked.where(F.col("code").isNull()).select("order_id", F.col("new_status").alias("_status"))
    joined = orders.join(accepted, "order_id", "left")
    hit = F.col("_status").isNotNull()
    return joined.select(*[
        F.when(hit, F.col("_status")).otherwise(F.col(c)).alias(c) if c == "status"
        else F.when(hit, now).otherwise(F.col(c)).alias(c) if c == "modified_at"
        else F.when(hit, F.lit(next_version).cast("bigint")).otherwise(F.col(c)).alias(c) if c == "row_ver"
        else F.col(c) for c in orders.columns])


def channel_fits() -> Column:
    """A known channel, and a store exactly for orders in a store; an unknown value breaks the rule."""
    in_store = (F.col("channel") == "Store") & F.col("store_id").isNotNull()
    return F.coalesce(in_store | ((F.col("channel") == "Online") & F.col("store_id").isNull()), F.lit(False))


class PlacedOrders(NamedTuple):
    """Result of a batch: new headers, new lines, coded rejects, and logged constraint failures."""

    orders: DataFrame
    lines: DataFrame
    rejects: DataFrame
    error_log: DataFrame


def place_orders(requests: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame, max_order_id: int) -> PlacedOrders:
    """Turn order requests (one JSON array of lines each) into orders, all or nothing per request.

    Coded validation (bad JSON, customer, product) only rejects. Constraint failures (quantity,
    channel and store, missing region) are rejected and go to the error log as well. Judged requests and priced items
    are written once, because all four results read them.
    """
    country_region = stores.groupBy("country").agg(F.min("region").alias("_country_region"))
    by_store = stores.select("store_id", F.col("region").alias("_store_region"))
    asked = requests.join(customers.select("customer_id", "country", "loyalty_tier", F.lit(True).alias("_known")), "customer_id", "left")
    known = (
        left_join_sparse(asked, by_store, "store_id", "request_id").join(country_region, "country", "left")
        .withColumn("sales_region", F.when(F.col("channel") == "Store", F.col("_store_region")).otherwise(F.col("_country_region")))
        .withColumn("_array", F.coalesce(is_json_array(F.col("lines")), F.lit(False)))
        .drop("_store_region", "_country_region", "country")
    )
    parsed = F.from_json("lines", "array<struct<productId: int, qty: int>>")
    items = requests.where(F.coalesce(is_json_array(F.col("lines")), F.lit(False))).select(
        "request_id", F.posexplode(parsed).alias("_pos", "_l")
    ).select("request_id", (F.col("_pos") + 1).alias("line_number"),
             F.col("_l.productId").cast("bigint").alias("product_id"), F.col("_l.qty").alias("quantity"))
    priced = materialize(items.join(products.select("product_id", "list_price", "is_active"), "product_id", "left"), "priced_items")
    faults = priced.groupBy("request_id").agg(
        F.max(F.coalesce(~F.col("is_active"), F.lit(True))).alias("_bad_product"),
        F.max(F.col("quantity").isNull()).alias("_no_quantity"),
        F.max(F.coalesce(F.col("quantity") <= 0, F.lit(False))).alias("_bad_quantity"),
    )
    judged = materialize(known.join(faults, "request_id", "left").withColumn(
        "code",
        F.when(~F.col("_array"), NOT_JSON)
        .when(F.col("_known").isNull(), UNKNOWN_CUSTOMER)
        .when(F.col("_bad_product"), BAD_PRODUCT)
        .when(F.col("sales_region").isNull() | F.col("_no_quantity"), NULL_VIOLATION)
        .when(F.col("_bad_quantity") | ~channel_fits(), CHECK_VIOLATION),
    ).withColumn("_channel_fits", channel_fits()).drop("lines"), "judged_requests")
    accepted = numbered(judged.where(F.col("code").isNull()), "request_id", "_n").withColumn(
        "order_id", F.col("_n") + F.lit(max_order_id))
    headers = accepted.select(
        "order_id", "request_id", "customer_id", "store_id", "channel", "sales_region", F.lit("Placed").alias("status"))
    discount = F.lit("0")
    for tier, value in TIER_DISCOUNT.items():
        discount = F.when(F.col("loyalty_tier") == tier, value).otherwise(discount)
    lines = priced.join(accepted.select("request_id", "order_id", "loyalty_tier"), "request_id").select(
        "order_id", "line_number", "product_id", "quantity", F.col("list_price").alias("unit_price"),
        discount.cast("decimal(4,2)").alias("discount_pct"),
    ).withColumn("line_total", (F.col("quantity") * F.col("unit_price") * (1 - F.col("discount_pct"))).cast("decimal(12,2)"))
    rejects = judged.where(F.col("code").isNotNull()).select("request_id", "code")
    message = (
        F.when((F.col("code") == CHECK_VIOLATION) & F.col("_bad_quantity"), "quantity must be positive")
        .when(F.col("code") == CHECK_VIOLATION, "channel and store do not fit").otherwise("a required value is missing")
    )
    error_log = judged.where(F.col("code").isin(CHECK_VIOLATION, NULL_VIOLATION)).select(
        "request_id", F.lit("place_orders").alias("procedure_name"), F.col("code").alias("error_number"), message.alias("error_message"))
    return PlacedOrders(headers, lines, rejects, error_log)
