"""Masking, policies and encryption over customers and orders."""

import secrets

from pyspark.sql import functions as F

from lakeops.functions.scalars import mask_email, mask_partial
from lakeops.operators import governance
from lakeops.operators.sales import order_summary
from lakeops.plans.registry import query
from lakeops.tables import SQL_CUSTOMERS, SQL_ORDERS


def contacts(t):
    """Customers with contact data derived from key and segment; bronze customers have no e-mail."""
    key = F.col("customer_id").cast("string")
    return t.customers.select(
        "customer_id", "customer_name", "region", "loyalty_tier",
        F.when(F.col("loyalty_tier") != "Bronze", F.concat(F.lower("segment"), F.lit("."), key, F.lit("@example.com"))).alias("email"),
        F.when(F.col("loyalty_tier") == "Gold", key).otherwise(F.concat(F.lit("+371 2034 "), key)).alias("phone"))


SQL_CONTACTS = f"""{SQL_CUSTOMERS}, contacts AS (SELECT customer_id, customer_name, region, loyalty_tier,
  CASE WHEN loyalty_tier <> 'Bronze' THEN lower(segment) || '.' || customer_id || '@example.com' END AS email,
  CASE WHEN loyalty_tier = 'Gold' THEN CAST(customer_id AS VARCHAR) ELSE '+371 2034 ' || customer_id END AS phone FROM customers)"""
SQL_MASKED_PHONE = "CASE WHEN length(phone) < 6 THEN 'XXXXXXX' ELSE left(phone, 4) || 'XXXXXXX' || right(phone, 2) END"



def masks():
    return {"email": mask_email(F.col("email")), "phone": mask_partial(F.col("phone"), 4, "XXXXXXX", 2)}


UNMASKED = {"support": ("email",), "admin": ("email", "phone"), "analyst": ()}


@query("mask_columns", f"""WITH {SQL_CONTACTS}
SELECT 'support' AS role, customer_id, email, {SQL_MASKED_PHONE} AS phone FROM contacts
UNION ALL SELECT 'admin', customer_id, email, phone FROM contacts
UNION ALL SELECT 'analyst', customer_id, left(email, 1) || 'XXX@XXXX.com', {SQL_MASKED_PHONE} FROM contacts""")
def mask_columns(t):
    parts = [
        governance.mask_columns(contacts(t).select("customer_id", "email", "phone"), masks(), seen).withColumn("role", F.lit(role))
        for role, seen in UNMASKED.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("column_policy", f"""WITH {SQL_CONTACTS} SELECT customer_id, customer_name, region, loyalty_tier FROM contacts""")
def column_policy(t):
    return governance.column_policy(contacts(t), ["email", "phone"])


@query("masked_inference_check", f"""WITH {SQL_CONTACTS} SELECT customer_id, {SQL_MASKED_PHONE} AS phone FROM contacts WHERE phone LIKE '+371 2034 1%'""")
def masked_inference_check(t):
    found = contacts(t).where(F.col("phone").like("+371 2034 1%")).select("customer_id", "phone")
    return governance.mask_columns(found, {"phone": masks()["phone"]})


def regional_orders(t):
    return t.sales_orders.join(t.customers.select("customer_id", "region"), "customer_id").select("order_id", "region", "order_total")


SQL_REGIONAL = f"""{SQL_CUSTOMERS}, {SQL_ORDERS}, regional AS (SELECT order_id, region, order_total FROM sales_orders JOIN customers USING (customer_id))"""


@query("row_filter", f"""WITH {SQL_REGIONAL}
SELECT 'analyst_asia' AS viewer, region, count(*) AS orders FROM regional WHERE region = 'ASIA' GROUP BY 2
UNION ALL SELECT 'api', region, count(*) FROM regional WHERE region = 'EUROPE' GROUP BY 2
UNION ALL SELECT 'admin', region, count(*) FROM regional GROUP BY 2""")
def row_filter(t):
    mapping = t.spark.sql("SELECT * FROM VALUES ('analyst_asia', 'ASIA'), ('analyst_africa', 'AFRICA') AS m(user_name, region)")
    rows = regional_orders(t)

    def seen(viewer, df):
        return df.groupBy("region").agg(F.count(F.lit(1)).alias("orders")).withColumn("viewer", F.lit(viewer))

    return (
        seen("analyst_asia", governance.row_filter(rows, "region", "analyst_asia", mapping))
        .unionByName(seen("api", governance.row_filter(rows, "region", "api_user", mapping, context="EUROPE")))
        .unionByName(seen("admin", governance.row_filter(rows, "region", admin=True)))
        .unionByName(seen("stranger", governance.row_filter(rows, "region", "stranger", mapping)))
    )


@query("row_policy_claims", f"""WITH {SQL_REGIONAL} SELECT order_id, region, order_total FROM regional WHERE region = 'AMERICA'""")
def row_policy_claims(t):
    summary = order_summary(t.sales_orders, t.customers, t.stores, t.order_lines)
    seen = governance.row_policy_claims(summary, "sales_region", "sales", {"region": "AMERICA"})
    return seen.select("order_id", F.col("sales_region").alias("region")).join(t.sales_orders.select("order_id", "order_total"), "order_id")


@query("write_guard", f"""WITH {SQL_REGIONAL} SELECT order_id, region, region = 'ASIA' AS accepted FROM regional""")
def write_guard(t):
    split = governance.write_guard(regional_orders(t).select("order_id", "region"), "region", "ASIA")
    return split.accepted.withColumn("accepted", F.lit(True)).unionByName(split.blocked.withColumn("accepted", F.lit(False)))


KEY_CONF = "lakeops.encryption.key"


def column_key(spark):
    """The key is a setting of the session, never part of the code; without one a key for this process is made."""
    if not spark.conf.get(KEY_CONF, None):
        spark.conf.set(KEY_CONF, secrets.token_hex(16))
    return spark.conf.get(KEY_CONF)


@query("encrypt_column", """SELECT c_custkey AS customer_id, right('000000' || (c_custkey * 7919), 6) || '-' || (c_custkey % 90000 + 10000) AS national_id,
  CAST(DATE '2026-01-01' - CAST(c_custkey * 37 % 20000 AS INTEGER) - 6570 AS DATE) AS date_of_birth, TRUE AS is_encrypted, CAST(NULL AS VARCHAR) AS without_key, CAST(NULL AS VARCHAR) AS moved
FROM customer""")
def encrypt_column(t):
    key, secret = F.col("c_custkey"), column_key(t.spark)
    text = F.concat(F.right(F.concat(F.lit("000000"), (key * 7919).cast("string")), F.lit(6)), F.lit("-"), (key % 90000 + 10000).cast("string"))
    stored = t.customer.select(
        key.alias("customer_id"), governance.encrypt(text, secret, key).alias("national_id_enc"),
        F.date_sub(F.lit("2026-01-01").cast("date"), (key * 37 % 20000 + 6570).cast("int")).alias("date_of_birth"))
    row = F.col("customer_id")
    return stored.select(
        "customer_id", governance.decrypt(F.col("national_id_enc"), secret, row).alias("national_id"), "date_of_birth",
        (F.octet_length("national_id_enc") > 28).alias("is_encrypted"),
        governance.decrypt(F.col("national_id_enc"), None, row).alias("without_key"),
        governance.decrypt(F.col("national_id_enc"), secret, row + 1).alias("moved"))
