"""Cleaning of daily extracts: duplicates, late rows, dates, prices, contacts, dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.scalars import EMAIL_PATTERN
from lakeops.operators.skew import latest_per_key, neighbour
from lakeops.operators.temporal import asof_join, validity_intervals
from lakeops.session import materialize

# Date layouts found in the extracts.
ISO_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
SHORT_PATTERN = r"^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}$"
SHORT_FORMAT = "dd/MM/yyyy HH:mm"

# Dialling prefixes by country.
PHONE_PREFIX = {
    "Latvia": "+371", "Lithuania": "+370", "Estonia": "+372", "Finland": "+358", "Sweden": "+46",
    "Norway": "+47", "Germany": "+49", "Poland": "+48", "Austria": "+43",
}


def dedupe_exact(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact copies reduced to one row; copies are merged before the shuffle."""
    return df.dropDuplicates(list(columns) if columns else df.columns)


def upsert_latest_status(rows: DataFrame, key: str = "order_id") -> DataFrame:
    """Newest status per order; the same ``modified_at`` is decided by the later load."""
    return latest_per_key(rows, [key], ["modified_at", "load_date"])


def late_arrival_tag(rows: DataFrame, key: str = "order_id") -> DataFrame:
    """Days late on first arrival: an order is expected the day after it was placed."""
    first = rows.groupBy(key).agg(F.min("load_date").alias("first_load"), F.min(F.to_date("order_date")).alias("order_date"))
    return first.withColumn("days_late", F.datediff("first_load", "order_date") - 1)


def parse_mixed_dates(text: Column) -> tuple[Column, Column]:
    """Timestamp from either layout, and a reason when neither fits."""
    parsed = F.coalesce(
        F.when(text.rlike(ISO_PATTERN), F.try_to_timestamp(text, F.lit(ISO_FORMAT))),
        F.when(text.rlike(SHORT_PATTERN), F.try_to_timestamp(text, F.lit(SHORT_FORMAT))),
    ).cast("timestamp_ntz")
    reason = F.when(text.isNull(), "missing date").when(parsed.isNull(), "unknown date format")
    return parsed, reason


def impute_unit_price(lines: DataFrame, prices: DataFrame, ordered_at: str) -> DataFrame:
    """Fill missing prices with the product price in force on the order date, and flag them.

    A price file is dated one day after the change, so a price counts from ``load_date - 1``. Only
    lines without a price take part in the as-of join.
    """
    versions = prices.select("product_id", F.col("list_price").alias("_price"),
                             (F.col("load_date") - F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz").alias("_since"))
    missing = lines.where(F.col("unit_price").isNull())
    filled = asof_join(missing, versions, ["product_id"], ordered_at, "_since", ["_price"])
    imputed = filled.withColumn("unit_price", F.col("_price")).drop("_price").withColumn("price_imputed", F.col("unit_price").isNotNull())
    return lines.where(F.col("unit_price").isNotNull()).withColumn("price_imputed", F.lit(False)).unionByName(imputed)


class Quarantine(NamedTuple):
    good: DataFrame
    rejected: DataFrame


def quarantine_lines(lines: DataFrame, products: DataFrame) -> Quarantine:
    """Lines with every reason they fail; good lines have none. Nothing is dropped."""
    known = products.select("product_id").withColumn("_known", F.lit(True))
    reasons = F.array_compact(F.array(
        F.when(F.coalesce(F.col("quantity") <= 0, F.lit(True)), "quantity not positive"),
        F.when(F.col("_known").isNull(), "unknown product")))
    judged = lines.join(known, "product_id", "left").withColumn("reasons", reasons).drop("_known")
    return Quarantine(judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0))


def standardize_email(email: Column) -> tuple[Column, Column]:
    """Trimmed lower-case address, and ``ok``, ``missing`` or ``invalid``."""
    clean = F.lower(F.trim(email))
    flag = (
        F.when(F.coalesce(clean, F.lit("")) == "", "missing")
        .when(clean.rlike(f"^{EMAIL_PATTERN}$"), "ok").otherwise("invalid")
    )
    return F.when(flag != "missing", clean), flag


def standardize_country(df: DataFrame, countries: DataFrame, column: str = "country") -> DataFrame:
    """Trim and match by lower case to the official name; unknown names are title-cased and flagged."""
    official = countries.select(F.lower("country").alias("_key"), F.col("country").alias("_official")).distinct()
    return (
        df.withColumn("_key", F.lower(F.trim(F.col(column)))).join(official, "_key", "left")
        .withColumn("country_known", F.col("_official").isNotNull())
        .withColumn(column, F.coalesce("_official", F.initcap(F.trim(F.col(column))))).drop("_key", "_official")
    )


def prefix_of(country: Column, prefixes: dict[str, str] = PHONE_PREFIX) -> Column:
    return F.create_map(*[F.lit(x) for pair in prefixes.items() for x in pair])[country]


def standardize_phone(phone: Column, prefix: Column, local_digits: int = 8) -> Column:
    """E.164 number. Some layouts lost the prefix, so it comes from the country; NULL when too short."""
    digits = F.regexp_replace(phone, "[^0-9]", "")
    return F.when(F.length(digits) >= local_digits, F.concat(prefix, F.right(digits, F.lit(local_digits))))


def inferred_members(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Dimension plus one placeholder per fact key it lacks; a real row replaces the placeholder later."""
    real = dimension.where(~F.col("is_inferred")) if "is_inferred" in dimension.columns else dimension
    missing = facts.select(key).where(F.col(key).isNotNull()).distinct().join(real, key, "left_anti")
    placeholders = missing.withColumn("is_inferred", F.lit(True))
    return real.withColumn("is_inferred", F.lit(False)).unionByName(placeholders, allowMissingColumns=True)


def scd2(changes: DataFrame, key: str, ts: str, tracked: Sequence[str], overwritten: Sequence[str]) -> DataFrame:
    """Type-2 versions where a tracked column changed; overwritten columns carry the newest value everywhere."""
    changes = materialize(changes, "changes")
    before = neighbour(changes, [key], [ts], list(tracked), None, "_before", step=-1)
    differs = F.col("_before").isNull()
    for name in tracked:
        differs = differs | ~F.col(f"_before.{name}").eqNullSafe(F.col(name))
    opened = before.where(differs).select(key, ts, *tracked)
    newest = changes.groupBy(key).agg(*[F.max_by(c, ts).alias(c) for c in overwritten])
    return (
        validity_intervals(opened, [key], ts).drop(ts)
        .withColumn("is_current", F.year("valid_to") == 9999).join(newest, key)
    )


def scd1(changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Newest row per key overwrites older ones."""
    return latest_per_key(changes, [key], order)


class Rule(NamedTuple):
    """A row predicate that must hold; NULL counts as satisfied, as in a CHECK constraint."""

    name: str
    holds: Column


def check_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations of all row rules of a table in one pass."""
    counts = df.agg(*[F.count_if(F.coalesce(~r.holds, F.lit(False))).alias(r.name) for r in rules])
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("violations")) for r in rules])
    return counts.select(F.explode(pairs).alias("_p")).select("_p.*")


def unique_violations(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    repeated = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations")


def reference_violations(df: DataFrame, name: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference has no parent row; NULL references are allowed."""
    orphans = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_k")).join(
        parent.select(F.col(parent_key).alias("_k")), "_k", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations")


def pair_quality(found: DataFrame, truth: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Found and labelled pairs, hits, precision and recall; pairs are given in ascending order."""
    joined = found.select(*columns).distinct().withColumn("_f", F.lit(1)).join(
        truth.select(*columns).distinct().withColumn("_t", F.lit(1)), list(columns), "full")
    hits = F.count_if(F.col("_f").isNotNull() & F.col("_t").isNotNull())
    return joined.agg(F.count("_f").alias("found"), F.count("_t").alias("labelled"), hits.alias("hits")).withColumn(
        "precision", F.round(F.col("hits") / F.nullif(F.col("found"), F.lit(0)), 6)).withColumn(
        "recall", F.round(F.col("hits") / F.nullif(F.col("labelled"), F.lit(0)), 6))


def duplicate_count(rows: DataFrame, name: str) -> DataFrame:
    """How many rows an exact deduplication removes."""
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("found")).select(F.lit(name).alias("issue"), "found")


def compare_with_keys(found: DataFrame, keys: DataFrame) -> DataFrame:
    """``found`` and ``expected`` counts per issue, and whether they are equal; a kind that one side lacks counts 0 there."""
    none = F.lit(0).cast("bigint")
    return found.join(keys, "issue", "full").select(
        "issue", F.coalesce("found", none).alias("found"), F.coalesce("expected", none).alias("expected"),
        (F.coalesce("found", none) == F.coalesce("expected", none)).alias("as_expected"))
