"""Masks, column and row policies, write guards and column encryption."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask_columns(df: DataFrame, masks: Mapping[str, Column], unmasked: Sequence[str] = ()) -> DataFrame:
    """Replace masked columns in the result, except those the role may see. Apply it last: filters see clear values."""
    return df.withColumns({name: mask for name, mask in masks.items() if name not in unmasked})


def column_policy(df: DataFrame, denied: Sequence[str]) -> DataFrame:
    """Columns the role may not read are gone, so selecting one fails."""
    return df.drop(*denied)


def row_filter(df: DataFrame, column: str, user: str | None = None, mapping: DataFrame | None = None,
               context: str | None = None, admin: bool = False) -> DataFrame:
    """Rows the caller may see: all for admins, the context region, and regions mapped to the user; else none."""
    if admin:
        return df
    by_context = F.lit(False) if context is None else F.coalesce(F.col(column) == context, F.lit(False))
    if user is None or mapping is None:
        return df.where(by_context)
    allowed = mapping.where(F.col("user_name") == user).select(F.col("region").alias(column)).distinct().withColumn("_ok", F.lit(True))
    return df.join(allowed, column, "left").where(by_context | F.col("_ok")).drop("_ok").select(*df.columns)


def row_policy_claims(df: DataFrame, column: str, role: str, claims: Mapping[str, str], restricted: Sequence[str] = ("sales",),
                      unrestricted: Sequence[str] = ("sales-admin",)) -> DataFrame:
    """Restricted roles see rows whose column equals their region claim; other roles see nothing."""
    if role in unrestricted:
        return df
    if role in restricted and claims.get("region") is not None:
        return df.where(F.col(column) == claims["region"])
    return df.where(F.lit(False))


class Guarded(NamedTuple):
    accepted: DataFrame
    blocked: DataFrame


def write_guard(rows: DataFrame, column: str, region: str) -> Guarded:
    """Split incoming rows into those inside the writer's region and those outside."""
    inside = F.coalesce(F.col(column) == region, F.lit(False))
    return Guarded(rows.where(inside), rows.where(~inside))


def encrypt(text: Column, key: str, row_key: Column) -> Column:
    """AES-GCM ciphertext bound to its row: under another row key it does not decrypt."""
    return F.aes_encrypt(text, F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), row_key.cast("string"))


def decrypt(cipher: Column, key: str | None, row_key: Column) -> Column:
    """Clear text, or NULL without the key or for a ciphertext of another row."""
    if key is None:
        return F.lit(None).cast("string")
    return F.try_aes_decrypt(cipher, F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), row_key.cast("string")).cast("string")
