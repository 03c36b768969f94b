"""Lookups between record sets: identifiers, membership, delisting, staleness, routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.timeseries import latest_per_key

REJECTS = "rejects"


def unique_lookup(mapping: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """A mapping with one row per key, the last written; a join would multiply rows instead."""
    return latest_per_key(mapping.where(F.col(key).isNotNull()), [key], order)


def one_per_key(mapping: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) with one row per key: of several values the greatest that isn't empty; map-side combined.

    Vendors list a ticker twice, or reuse it, so a lookup by ticker needs this, or its rows multiply.
    """
    return mapping.where(F.col(key).isNotNull() & (F.coalesce(F.col(value).cast("string"), F.lit("")) != "")).groupBy(key).agg(F.max(value).alias(value))


def enrich_left(df: DataFrame, mapping: DataFrame, key: str, value: str, missing: object = "") -> DataFrame:
    """``df`` with ``value`` looked up by ``key``; unmatched rows get ``missing``. ``mapping`` is unique by key."""
    return df.join(mapping.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(missing)))


def enrich_inner(df: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` with ``value`` looked up by ``key``; unmatched rows are dropped."""
    return df.join(mapping.select(key, value), key)


def member_flag(df: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """``df`` with a boolean ``flag``: the key is in ``members``."""
    return df.join(members.select(key).distinct().withColumn(flag, F.lit(True)), key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def disappeared(stored: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose key is not among the current ones."""
    return stored.join(current.select(*keys), list(keys), "left_anti")


def confirmed(candidates: DataFrame, confirmation: DataFrame, keys: Sequence[str], overwrite: Sequence[str]) -> DataFrame:
    """Candidates that the confirmation set holds, with ``overwrite`` taken from there."""
    fresh = confirmation.select(*keys, *[F.col(c).alias(f"__q_{c}") for c in overwrite])
    kept = [F.col(f"__q_{c}").alias(c) if c in overwrite else F.col(c) for c in candidates.columns]
    return candidates.join(fresh, list(keys)).select(*kept)


def silent(candidates: DataFrame, confirmed_keys: DataFrame, keys: Sequence[str], last_seen: str, as_of: Column, days: int = 14) -> DataFrame:
    """Unconfirmed candidates that have been silent for more than ``days`` before ``as_of``."""
    left = candidates.join(confirmed_keys.select(*keys), list(keys), "left_anti")
    return left.where(F.datediff(as_of, F.col(last_seen)) > days)


def delisted(stored: DataFrame, current: DataFrame, proof: DataFrame, keys: Sequence[str], as_of: Column, last_seen: str = "last_updated", days: int = 14) -> DataFrame:
    """Stored rows that are gone, as they are to be written back: ``active`` false and ``delisted`` set.

    A stored active row is gone if ``current`` lacks its key and either the vendor's list of delisted assets (``proof``: keys
    and ``delisted``) has it, or it hasn't been seen for more than ``days`` before ``as_of``. The day of delisting is the
    vendor's, else the day it was last seen. All other rows, and rows with a null key, are left as they are and not returned.
    A key that ``proof`` lists more than once counts with its latest day. Upsert the result by key.
    """
    open_ = disappeared(stored.where(F.coalesce("active", F.lit(False)) & F.col("delisted").isNull()), current, keys)
    for k in keys:
        open_ = open_.where(F.col(k).isNotNull())
    vendor = proof.groupBy(*keys).agg(F.max("delisted").alias("__q_day"), F.lit(True).alias("__q_proof"))
    judged = open_.join(vendor, list(keys), "left")
    silent_ = F.datediff(as_of, F.col(last_seen)) > days
    day = F.coalesce("__q_day", F.col(last_seen)).cast(dict(stored.dtypes)["delisted"])
    gone = judged.where(F.col("__q_proof").isNotNull() | silent_)
    return gone.withColumns({"active": F.lit(False), "delisted": day}).select(*stored.columns)


def new_stale_current(fresh: DataFrame, stored: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """``fresh`` with ``state``: new (key unknown), stale (stored stamp is older or missing), current."""
    known = stored.select(*keys, F.col(stamp).alias("__q_stamp"), F.lit(True).alias("__q_known"))
    return (
        fresh.join(known, list(keys), "left")
        .withColumn(
            "state",
            F.when(F.col("__q_known").isNull(), "new").when(F.col("__q_stamp").isNull() | (F.col("__q_stamp") < F.col(stamp)), "stale").otherwise("current"),
        )
        .drop("__q_stamp", "__q_known")
    )


def refresh_list(states: DataFrame, order: Sequence[Column], limit: int = 100) -> DataFrame:
    """All new rows and the ``limit`` stale ones that come first in ``order``."""
    return states.where("state = 'new'").unionByName(states.where("state = 'stale'").orderBy(*order).limit(limit))


def publish(df: DataFrame, mapping: DataFrame | None, normalize: Column) -> DataFrame:
    """Rows with an identifier, after a lookup for those without; the ticker is normalized on the way out.

    A ticker that the mapping lists more than once counts once (:func:`one_per_key`), so every row stays one row.
    """
    rows = df
    if mapping is not None:
        found = one_per_key(mapping, "ticker", "composite_figi").withColumnRenamed("composite_figi", "__q_figi")
        rows = df.join(found, "ticker", "left").withColumn("composite_figi", F.coalesce(F.nullif("composite_figi", F.lit("")), "__q_figi")).drop("__q_figi")
    return rows.where(F.coalesce(F.col("composite_figi"), F.lit("")) != "").withColumn("ticker", normalize)


def apply_identifiers(assets: DataFrame, found: DataFrame, kind: Column) -> DataFrame:
    """Identifiers and, where unknown, kinds from a mapping answer.

    Only rows without identifier or kind and without a delisting date are touched. ``found`` has one row per
    ticker: ticker, figi, share_class, and the columns that ``kind`` uses.
    """
    open_ = ((F.coalesce("composite_figi", F.lit("")) == "") | (F.col("asset_type") == "Unknown")) & F.col("delisted").isNull() & F.col("figi").isNotNull()
    return assets.join(found, "ticker", "left").select(
        *[
            F.when(open_, F.col("figi")).otherwise(F.col(c)).alias(c) if c == "composite_figi"
            else F.when(open_, F.col("share_class")).otherwise(F.col(c)).alias(c) if c == "share_class_figi"
            else F.when(open_ & (F.col(c) == "Unknown"), F.coalesce(kind, F.col(c))).otherwise(F.col(c)).alias(c) if c == "asset_type"
            else F.col(c)
            for c in assets.columns
        ]
    )


def route(observations: DataFrame, subscriptions: DataFrame, kinds: Mapping[str, str]) -> dict[str, DataFrame]:
    """Observations by kind, and those of unknown subscriptions under ``rejects``.

    ``kinds`` maps a kind to its struct column. Subscriptions have a column subscription_id.
    """
    known = observations.join(subscriptions.select("subscription_id").distinct(), "subscription_id", "left_semi")
    out = {k: known.where(F.col(c).isNotNull()).select(f"{c}.*") for k, c in kinds.items()}
    out[REJECTS] = observations.join(subscriptions.select("subscription_id").distinct(), "subscription_id", "left_anti")
    return out
