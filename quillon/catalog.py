"""The catalog of subscriptions and its summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.dates import until
from quillon.functions.normalize import table_name

NEVER = "0001-01-01 00:00:00"
SCHEMA = (
    "subscription_id string, name string, provider string, dataset string, data_types array<string>, active boolean, "
    "total_records bigint, total_securities bigint, first_obs timestamp_ntz, last_obs timestamp_ntz, last_run timestamp_ntz"
)


@dataclass(frozen=True)
class Subscription:
    """A provider's dataset that the library keeps, with the record types it delivers."""

    subscription_id: str
    name: str
    provider: str
    dataset: str
    data_types: tuple[str, ...]
    active: bool = True


def as_rows(spark: SparkSession, subscriptions: list[Subscription]) -> DataFrame:
    """A catalog frame of new subscriptions: counters zero, dates unknown."""
    rows = [(s.subscription_id, s.name, s.provider, s.dataset, list(s.data_types), s.active, 0, 0, None, None, None) for s in subscriptions]
    return spark.createDataFrame(rows, SCHEMA)


def add(catalog: DataFrame, more: DataFrame) -> DataFrame:
    """The catalog with new rows; known ids keep their old row."""
    return catalog.unionByName(more.join(catalog.select("subscription_id"), "subscription_id", "left_anti").select(*catalog.columns))


def set_active(catalog: DataFrame, id_: str, active: bool) -> DataFrame:
    return catalog.withColumn("active", F.when(F.col("subscription_id") == id_, F.lit(active)).otherwise(F.col("active")))


def drop(catalog: DataFrame, id_: str) -> DataFrame:
    return catalog.where(F.col("subscription_id") != id_)


def find(catalog: DataFrame, prefix: str) -> DataFrame:
    """The subscription whose id begins with ``prefix``; an error if there are several."""
    hits = catalog.where(F.col("subscription_id").startswith(prefix)).limit(2)
    n = hits.count()
    if n > 1:
        raise ValueError(f"{prefix} is the beginning of several ids")
    return hits


def scan(catalog: DataFrame) -> DataFrame:
    """All subscriptions, unknown timestamps as the year 1."""
    never = F.lit(NEVER).cast("timestamp_ntz")
    return catalog.withColumns({c: F.coalesce(F.col(c), never) for c in ("first_obs", "last_obs", "last_run")})


def tables(catalog: DataFrame) -> DataFrame:
    """(subscription_id, data_type, table_name) of every subscription; types and names are zipped."""
    kinds = catalog.select("subscription_id", "provider", "dataset", F.explode("data_types").alias("data_type"))
    return kinds.select("subscription_id", "data_type", table_name(F.col("provider"), F.col("dataset"), F.col("data_type"), F.col("subscription_id")).alias("table_name"))


def totals(catalog: DataFrame) -> DataFrame:
    """One row: active subscriptions, last run (year 1 if never), total records, total securities."""
    return catalog.agg(
        F.count(F.when(F.col("active"), 1)).alias("active"), F.coalesce(F.max("last_run"), F.lit(NEVER).cast("timestamp_ntz")).alias("last_run"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"), F.coalesce(F.sum("total_securities"), F.lit(0)).alias("total_securities"),
    )


def counters(observations: DataFrame, key: Column, security: Column, day: Column) -> DataFrame:
    """Counters of each subscription from its data: records, securities, first and last day."""
    return observations.groupBy(key.alias("subscription_id")).agg(
        F.count(F.lit(1)).alias("total_records"), F.countDistinct(security).alias("total_securities"), F.min(day).alias("first_obs"), F.max(day).alias("last_obs")
    )


def report(catalog: DataFrame, library: str, as_of: str) -> str:
    """The library's summary as Markdown; the catalog is small by nature (one row per subscription)."""
    t = totals(catalog).first()
    shown = catalog.select(
        "active", "provider", "dataset", F.substring("subscription_id", 1, 6).alias("id"), F.date_format("first_obs", "MMM yyyy").alias("first"),
        until(F.col("last_obs").cast("date"), F.lit(as_of).cast("date")).alias("last"), "data_types",
    ).orderBy("provider", "dataset", "id")
    never = t["last_run"].year == 1
    out = [f"# {library}", "", f"Subscriptions: {t['active']:,}", f"Records: {t['total_records']:,}", f"Securities: {t['total_securities']:,}"]
    out += [f"Last updated: {'never' if never else t['last_run'].strftime('%m/%d/%Y')}", "", "## Subscriptions", ""]
    rows = shown.collect()
    for r in rows:
        if r["active"]:
            out += [f"  * {r['provider']} {r['dataset']} ({r['first'] or '?'} - {r['last']}) [{r['id']}]", *[f"    * {k}" for k in r["data_types"]]]
    out += ["", "## Inactive subscriptions", "", *[f"  * {r['provider']} {r['dataset']} [{r['id']}]" for r in rows if not r["active"]]]
    return "\n".join(out) + "\n"
