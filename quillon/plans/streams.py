"""Streams, exports and the provider registry as queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from quillon.common import clean_key, scratch, table
from quillon.operators.upsert import ParquetStore
from quillon.plans.registry import Registry
from quillon.sinks import export
from quillon.sources.registry import PROVIDERS
from quillon.streaming.ingest import file_stream, merge_stream
from quillon.types import DATA_TYPES

R = Registry()


@R.add("select event_type as series, ts::date as event_date, arg_max(value::float, event_id) as value from events group by 1, 2")
def stream_upsert(spark, d):
    """The events as a stream of files, merged by key batch by batch, then read back."""
    schema = table(spark, d, "events").schema
    stream = file_stream(spark, f"{d}/{{events}}.parquet", schema).select(
        F.col("event_type").alias("series"), F.col("ts").cast("date").alias("event_date"), F.col("value").cast("float").alias("value"), "event_id"
    )
    root = scratch(spark, "stream")
    store = ParquetStore(spark, f"{root}/table", DATA_TYPES["economic-indicator"])
    merge_stream(stream, store, F.col("event_id"), f"{root}/checkpoint").awaitTermination()
    return store.read()


@R.add("select o_orderkey, o_totalprice, o_orderdate, year(o_orderdate)::int as year from orders")
def parquet_export(spark, d):
    """Orders exported below a folder per year and read back."""
    root = scratch(spark, "export")
    export(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"), root, F.year("o_orderdate"))
    return spark.read.parquet(root)


@R.add(
    "select provider, count(*) as datasets, min(start)::date as first_day from (values "
    + ", ".join(f"('{p}', '{x.start}')" for p, ds in PROVIDERS.items() for x in ds.values())
    + ") v(provider, start) group by 1"
)
def provider_registry(spark, d):
    rows = [(p, x.name, x.start) for p, ds in PROVIDERS.items() for x in ds.values()]
    r = spark.createDataFrame(rows, "provider string, dataset string, start string")
    return r.groupBy("provider").agg(F.count(F.lit(1)).alias("datasets"), F.min(F.col("start").cast("date")).alias("first_day"))


_KEY = "upper(nullif(trim(composite_figi, ' ' || chr(9) || chr(10) || chr(13) || chr(160)), ''))"


@R.add(
    f"""select {_KEY} as composite_figi, event_date, close, volume from eod where {_KEY} is not null and event_date between date '2022-06-01' and date '2022-06-30'
    qualify row_number() over (partition by {_KEY}, event_date order by loaded_at desc, eod_id desc) = 1"""
)
def stored_range(spark, d):
    """Prices merged into their bucketed store, then one month read with the bucket predicate."""
    e = table(spark, d, "eod").withColumn("composite_figi", clean_key(F.col("composite_figi")))
    rows = e.where("composite_figi is not null").select(*DATA_TYPES["eod"].schema.names, F.struct("loaded_at", "eod_id").alias("seq"))
    root = scratch(spark, "eod")
    store = ParquetStore(spark, root, replace(DATA_TYPES["eod"], defaults={}))
    store.merge(rows, F.col("seq"))
    return store.read_range("2022-06-01", "2022-06-30").select("composite_figi", "event_date", "close", "volume")
