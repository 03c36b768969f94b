"""Calendar, carry-forward, newest-row, change and date-bucket queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.common import table
from quillon.functions.dates import close_time, compact_date, iso_micros, new_york_date, plain_date, stamp_date, until
from quillon.operators.partitions import BUCKET, bucket_start, in_range
from quillon.operators.timeseries import changes_only, latest_per_key, locf, locf_agg, trading_days
from quillon.plans.registry import Registry

R = Registry()

# Holidays of the test calendar.
HOLIDAYS = [("2024-01-01", "NYSE"), ("2024-01-15", "NYSE"), ("2024-01-16", "NASDAQ")]
START, END = "2024-01-01", "2024-01-31"


def holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HOLIDAYS, "event_date string, market string").withColumn("event_date", F.col("event_date").cast("date"))


_DAYS = """
hol as (select * from (values (date '2024-01-01', 'NYSE'), (date '2024-01-15', 'NYSE'), (date '2024-01-16', 'NASDAQ')) h(event_date, market)),
cal as (select g::date as trading_day from generate_series(timestamp '2024-01-01', timestamp '2024-01-31', interval 1 day) t(g)
  where extract(dow from g) between 1 and 5 and g::date not in (select event_date from hol where market = 'NYSE'))"""


@R.add(f"with {_DAYS} select trading_day from cal", name="trading_days")
def trading_days_(spark, d):
    return trading_days(spark, START, END, holidays(spark))



def _daily(spark: SparkSession, d: str, where: str) -> DataFrame:
    """One value per event type and day, the last by time."""
    return (
        table(spark, d, "events")
        .where(where)
        .groupBy(F.col("event_type").alias("series"), F.col("ts").cast("date").alias("trading_day"))
        .agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))
    )


@R.add(
    f"""with {_DAYS},
    s as (select ts::date as trading_day, arg_max(value, (ts, event_id)) as value from events where event_type = 'purchase' and value > 170 group by 1)
    select trading_day, value as raw_value, last_value(value ignore nulls) over (order by trading_day rows between unbounded preceding and current row) as value
    from cal left join s using (trading_day) order by trading_day desc"""
)
def locf_calendar(spark, d):
    """Trading days with one series' value carried forward, newest first."""
    s = _daily(spark, d, "event_type = 'purchase' and value > 170").drop("series")
    cal = trading_days(spark, START, END, holidays(spark))
    return (
        cal.join(s.withColumnRenamed("value", "raw_value"), "trading_day", "left")
        .select("trading_day", "raw_value", locf(F.col("raw_value"), ["trading_day"]).alias("value"))
        .orderBy(F.col("trading_day").desc())
    )


_BY_SERIES = f"""with {_DAYS},
    s as (select event_type as series, ts::date as trading_day, arg_max(value, (ts, event_id)) as value from events where value > 100 group by 1, 2),
    g as (select series, trading_day from (select distinct event_type as series from events), cal)
    select series, trading_day, last_value(value ignore nulls) over (partition by series order by trading_day rows between unbounded preceding and current row) as value
    from g left join s using (series, trading_day)"""


@R.add(_BY_SERIES)
def locf_by_series(spark, d):
    """Every series on every trading day; the calendar is bounded by its date range."""
    cal = trading_days(spark, START, END, holidays(spark))
    names = table(spark, d, "events").select(F.col("event_type").alias("series")).distinct()
    days = F.explode(F.expr(f"sequence(date'{START}', date'{END}', interval 1 day)"))
    grid = names.select("series", days.alias("trading_day")).join(cal, "trading_day", "left_semi")
    return grid.join(_daily(spark, d, "value > 100"), ["series", "trading_day"], "left").select(
        "series", "trading_day", locf(F.col("value"), ["trading_day"], ["series"]).alias("value")
    )


@R.add("select user_id, arg_max(value, (ts, event_id)) filter (where value > 50) as last_value from events group by 1", name="locf_agg")
def locf_agg_(spark, d):
    e = table(spark, d, "events").withColumn("v", F.when(F.col("value") > 50, F.col("value")))
    return e.groupBy("user_id").agg(locf_agg(F.col("v"), F.struct("ts", "event_id")).alias("last_value"))



@R.add(
    """with d as (select user_id, event_type, ts, event_id, case when value > 120 then value end as v from events)
    select event_id, last_value(v ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as per_user,
    last_value(v ignore nulls) over (partition by user_id, event_type order by ts, event_id rows between unbounded preceding and current row) as per_kind
    from d"""
)
def locf_fn(spark, d):
    """Carry-forward per user, and per user and kind."""
    v = F.when(F.col("value") > 120, F.col("value"))
    by = ["ts", "event_id"]
    return table(spark, d, "events").select("event_id", locf(v, by, ["user_id"]).alias("per_user"), locf(v, by, ["user_id", "event_type"]).alias("per_kind"))


@R.add("select event_id, ts, user_id, value from events where event_type = 'purchase' order by ts desc, event_id desc limit 1")
def latest_one(spark, d):
    e = table(spark, d, "events").where(F.col("event_type") == F.lit("purchase"))
    return e.orderBy(F.desc("ts"), F.desc("event_id")).limit(1).select("event_id", "ts", "user_id", "value")


@R.add("select user_id, event_type, event_id, value from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1", name="latest_per_key")
def latest_per_key_(spark, d):
    e = table(spark, d, "events")
    return latest_per_key(e, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "value")



@R.add(
    """with l as (select *, lag(event_type) over w as b, row_number() over w as n from events window w as (partition by user_id order by ts, event_id))
    select event_id, user_id, event_type from l where n = 1 or event_type is distinct from b""", name="changes_only")
def changes_only_(spark, d):
    return changes_only(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


_BUCKET = "case when year({0}) < 1900 then null when year({0}) < 2000 then 1900 when year({0}) < 2005 then 2000 when year({0}) < 2010 then 2005 when year({0}) < 2015 then 2010 else year({0}) - (year({0}) - 2015) % 5 end"


@R.add(f"select {_BUCKET.format('l_shipdate')}::int as bucket_start, year(l_shipdate)::int as y, count(*) as n from lineitem group by 1, 2")
def partition_buckets(spark, d):
    b = table(spark, d, "lineitem")
    return b.groupBy(bucket_start(F.col("l_shipdate")).alias("bucket_start"), F.year("l_shipdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@R.add("select l_orderkey, l_linenumber, l_shipdate::date as shipped from lineitem where l_shipdate::date between date '1999-11-01' and date '2000-02-15'")
def pruned_range(spark, d):
    b = table(spark, d, "lineitem").withColumn("shipped", F.col("l_shipdate").cast("date")).withColumn(BUCKET, bucket_start(F.col("shipped")))
    return in_range(b, "shipped", "1999-11-01", "2000-02-15").select("l_orderkey", "l_linenumber", "shipped")


@R.add("select event_id, ts from events where ts >= timestamp '2024-01-31' - interval 14 day and ts < timestamp '2024-01-31'")
def lookback_14d(spark, d):
    return table(spark, d, "events").where("ts >= timestamp_ntz '2024-01-31 00:00:00' - interval 14 days and ts < timestamp_ntz '2024-01-31 00:00:00'").select("event_id", "ts")


_TEXTS = ["2024-01-02", "2024-13-01", "202403", "20240115", "0", "", "2024-02-30", "2024-01-02T21:30:00.5Z", "x"]


@R.add(
    "with t as (select unnest(["
    + ", ".join(f"'{x}'" for x in _TEXTS)
    + """]) as raw) select raw, case when regexp_full_match(raw, '\\d{4}-\\d{2}-\\d{2}') then try_strptime(raw, '%Y-%m-%d')::date end as plain,
    case when length(raw) >= 10 then try_strptime(raw[1:10], '%Y-%m-%d')::date end as stamped,
    coalesce(case when regexp_full_match(raw, '\\d{8}') then strftime(try_strptime(raw, '%Y%m%d'), '%Y-%m-%d') end,
      case when regexp_full_match(raw, '\\d{6}') then strftime(try_strptime(raw || '01', '%Y%m%d'), '%Y-%m-%d') end, raw) as compact from t"""
)
def date_parse_variants(spark, d):
    t = spark.createDataFrame([(x,) for x in _TEXTS], "raw string")
    c = F.col("raw")
    return t.select("raw", plain_date(c).alias("plain"), stamp_date(c).alias("stamped"), compact_date(c).alias("compact"))


@R.add(
    "with t as (select raw_value as raw from vendor_stamp union all select unnest(["
    + ", ".join(f"'{x}'" for x in _TEXTS)
    + """]) as raw) select raw, case when regexp_full_match(raw, '\\d{4}-\\d{2}-\\d{2}') then try_strptime(raw, '%Y-%m-%d')::date end as plain,
    case when regexp_matches(raw, '^\\d{4}-\\d{2}-\\d{2}') then try_strptime(raw[1:10], '%Y-%m-%d')::date end as stamped,
    coalesce(case when regexp_full_match(raw, '\\d{8}') then strftime(try_strptime(raw, '%Y%m%d'), '%Y-%m-%d') end,
      case when regexp_full_match(raw, '\\d{6}') then strftime(try_strptime(raw || '01', '%Y%m%d'), '%Y-%m-%d') end, raw) as compact from t"""
)
def date_parse_stamps(spark, d):
    """The same parsers over every raw text of vendor_stamp and the literals."""
    t = table(spark, d, "vendor_stamp").select(F.col("raw_value").alias("raw")).unionByName(spark.createDataFrame([(x,) for x in _TEXTS], "raw string"))
    c = F.col("raw")
    return t.select("raw", plain_date(c).alias("plain"), stamp_date(c).alias("stamped"), compact_date(c).alias("compact"))


@R.add(
    """select o_orderkey, (o_orderdate::timestamp at time zone 'UTC' at time zone 'America/New_York')::date as ny_date,
    coalesce(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ'), '') as stamp,
    case when date '2001-07-15' - o_orderdate::date > 30 then strftime(o_orderdate, '%b %Y') else 'present' end as until from orders"""
)
def ny_shift(spark, d):
    o = table(spark, d, "orders")
    c = F.col("o_orderdate")
    return o.select("o_orderkey", new_york_date(c).alias("ny_date"), iso_micros(c).alias("stamp"), until(c.cast("date"), F.lit("2001-07-15").cast("date")).alias("until"))


_CLOSES = ["2024-07-03T17:00:00Z", "2024-11-29T18:00:00.000Z", None, "2024-12-24T13:00:00-05:00"]


@R.add(
    "with t as (select unnest(["
    + ", ".join("null" if x is None else f"'{x}'" for x in _CLOSES)
    + """]) as raw) select raw, coalesce(strftime(raw::timestamptz at time zone 'America/New_York', '%H:%M:%S'), '16:00:00') as close_time from t""", name="close_time")
def close_time_(spark, d):
    t = spark.createDataFrame([(x,) for x in _CLOSES], "raw string")
    return t.select("raw", close_time(F.col("raw")).alias("close_time"))

