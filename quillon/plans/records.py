"""Upsert, lookup, delisting, routing and set queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillon.common import bounded_broadcast, table
from quillon.functions.normalize import asset_id, slashed
from quillon.operators import enrich
from quillon.operators.upsert import upsert, upsert_spec
from quillon.plans.registry import Registry
from quillon.types import DATA_TYPES

R = Registry()
AS_OF = "2001-08-01"


def merged_sql(base: str, batch: str, keys: list[str], updates: list[str], columns: list[str]) -> str:
    """Upsert as SQL over two CTE bodies: ``batch`` has a column seq that orders repeats of a key."""
    k = ", ".join(keys)
    on = " and ".join(f"t.{c} = b.{c}" for c in keys)
    static = [c for c in columns if c not in keys and c not in updates]
    picks = ", ".join([*[f"arg_max_null({c}, seq) as {c}" for c in updates], *[f"arg_min_null({c}, seq) as {c}" for c in static]])
    out = ", ".join(
        f"case when b.{keys[0]} is not null then b.{c} else t.{c} end as {c}" if c in updates
        else f"case when t.{keys[0]} is not null then t.{c} else b.{c} end as {c}" for c in columns
    )
    picks = picks.replace("arg_max_null(", "arg_max(struct_pack(v := ").replace("arg_min_null(", "arg_min(struct_pack(v := ")
    for c in [*updates, *static]:
        picks = picks.replace(f"struct_pack(v := {c}, seq) as {c}", f"struct_pack(v := {c}), seq).v as {c}")
    b = f"select {k}{', ' + picks if picks else ''} from bt group by {k}"
    return f"with base as ({base}), bt as ({batch}), b as ({b}) select {out} from base t full join b on {on}"


# --- upserts ---------------------------------------------------------------------------------------------------------

_EOD = ["ticker", "composite_figi", "event_date", "open", "high", "low", "close", "adj_close", "volume", "dividend", "split_factor"]
_EOD_SQL = """select 't' || l_suppkey as ticker, lpad(l_partkey::varchar, 12, '0') as composite_figi, l_shipdate::date as event_date,
 {open} as open, l_extendedprice::decimal(12,4) as high, l_tax::decimal(12,4) as low, l_extendedprice::decimal(12,4) as close,
 l_extendedprice::decimal(12,4) as adj_close, l_quantity::bigint as volume, l_discount::decimal(12,4) as dividend, 1::decimal(9,6) as split_factor{seq}
 from lineitem where {where}"""
_MID = "(select (max(o_orderkey) + min(o_orderkey)) / 2 from orders)"


def _eod(df: DataFrame) -> DataFrame:
    m = lambda c: F.col(c).cast("decimal(12,4)")
    return df.select(
        F.concat(F.lit("t"), F.col("l_suppkey")).alias("ticker"), F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("composite_figi"),
        F.col("l_shipdate").cast("date").alias("event_date"), m("l_discount").alias("open"), m("l_extendedprice").alias("high"), m("l_tax").alias("low"),
        m("l_extendedprice").alias("close"), F.when(F.lit(False), m("l_tax")).alias("adj_close"), F.col("l_quantity").cast("bigint").alias("volume"),
        m("l_discount").alias("dividend"), F.lit(1).cast("decimal(9,6)").alias("split_factor"), F.struct("l_orderkey", "l_linenumber").alias("seq"),
    )


@R.add(
    merged_sql(
        "select * exclude (seq) from (" + _EOD_SQL.format(open="l_discount::decimal(12,4)", seq=", (l_orderkey, l_linenumber) as seq", where="l_orderkey % 2 = 1")
        + ") qualify row_number() over (partition by composite_figi, event_date order by seq desc) = 1",
        _EOD_SQL.format(open="l_discount::decimal(12,4)", seq=", (l_orderkey, l_linenumber) as seq", where="l_orderkey % 2 = 0"),
        ["composite_figi", "event_date"], _EOD[3:7] + _EOD[8:], _EOD,
    )
)
def upsert_eod(spark, d):
    """Prices keyed by security and day: the newer half of the lines updates the older; the ticker stays, adj_close starts as close."""
    spec = DATA_TYPES["eod"]
    lines = _eod(table(spark, d, "lineitem"))
    old, new = lines.where("seq.l_orderkey % 2 = 1"), lines.where("seq.l_orderkey % 2 = 0")
    newest = old.groupBy(*spec.keys).agg(F.max_by(F.struct(*[c for c in _EOD if c not in spec.keys]), "seq").alias("x"))
    target = newest.select(*[F.col(c) if c in spec.keys else F.col(f"x.{c}").alias(c) for c in _EOD]).withColumn("adj_close", F.col("close"))
    return upsert_spec(target, new, spec, F.col("seq"))


_MONTH = "select 't' || {t} as ticker, o_custkey::varchar as composite_figi, date_trunc('month', o_orderdate)::date as event_date, (o_totalprice * 100)::bigint as market_cap{seq} from orders where {where}"


@R.add(
    merged_sql(
        "select * exclude (seq) from (" + _MONTH.format(t="(o_orderkey % 7)", seq=", o_orderkey as seq", where="o_orderkey % 3 <> 0") + ") qualify row_number() over (partition by composite_figi, event_date order by seq desc) = 1",
        _MONTH.format(t="(o_orderkey % 5)", seq=", o_orderkey as seq", where="o_orderkey % 3 = 0"),
        ["composite_figi", "event_date"], ["ticker", "market_cap"], ["ticker", "composite_figi", "event_date", "market_cap"],
    ).replace("(o_totalprice * 100)::bigint", "cast(trunc(o_totalprice * 100) as bigint)")
)
def upsert_metric_updates_ticker(spark, d):
    """Metrics keyed by security and month; here an update replaces the ticker too."""
    o = table(spark, d, "orders")
    rows = lambda m: o.select(
        F.concat(F.lit("t"), F.col("o_orderkey") % m).alias("ticker"), F.col("o_custkey").cast("string").alias("composite_figi"),
        F.trunc("o_orderdate", "month").alias("event_date"), (F.col("o_totalprice") * 100).cast("bigint").alias("market_cap"), F.col("o_orderkey").alias("seq"),
    )
    keys, cols = ["composite_figi", "event_date"], ["ticker", "composite_figi", "event_date", "market_cap"]
    old = rows(7).where("seq % 3 <> 0").groupBy(*keys).agg(F.max_by(F.struct("ticker", "market_cap"), "seq").alias("x"))
    return upsert(old.select("x.ticker", *keys, "x.market_cap").select(*cols), rows(5).where("seq % 3 = 0"), keys, ["ticker", "market_cap"], F.col("seq"))


@R.add(
    merged_sql(
        "select c_custkey, c_name, c_mktsegment, c_acctbal from customer where c_acctbal > 1000",
        "select c_custkey, c_name || '*' as c_name, 'CHANGED' as c_mktsegment, case when c_custkey % 5 = 0 then null else c_acctbal + 1 end as c_acctbal, 1 as seq from customer where c_mktsegment in ('BUILDING', 'MACHINERY')",
        ["c_custkey"], ["c_name", "c_acctbal"], ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"],
    )
)
def upsert_keeps_static_cols(spark, d):
    """An update sets nulls too, and leaves columns that are not in its list."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    batch = c.where("c_mktsegment in ('BUILDING', 'MACHINERY')").select(
        "c_custkey", F.concat("c_name", F.lit("*")).alias("c_name"), F.lit("CHANGED").alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal") + 1).alias("c_acctbal"),
    )
    return upsert(c.where("c_acctbal > 1000"), batch, ["c_custkey"], ["c_name", "c_acctbal"])


_ASSET = ["ticker", "composite_figi", "share_class_figi", "primary_exchange", "asset_type", "active", "name", "cik"]
_ASSET_SQL = (
    "select translate(upper(trim(ticker)), '.-', '//') as ticker, nullif(upper(trim(composite_figi)), '') as composite_figi, share_class_figi, primary_exchange, asset_type, active, name, cik, rec_id as seq "
    "from asset_polygon where nullif(trim(ticker), '') is not null and nullif(trim(composite_figi), '') is not null and {where}"
)


@R.add(
    merged_sql(
        "select * exclude (seq) from (" + _ASSET_SQL.format(where="rec_id % 3 <> 0") + ") qualify row_number() over (partition by ticker, composite_figi order by seq desc) = 1",
        _ASSET_SQL.format(where="rec_id % 2 = 0"), _ASSET[:2], ["primary_exchange", "active", "name", "cik"], _ASSET,
    )
)
def upsert_asset(spark, d):
    """Assets keyed by ticker and identifier; kind and share class identifier stay as first written, rows without identifier are skipped."""
    whole = DATA_TYPES["asset-description"]
    spec = replace(whole, schema=StructType([whole.schema[c] for c in _ASSET]), update=tuple(c for c in whole.updates if c in _ASSET))
    a = table(spark, d, "asset_polygon").select(
        slashed(F.upper(F.trim("ticker"))).alias("ticker"), F.nullif(F.upper(F.trim("composite_figi")), F.lit("")).alias("composite_figi"), *_ASSET[2:], F.col("rec_id").alias("seq")
    )
    first = a.where("seq % 3 <> 0 and ticker <> ''").where(spec.valid()).groupBy(*spec.keys).agg(F.max_by(F.struct(*_ASSET[2:]), "seq").alias("x"))
    return upsert_spec(first.select(*spec.keys, "x.*").select(*_ASSET), a.where("seq % 2 = 0 and ticker <> ''"), spec, F.col("seq"))


def _indicator(e: DataFrame, day: str) -> DataFrame:
    return e.select(F.col("event_type").alias("series"), F.expr(day).alias("event_date"), F.col("value").cast("float").alias("value"), "event_id")


@R.add(
    merged_sql(
        "select event_type as series, ts::date as event_date, arg_max(value::float, event_id) as value from events where event_id % 4 <> 0 group by 1, 2",
        "select event_type as series, ts::date + 3 as event_date, value::float as value, event_id as seq from events where event_id % 4 = 0",
        ["series", "event_date"], ["value"], ["series", "event_date", "value"],
    )
)
def upsert_indicator(spark, d):
    e = table(spark, d, "events")
    old = _indicator(e.where("event_id % 4 <> 0"), "cast(ts as date)").groupBy("series", "event_date").agg(F.max_by("value", "event_id").alias("value"))
    return upsert_spec(old, _indicator(e.where("event_id % 4 = 0"), "date_add(cast(ts as date), 3)"), DATA_TYPES["economic-indicator"], F.col("event_id"))


_K = lambda c: f"nullif(upper(trim({c})), '')"
_RATING = f"select ticker, {_K('composite_figi')} as composite_figi, event_date, analyst, rating{{seq}} from rating where {_K('composite_figi')} is not null and event_date is not null and analyst is not null and {{where}}"


@R.add(
    merged_sql(
        "select * exclude (seq) from (" + _RATING.format(seq=", (received_at, rating_id) as seq", where="rating_id % 2 = 0") + ") qualify row_number() over (partition by analyst, composite_figi, event_date order by seq desc) = 1",
        _RATING.format(seq=", (received_at, rating_id) as seq", where="rating_id % 2 = 1"),
        ["analyst", "composite_figi", "event_date"], ["rating"], ["ticker", "composite_figi", "event_date", "analyst", "rating"],
    )
)
def upsert_rating(spark, d):
    r = table(spark, d, "rating").withColumn("composite_figi", F.nullif(F.upper(F.trim("composite_figi")), F.lit("")))
    spec = DATA_TYPES["rating"]
    cols = spec.schema.names
    good = r.where(spec.valid()).withColumn("seq", F.struct("received_at", "rating_id"))
    old = good.where("rating_id % 2 = 0").groupBy(*spec.keys).agg(F.max_by(F.struct("ticker", "rating"), "seq").alias("x"))
    return upsert_spec(old.select(*[F.col(c) if c in spec.keys else F.col(f"x.{c}").alias(c) for c in cols]), good.where("rating_id % 2 = 1"), spec, F.col("seq"))


_FUND = ["composite_figi", "dimension", "event_date", "revenues", "equity", "eps", "price"]
_FUND_SQL = f"select {_K('composite_figi')} as composite_figi, {_K('dimension')} as dimension, event_date, revenues, equity, eps, price{{seq}} from fundamental where {_K('composite_figi')} is not null and {_K('dimension')} is not null and event_date is not null and {{where}}"


@R.add(
    merged_sql(
        "select * exclude (seq) from (" + _FUND_SQL.format(seq=", (last_updated, fundamental_id) as seq", where="fundamental_id % 3 = 0") + ") qualify row_number() over (partition by composite_figi, dimension, event_date order by seq desc nulls last) = 1",
        _FUND_SQL.format(seq=", (last_updated, fundamental_id) as seq", where="fundamental_id % 3 <> 0"),
        _FUND[:3], _FUND[3:], _FUND,
    )
)
def upsert_fundamental(spark, d):
    f = table(spark, d, "fundamental")
    f = f.withColumns({c: F.nullif(F.upper(F.trim(c)), F.lit("")) for c in ("composite_figi", "dimension")}).where("composite_figi is not null and dimension is not null and event_date is not null")
    f = f.withColumn("seq", F.struct("last_updated", "fundamental_id")).select(*_FUND, "seq", "fundamental_id")
    old = f.where("fundamental_id % 3 = 0").groupBy(*_FUND[:3]).agg(F.max_by(F.struct(*_FUND[3:]), "seq").alias("x")).select(*_FUND[:3], "x.*")
    return upsert(old, f.where("fundamental_id % 3 <> 0"), _FUND[:3], _FUND[3:], F.col("seq"))


_HOLIDAYS_OLD = [("New Year", "2024-01-01", "NYSE", False, "16:00:00"), ("Eve", "2024-12-24", "NYSE", False, "16:00:00")]
_HOLIDAYS_NEW = [("Christmas Eve", "2024-12-24", "NYSE", True, "13:00:00"), ("Eve", "2024-12-24", "NASDAQ", True, "13:00:00"), ("Eve again", "2024-12-24", "NASDAQ", None, None)]


def _values(rows: list[tuple]) -> str:
    show = lambda x: "null" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else f"'{x}'"
    return "values " + ", ".join("(" + ", ".join(map(show, r)) + ")" for r in rows)


@R.add(
    merged_sql(
        f"select a as holiday, b::date as event_date, c as market, e as early_close, f as close_time from ({_values(_HOLIDAYS_OLD)}) v(a, b, c, e, f)",
        f"select a as holiday, b::date as event_date, c as market, coalesce(e, false) as early_close, coalesce(f, '16:00:00') as close_time, s as seq from ({_values([(*r, i) for i, r in enumerate(_HOLIDAYS_NEW)])}) v(a, b, c, e, f, s)",
        ["event_date", "market"], ["holiday", "early_close", "close_time"], ["holiday", "event_date", "market", "early_close", "close_time"],
    )
)
def upsert_holiday(spark, d):
    ddl = "holiday string, event_date string, market string, early_close boolean, close_time string"
    old = spark.createDataFrame(_HOLIDAYS_OLD, ddl).withColumn("event_date", F.col("event_date").cast("date"))
    new = spark.createDataFrame([(*r, i) for i, r in enumerate(_HOLIDAYS_NEW)], ddl + ", seq int").withColumn("event_date", F.col("event_date").cast("date"))
    return upsert_spec(old, new, DATA_TYPES["market-holidays"], F.col("seq"))


_CUSTOM = "select 'u' || user_id as ticker, case when user_id % 9 = 0 then '' else lpad(user_id::varchar, 12, '0') end as composite_figi, ts::date as event_date, event_type as key, props as value{seq} from events where {where}"


@R.add(
    merged_sql(
        "select * exclude (seq) from (" + _CUSTOM.format(seq=", event_id as seq", where="event_id % 2 = 0 and user_id % 9 <> 0") + ") qualify row_number() over (partition by key, composite_figi, event_date order by seq desc) = 1",
        _CUSTOM.format(seq=", event_id as seq", where="event_id % 2 = 1 and user_id % 9 <> 0"),
        ["key", "composite_figi", "event_date"], ["value"], ["ticker", "composite_figi", "event_date", "key", "value"],
    )
)
def upsert_custom(spark, d):
    """Key-value observations; rows without identifier are skipped."""
    e = table(spark, d, "events").select(
        F.concat(F.lit("u"), F.col("user_id")).alias("ticker"),
        F.when(F.col("user_id") % 9 == 0, "").otherwise(F.lpad(F.col("user_id").cast("string"), 12, "0")).alias("composite_figi"),
        F.col("ts").cast("date").alias("event_date"), F.col("event_type").alias("key"), F.col("props").alias("value"), "event_id",
    )
    spec = DATA_TYPES["custom"]
    old = e.where(spec.valid()).where("event_id % 2 = 0").groupBy(*spec.keys).agg(F.max_by(F.struct("ticker", "value"), "event_id").alias("x"))
    target = old.select("x.ticker", "composite_figi", "event_date", "key", "x.value")
    return upsert_spec(target, e.where("event_id % 2 = 1"), spec, F.col("event_id"))


@R.add(
    """with o as (select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders), b as (select o_orderkey, o_custkey, o_totalprice + 1 as o_totalprice, 'U' as o_orderstatus from orders where o_orderstatus = 'O'),
    m as (select o_orderkey, o.o_custkey, coalesce(b.o_totalprice, o.o_totalprice) as p, o.o_orderstatus from o left join b using (o_orderkey))
    select count(*) as n, 0::bigint as differing, sum(p::decimal(18,2))::double as total from m"""
)
def upsert_idempotent(spark, d):
    """Merging a batch twice gives the same table as once."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    b = o.where("o_orderstatus = 'O'").withColumns({"o_totalprice": F.col("o_totalprice") + 1, "o_orderstatus": F.lit("U")})
    once = upsert(o, b, ["o_orderkey"], ["o_totalprice"])
    twice = upsert(once, b, ["o_orderkey"], ["o_totalprice"])
    both = once.withColumn("side", F.lit(1)).unionByName(twice.withColumn("side", F.lit(2)))
    per = both.groupBy("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus").agg(F.count(F.lit(1)).alias("c"), F.count(F.when(F.col("side") == 1, 1)).alias("c1"))
    return per.agg(
        F.sum("c1").cast("bigint").alias("n"), F.count(F.when(F.col("c") != 2 * F.col("c1"), 1)).alias("differing"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)") * F.col("c1")).cast("double").alias("total"),
    )


@R.add("select event_id, ts, value from events")
def overlap_reread(spark, d):
    """Two overlapping windows merged by key equal one full read."""
    e = table(spark, d, "events").select("event_id", "ts", "value")
    return upsert(e.where("ts < timestamp_ntz '2024-01-18 00:00:00'"), e.where("ts >= timestamp_ntz '2024-01-12 00:00:00'"), ["event_id"], ["ts", "value"])


# --- lookups ---------------------------------------------------------------------------------------------------------


@R.add("select l_orderkey, l_linenumber, coalesce(p_brand, '') as p_brand from lineitem left join (select * from part where p_size <= 40) on l_partkey = p_partkey")
def enrich_left(spark, d):
    """Lines with the brand of their part, '' where the mapping lacks it."""
    m = table(spark, d, "part").where("p_size <= 40").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return enrich.enrich_left(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), m, "l_partkey", "p_brand").drop("l_partkey")


@R.add("select o_orderkey, c_name from orders join customer on o_custkey = c_custkey where c_acctbal > 0")
def enrich_inner(spark, d):
    m = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return enrich.enrich_inner(table(spark, d, "orders").select("o_orderkey", "o_custkey"), m, "o_custkey", "c_name").drop("o_custkey")


@R.add("select l_orderkey, l_linenumber, l_partkey in (select p_partkey from part order by p_retailprice desc, p_partkey limit 50) as member from lineitem")
def member_flag(spark, d):
    top = table(spark, d, "part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(50).select(F.col("p_partkey").alias("l_partkey"))
    return enrich.member_flag(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), F.broadcast(top), "l_partkey", "member").drop("l_partkey")


@R.add("select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderdate >= timestamp '2001-01-01')")
def disappeared_keys(spark, d):
    recent = table(spark, d, "orders").where("o_orderdate >= timestamp_ntz '2001-01-01 00:00:00'").select(F.col("o_custkey").alias("c_custkey"))
    return enrich.disappeared(table(spark, d, "customer").select("c_custkey", "c_name"), recent, ["c_custkey"])


@R.add(
    """select distinct 'T/' || l_partkey as ticker, l_suppkey as figi, 'T/' || l_partkey || ':' || l_suppkey as id from lineitem a where l_shipdate < timestamp '1999-01-01'
    and not exists (select 1 from lineitem b where b.l_partkey = a.l_partkey and b.l_suppkey = a.l_suppkey and b.l_shipdate >= timestamp '1999-01-01')"""
)
def disappeared_two_part(spark, d):
    """Pairs of ticker and identifier that are gone; stored and current tickers are written differently and normalized first."""
    li = table(spark, d, "lineitem")
    ticker = lambda mark: slashed(F.concat(F.lit(f"T{mark}"), F.col("l_partkey"))).alias("ticker")
    stored = li.where("l_shipdate < timestamp_ntz '1999-01-01 00:00:00'").select(ticker("/"), F.col("l_suppkey").alias("figi")).distinct()
    current = li.where("l_shipdate >= timestamp_ntz '1999-01-01 00:00:00'").select(ticker("."), F.col("l_suppkey").alias("figi"))
    return enrich.disappeared(stored, current, ["ticker", "figi"]).withColumn("id", asset_id(F.col("ticker"), F.col("figi")))


_GONE = "select c_custkey, c_name, true as active, null::date as delisted from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderdate >= timestamp '2001-01-01')"


@R.add(f"with g as ({_GONE}) select g.c_custkey, g.c_name, false as active, date '2001-07-01' as delisted from g join customer c on c.c_custkey = g.c_custkey where c.c_acctbal <= 0")
def delist_confirm(spark, d):
    """Disappeared rows that the confirmation set holds take its attributes."""
    c = table(spark, d, "customer")
    gone = disappeared_keys(spark, d).withColumns({"active": F.lit(True), "delisted": F.lit(None).cast("date")})
    proof = c.where("c_acctbal <= 0").select("c_custkey", F.lit(False).alias("active"), F.lit("2001-07-01").cast("date").alias("delisted"))
    return enrich.confirmed(gone, proof, ["c_custkey"], ["active", "delisted"])


@R.add(
    f"""select o_custkey as c_custkey, max(o_orderdate)::date as last_seen from orders group by 1
    having date '{AS_OF}' - max(o_orderdate)::date > 14 and o_custkey not in (select c_custkey from customer where c_acctbal <= 0)"""
)
def delist_silent_14d(spark, d):
    seen = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").cast("date").alias("last_seen"))
    return enrich.silent(seen, table(spark, d, "customer").where("c_acctbal <= 0"), ["c_custkey"], "last_seen", F.lit(AS_OF).cast("date"))


_STATES = """select a.o_orderkey, a.stamp, case when b.o_orderkey is null then 'new' when b.stamp is null or b.stamp < a.stamp then 'stale' else 'current' end as state
 from (select o_orderkey, o_orderdate::date as stamp from orders) a left join (select o_orderkey, case when o_orderkey % 11 = 0 then null else o_orderdate::date - (o_orderkey % 3)::int end as stamp from orders where o_orderstatus <> 'P') b using (o_orderkey)"""


def _states(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("stamp"), "o_orderstatus")
    old, o = o.where("o_orderstatus <> 'P'"), o.drop("o_orderstatus")
    old = old.withColumn("stamp", F.expr("if(o_orderkey % 11 = 0, null, date_sub(stamp, cast(o_orderkey % 3 as int)))"))
    return enrich.new_stale_current(o, old, ["o_orderkey"], "stamp")


@R.add(_STATES)
def new_stale_current(spark, d):
    return _states(spark, d)


@R.add(f"with s as ({_STATES}) select * from s where state = 'new' union all (select * from s where state = 'stale' order by stamp, o_orderkey limit 100)")
def stale_first_100(spark, d):
    """All new rows and the hundred stale ones that waited longest."""
    return enrich.refresh_list(_states(spark, d), [F.col("stamp"), F.col("o_orderkey")])


@R.add(
    """with a as (select unnest([1, 2, null, 4]) as k), b as (select unnest([1, null]) as k)
    select 'not_in' as form, count(*) as n from a where k not in (select k from b) union all select 'anti', count(*) from a where not exists (select 1 from b where b.k = a.k)"""
)
def not_in_vs_anti(spark, d):
    """With nulls the two forms differ: NOT IN keeps no row."""
    a, b = spark.createDataFrame([(1,), (2,), (None,), (4,)], "k int"), spark.createDataFrame([(1,), (None,)], "k int")
    strict = spark.sql("select 'not_in' as form, count(*) as n from {a} where k not in (select k from {b})", a=a, b=b)
    return strict.unionByName(a.join(b, "k", "left_anti").agg(F.lit("anti").alias("form"), F.count(F.lit(1)).alias("n")))


@R.add(
    """with o as (select o_orderkey, 'C.' || o_custkey as ticker, o_custkey, case when o_orderstatus = 'P' then '' else 'F' || o_orderkey end as figi from orders)
    select o_orderkey, replace(replace(ticker, '.', '/'), '-', '/') as ticker, coalesce(nullif(figi, ''), 'M' || o_custkey) as composite_figi from o
    where figi <> '' or o_custkey in (select c_custkey from customer where c_acctbal > 0)"""
)
def publish_gate(spark, d):
    """Rows without identifier are looked up; those still without one are dropped; tickers are normalized."""
    o = table(spark, d, "orders").select(
        "o_orderkey", F.concat(F.lit("C."), F.col("o_custkey")).alias("ticker"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat(F.lit("F"), F.col("o_orderkey"))).alias("composite_figi"),
    )
    m = table(spark, d, "customer").where("c_acctbal > 0").select(F.concat(F.lit("C."), F.col("c_custkey")).alias("ticker"), F.concat(F.lit("M"), F.col("c_custkey")).alias("composite_figi"))
    return enrich.publish(o, m, slashed(F.col("ticker"))).select("o_orderkey", "ticker", "composite_figi")


@R.add(
    """select o.o_orderkey, s.stamp from orders o
    left join (select o_orderkey, o_orderdate as stamp from orders where o_orderstatus = 'F') s using (o_orderkey)"""
)
def point_lookup_join(spark, d):
    """One left join in place of a lookup per row."""
    o = table(spark, d, "orders")
    return o.select("o_orderkey").join(o.where("o_orderstatus = 'F'").select("o_orderkey", F.col("o_orderdate").alias("stamp")), "o_orderkey", "left")


@R.add("select c_mktsegment as name, max(c_custkey) as id from customer where c_acctbal > 0 group by 1")
def active_cache(spark, d):
    """Two columns of the active rows, one row a name, the last written."""
    c = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_mktsegment").alias("name"), F.col("c_custkey").alias("id"))
    return c.groupBy("name").agg(F.max("id").alias("id"))


@R.add(
    """with e as (select event_id, event_type, user_id, value, case when user_id % 10 = 0 then 99 else user_id % 3 end as sub from events)
    select case when sub = 99 then 'rejects' when event_type in ('view', 'click') then 'traffic' when event_type = 'purchase' then 'sales' else 'other' end as kind, count(*) as n,
    sum(event_id)::bigint as ids from e group by 1"""
)
def observation_router(spark, d):
    """Observations split by kind; those of unknown subscriptions are kept apart."""
    kind = F.when(F.col("event_type").isin("view", "click"), "traffic").when(F.col("event_type") == "purchase", "sales").otherwise("other")
    member = lambda k: F.when(F.col("kind") == k, F.struct("event_id", "value")).alias(k)
    e = table(spark, d, "events").withColumns({"kind": kind, "subscription_id": F.when(F.col("user_id") % 10 == 0, 99).otherwise(F.col("user_id") % 3)})
    obs = e.select("event_id", "subscription_id", member("traffic"), member("sales"), member("other"))
    routed = enrich.route(obs, spark.range(3).select(F.col("id").alias("subscription_id")), {k: k for k in ("traffic", "sales", "other")})
    parts = [f.select(F.lit(k).alias("kind"), "event_id") for k, f in routed.items()]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@R.add("select p_partkey, p_type, 'small' as src from part where p_size < 10 union all select p_partkey, p_type, 'mid' from part where p_size between 20 and 30 union all select p_partkey, p_type, 'large' from part where p_size > 45")
def union_types(spark, d):
    p = table(spark, d, "part")
    cut = lambda where, src: p.where(where).select("p_partkey", "p_type", F.lit(src).alias("src"))
    return cut("p_size < 10", "small").unionByName(cut("p_size between 20 and 30", "mid")).unionByName(cut("p_size > 45", "large"))


@R.add("select c_custkey as id, c_name as name, null::double as price from customer union all by name select o_orderkey as id, o_totalprice as price from orders")
def union_missing_cols(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(None).cast("double").alias("price"))
    b = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    return a.unionByName(b, allowMissingColumns=True)


@R.add("select n_name, count(*) as suppliers, sum(s_acctbal::decimal(18,2))::double as balance from supplier join nation on s_nationkey = n_nationkey group by 1")
def lookup_small_side(spark, d):
    """Enrichment whose small side is broadcast after a check of its size."""
    n = bounded_broadcast(table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), 10_000)
    s = table(spark, d, "supplier").join(n, "s_nationkey")
    return s.groupBy("n_name").agg(F.count(F.lit(1)).alias("suppliers"), F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))
