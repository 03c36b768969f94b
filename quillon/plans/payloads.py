"""Queries of the payload readers: tables are written as vendor payloads and read back by the reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.common import clean_key, scratch, table
from quillon.functions import normalize as nz
from quillon.operators import enrich
from quillon.operators.timeseries import changes_against
from quillon.operators.upsert import ParquetStore, upsert
from quillon.plans.registry import Registry
from quillon.sinks import write_files
from quillon.sources import readers as rd
from quillon.sources.layouts import FUNDAMENTAL, TICKERS
from quillon.sources.paged import register
from quillon.types import DATA_TYPES

R = Registry()

#: Rows of a payload file.
PAGE = 200


def _files(spark: SparkSession, name: str, files: DataFrame) -> str:
    """The folder of written (name, content) files."""
    root = scratch(spark, name)
    write_files(files, root)
    return root


def _pages(rows: DataFrame, key: Column, content: Column, pattern: str = "page-%d.json") -> DataFrame:
    """(name, content) of files with about ``PAGE`` rows each; ``content`` aggregates a page's rows."""
    pages = F.expr(f"{max(1, rows.count() // PAGE)}")
    numbered = rows.withColumn("__page", F.pmod(F.xxhash64(key), pages))
    return numbered.groupBy("__page").agg(content.alias("content")).select(F.format_string(pattern, F.col("__page")).alias("name"), "content")


def _body(field: str, rows: Column) -> Column:
    return F.to_json(F.struct(F.collect_list(rows).alias(field)))


def _datatable(rows: DataFrame, key: Column, positions: list[Column]) -> DataFrame:
    """Datatable files: rows of positions as texts, nulls kept."""
    x = F.array(*[p.cast("string") for p in positions])
    return _pages(rows, key, F.to_json(F.struct(F.struct(F.collect_list(x).alias("data")).alias("datatable")), {"ignoreNullFields": "false"}))


_K = lambda c: f"upper(nullif(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(8199) || chr(8239)), ''))"
_SLASH = lambda c: f"translate({c}, '.-', '//')"
_MAPPED = lambda c, m, default: f"case {c} " + " ".join(f"when '{k}' then '{v}'" for k, v in m.items()) + f" else '{default}' end"
_FIGIS = f"(select {_SLASH(_K('ticker'))} as ticker, max({_K('composite_figi')}) as composite_figi from asset_polygon where {_K('ticker')} is not null and {_K('composite_figi')} is not null group by 1)"


def _figis(spark: SparkSession, d: str) -> DataFrame:
    """Tickers with their identifiers, as the vendor lists them: some twice."""
    a = table(spark, d, "asset_polygon")
    return a.select(nz.slashed(clean_key(F.col("ticker"))).alias("ticker"), clean_key(F.col("composite_figi")).alias("composite_figi"))


@R.add("select series, event_date, value from economic_indicator where series is not null and event_date is not null and value is not null and not isnan(value) and not isinf(value)")
def read_indicators(spark, d):
    """Indicator readings written as one file per series and block of days, void ones as ".", and read back."""
    e = table(spark, d, "economic_indicator").where("series is not null")
    void = F.col("value").isNull() | F.isnan("value") | (F.abs("value") == float("inf"))
    o = F.struct(F.date_format("event_date", "yyyy-MM-dd").alias("date"), F.when(void, ".").otherwise(F.col("value").cast("string")).alias("value"))
    # A series is bounded by its days in a file; its name is the file's.
    blocks = e.groupBy("series", F.year("event_date").alias("y")).agg(_body("observations", o).alias("content"))
    name = F.concat(F.coalesce(F.col("y"), F.lit(0)).cast("string"), F.lit("/"), F.base64(F.encode("series", "UTF-8")), F.lit(".json"))
    root = _files(spark, "indicators", blocks.select(F.translate(name, "+=", "-_").alias("name"), "content"))
    read = rd.indicators(spark, f"{root}/*")
    return read.withColumn("series", F.decode(F.unbase64(F.translate("series", "-_", "+=")), "UTF-8"))


_ASSET_SQL = f"""select {_SLASH('ticker')} as ticker, coalesce(composite_figi, '') as composite_figi, share_class_figi, {_MAPPED('primary_exchange', nz.EXCHANGES, 'UNK')} as primary_exchange,
    coalesce(asset_type, 'Unknown') as asset_type, coalesce(active, false) as active, name, coalesce(try_cast(sic_code as int), 0) as sic_code, cik,
    try_strptime(list_date, '%Y-%m-%d') as listed, try_strptime(last_updated_utc, '%Y-%m-%dT%H:%M:%SZ') as last_updated from asset_polygon"""
_ASSET = ("ticker", "composite_figi", "share_class_figi", "primary_exchange", "asset_type", "active", "name", "sic_code", "cik", "listed", "last_updated")


def _tickers(spark: SparkSession, d: str) -> tuple[DataFrame, Column]:
    a = table(spark, d, "asset_polygon")
    same = ["ticker", "composite_figi", "share_class_figi", "primary_exchange", "active", "name", "sic_code", "cik", "list_date", "last_updated_utc"]
    return a, F.struct(*same, F.col("asset_type").alias("type"))


@R.add(_ASSET_SQL)
def read_ticker_pages(spark, d):
    """Asset pages, as the ticker list sends them."""
    a, row = _tickers(spark, d)
    return rd.ticker_pages(spark, _files(spark, "tickers", _pages(a, F.col("rec_id"), _body("results", row)))).select(*_ASSET)


@R.add(_ASSET_SQL + " where active = false")
def read_delisted_pages(spark, d):
    """The list of delisted assets has the same shape."""
    a, row = _tickers(spark, d)
    return rd.ticker_pages(spark, _files(spark, "delisted", _pages(a.where("active = false"), F.col("rec_id"), _body("results", row)))).select(*_ASSET)


@R.add(_ASSET_SQL)
def read_ticker_details(spark, d):
    """One file per asset."""
    a, row = _tickers(spark, d)
    files = a.select(F.format_string("%d.json", F.col("rec_id")).alias("name"), F.to_json(F.struct(row.alias("results"))).alias("content"))
    return rd.ticker_details(spark, _files(spark, "details", files)).select(*_ASSET)


@R.add("select ticker, name, composite_figi, primary_exchange, asset_type as type, active, try_cast(sic_code as bigint) as sic_code from asset_polygon")
def read_paged_source(spark, d):
    """The same pages through the paged data source, one partition a page."""
    a, row = _tickers(spark, d)
    root = _files(spark, "paged", _pages(a, F.col("rec_id"), _body("results", row)))
    register(spark)
    ddl = "ticker string, name string, composite_figi string, primary_exchange string, type string, active boolean, sic_code bigint"
    return spark.read.format("paged_json").schema(ddl).option("path", root).option("maxPages", 1_000_000).load()


@R.add(
    """select provider || ' day' as holiday, strptime(raw_value, '%Y-%m-%d')::date as event_date, mic as market, stamp_id % 3 = 0 as early_close,
    case when stamp_id % 3 = 0 then '13:00:00' else '16:00:00' end as close_time from vendor_stamp
    where regexp_full_match(raw_value, '\\d{4}-\\d{2}-\\d{2}') and try_strptime(raw_value, '%Y-%m-%d') is not null"""
)
def read_holidays(spark, d):
    """Days of vendor_stamp in the shape of the holiday list; every third closes at 13:00 in New York."""
    v = table(spark, d, "vendor_stamp")
    early = F.col("stamp_id") % 3 == 0
    # The close is given in UTC, as the vendor does.
    close = F.to_utc_timestamp(F.try_to_timestamp(F.concat("raw_value", F.lit(" 13:00:00"))), "America/New_York")
    row = F.struct(
        F.col("raw_value").alias("date"), F.col("mic").alias("exchange"), F.concat("provider", F.lit(" day")).alias("name"),
        F.when(early, F.coalesce(F.date_format(close, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))).alias("close"), F.when(early, "early-close").otherwise("closed").alias("status"),
    )
    return rd.holidays(spark, _files(spark, "holidays", _pages(v, F.col("stamp_id"), F.to_json(F.collect_list(row)))))


_CAT = _MAPPED("category", nz.CATEGORIES, "Unknown")
_EXCH = _MAPPED("primary_exchange", nz.EXCHANGES, "UNK")


@R.add(
    f"""select replace(ticker, '.', '/') as ticker, name, {_EXCH} as primary_exchange, {_CAT} as asset_type, coalesce(isdelisted = 'N', null) as active, coalesce(try_cast(siccode as int), 0) as sic_code,
    sector, rec_id::varchar as permaticker, case when regexp_full_match(firstpricedate, '\\d{{4}}-\\d{{2}}-\\d{{2}}') then try_strptime(firstpricedate, '%Y-%m-%d') end as first_price from asset_sharadar
    where coalesce(primary_exchange, '') <> '' and {_EXCH} not in ('OTC', 'INDEX', 'UNK') and {_CAT} not in ('INDEX', 'Unknown')"""
)
def read_datatable_tickers(spark, d):
    """Asset rows by position; unwanted exchanges and kinds are left out."""
    a = table(spark, d, "asset_sharadar")
    have = {"permaticker": "rec_id", "ticker": "ticker", "name": "name", "exchange": "primary_exchange", "isdelisted": "isdelisted", "category": "category", "siccode": "siccode", "sector": "sector", "firstpricedate": "firstpricedate"}
    cells = [F.col(have[c]) if c in have else F.lit(None) for c in TICKERS]
    read = rd.datatable_tickers(spark, _files(spark, "datatable", _datatable(a, F.col("rec_id"), cells)))
    cols = ["ticker", "name", "primary_exchange", "asset_type", "active", "sic_code", "sector"]
    return read.select(*cols, F.col("other_identifiers")["sharadar"].alias("permaticker"), "first_price")


_METRIC_FROM = f"""(select *, {_SLASH('ticker')} as t from fundamental) f left join {_FIGIS} g on g.ticker = f.t"""


@R.add("select distinct ticker, event_date from fundamental where dimension = 'ARQ' and ticker is not null and event_date is not null")
def read_constituents(spark, d):
    """Index members; rows of other actions are left out."""
    f = table(spark, d, "fundamental")
    action = F.when(F.col("dimension") == "ARQ", "current").otherwise("removed")
    cells = [F.col("event_date"), action, F.col("ticker")]
    return rd.constituents(spark, _files(spark, "members", _datatable(f, F.col("fundamental_id"), cells))).where("ticker is not null and event_date is not null")


@R.add(
    f"""select t as ticker, coalesce(g.composite_figi, '') as composite_figi, event_date, coalesce(market_capitalization // 1000, 0) * 1000000 as market_cap, coalesce(total_debt // 1000, 0) * 1000000 as ev,
    coalesce(price, 0)::float as pe, coalesce(eps, 0)::float as pb, t in (select {_SLASH('ticker')} from fundamental where dimension = 'ARQ') as sp500 from {_METRIC_FROM} where event_date is not null and t is not null"""
)
def read_daily_metrics(spark, d):
    """Amounts in millions, identifiers and membership looked up by a ticker that the lookup lists twice."""
    f = table(spark, d, "fundamental").where("ticker is not null").withColumn("ticker", nz.slashed(F.col("ticker")))
    cells = [F.col("ticker"), F.col("event_date"), F.lit("x"), F.expr("total_debt div 1000"), F.lit(0), F.lit(0), F.expr("market_capitalization div 1000"), F.col("eps"), F.col("price"), F.lit(0)]
    root = _files(spark, "metrics", _datatable(f, F.col("fundamental_id"), cells))
    read = rd.daily_metrics(spark, root, _figis(spark, d), f.where("dimension = 'ARQ'").select("ticker"))
    return read.select("ticker", "composite_figi", "event_date", "market_cap", "ev", "pe", "pb", "sp500")


@R.add(
    f"""select event_date, t as ticker, coalesce(g.composite_figi, '') as composite_figi, dimension, date_key, report_period, coalesce(last_updated, date '2024-03-01') as last_updated,
    coalesce(revenues, 0) as revenues, coalesce(net_income_common_stock, 0) as net_income_common_stock, coalesce(total_assets, 0) as total_assets, coalesce(total_debt, 0) as total_debt,
    coalesce(equity, 0) as equity, coalesce(shares_basic, 0) as shares_basic, coalesce(eps, 0) as eps, coalesce(price, 0) as price, coalesce(market_capitalization, 0) as market_capitalization from {_METRIC_FROM}"""
)
def read_fundamentals(spark, d):
    """Rows of 111 positions become the record's measures."""
    f = table(spark, d, "fundamental").withColumn("ticker", nz.slashed(F.col("ticker")))
    have = {
        "ticker": "ticker", "dimension": "dimension", "calendardate": "event_date", "datekey": "date_key", "reportperiod": "report_period", "lastupdated": "last_updated",
        "revenue": "revenues", "netinccmn": "net_income_common_stock", "assets": "total_assets", "debt": "total_debt", "equity": "equity", "sharesbas": "shares_basic",
        "eps": "eps", "price": "price", "marketcap": "market_capitalization",
    }
    cells = [F.col(have[n]) if n in have else F.lit(None) for n, _ in FUNDAMENTAL]
    read = rd.fundamentals(spark, _files(spark, "fundamentals", _datatable(f, F.col("fundamental_id"), cells)), _figis(spark, d), "2024-03-01")
    keep = ["event_date", "ticker", "composite_figi", "dimension", "date_key", "report_period", "last_updated", *list(have.values())[6:]]
    return read.select(*keep)


_SPAN = "(date '2024-01-07' - (e - 1))"


@R.add(
    f"""with a as (select *, case exch when 'NYSE American' then 'NYSE MKT' else exch end as x, try_strptime(list_date, '%Y-%m-%d')::date + 900 as e from
      (select *, case primary_exchange when 'XNAS' then 'NASDAQ' when 'XNYS' then 'NYSE' when 'ARCX' then 'NYSE ARCA' when 'XASE' then 'NYSE MKT' else primary_exchange end as exch from asset_polygon))
    select {_SLASH('ticker')} as ticker, {_MAPPED('x', nz.EXCHANGES, 'UNK')} as primary_exchange, case asset_type when 'CS' then 'CS' when 'ETF' then 'ETF' else 'Unknown' end as asset_type,
    try_strptime(list_date, '%Y-%m-%d')::date as listed, case when {_SPAN} >= 7 then e - 1 end as delisted, not coalesce({_SPAN} >= 7, false) as active from a
    where x in ('BATS', 'NASDAQ', 'NMFQS', 'NYSE', 'NYSE ARCA', 'NYSE MKT') and list_date is not null and ticker is not null and not (starts_with(ticker, 'ATEST') or starts_with(ticker, 'NTEST') or starts_with(ticker, 'PTEST')
    or contains(ticker, ' ') or regexp_matches(ticker, '^[A-Za-z0-9]+-[WPU]') or regexp_matches(ticker, '^[A-Za-z0-9]{{4}}[WPU]'))"""
)
def read_zipped_tickers(spark, d):
    """Supported tickers as zipped CSV files; test tickers, warrants and other exchanges are left out."""
    import io
    import zipfile

    a = table(spark, d, "asset_polygon").where("ticker is not null")
    names = {"XNAS": "NASDAQ", "XNYS": "NYSE", "ARCX": "NYSE ARCA", "XASE": "NYSE MKT"}
    end = F.date_format(F.date_add(F.to_date("list_date"), 900), "yyyy-MM-dd")
    line = F.concat_ws(
        ",", F.concat(F.lit('"'), "ticker", F.lit('"')), F.coalesce(nz.lookup(F.col("primary_exchange"), names), F.col("primary_exchange"), F.lit("")),
        F.coalesce(nz.lookup(F.col("asset_type"), {"CS": "Stock", "ETF": "ETF"}), F.lit("")), F.lit("USD"), F.coalesce("list_date", F.lit("")), F.coalesce(end, F.lit("")),
    )
    head = "ticker,exchange,assetType,priceCurrency,startDate,endDate\n"
    text = _pages(a, F.col("rec_id"), F.concat(F.lit(head), F.concat_ws("\n", F.collect_list(line)), F.lit("\n")), "tickers-%d.zip")

    def zipped(frames):
        for f in frames:
            out = []
            for content in f["content"]:
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("tickers.csv", content)
                out.append(buffer.getvalue())
            yield f.assign(content=out)

    root = _files(spark, "zips", text.mapInPandas(zipped, "name string, content binary"))
    return rd.covered_assets(rd.zipped_tickers(spark, root), F.lit("2024-01-07").cast("date"))


@R.add(
    f"""with e as (select *, {_SLASH(_K('ticker'))} as t from eod where {_K('ticker')} is not null and event_date is not null)
    select t as ticker, g.composite_figi, event_date, open, high, low, close, null::decimal(12,4) as adj_close, volume, dividend, split_factor from e join {_FIGIS} g on g.ticker = t where event_date >= date '2022-06-01'"""
)
def read_prices(spark, d):
    """Prices in a file per ticker and year, read from a day on for the active assets."""
    e = table(spark, d, "eod").withColumn("t", clean_key(F.col("ticker"))).where("t is not null and event_date is not null")
    row = F.struct(
        F.date_format("event_date", "yyyy-MM-dd'T00:00:00.000Z'").alias("date"), *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
        F.col("dividend").cast("double").alias("divCash"), F.col("split_factor").cast("double").alias("splitFactor"),
    )
    files = e.groupBy(nz.dashed(nz.slashed(F.col("t"))).alias("t"), F.year("event_date").alias("y")).agg(F.to_json(F.collect_list(row)).alias("content"))
    root = _files(spark, "prices", files.select(F.concat(F.col("y").cast("string"), F.lit("/"), F.col("t"), F.lit(".json")).alias("name"), "content"))
    return rd.prices(spark, f"{root}/*", _figis(spark, d), since="2022-06-01")


_GRADE = "case rating when 1 then 'A' when 2 then 'B' when 3 then 'C' when 4 then 'D' when 5 then 'F' else 'NA' end"


def _screened(spark: SparkSession, d: str) -> DataFrame:
    """Ratings in the shape of the screener: the grade as letter and as rank, a file a month."""
    r = table(spark, d, "rating").where("ticker is not null and event_date is not null")
    letter = F.expr(_GRADE)
    cell = lambda c: F.concat(F.lit('"'), F.coalesce(c.cast("string"), F.lit("NA")), F.lit('"'))
    line = F.concat_ws(",", cell(F.upper(F.trim("ticker"))), cell(F.col("rating")), cell(letter))
    month = r.groupBy(F.date_format("event_date", "yyyy-MM").alias("m"), F.pmod(F.xxhash64("rating_id"), F.lit(1 + r.count() // 200_000)).alias("part")).agg(F.collect_list(line).alias("lines"))
    content = F.concat(F.lit('"Ticker","Zacks Rank","Value Score"\n'), F.concat_ws("\n", "lines"), F.lit("\n"))
    root = _files(spark, "screens", month.select(F.format_string("%d/screen-%s-01.csv", F.col("part"), F.col("m")).alias("name"), content.alias("content")))
    return rd.screener(spark, f"{root}/*")


@R.add(
    f"""select {_SLASH('upper(trim(ticker))')} as ticker, date_trunc('month', event_date)::date as event_date, coalesce(rating, 0) as zacks_rank, case {_GRADE} when 'NA' then '0' else {_GRADE} end as value_score,
    count(*) as n from rating where ticker is not null and event_date is not null group by all"""
)
def read_screener(spark, d):
    """Screener exports by header; NA is 0, the day is in the file's name."""
    return _screened(spark, d).groupBy("ticker", "event_date", "zacks_rank", "value_score").agg(F.count(F.lit(1)).alias("n"))


@R.add(
    f"""with r as (select {_SLASH('upper(trim(ticker))')} as t, date_trunc('month', event_date)::date as event_date, rating from rating where ticker is not null and event_date is not null and rating between 1 and 5)
    select t as ticker, g.composite_figi, event_date, analyst, rating, count(*) as n from r join {_FIGIS} g on g.ticker = t, (values ('zacks-value'), ('zacks-rank')) a(analyst) group by all"""
)
def read_ratings(spark, d):
    """Grades and ranks as ratings of one analyst each, with the identifier of the ticker."""
    found = rd.ratings(_screened(spark, d), _figis(spark, d))
    return found.groupBy("ticker", "composite_figi", "event_date", "analyst", "rating").agg(F.count(F.lit(1)).alias("n"))


def _answer(batch: list[str]) -> list[dict]:
    """A mapping service that knows tickers of an even length."""
    return [{"ticker": t, "figi": f"ZZ{t}" if len(t) % 2 == 0 else None, "share_class": f"SC{t}", "security_type": "ETP", "security_type2": "Mutual Fund"} for t in batch]


@R.add(
    """with a as (select rec_id, ticker, coalesce(composite_figi, '') as f, coalesce(share_class_figi, '') as s, coalesce(asset_type, 'Unknown') as k, case when active = false then '2020-01-01' end as d from asset_polygon),
    o as (select *, (f = '' or k = 'Unknown') and d is null and ticker is not null and length(ticker) % 2 = 0 as hit from a)
    select rec_id, ticker, case when hit then 'ZZ' || ticker else f end as composite_figi, case when hit then 'SC' || ticker else s end as share_class_figi, case when hit and k = 'Unknown' then 'ETF' else k end as asset_type, d as delisted from o"""
)
def identifiers_applied(spark, d):
    """Assets without identifier or kind ask the mapping service, a hundred tickers a request; its answer fills them."""
    a = table(spark, d, "asset_polygon").select(
        "rec_id", "ticker", F.coalesce("composite_figi", F.lit("")).alias("composite_figi"), F.coalesce("share_class_figi", F.lit("")).alias("share_class_figi"),
        F.coalesce("asset_type", F.lit("Unknown")).alias("asset_type"), F.when(F.col("active") == F.lit(False), "2020-01-01").alias("delisted"),
    )
    found = rd.map_identifiers(a, _answer)
    return enrich.apply_identifiers(a, found, nz.security_kind(F.col("security_type2"), F.col("security_type"))).select(*a.columns)


_GOOD = f"(select *, {_K('composite_figi')} as k from rating where {_K('composite_figi')} is not null and event_date is not null and analyst is not null)"


@R.add(
    f"""with g as {_GOOD}, o as (select analyst, k, event_date, arg_max(struct_pack(r := rating), (received_at, rating_id)).r as rating from g where rating_id % 2 = 0 group by 1, 2, 3),
    newest as (select analyst, k, max(struct_pack(d := event_date, r := rating)).r as rating from o group by 1, 2),
    b as (select analyst, k, event_date, max(rating) as rating from g where rating_id % 2 = 1 group by 1, 2, 3),
    w as (select b.*, lag(b.rating) over w as before, row_number() over w as n, newest.rating as stored, newest.k is not null as known from b left join newest using (analyst, k) window w as (partition by b.analyst, b.k order by b.event_date, b.rating))
    select analyst, k as composite_figi, event_date, rating from w where case when n = 1 then not known or rating is distinct from stored else rating is distinct from before end"""
)
def changes_against_store(spark, d):
    """Ratings that differ from the newest stored one of their security and analyst; the store is written and read back."""
    spec = DATA_TYPES["rating"]
    r = table(spark, d, "rating").withColumn("composite_figi", clean_key(F.col("composite_figi")))
    r = r.where(spec.valid()).select(*spec.schema.names, "rating_id", F.struct("received_at", "rating_id").alias("seq"))
    store = ParquetStore(spark, scratch(spark, "ratings"), spec)
    store.merge(r.where("rating_id % 2 = 0").drop("rating_id"), F.col("seq"))
    batch = r.where("rating_id % 2 = 1").groupBy("analyst", "composite_figi", "event_date").agg(F.max("rating").alias("rating"))
    return changes_against(batch, store.read(), ["analyst", "composite_figi"], "event_date", "rating")


_STORED = f"(select {_SLASH(_K('ticker'))} as ticker, max(name) as name, max(try_strptime(last_updated_utc, '%Y-%m-%dT%H:%M:%SZ')) as last_updated from asset_polygon where {_K('ticker')} is not null group by 1)"


@R.add(
    f"""with s as {_STORED}, cur as (select distinct {_SLASH(_K('ticker'))} as ticker from asset_polygon where active),
    p as (select {_SLASH(_K('ticker'))} as ticker, max(try_strptime(firstpricedate, '%Y-%m-%d')) as d from asset_sharadar where isdelisted = 'Y' and {_K('ticker')} is not null group by 1),
    j as (select s.*, p.ticker is not null as proof, p.d, s.ticker in (select ticker from cur where ticker is not null) as here from s left join p using (ticker))
    select ticker, name, last_updated, not (not here and (proof or date '2024-12-01' - last_updated::date > 14)) as active,
    case when not here and (proof or date '2024-12-01' - last_updated::date > 14) then coalesce(d, last_updated) end as delisted from j"""
)
def delisting_flow(spark, d):
    """Assets that the current list lacks are confirmed by the vendor's list or silent for 14 days; they are written back as delisted."""
    a = table(spark, d, "asset_polygon").withColumn("ticker", nz.slashed(clean_key(F.col("ticker"))))
    seen = F.try_to_timestamp(F.col("last_updated_utc")).cast("timestamp_ntz")
    stored = a.where("ticker is not null").groupBy("ticker").agg(F.max("name").alias("name"), F.max(seen).alias("last_updated"))
    stored = stored.withColumns({"active": F.lit(True), "delisted": F.lit(None).cast("timestamp_ntz")})
    gone = table(spark, d, "asset_sharadar").where("isdelisted = 'Y'")
    proof = gone.select(nz.slashed(clean_key(F.col("ticker"))).alias("ticker"), F.to_timestamp_ntz(F.expr("try_to_date(firstpricedate, 'yyyy-MM-dd')")).alias("delisted"))
    lost = enrich.delisted(stored, a.where("active"), proof, ["ticker"], F.lit("2024-12-01").cast("date"))
    return upsert(stored, lost, ["ticker"], ["active", "delisted"])
