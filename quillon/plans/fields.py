"""Scalar functions, predicates, payload shapes and catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon import catalog
from quillon.common import table
from quillon.functions import measures as ms
from quillon.functions import normalize as nz
from quillon.functions.dates import iso_micros
from quillon.plans.registry import Registry
from quillon.types import figi_ok

R = Registry()


def _values(spark, rows: list[tuple], ddl: str):
    return spark.createDataFrame(rows, ddl)


def _sql(rows: list[tuple], columns: str) -> str:
    show = lambda x: "null" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"
    return "(values " + ", ".join("(" + ", ".join(map(show, r)) + ")" for r in rows) + f") v({columns})"


# --- filters -----------------------------------------------------------------------------------------------------------


@R.add("select c_custkey, c_name, strftime(timestamp '2024-01-01' + to_days((c_custkey % 365)::int), '%Y-%m-%dT%H:%M:%S.%fZ') as updated from customer where c_acctbal > 0")
def active_scan(spark, d):
    """Active rows with their date as a text."""
    c = table(spark, d, "customer").withColumn("active", F.col("c_acctbal") > 0)
    day = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 365 as int))")
    return c.where("active").select("c_custkey", "c_name", iso_micros(day).alias("updated"))


@R.add("select event_id, user_id from events where event_type = 'error'")
def param_filter(spark, d):
    return table(spark, d, "events").where(F.col("event_type") == F.lit("error")).select("event_id", "user_id")


@R.add("select p_partkey from part where p_brand in ('Brand#11', 'Brand#12', 'Brand#23', 'Brand#34', 'Brand#45', 'Brand#55')")
def whitelist(spark, d):
    return table(spark, d, "part").where(F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#23", "Brand#34", "Brand#45", "Brand#55")).select("p_partkey")


_EXCH = "case trim(primary_exchange) when 'BATS' then 'BATS' when 'NASDAQ' then 'XNAS' when 'NYSE' then 'XNYS' when 'NYSEARCA' then 'ARCX' when 'NYSE ARCA' then 'ARCX' when 'NYSEMKT' then 'XASE' when 'NYSE MKT' then 'XASE' when 'AMEX' then 'XASE' when 'INDEX' then 'INDEX' when 'OTC' then 'OTC' when 'NMFQS' then 'NMFQS' when 'XNAS' then 'XNAS' when 'XNYS' then 'XNYS' when 'XASE' then 'XASE' when 'ARCX' then 'ARCX' else 'UNK' end"
_CAT = "case category when 'ETF' then 'ETF' when 'Domestic Common Stock' then 'CS' when 'Domestic Common Stock Primary Class' then 'CS' when 'Domestic Common Stock Secondary Class' then 'CS' else 'Unknown' end"


@R.add(f"select rec_id, {_EXCH} as exchange, {_CAT} as asset_type from asset_sharadar where coalesce(primary_exchange, '') <> '' and {_EXCH} not in ('OTC', 'INDEX', 'UNK') and {_CAT} not in ('INDEX', 'Unknown')")
def exclude_enum(spark, d):
    """Vendor names become codes first; rows of unwanted codes or without exchange are dropped."""
    a = table(spark, d, "asset_sharadar").where("primary_exchange <> ''")
    a = a.select("rec_id", nz.exchange(F.trim("primary_exchange")).alias("exchange"), nz.category(F.col("category")).alias("asset_type"))
    return a.where(~F.col("exchange").isin("OTC", "INDEX", "UNK") & ~F.col("asset_type").isin("INDEX", "Unknown"))


_SPANS = [("A", "", ""), ("B", "2020-01-01", ""), ("C", "", "2021-01-01"), ("D", "2020-01-01", "2021-01-01")]


@R.add(f"select t from {_sql(_SPANS, 't, a, b')} where not (a = '' and b = '')")
def both_empty(spark, d):
    return _values(spark, _SPANS, "t string, a string, b string").where(~((F.col("a") == "") & (F.col("b") == ""))).select("t")


_OBS = [("2024-01-01", "1.5"), ("2024-01-02", "."), ("2024-01-03", "abc"), ("2024-13-01", "2"), ("2024-01-05", None), ("2024-01-06", "-3e2")]


@R.add(f"select a, try_cast(b as double) as v from {_sql(_OBS, 'a, b')} where b <> '.'")
def sentinel_drop(spark, d):
    """The sign for a missing value is dropped; other texts stay, null where they are no number."""
    return _values(spark, _OBS, "a string, b string").where("b <> '.'").select("a", F.expr("try_cast(b as double)").alias("v"))


@R.add(f"select a, b, case when try_strptime(a, '%Y-%m-%d') is null then 'date' when try_cast(b as double) is null then 'value' else 'ok' end as fate from {_sql(_OBS, 'a, b')}")
def parse_fail(spark, d):
    """Every row with its fate; the driver of a load keeps ``ok`` and stores the rest as rejects."""
    day, v = F.try_to_date("a", "yyyy-MM-dd"), F.expr("try_cast(b as double)")
    return _values(spark, _OBS, "a string, b string").select("a", "b", F.when(day.isNull(), "date").when(v.isNull(), "value").otherwise("ok").alias("fate"))


_TICKERS = [(t,) for t in ("GOOG", "ABC-W", "ABC-WS", "BRK-A", "ABCDW", "ABCDWS", "ABCDE", "WXYZP1", "ATEST1", "A B", "AB-P-A", "ABCWX", "ABCD-U")]


@R.add(
    f"""with t as (select upper(replace(p_name, ' ', '-')) as t from part union all select t from {_sql(_TICKERS, 't')})
    select t, count(*) as n from t where starts_with(t, 'ATEST') or starts_with(t, 'NTEST') or starts_with(t, 'PTEST') or contains(t, ' ')
    or regexp_matches(t, '^[A-Za-z0-9]+-[WPU]') or regexp_matches(t, '^[A-Za-z0-9]{{4}}[WPU]') group by 1"""
)
def reject_tickers(spark, d):
    t = table(spark, d, "part").select(F.upper(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("t")).unionByName(_values(spark, _TICKERS, "t string"))
    return t.where(nz.rejected_ticker(F.col("t"))).groupBy("t").agg(F.count(F.lit(1)).alias("n"))


@R.add("select fundamental_id, coalesce(length(trim(composite_figi)) = 12, false) as ok from fundamental")
def check_figi(spark, d):
    return table(spark, d, "fundamental").select("fundamental_id", figi_ok(F.col("composite_figi")).alias("ok"))


@R.add("select case when coalesce(trim(composite_figi), '') = '' then 'dropped' else 'kept' end as fate, analyst, count(*) as n from rating group by 1, 2")
def key_guard(spark, d):
    fate = F.when(F.coalesce(F.trim("composite_figi"), F.lit("")) == "", "dropped").otherwise("kept")
    return table(spark, d, "rating").groupBy(fate.alias("fate"), "analyst").agg(F.count(F.lit(1)).alias("n"))


@R.add("select c_name as subscription_id, c_mktsegment as name from customer where starts_with(c_name, 'Customer#000000001')")
def prefix_lookup(spark, d):
    """The one row whose id begins with a prefix; several would be an error."""
    c = table(spark, d, "customer").select(F.col("c_name").alias("subscription_id"), F.col("c_mktsegment").alias("name"))
    return catalog.find(c, "Customer#000000001")


@R.add("select r_regionkey, r_name from region order by r_regionkey limit 1")
def singleton(spark, d):
    return table(spark, d, "region").orderBy("r_regionkey").limit(1).select("r_regionkey", "r_name")


# --- projections -------------------------------------------------------------------------------------------------------


@R.add("select eod_id, coalesce(close, 0) as close, coalesce(volume, 0) as volume, coalesce(split_factor, 1) as split_factor from eod")
def defaults_fill(spark, d):
    e = table(spark, d, "eod")
    return e.select("eod_id", *[F.coalesce(F.col(c), F.lit(v)).cast(dict(e.dtypes)[c]).alias(c) for c, v in (("close", 0), ("volume", 0), ("split_factor", 1))])


@R.add("select eod_id, coalesce(adj_close, close) as adj_close from eod")
def adj_close_default(spark, d):
    return table(spark, d, "eod").select("eod_id", F.coalesce("adj_close", "close").alias("adj_close"))


@R.add("select l_orderkey, l_linenumber, cast(trunc((l_tax - l_discount) * 1e6) as bigint) as units from lineitem")
def scale_truncate(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", nz.millions(F.col("l_tax") - F.col("l_discount")).alias("units"))


_PAYLOAD = '{"datatable":{"data":[["A","2024-01-02",1.5,null],["B","bad","x",2],["C"]]},"meta":{"next_cursor_id":null}}'


@R.add(
    f"""with r as (select unnest(from_json('{_PAYLOAD}'::json->'datatable'->'data', '[["json"]]')) as x)
    select x[1]->>'$' as ticker, coalesce(try_cast(x[3]->>'$' as double), 0) as ev, coalesce(try_cast(x[4]->>'$' as bigint), 0) as cap from r"""
)
def positional_json(spark, d):
    """Rows of positions become named columns; what is missing or no number becomes 0."""
    raw = _values(spark, [(_PAYLOAD,)], "body string")
    x = raw.select(F.explode(F.from_json(F.get_json_object("body", "$.datatable.data"), "array<array<string>>")).alias("x"))
    at = lambda i: F.get("x", F.lit(i))
    return x.select(at(0).alias("ticker"), nz.number(at(2)).alias("ev"), nz.number(at(3), "bigint").alias("cap"))


@R.add("select event_id, (props::json->>'k')::bigint as k from events")
def json_path(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@R.add("select event_id, coalesce((props::json->>'k')::int, 0) as k, '' as note from events")
def json_struct(spark, d):
    """A typed struct: unknown fields are ignored, missing ones become zero values."""
    s = F.from_json("props", "k int, note string")
    return table(spark, d, "events").select("event_id", F.coalesce(s["k"], F.lit(0)).alias("k"), F.coalesce(s["note"], F.lit("")).alias("note"))


@R.add(
    """select fundamental_id, market_capitalization + total_debt as gross_value, net_income_common_stock / nullif(revenues, 0)::double as profit_margin,
    total_debt / nullif(equity, 0)::double as debt_to_equity, total_assets - equity as liabilities, net_income_common_stock / nullif(total_assets, 0)::double as roa,
    net_income_common_stock / nullif(equity, 0)::double as roe, revenues / nullif(total_assets, 0)::double as asset_turnover,
    equity / nullif(shares_basic, 0)::double as book_value_per_share, market_capitalization / nullif(equity, 0)::double as pb from fundamental"""
)
def derived_metrics(spark, d):
    income, revenues, assets, debt, equity, shares, cap = (F.col(c) for c in ("net_income_common_stock", "revenues", "total_assets", "total_debt", "equity", "shares_basic", "market_capitalization"))
    return table(spark, d, "fundamental").select(
        "fundamental_id", ms.gross_value(cap, debt).alias("gross_value"), ms.profit_margin(income, revenues).alias("profit_margin"),
        ms.debt_to_equity(debt, equity).alias("debt_to_equity"), ms.liabilities(assets, equity).alias("liabilities"), ms.return_on_assets(income, assets).alias("roa"),
        ms.return_on_equity(income, equity).alias("roe"), ms.asset_turnover(revenues, assets).alias("asset_turnover"),
        ms.book_value_per_share(equity, shares).alias("book_value_per_share"), ms.price_to_book(cap, equity).alias("pb"),
    )


@R.add("select l_orderkey, l_linenumber, 'F' || l_partkey as composite_figi, l_quantity, l_shipdate from lineitem")
def wide_subset(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("F"), F.col("l_partkey")).alias("composite_figi"), "l_quantity", "l_shipdate")


_SITES = [("http://www.sec.gov/cgi-bin/browse-edgar?action=getcompany&CIK=0000320193",), ("http://example.org/none",), (None,)]


@R.add(f"select u, regexp_extract(u, 'CIK=(\\d+)', 1) as cik from {_sql(_SITES, 'u')} union all select text, regexp_extract(text, '\\b(\\d+) months', 1) from documents")
def regex_extract(spark, d):
    s = _values(spark, _SITES, "u string").select("u", nz.cik(F.col("u")).alias("cik"))
    return s.unionByName(table(spark, d, "documents").select(F.col("text").alias("u"), nz.captured(F.col("text"), r"\b(\d+) months").alias("cik")))


@R.add("select p_partkey, w from (select p_partkey, unnest(string_split(trim(p_name), ' ')) as w from part where trim(p_name) <> '')")
def split_list(spark, d):
    return table(spark, d, "part").select("p_partkey", F.explode(nz.blank_list(F.col("p_name"))).alias("w"))


@R.add("select p_partkey, split_part(p_type, ' ', 1) as first, string_split(p_type, ' ')[-1] as last, len(string_split(p_type, ',')) as n from part")
def split_part(spark, d):
    c = F.col("p_type")
    return table(spark, d, "part").select("p_partkey", F.split_part(c, F.lit(" "), F.lit(1)).alias("first"), F.element_at(F.split(c, " "), -1).alias("last"), F.size(nz.comma_list(c)).cast("bigint").alias("n"))


@R.add("select p_partkey, trim(regexp_replace(lower(p_brand || ' ' || p_type || ' ' || substr('abcdefgh', 1, 5)), '[^a-z0-9]+', '_', 'g'), '_') as t, upper(substr(p_type, 1, 1)) || substr(p_type, 2) as cap from part")
def slug(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", nz.slug(F.concat_ws(" ", "p_brand", "p_type", F.substring(F.lit("abcdefgh"), 1, 5))).alias("t"), nz.capitalized(F.col("p_type")).alias("cap"))


@R.add("select rec_id, replace(replace(ticker, '.', '/'), '-', '/') as slashed, replace(ticker, '/', '-') as dashed, replace(ticker, '-', '') as undashed from asset_polygon")
def ticker_norm(spark, d):
    t = F.col("ticker")
    return table(spark, d, "asset_polygon").select("rec_id", nz.slashed(t).alias("slashed"), nz.dashed(t).alias("dashed"), nz.undashed(t).alias("undashed"))


@R.add("select c_custkey, case when c_acctbal < 0 then '' else c_name || ', ' || c_mktsegment end as place, c_name || ':' || c_custkey as id from customer")
def concat_guard(spark, d):
    c = table(spark, d, "customer")
    city = F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name"))
    return c.select("c_custkey", nz.location(city, F.col("c_mktsegment")).alias("place"), nz.asset_id(F.col("c_name"), F.col("c_custkey")).alias("id"))


_GRADED = [(g, m, k, s) for g, m, k, s in (("A", "image/jpeg", "Mutual Fund", "ETP"), ("B", "image/png", "Mutual Fund", "Open-End Fund"), ("C", "image/svg+xml", "Mutual Fund", "Closed-End Fund"), ("D", "image/svg", "Common Stock", ""), ("E", "", "Depositary Receipt", ""), ("F", "image/gif", "Warrant", ""))]


@R.add(
    f"""select g, case g when 'A' then 1 when 'B' then 2 when 'C' then 3 when 'D' then 4 when 'F' then 5 end as grade,
    case m when 'image/jpeg' then '.jpg' when 'image/png' then '.png' when 'image/svg' then '.svg' when 'image/svg+xml' then '.svg' when '' then null else 'unknown' end as ext,
    case when k in ('Partnership Shares', 'Common Stock') then 'CS' when k = 'Depositary Receipt' then 'ADRC' when k = 'Mutual Fund' then case s when 'ETP' then 'ETF' when 'Closed-End Fund' then 'CEF' else 'MF' end end as kind
    from {_sql(_GRADED, 'g, m, k, s')}"""
)
def lookup_map(spark, d):
    v = _values(spark, _GRADED, "g string, m string, k string, s string")
    return v.select("g", nz.grade(F.col("g")).alias("grade"), nz.extension(F.col("m")).alias("ext"), nz.security_kind(F.col("k"), F.col("s")).alias("kind"))


@R.add("select o_orderkey, o_orderstatus = 'F' as early, case when o_totalprice > 100000 then 'large' else 'small' end as size, substr(o_orderpriority, 1, 1)::int as grade from orders")
def flags_and_labels(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("early"), F.when(F.col("o_totalprice") > 100000, "large").otherwise("small").alias("size"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("grade"))


@R.add("select k, t from (values ('eod', 'prices'), ('metric', 'ratios')) v(k, t)")
def zip_map(spark, d):
    """Two parallel arrays become a map, and the map rows again."""
    a = _values(spark, [(["eod", "metric"], ["prices", "ratios"])], "kinds array<string>, tables array<string>")
    return a.select(F.explode(F.map_from_arrays("kinds", "tables")).alias("k", "t"))


@R.add("select c_custkey, 'vendor' as k, c_custkey::varchar as v from customer")
def map_literal(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.create_map(F.lit("vendor"), F.col("c_custkey").cast("string")).alias("ids"))
    return c.select("c_custkey", F.explode("ids").alias("k", "v"))


_CELLS = [("a", "NA", "1"), ("b", "3", "NA"), ("c", "x", "")]


@R.add(f"select k, coalesce(try_cast(replace(a, 'NA', '0') as int), 0) as num_brokers, coalesce(try_cast(replace(b, 'NA', '0') as double), 0) as change from {_sql(_CELLS, 'k, a, b')}")
def na_sentinel(spark, d):
    """Vendor headers are renamed, NA means 0, and so do texts that are no number."""
    names = {"# of Brokers in Rating": "num_brokers", "Change in Avg Rec ": "change"}
    v = _values(spark, _CELLS, "k string, a string, b string").withColumnsRenamed({"a": "# of Brokers in Rating", "b": "Change in Avg Rec "}).withColumnsRenamed(names)
    zero = lambda c, t: nz.number(F.replace(F.col(c), F.lit("NA"), F.lit("0")), t).alias(c)
    return v.select("k", zero("num_brokers", "int"), zero("change", "double"))


@R.add(
    """with t as (select p_partkey, unnest(regexp_split_to_array(lower(p_name), '[^a-z0-9]+')) as term, 'A' as weight from part
    union all select p_partkey, unnest(regexp_split_to_array(lower(p_brand), '[^a-z0-9]+')), 'B' from part union all select p_partkey, unnest(regexp_split_to_array(lower(p_type), '[^a-z0-9]+')), 'C' from part)
    select term, weight, count(*) as n, count(distinct p_partkey) as parts from t where term <> '' group by 1, 2"""
)
def search_terms(spark, d):
    """Inverted index sizes of the weighted terms of name, brand and type."""
    terms = nz.weighted_terms({"A": F.col("p_name"), "B": F.col("p_brand"), "C": F.col("p_type")})
    t = table(spark, d, "part").select("p_partkey", F.inline(terms))
    return t.groupBy("term", "weight").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p_partkey").alias("parts"))


_URLS = [("https://www.google.com/x",), ("https://example.org/auction-list",), ("https://example.org/a",), ("https://uat5-b.investingchannel.com/",), (None,)]


@R.add(
    f"select u from {_sql(_URLS, 'u')} where "
    + " or ".join(f"contains(u, '{t}')" for t in nz.TRACKERS)
)
def url_blocklist(spark, d):
    return _values(spark, _URLS, "u string").where(nz.blocked(F.col("u"))).select("u")


# --- catalog -----------------------------------------------------------------------------------------------------------


def _suppliers(spark, d):
    """Suppliers in the place of subscriptions, with counters from their lines."""
    s = table(spark, d, "supplier")
    li = table(spark, d, "lineitem")
    counted = catalog.counters(li, F.col("l_suppkey"), F.col("l_partkey"), F.col("l_shipdate"))
    return s.select(F.col("s_suppkey").alias("subscription_id"), (F.col("s_acctbal") > 0).alias("active")).join(counted, "subscription_id", "left").withColumn("last_run", F.col("last_obs"))


_SUPPLIERS = """with c as (select l_suppkey as id, count(*) as total_records, count(distinct l_partkey) as total_securities, max(l_shipdate) as last_run from lineitem group by 1),
 s as (select s_suppkey, s_acctbal > 0 as active, c.* from supplier left join c on c.id = s_suppkey)"""


@R.add("select count(*) as n from supplier where s_acctbal > 0")
def count_active(spark, d):
    return table(spark, d, "supplier").where("s_acctbal > 0").agg(F.count(F.lit(1)).alias("n"))


@R.add("select coalesce(max(o_orderdate), timestamp '0001-01-01') as last_run from orders")
def last_run(spark, d):
    return table(spark, d, "orders").agg(F.coalesce(F.max("o_orderdate"), F.lit(catalog.NEVER).cast("timestamp_ntz")).alias("last_run"))


@R.add(f"{_SUPPLIERS} select coalesce(sum(total_records), 0)::bigint as total_records from s")
def total_records(spark, d):
    return catalog.totals(_suppliers(spark, d)).select("total_records")


@R.add(f"{_SUPPLIERS} select coalesce(sum(total_securities), 0)::bigint as total_securities from s")
def total_securities(spark, d):
    return catalog.totals(_suppliers(spark, d)).select("total_securities")


@R.add(
    f"""{_SUPPLIERS} select count(*) filter (where active) as active, coalesce(max(last_run), timestamp '0001-01-01') as last_run,
    coalesce(sum(total_records), 0)::bigint as total_records, coalesce(sum(total_securities), 0)::bigint as total_securities from s"""
)
def library_summary(spark, d):
    return catalog.totals(_suppliers(spark, d))


_SUBS = [catalog.Subscription("0b97b000", "rates", "fred", "Economic Indicators", ("economic-indicator",)), catalog.Subscription("7c11a000", "prices", "tiingo", "EOD", ("eod",)), catalog.Subscription("9d22f000", "stocks", "polygon", "Stock Tickers", ("asset-description", "custom"))]


@R.add(
    """select * from (values ('0b97b000', true, 'economic-indicator', 'fred_economic_indicators_economic_indicator_0b97b'),
    ('9d22f000', false, 'asset-description', 'polygon_stock_tickers_asset_description_9d22f'), ('9d22f000', false, 'custom', 'polygon_stock_tickers_custom_9d22f')) v(subscription_id, active, data_type, table_name)"""
)
def catalog_lifecycle(spark, d):
    """Add, add again, deactivate, activate and delete subscriptions; then their tables."""
    c = catalog.add(catalog.as_rows(spark, _SUBS[:2]), catalog.as_rows(spark, _SUBS[1:]))
    c = catalog.set_active(catalog.set_active(catalog.set_active(c, "9d22f000", False), "0b97b000", False), "0b97b000", True)
    c = catalog.drop(c, "7c11a000")
    return c.select("subscription_id", "active").join(catalog.tables(c), "subscription_id")
