"""Readers of vendor payload files. They declare schemas, never infer them, and give canonical records.

Each reader gives good rows; where rows can fail to parse, a ``*_rejects`` twin or a reject column tells them apart.
"""

from __future__ import annotations

import io
import time
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import normalize as nz
from quillon.functions.dates import close_time, compact_date, plain_date, stamp_date
from quillon.operators.enrich import one_per_key
from quillon.sources.layouts import DAILY, FUNDAMENTAL, SCREENER, TICKERS
from quillon.types import FUNDAMENTAL_MEASURES

_OBSERVATIONS = "observations array<struct<date string, value string>>"
_TICKER = (
    "ticker string, name string, description string, composite_figi string, share_class_figi string, primary_exchange string, type string, "
    "active boolean, cik string, sic_code string, homepage_url string, list_date string, delisted_utc string, "
    "branding struct<logo_url string, icon_url string>, address struct<address1 string, city string, state string, postal_code string>, "
    "last_updated_utc string"
)


# --- indicators --------------------------------------------------------------------------------------------------------


def indicator_rows(spark: SparkSession, path: str) -> DataFrame:
    """(series, raw_date, raw_value, event_date, value) of indicator files named SERIES.json; nothing is dropped."""
    body = spark.read.schema(_OBSERVATIONS).option("multiLine", True).json(path)
    series = F.regexp_extract(F.col("_metadata.file_name"), r"([^/]+)\.json$", 1)
    x = body.select(series.alias("series"), F.explode("observations").alias("o"))
    return x.select(
        "series", F.col("o.date").alias("raw_date"), F.col("o.value").alias("raw_value"), plain_date(F.col("o.date")).alias("event_date"),
        F.col("o.value").try_cast("float").alias("value"),
    )


def indicators(spark: SparkSession, path: str) -> DataFrame:
    """Indicator records; the sign "." for a missing value and rows that do not parse are left out."""
    return indicator_rows(spark, path).where("event_date is not null and value is not null").select("series", "event_date", "value")


def indicator_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rows that do not parse; a missing value is no error."""
    return indicator_rows(spark, path).where("coalesce(raw_value, '') <> '.' and (event_date is null or value is null)")


# --- assets ------------------------------------------------------------------------------------------------------------


def _asset(row: Callable[[str], Column]) -> list[Column]:
    stamp = lambda c: F.try_to_timestamp(row(c)).cast("timestamp_ntz")
    return [
        nz.slashed(row("ticker")).alias("ticker"), F.coalesce(row("composite_figi"), F.lit("")).alias("composite_figi"),
        row("share_class_figi").alias("share_class_figi"), nz.exchange(row("primary_exchange")).alias("primary_exchange"),
        F.coalesce(row("type"), F.lit("Unknown")).alias("asset_type"), F.coalesce(row("active"), F.lit(False)).alias("active"), row("name").alias("name"),
        row("description").alias("description"), row("homepage_url").alias("corporate_url"), nz.number(row("sic_code"), "int").alias("sic_code"),
        row("cik").alias("cik"), nz.location(row("address.city"), row("address.state")).alias("headquarters"),
        row("branding.icon_url").alias("icon_url"), row("branding.logo_url").alias("logo_url"), stamp("list_date").alias("listed"),
        stamp("delisted_utc").alias("delisted"), stamp("last_updated_utc").alias("last_updated"),
    ]


def ticker_pages(spark: SparkSession, path: str) -> DataFrame:
    """Assets of ticker page files; also of the delisted list, which has the same shape with active = false."""
    pages = spark.read.schema(f"results array<struct<{_struct(_TICKER)}>>").option("multiLine", True).json(path)
    x = pages.select(F.explode("results").alias("r"))
    return x.select(*_asset(lambda c: F.col(f"r.{c}")))


def ticker_details(spark: SparkSession, path: str) -> DataFrame:
    """Assets of detail files, one asset a file."""
    body = spark.read.schema(f"results struct<{_struct(_TICKER)}>").option("multiLine", True).json(path)
    return body.select(*_asset(lambda c: F.col(f"results.{c}")))


def _struct(ddl: str) -> str:
    """``name type, ...`` as the fields of a struct type: ``name:type, ...``."""
    depth, out, word = 0, [], ""
    for part in ddl.split(", "):
        word = f"{word}, {part}" if word else part
        depth += part.count("<") - part.count(">")
        if depth == 0:
            name, kind = word.split(" ", 1)
            out.append(f"{name}:{kind if '<' not in kind else _nested(kind)}")
            word = ""
    return ", ".join(out)


def _nested(kind: str) -> str:
    inner = kind[kind.index("<") + 1 : -1]
    return f"struct<{_struct(inner)}>"


def images(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of image files."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def holidays(spark: SparkSession, path: str) -> DataFrame:
    """Market holidays; rows whose date does not parse are left out."""
    body = spark.read.schema("date string, exchange string, name string, open string, close string, status string").option("multiLine", True).json(path)
    return body.select(
        F.col("name").alias("holiday"), plain_date(F.col("date")).alias("event_date"), F.col("exchange").alias("market"),
        (F.col("status") == "early-close").alias("early_close"), close_time(F.nullif("close", F.lit(""))).alias("close_time"),
    ).where("event_date is not null")


# --- datatables --------------------------------------------------------------------------------------------------------


def datatable(spark: SparkSession, path: str) -> DataFrame:
    """(x array<string>) of the positional rows of datatable files."""
    body = spark.read.text(path, wholetext=True)
    return body.select(F.explode(F.from_json(F.get_json_object("value", "$.datatable.data"), "array<array<string>>")).alias("x"))


def _at(names: tuple[str, ...], name: str) -> Column:
    return F.get(F.col("x"), F.lit(names.index(name)))


def datatable_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Assets of the ticker datatable without rows of unwanted exchanges and kinds.

    The last price date has a position of its own, next to the first one's. Unknown exchanges and categories do not
    stop the load: they become UNK and Unknown and are left out with the others.
    """
    at = lambda n: _at(TICKERS, n)
    stamp = lambda n: plain_date(at(n)).cast("timestamp_ntz")
    rows = datatable(spark, path).where(F.coalesce(at("exchange"), F.lit("")) != "").select(
        F.replace(at("ticker"), F.lit("."), F.lit("/")).alias("ticker"), at("name").alias("name"), nz.exchange(at("exchange")).alias("primary_exchange"),
        nz.category(at("category")).alias("asset_type"), (at("isdelisted") == "N").alias("active"), at("companysite").alias("corporate_url"),
        nz.number(at("siccode"), "int").alias("sic_code"), at("location").alias("headquarters"), at("industry").alias("industry"), at("sector").alias("sector"),
        nz.blank_list(at("cusips")).alias("cusips"), nz.blank_list(at("relatedtickers")).alias("similar_tickers"), nz.cik(at("secfilings")).alias("cik"),
        F.create_map(F.lit("sharadar"), nz.number(at("permaticker"), "bigint").cast("string")).alias("other_identifiers"), stamp("firstadded").alias("listed"),
        F.when(at("isdelisted") != "N", stamp("lastpricedate")).alias("delisted"), stamp("firstpricedate").alias("first_price"),
        stamp("lastpricedate").alias("last_price"), stamp("lastupdated").alias("last_updated"),
    )
    return rows.where(~F.col("primary_exchange").isin("OTC", "INDEX", "UNK") & ~F.col("asset_type").isin("INDEX", "Unknown"))


def constituents(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, event_date) of current index members."""
    x = datatable(spark, path).where(F.get("x", F.lit(1)) == "current")
    return x.select(F.get("x", F.lit(2)).alias("ticker"), plain_date(F.get("x", F.lit(0))).alias("event_date")).distinct()


def daily_metrics(spark: SparkSession, path: str, figis: DataFrame, members: DataFrame) -> DataFrame:
    """Metric records: amounts in millions become units; identifiers and membership are looked up by ticker.

    ``figis`` is (ticker, composite_figi), a ticker listed twice counts once; tickers without one get ''.
    """
    at = lambda n: _at(DAILY, n)
    ratio = lambda n, to: nz.number(at(n), "float").alias(to)
    rows = datatable(spark, path).select(
        F.replace(at("ticker"), F.lit("."), F.lit("/")).alias("ticker"), plain_date(at("date")).alias("event_date"),
        F.coalesce(nz.millions(at("marketcap").try_cast("double")), F.lit(0)).alias("market_cap"),
        F.coalesce(nz.millions(at("ev").try_cast("double")), F.lit(0)).alias("ev"), ratio("pe", "pe"), ratio("pb", "pb"), ratio("ps", "ps"),
        ratio("evebit", "ev_ebit"), ratio("evebitda", "ev_ebitda"),
    ).where("event_date is not null")
    named = rows.join(one_per_key(figis, "ticker", "composite_figi"), "ticker", "left").join(members.select("ticker", F.lit(True).alias("sp500")).distinct(), "ticker", "left")
    order = ["ticker", "composite_figi", "event_date", "market_cap", "ev", "pe", "pb", "ps", "ev_ebit", "ev_ebitda", "sp500"]
    return named.withColumns({"composite_figi": F.coalesce("composite_figi", F.lit("")), "sp500": F.coalesce("sp500", F.lit(False))}).select(*order)


def fundamentals(spark: SparkSession, path: str, figis: DataFrame, as_of: str) -> DataFrame:
    """Fundamental records: 111 positions, of which the amounts in dollars are dropped; 104 columns.

    A last-updated date that does not parse is ``as_of``; missing numbers are 0.
    """
    position = {n: i for i, (n, _) in enumerate(FUNDAMENTAL)}
    at = lambda n: F.get(F.col("x"), F.lit(position[n]))
    kept = [(n, t) for n, t in FUNDAMENTAL[6:] if n == "fxusd" or not n.endswith("usd")]
    measures = [nz.number(at(n), t).alias(c) for (n, t), c in zip(kept, FUNDAMENTAL_MEASURES, strict=True)]
    rows = datatable(spark, path).select(
        plain_date(at("calendardate")).alias("event_date"), F.replace(at("ticker"), F.lit("."), F.lit("/")).alias("ticker"), at("dimension").alias("dimension"),
        plain_date(at("datekey")).alias("date_key"), plain_date(at("reportperiod")).alias("report_period"),
        F.coalesce(plain_date(at("lastupdated")), F.lit(as_of).cast("date")).alias("last_updated"), *measures,
    )
    named = rows.join(one_per_key(figis, "ticker", "composite_figi"), "ticker", "left").withColumn("composite_figi", F.coalesce("composite_figi", F.lit("")))
    return named.select("event_date", "ticker", "composite_figi", "dimension", "date_key", "report_period", "last_updated", *FUNDAMENTAL_MEASURES)


# --- prices and covered tickers ----------------------------------------------------------------------------------------


def _unzip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        for content in f["content"]:
            with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as member:
                for part in pd.read_csv(member, dtype=str, keep_default_na=False, chunksize=50_000):
                    yield part.reindex(columns=["ticker", "exchange", "assetType", "priceCurrency", "startDate", "endDate"]).fillna("")


def zipped_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows of the first CSV file in each zip archive."""
    z = spark.read.format("binaryFile").load(path).select("content")
    return z.mapInPandas(_unzip, "ticker string, exchange string, assetType string, priceCurrency string, startDate string, endDate string")


def covered_assets(raw: DataFrame, as_of: Column) -> DataFrame:
    """Assets of covered exchanges with a life span, without test tickers, warrants and units.

    An end date counts as delisting once it is seven days before ``as_of`` in New York, where a UTC midnight falls
    on the day before.
    """
    end = F.date_sub(plain_date(F.col("endDate")), 1)
    delisted = F.when(F.datediff(as_of, end) >= 7, end)
    kinds = {"Stock": "CS", "ETF": "ETF", "Mutual Fund": "MF"}
    keep = F.col("exchange").isin(*nz.COVERED) & ~((F.col("startDate") == "") & (F.col("endDate") == "")) & ~nz.rejected_ticker(F.col("ticker"))
    return raw.where(keep).select(
        nz.slashed(F.col("ticker")).alias("ticker"), nz.exchange(F.col("exchange")).alias("primary_exchange"),
        nz.lookup(F.col("assetType"), kinds, "Unknown").alias("asset_type"), plain_date(F.col("startDate")).alias("listed"), delisted.alias("delisted"),
        delisted.isNull().alias("active"),
    )


def prices(spark: SparkSession, path: str, active: DataFrame, since: str | None = None) -> DataFrame:
    """Price records of files named TICKER.json for the active assets (ticker, composite_figi).

    ``since`` is the first day to read again; the overlap is merged by key later.
    """
    body = (
        spark.read.schema("date string, open double, high double, low double, close double, volume double, divCash double, splitFactor double")
        .option("multiLine", True)
        .json(path)
        .withColumn("ticker", nz.slashed(F.regexp_extract(F.col("_metadata.file_name"), r"([^/]+)\.json$", 1)))
    )
    money = lambda c: F.col(c).try_cast("decimal(12,4)")
    rows = body.withColumn("event_date", stamp_date(F.col("date"))).where("event_date is not null")
    if since:
        rows = rows.where(F.col("event_date") >= F.lit(since).cast("date"))
    return rows.join(one_per_key(active, "ticker", "composite_figi"), "ticker").select(
        "ticker", "composite_figi", "event_date", *[money(c).alias(c) for c in ("open", "high", "low", "close")], F.lit(None).cast("decimal(12,4)").alias("adj_close"),
        F.col("volume").cast("bigint").alias("volume"), money("divCash").alias("dividend"), F.col("splitFactor").try_cast("decimal(9,6)").alias("split_factor"),
    )


# --- screener ----------------------------------------------------------------------------------------------------------

#: Columns of the screener whose letters are grades of one analyst each.
SCORES = {"value_score": "value", "growth_score": "growth", "momentum_score": "momentum", "vgm_score": "vgm"}


def screener(spark: SparkSession, path: str) -> DataFrame:
    """Typed rows of screener exports; NA means 0, the event date is in the file's name."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    there = {c: c for c in raw.columns}
    day = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-?\d{2}-?\d{2})", 1)

    def typed(header: str, name: str, kind: str) -> Column:
        if header not in there:
            return F.lit(None if kind == "string" else 0).cast(kind).alias(name)
        c = F.replace(F.col(f"`{header}`"), F.lit("NA"), F.lit("0")) if kind != "string" else F.when(F.col(f"`{header}`") == "NA", "0").otherwise(F.col(f"`{header}`"))
        if kind == "boolean":
            return F.lower(c).isin("yes", "y", "true", "1", "x").alias(name)
        if kind != "string":
            return nz.number(c, kind).alias(name)
        return (compact_date(c) if "yyyymm" in header else c).alias(name)

    cols = [typed(*x) for x in SCREENER]
    rows = raw.select(*cols, compact_date(day).cast("date").alias("event_date"))
    return rows.withColumn("ticker", nz.slashed(F.col("ticker")))


def ratings(screened: DataFrame, figis: DataFrame) -> DataFrame:
    """Rating records of screener rows: letter scores as numbers, the rank as it is; rows without identifier or grade are dropped."""
    named = screened.join(one_per_key(figis, "ticker", "composite_figi"), "ticker")
    grades = F.array(
        *[F.struct(F.lit(f"zacks-{a}").alias("analyst"), nz.grade(F.col(c)).alias("rating")) for c, a in SCORES.items()],
        F.struct(F.lit("zacks-rank").alias("analyst"), F.when(F.col("zacks_rank").between(1, 5), F.col("zacks_rank")).alias("rating")),
    )
    return named.select("ticker", "composite_figi", "event_date", F.inline(grades)).where("rating is not null")


# --- identifiers -------------------------------------------------------------------------------------------------------

MAPPED = "ticker string, figi string, share_class string, security_type string, security_type2 string"


def map_identifiers(tickers: DataFrame, answer: Callable[[list[str]], list[dict]], batch: int = 100, retries: int = 3, wait: float = 1.0) -> DataFrame:
    """Answers of an identifier service for distinct tickers, ``batch`` a request.

    ``answer`` takes a list of tickers and gives a dict per ticker with the columns of ``MAPPED`` (missing keys are
    null). It runs on the executors; a service behind it is asked once per request. A request that fails is repeated
    up to ``retries`` times, ``wait`` seconds later and twice as long each time; the last failure fails the job. Requests are
    formed over all tickers, so only the last of a task may be short, and tasks have thousands of tickers each.
    """

    def asked(names: list[str]) -> list[dict]:
        for attempt in range(retries + 1):
            try:
                found = answer(names)
                break
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(wait * 2**attempt)
        if len(found) != len(names):
            raise ValueError(f"{len(found)} answers to {len(names)} tickers")
        return found

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, waiting = [c.split()[0] for c in MAPPED.split(", ")], []
        rows = lambda found: pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in found], pa.string()) for n in names], names=names)
        for b in batches:
            waiting += b.column(0).to_pylist()
            while len(waiting) >= batch:
                yield rows(asked(waiting[:batch]))
                waiting = waiting[batch:]
        if waiting:
            yield rows(asked(waiting))

    distinct = tickers.select("ticker").where("ticker is not null").distinct()
    # Adaptive execution leaves few tasks for few tickers, so requests are full.
    return distinct.mapInArrow(ask, MAPPED)
