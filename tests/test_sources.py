import json
import os
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from quillon.functions import normalize as nz
from quillon.operators.enrich import apply_identifiers, disappeared, publish
from quillon.sources import readers as rd
from quillon.sources.layouts import FUNDAMENTAL, SCREENER, TICKERS
from quillon.sources.paged import register
from quillon.sources.registry import PROVIDERS, dataset
from quillon.types import DATA_TYPES


def put(path, obj):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(obj if isinstance(obj, str) else json.dumps(obj))
    return str(path.parent)


def table(rows, cursor=None):
    return {"datatable": {"data": rows}, "meta": {"next_cursor_id": cursor}}


def test_registry():
    assert sum(len(d) for d in PROVIDERS.values()) == 8 + 1 or sum(len(d) for d in PROVIDERS.values()) == 9
    assert dataset("tiingo", "EOD").start == "1960-01-01"
    with pytest.raises(ValueError, match="on offer"):
        dataset("tiingo", "nothing")


def test_indicator(spark, tmp_path):
    obs = [("2024-01-01", "1.5"), ("2024-01-02", "."), ("2024-01-03", "abc"), ("2024-13-01", "2"), ("2024-01-05", None)]
    p = put(tmp_path / "i" / "UNRATE.json", {"units": "lin", "observations": [{"date": d, "value": v, "extra": 1} for d, v in obs]})
    assert [tuple(r) for r in rd.indicators(spark, p).collect()] == [("UNRATE", date(2024, 1, 1), 1.5)]
    assert sorted(r["raw_date"] for r in rd.indicator_rejects(spark, p).collect()) == ["2024-01-03", "2024-01-05", "2024-13-01"]


def test_tickers_details_and_paging(spark, tmp_path):
    row = lambda t, **k: {"ticker": t, "name": t, "primary_exchange": "ARCX", "type": "ETF", "active": True, "last_updated_utc": "2024-01-02T00:00:00Z", "sic_code": "x", **k}
    put(tmp_path / "t" / "page-1.json", {"results": [row("BRK.A", address={"city": "Omaha", "state": "NE"})], "next_url": "http://host/page-2.json"})
    put(tmp_path / "t" / "page-2.json", {"results": [row("B", address={"city": "", "state": "NE"}), row("C")], "next_url": "page-3.json"})
    p = put(tmp_path / "t" / "page-3.json", {"results": [row("D")]})
    got = {r["ticker"]: r for r in rd.ticker_pages(spark, p).collect()}
    assert sorted(got) == ["B", "BRK/A", "C", "D"]
    assert got["BRK/A"]["headquarters"] == "Omaha, NE" and got["B"]["headquarters"] == "" and got["C"]["sic_code"] == 0
    assert got["C"]["primary_exchange"] == "ARCX" and got["C"]["composite_figi"] == ""
    register(spark)
    src = spark.read.format("paged_json").option("path", p)
    assert src.load().count() == 4 and src.load().rdd.getNumPartitions() == 3
    with pytest.raises(Exception, match="3 pages"):
        src.option("maxPages", 2).load().count()
    assert src.option("maxPages", 2).option("more", "stop").load().count() == 3
    d = put(tmp_path / "d" / "x.json", {"results": row("X", sic_code="3571", branding={"icon_url": "i"})})
    assert rd.ticker_details(spark, d).first()["sic_code"] == 3571
    stored = spark.createDataFrame([("BRK/A", ""), ("GONE", "")], "ticker string, composite_figi string")
    assert [r["ticker"] for r in disappeared(stored, rd.ticker_pages(spark, p), ["ticker", "composite_figi"]).collect()] == ["GONE"]


def test_paged_rows_of_any_schema_in_batches_and_streams(spark, tmp_path):
    register(spark)
    put(tmp_path / "p" / "part-2.json", {"datatable": {"data": [["b", 2.5, "2024-01-02", True], ["c", "x", None]]}})
    p = put(tmp_path / "p" / "part-1.json", {"datatable": {"data": [["a", 1, "bad", "false"]]}})
    options = {"path": p, "pattern": r"part-(\d+)\.json", "rows": "datatable.data"}
    ddl = "k string, v double, d date, ok boolean"
    rows = [("a", 1.0, None, False), ("b", 2.5, date(2024, 1, 2), True), ("c", None, None, None)]
    assert [tuple(r) for r in spark.read.format("paged_json").schema(ddl).options(**options).load().orderBy("k").collect()] == rows
    stream = spark.readStream.format("paged_json").schema(ddl).options(**options).load()
    for number, more, n in ((0, None, 3), (10, {"datatable": {"data": [["d", 4, None, None]]}}, 4), (11, {"datatable": None}, 4)):
        if more:
            put(tmp_path / "p" / f"part-{number}.json", more)
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == n


def test_lookups_of_a_ticker_listed_twice_do_not_multiply_rows(spark, tmp_path):
    figis = spark.createDataFrame([("A", "F" * 12), ("A", "G" * 12), ("A", ""), (None, "H" * 12)], "ticker string, composite_figi string")
    members = spark.createDataFrame([("A",), ("A",)], "ticker string")
    p = put(tmp_path / "m" / "m.json", table([["A", "2024-01-02", "x", 1.5, None, 0, 2.0, 1, 2, 3]]))
    assert [r["composite_figi"] for r in rd.daily_metrics(spark, p, figis, members).collect()] == ["G" * 12]
    f = put(tmp_path / "f" / "f.json", table([["A", "ARQ", "2023-12-31", "2024-02-01", "2023-12-30", "bad", *range(6, 111)]]))
    assert rd.fundamentals(spark, f, figis, "2024-03-01").count() == 1
    q = put(tmp_path / "p" / "A.json", [{"date": "2024-01-02T00:00:00.000Z", "close": 1, "volume": 5}])
    assert rd.prices(spark, q, figis).count() == 1
    rows = spark.createDataFrame([("A", ""), ("B", "")], "ticker string, composite_figi string")
    assert [tuple(r) for r in publish(rows, figis, F.col("ticker")).collect()] == [("A", "G" * 12)]


def test_identifier_requests_are_full_and_repeated(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def answer(batch, folder=str(log)):
        import os
        import uuid

        first = not os.listdir(folder)
        open(f"{folder}/{len(batch)}-{uuid.uuid4().hex}", "w").close()
        if first:
            raise OSError("busy")
        return [{"ticker": t, "figi": f"F{t}"} for t in batch]

    found = rd.map_identifiers(spark.range(95).select(F.col("id").cast("string").alias("ticker")).coalesce(1), answer, 10, wait=0.01)
    assert found.collect() and sorted({int(n.split("-")[0]) for n in os.listdir(log)}) == [5, 10]
    with pytest.raises(Exception, match="answers to"):
        rd.map_identifiers(spark.createDataFrame([("x",)], "ticker string"), lambda b: [], 10).collect()


def test_holidays(spark, tmp_path):
    rows = [{"date": "2024-07-03", "exchange": "NYSE", "name": "Eve", "close": "2024-07-03T17:00:00.000Z", "status": "early-close"}, {"date": "2024-07-04", "exchange": "NYSE", "name": "Day", "status": "closed"}, {"date": "bad", "exchange": "NYSE"}]
    got = [tuple(r) for r in rd.holidays(spark, put(tmp_path / "h" / "h.json", rows)).orderBy("event_date").collect()]
    assert got == [("Eve", date(2024, 7, 3), "NYSE", True, "13:00:00"), ("Day", date(2024, 7, 4), "NYSE", False, "16:00:00")]


def test_datatables(spark, tmp_path):
    def ticker(**kw):
        r = [None] * len(TICKERS)
        for k, v in kw.items():
            r[TICKERS.index(k)] = v
        return r

    base = dict(exchange="NYSE", category="Domestic Common Stock", isdelisted="Y", firstpricedate="2001-01-01", lastpricedate="2020-02-02")
    rows = [ticker(ticker="A.B", permaticker=7, cusips=" 1 2 ", secfilings="http://x/?CIK=0009&y", **base), ticker(ticker="OTC", **{**base, "exchange": "OTC"}), ticker(ticker="ODD", **{**base, "category": "Nonsense"}), ticker(ticker="NOX", **{**base, "exchange": ""})]
    a = rd.datatable_tickers(spark, put(tmp_path / "a" / "a.json", table(rows))).collect()
    assert [r["ticker"] for r in a] == ["A/B"]
    assert a[0]["cik"] == "0009" and a[0]["cusips"] == ["1", "2"] and a[0]["similar_tickers"] is None and a[0]["other_identifiers"] == {"sharadar": "7"}
    assert str(a[0]["first_price"])[:10] == "2001-01-01" and str(a[0]["delisted"])[:10] == "2020-02-02"
    figis = spark.createDataFrame([("A", "F" * 12)], "ticker string, composite_figi string")
    members = rd.constituents(spark, put(tmp_path / "s" / "s.json", table([["2024-01-02", "current", "A"], ["2024-01-02", "removed", "B"]])))
    m = rd.daily_metrics(spark, put(tmp_path / "m" / "m.json", table([["A", "2024-01-02", "x", 1.5, None, "bad", 2.0000019, 1, 2, 3], ["B", "2024-01-02"], ["C", "bad"]])), figis, members)
    got = {r["ticker"]: r for r in m.collect()}
    assert sorted(got) == ["A", "B"] and got["A"]["market_cap"] == 2000001 and got["A"]["ev"] == 1500000 and got["A"]["sp500"] and got["A"]["ev_ebitda"] == 0
    assert got["B"]["composite_figi"] == "" and not got["B"]["sp500"] and m.columns == DATA_TYPES["metric"].schema.names
    f = rd.fundamentals(spark, put(tmp_path / "f" / "f.json", table([["A", "ARQ", "2023-12-31", "2024-02-01", "2023-12-30", "bad", *range(6, 111)]])), figis, "2024-03-01")
    assert len(FUNDAMENTAL) == 111 and f.columns == DATA_TYPES["fundamental"].schema.names
    r = f.first()
    assert r["last_updated"] == date(2024, 3, 1) and r["revenues"] == 91 and r["r_and_d_expenses"] == 93 and r["working_capital"] == 110 and r["fx_usd"] == 46.0 and r["composite_figi"] == "F" * 12


def test_zip_prices_and_covered(spark, tmp_path):
    p = tmp_path / "z"
    p.mkdir()
    with zipfile.ZipFile(p / "t.zip", "w") as z:
        z.writestr("t.csv", "ticker,exchange,assetType,priceCurrency,startDate,endDate\nBRK-A,NYSE,Stock,USD,2000-01-01,2024-01-02\nOLD,NYSE,Stock,USD,2000-01-01,2020-01-02\nNO,OTHER,Stock,USD,2000-01-01,\nNODATES,NYSE,Stock,USD,,\nABC-W,NYSE,Stock,USD,2000-01-01,\n")
    got = {r["ticker"]: r for r in rd.covered_assets(rd.zipped_tickers(spark, str(p)), F.lit("2024-01-07").cast("date")).collect()}
    assert sorted(got) == ["BRK/A", "OLD"]
    assert got["BRK/A"]["active"] and str(got["OLD"]["delisted"]) == "2020-01-01", "midnight in UTC is the day before in New York"
    q = put(tmp_path / "p" / "BRK-A.json", [{"date": "2024-01-02T00:00:00.000Z", "close": 1.00005, "volume": 5, "divCash": 0, "splitFactor": 1}, {"date": "2023-01-02T00:00:00Z", "close": 1, "volume": 5}])
    active = spark.createDataFrame([("BRK/A", "F" * 12)], "ticker string, composite_figi string")
    r = rd.prices(spark, q, active, since="2023-12-20").collect()
    assert len(r) == 1 and str(r[0]["close"]) == "1.0001" and r[0]["event_date"] == date(2024, 1, 2) and list(r[0].asDict()) == DATA_TYPES["eod"].schema.names


def test_screener_and_ratings(spark, tmp_path):
    head = ["Ticker", "Change in Avg Rec ", "# Rating Upgrades", "Zacks Rank", "Value Score", "Growth Score", "Last Reported Qtr (yyyymm)", "Next EPS Report Date  (yyyymmdd)", "S&P 500 - ETF"]
    body = ["BRK.A", "NA", "3", "2", "A", "E", "202403", "NA", "Yes"]
    quote = lambda xs: ",".join(f'"{x}"' for x in xs)
    s = rd.screener(spark, put(tmp_path / "c" / "screen-2024-05-06.csv", quote(head) + "\n" + quote(body) + "\n"))
    r = s.first()
    assert len(SCREENER) == 135 and r["ticker"] == "BRK/A" and r["change_in_avg_rec"] == 0 and r["number_rating_upgrades"] == 3 and r["event_date"] == date(2024, 5, 6)
    assert r["last_reported_qtr_date"] == "2024-03-01" and r["next_eps_report_date"] == "0" and r["in_sp500"]
    figis = spark.createDataFrame([("BRK/A", "F" * 12)], "ticker string, composite_figi string")
    assert sorted((x["analyst"], x["rating"]) for x in rd.ratings(s, figis).collect()) == [("zacks-rank", 2), ("zacks-value", 1)]


def test_identifier_batches(spark):
    def answer(batch):
        assert len(batch) <= 10
        return [{"ticker": t, "figi": f"F{t}", "security_type": "ETP", "security_type2": "Mutual Fund"} for t in batch]

    t = spark.createDataFrame([(str(i % 25),) for i in range(100)] + [(None,)], "ticker string")
    found = rd.map_identifiers(t, answer, 10)
    assert found.count() == 25
    assets = spark.createDataFrame([("1", "", "", "Unknown", None), ("2", "X", "s", "CS", None), ("3", "", "", "Unknown", "2020"), ("99", "", "", "Unknown", None)], "ticker string, composite_figi string, share_class_figi string, asset_type string, delisted string")
    got = {r["ticker"]: (r["composite_figi"], r["asset_type"]) for r in apply_identifiers(assets, found, nz.security_kind(F.col("security_type2"), F.col("security_type"))).collect()}
    assert got == {"1": ("F1", "ETF"), "2": ("X", "CS"), "3": ("", "Unknown"), "99": ("", "Unknown")}
