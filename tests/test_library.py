import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from pyspark.sql import types as T

from quillon import catalog, sinks
from quillon.library import Library, Migration
from quillon.operators.enrich import delisted
from quillon.operators.timeseries import changes_against, changes_only, latest_per_key
from quillon.operators.upsert import ParquetStore
from quillon.streaming import ingest
from quillon.types import DATA_TYPES

SUBS = [catalog.Subscription("abc12345", "n", "fred", "Economic Indicators", ("economic-indicator",)), catalog.Subscription("abd99999", "n", "tiingo", "EOD", ("eod",), active=False)]


def test_catalog_and_report(spark):
    c = catalog.as_rows(spark, SUBS)
    assert catalog.find(c, "abc").count() == 1 and catalog.find(c, "x").count() == 0
    with pytest.raises(ValueError):
        catalog.find(c, "ab")
    assert catalog.scan(c).first()["last_run"].year == 1
    text = catalog.report(c, "Lib", "2024-06-01")
    assert "Last updated: never" in text and "fred Economic Indicators" in text and "## Inactive subscriptions\n\n  * tiingo EOD [abd999]" in text
    assert catalog.totals(spark.createDataFrame([], c.schema)).first()["total_records"] == 0


def test_images(spark, tmp_path):
    rows = [("F1", b"i", "image/jpeg", b"l", "image/svg+xml"), ("F2", b"i", "", None, None), ("F3", b"x", "image/gif", b"y", "image/png")]
    a = spark.createDataFrame(rows, "composite_figi string, icon binary, icon_mime string, logo binary, logo_mime string")
    sinks.write_images(a, f"file://{tmp_path}/img")
    assert sorted(os.listdir(tmp_path / "img")) == ["F1-icon.jpg", "F1-logo.svg", "F3-logo.png"]
    assert sinks.image_files(a).where("name is null").count() == 1
    sinks.write_images(a, f"{tmp_path}/plain/deep")
    assert sorted(os.listdir(tmp_path / "plain" / "deep")) == ["F1-icon.jpg", "F1-logo.svg", "F3-logo.png"]
    with pytest.raises(Exception, match="nowhere"):
        sinks.write_images(a, "nowhere://x/y")


def test_export_by_year(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2023, 1, 1)), (2, date(2024, 1, 1))], "a int, d date")
    sinks.export(df, str(tmp_path / "e"), F.year("d"))
    sinks.export(df.where("a = 2").withColumn("a", F.lit(3)), str(tmp_path / "e"), F.year("d"))
    assert sorted(r["a"] for r in spark.read.parquet(str(tmp_path / "e")).collect()) == [1, 3]


def test_newest_and_changes_per_security(spark):
    rows = [("z", "A", 1, 1), ("z", "B", 2, 1), ("z", "A", 3, 1), ("z", "B", 4, 2), ("z", "A", 5, None), ("z", "A", 6, None)]
    r = spark.createDataFrame(rows, "analyst string, figi string, day int, rating int")
    got = sorted((x["figi"], x["day"]) for x in changes_only(r, ["analyst", "figi"], ["day"], "rating").collect())
    assert got == [("A", 1), ("A", 5), ("B", 2), ("B", 4)]
    assert sorted((x["figi"], x["day"]) for x in latest_per_key(r, ["figi"], [F.desc("day")]).collect()) == [("A", 6), ("B", 4)]


def test_changes_against_the_store(spark):
    ddl = "k string, day int, v int"
    stored = spark.createDataFrame([("a", 1, 1), ("a", 9, 2), ("a", 9, 1), ("n", 1, None), (None, 1, 5)], ddl)
    batch = spark.createDataFrame([("a", 3, 2), ("a", 4, 2), ("a", 5, 3), ("new", 1, None), ("n", 2, None), ("n", 3, 1), (None, 2, 5)], ddl)
    got = sorted(map(tuple, changes_against(batch, stored, ["k"], "day", "v").collect()), key=str)
    assert got == [("a", 5, 3), ("n", 3, 1), ("new", 1, None)]
    assert changes_against(batch, stored.limit(0), ["k"], "day", "v").count() == 6 and changes_against(batch.limit(0), stored, ["k"], "day", "v").count() == 0


def test_delisted_rows_are_confirmed_or_silent(spark):
    day = date(2024, 1, 1)
    rows = [("here", True, None, day), ("proven", True, None, date(2024, 2, 28)), ("silent", True, None, day), ("fresh", True, None, date(2024, 2, 28)), ("off", False, None, day), ("old", True, day, day), (None, True, None, day)]
    stored = spark.createDataFrame(rows, "ticker string, active boolean, delisted date, last_updated date")
    current = spark.createDataFrame([("here",), ("here",)], "ticker string")
    proof = spark.createDataFrame([("proven", date(2024, 2, 1)), ("proven", date(2024, 2, 2)), ("here", day)], "ticker string, delisted date")
    got = {r["ticker"]: (r["active"], r["delisted"]) for r in delisted(stored, current, proof, ["ticker"], F.lit("2024-03-01").cast("date")).collect()}
    assert got == {"proven": (False, date(2024, 2, 2)), "silent": (False, day)}


def test_observed_rows(spark, tmp_path):
    from pyspark.sql import Observation

    seen = Observation("run")
    spark.range(7).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(str(tmp_path / "o"))
    assert seen.get["rows"] == 7


def test_stream_equals_batch_and_replay(spark, tmp_path):
    ddl = "series string, event_date date, value float, seq int"
    rows = [("a", date(2024, 1, 1 + i % 5), float(i), i) for i in range(20)]
    for k in range(4):
        spark.createDataFrame(rows[k * 5 : k * 5 + 5], ddl).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{k}"))
    log = ingest.RunLog()
    spark.streams.addListener(log)
    spec = DATA_TYPES["economic-indicator"]
    out = []
    for run in ("one", "two"):
        store = ParquetStore(spark, str(tmp_path / run), spec)
        for _ in range(2):  # the second start has nothing new
            s = ingest.file_stream(spark, str(tmp_path / "in" / "*"), spark.read.parquet(str(tmp_path / "in" / "f0")).schema)
            ingest.merge_stream(s, store, F.col("seq"), str(tmp_path / f"{run}-c")).awaitTermination()
        out.append(sorted(map(tuple, store.read().collect())))
    last = {d: v for _, d, v, _ in rows}
    assert out[0] == out[1] == sorted(("a", d, v) for d, v in last.items())
    spark.streams.removeListener(log)


def test_route_stream_and_windows(spark, tmp_path):
    obs = spark.createDataFrame([(1, ("a", date(2024, 1, 1), 1.0), None), (9, ("b", date(2024, 1, 1), 2.0), None), (1, None, ("H", date(2024, 1, 1), "NYSE", None, None))], "subscription_id int, ind struct<series string, event_date date, value float>, hol struct<holiday string, event_date date, market string, early_close boolean, close_time string>")
    obs.write.parquet(str(tmp_path / "in"))
    stores = {k: ParquetStore(spark, str(tmp_path / k), DATA_TYPES[n]) for k, n in (("ind", "economic-indicator"), ("hol", "market-holidays"))}
    s = ingest.file_stream(spark, str(tmp_path / "in"), obs.schema)
    subs = spark.createDataFrame([(1,)], "subscription_id int")
    ingest.route_stream(s, subs, {"ind": "ind", "hol": "hol"}, stores, lambda: F.lit(1), str(tmp_path / "rej"), str(tmp_path / "c")).awaitTermination()
    assert stores["ind"].read().count() == 1 and stores["hol"].read().first()["close_time"] == "16:00:00"
    assert spark.read.parquet(str(tmp_path / "rej")).count() == 1
    e = spark.createDataFrame([(i, "k") for i in range(3)], "i int, kind string").withColumn("ts", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, i * 4)"))
    e.coalesce(1).write.parquet(str(tmp_path / "ev"))
    w = ingest.windowed_counts(ingest.file_stream(spark, str(tmp_path / "ev"), e.schema), "ts", "kind", "5 minutes", "1 minute")
    q = w.writeStream.format("memory").queryName("win").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["n"] for r in spark.table("win").collect()) == [1, 2]


def test_library_saves_drops_counts_and_migrates(spark, tmp_path, monkeypatch):
    lib = Library(spark, str(tmp_path / "lib"))
    s = lib.save(catalog.Subscription("", "rates", "fred", "Economic Indicators", ("economic-indicator",)))
    assert len(s.subscription_id) == 36
    with pytest.raises(ValueError, match="exists"):
        lib.save(s)
    with pytest.raises(ValueError, match="unknown"):
        lib.save(catalog.Subscription("x", "n", "p", "d", ("nothing",)))
    other = lib.save(catalog.Subscription("abd99999", "n", "tiingo", "EOD", ("eod", "custom"), active=False))
    store = lib.stores(s.subscription_id)["economic-indicator"]
    assert store.exists() and store.read().count() == 0
    store.merge(spark.createDataFrame([("a", date(2024, 1, 1), 1.0), ("a", date(2024, 2, 1), 2.0)], "series string, event_date date, value float"))
    lib.count(s.subscription_id)
    lib.set_active(s.subscription_id, False)
    row = lib.catalog().where(F.col("subscription_id") == s.subscription_id).first()
    assert row["total_records"] == 2 and str(row["last_obs"])[:10] == "2024-02-01" and not row["active"]

    wider = T.StructType([*DATA_TYPES["economic-indicator"].schema.fields, T.StructField("unit", T.StringType())])
    steps = [Migration(1, "unit", "economic-indicator", wider, lambda t: t.withColumn("unit", F.lit("index")))]
    with monkeypatch.context() as m:
        m.setattr(Library, "_record", lambda *a: (_ for _ in ()).throw(OSError))
        with pytest.raises(OSError):
            lib.migrate(steps)
    versions = store.version()
    assert [n for _, n in lib.migrate(steps)] == [1] and lib.migrate(steps) == [] and store.version() == versions, "not rewritten twice"
    again = lib.stores(s.subscription_id)["economic-indicator"]
    again.merge(spark.createDataFrame([("b", date(2024, 3, 1), 3.0, "percent")], wider))
    assert sorted((r["series"], r["unit"]) for r in again.read().collect()) == [("a", "index"), ("a", "index"), ("b", "percent")]

    roots = [x.root for x in lib.stores(other.subscription_id).values()]
    lib.drop(other.subscription_id)
    assert lib.catalog().count() == 1 and len(roots) == 2 and not any(os.path.exists(r) for r in roots)
