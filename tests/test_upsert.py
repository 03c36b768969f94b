from datetime import date

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillon.operators.partitions import BUCKET, bucket_names, bucket_start
from quillon.operators.upsert import ConcurrentMerge, ParquetStore, upsert, upsert_spec
from quillon.types import DATA_TYPES

ROW = st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3)))
DDL = "k int, fixed string, v int"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=5, unique_by=lambda r: r[0]), st.lists(ROW, max_size=8))
def test_equals_row_by_row_insert_on_conflict(spark, base, batch):
    con = duckdb.connect()
    con.execute("create table t (k int primary key, fixed varchar, v int)")
    for r in [*base, *batch]:
        con.execute("insert into t values (?, ?, ?) on conflict (k) do update set v = excluded.v", r)
    want = sorted(con.execute("select * from t").fetchall(), key=str)
    t = spark.createDataFrame(base, DDL)
    b = spark.createDataFrame([(*r, i) for i, r in enumerate(batch)], DDL + ", seq int")
    once = upsert(t, b, ["k"], ["v"], F.col("seq"))
    assert sorted(map(tuple, once.collect()), key=str) == want
    assert sorted(map(tuple, upsert(once, b, ["k"], ["v"], F.col("seq")).collect()), key=str) == want


def test_ticker_rules_and_guards(spark):
    eod, metric = DATA_TYPES["eod"], DATA_TYPES["metric"]
    assert "ticker" in eod.static and "ticker" in metric.updates
    row = lambda spec, **kw: spark.createDataFrame([tuple(kw.get(c) for c in spec.schema.names)], spec.schema)
    d = date(2024, 1, 2)
    new = upsert_spec(row(metric, ticker="T1", composite_figi="F", event_date=d), row(metric, ticker="T2", composite_figi="F", event_date=d), metric)
    assert new.first()["ticker"] == "T2" and new.first()["market_cap"] == 0
    skipped = upsert_spec(spark.createDataFrame([], metric.schema), row(metric, ticker="", composite_figi="F", event_date=d), metric)
    assert skipped.count() == 0
    kept = upsert_spec(spark.createDataFrame([], eod.schema), row(eod, ticker="T", composite_figi="", event_date=d, close=__import__("decimal").Decimal("2.5")), eod)
    assert float(kept.first()["adj_close"]) == 2.5, "prices have no identifier guard; adj_close starts as close"


def test_bucket_borders(spark):
    days = ["1899-12-31", "1999-12-31", "2000-01-01", "2004-12-31", "2005-01-01", "2015-01-01", "2020-01-01"]
    got = spark.createDataFrame([(d,) for d in days], "d string").select(bucket_start(F.col("d").cast("date"))).collect()
    assert [r[0] for r in got] == [None, 1900, 2000, 2000, 2005, 2015, 2020]
    assert bucket_names("t", 2020) == ["t_1900_2000", "t_2000_2005", "t_2005_2010", "t_2010_2015", "t_2015_2020", "t_2020_2025"]


def prices(spark, rows):
    ddl = "ticker string, composite_figi string, event_date date, close double"
    df = spark.createDataFrame(rows, ddl)
    spec = DATA_TYPES["eod"]
    return df.select(*[F.col(c).cast(spec.schema[c].dataType).alias(c) if c in df.columns else F.lit(None).cast(spec.schema[c].dataType).alias(c) for c in spec.schema.names], F.lit(1).alias("seq"))


def values(store):
    return sorted((r["composite_figi"], r["ticker"], str(r["event_date"]), float(r["close"])) for r in store.read().collect())


def test_store_rewrites_touched_buckets_only(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "eod"), DATA_TYPES["eod"])
    first = store.merge(prices(spark, [("A", "F1", date(1999, 5, 3), 1.0), ("A", "F1", date(2021, 5, 3), 2.0), ("A", "F1", date(1890, 1, 1), 9.0), ("A", "F1", None, 9.0)]), F.col("seq"))
    assert first == (2, 2, 1) and sorted(float(r["close"]) for r in store.rejects().collect()) == [9.0, 9.0]
    old = sorted((tmp_path / "eod" / "data" / f"{BUCKET}=1900").iterdir())
    assert store.merge(prices(spark, [("B", "F1", date(2021, 5, 3), 3.0), ("A", "F2", date(2022, 5, 3), 4.0)]), F.col("seq")) == (2, 0, 2)
    assert sorted((tmp_path / "eod" / "data" / f"{BUCKET}=1900").iterdir()) == old
    assert values(store) == [("F1", "A", "1999-05-03", 1.0), ("F1", "A", "2021-05-03", 3.0), ("F2", "A", "2022-05-03", 4.0)]
    assert sorted(float(r["close"]) for r in store.read(1).collect()) == [1.0, 2.0], "the version before is still there"
    month = store.read_range("2020-01-01", "2021-12-31")
    assert month.count() == 1 and f"PartitionFilters: [isnotnull({BUCKET}" in month._jdf.queryExecution().executedPlan().toString()
    assert store.vacuum() == 1 and len(values(store)) == 3


def test_merge_that_dies_before_its_log_entry_leaves_the_table(spark, tmp_path, monkeypatch):
    store = ParquetStore(spark, str(tmp_path / "eod"), DATA_TYPES["eod"])
    store.merge(prices(spark, [("A", "F1", date(1999, 5, 3), 1.0), ("A", "F1", date(2021, 5, 3), 2.0)]), F.col("seq"))
    before = values(store)
    batch = prices(spark, [("A", "F1", date(1999, 5, 3), 7.0), ("A", "F1", date(2021, 5, 3), 8.0)])
    with monkeypatch.context() as m:
        m.setattr(ParquetStore, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            store.merge(batch, F.col("seq"))
    assert values(ParquetStore(spark, store.root, store.spec)) == before, "neither of the two new buckets shows"
    store.merge(batch, F.col("seq"))
    assert [v[-1] for v in values(store)] == [7.0, 8.0] and store.vacuum() == 4


def test_of_two_writers_on_one_version_one_is_told(spark, tmp_path):
    a = ParquetStore(spark, str(tmp_path / "a"), DATA_TYPES["eod"])
    a.create()
    n, state = a._newest()
    a.merge(prices(spark, [("A", "F1", date(2021, 5, 3), 2.0)]), F.col("seq"))
    with pytest.raises(ConcurrentMerge):
        a._commit(n, state)
    assert len(values(a)) == 1
    assert sorted(p.name for p in (tmp_path / "a" / "log").iterdir() if p.suffix != ".crc") == ["000000000001.json", "000000000002.json"]


@pytest.mark.parametrize(("name", "column"), [("rating", "event_year"), ("asset-description", "key_bucket")])
def test_other_types_rewrite_touched_buckets_only(spark, tmp_path, name, column):
    spec = DATA_TYPES[name]
    store = ParquetStore(spark, str(tmp_path / name), spec)

    def rows(figis, year):
        have = {"ticker": F.lit("T"), "composite_figi": F.col("f"), "event_date": F.make_date(F.lit(year), F.lit(1), F.lit(2)), "analyst": F.lit("a"), "rating": F.lit(year), "name": F.lit(str(year))}
        base = spark.createDataFrame([(f,) for f in figis], "f string")
        return base.select(*[have.get(c, F.lit(None)).cast(spec.schema[c].dataType).alias(c) for c in spec.schema.names], F.lit(1).alias("seq"))

    store.merge(rows([f"F{i}" for i in range(200)], 2020), F.col("seq"))
    made = len(list((tmp_path / name / "data").glob(f"{column}=*")))
    assert made == 1 if column == "event_year" else 50 < made <= 64
    second = store.merge(rows(["F1"], 2021), F.col("seq"))
    assert second.rows <= (1 if column == "event_year" else 20)
    assert store.read().count() == (201 if column == "event_year" else 200)


def test_failed_merge_leaves_the_table(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "i"), DATA_TYPES["economic-indicator"])
    good = spark.createDataFrame([("a", date(2024, 1, 1), 1.0, 1)], "series string, event_date date, value float, seq int")
    store.merge(good, F.col("seq"))
    with pytest.raises(Exception):  # noqa: B017
        store.merge(good.withColumn("value", F.raise_error(F.lit("broken")).cast("float")), F.col("seq"))
    assert [tuple(r) for r in store.read().collect()] == [("a", date(2024, 1, 1), 1.0)]
    assert store.merge(good.where("false"), F.col("seq")) == (0, 0, 1)
