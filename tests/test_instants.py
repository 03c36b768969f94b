import pytest
from brute_instants import brute, micros
from datetime import datetime

from quillon.operators.instants import to_instants

ZONES = [("XNYS", "America/New_York", False), ("XLON", "Europe/London", True), ("XASX", "Australia/Sydney", True), ("XNSE", "Asia/Kolkata", True), ("XNSE", "Asia/Kolkata", True)]


def run(spark, rows):
    v = spark.createDataFrame([(i, m, r) for i, (r, m) in enumerate(rows)], "id int, mic string, raw string")
    z = spark.createDataFrame(ZONES, "mic string, tz string, df boolean")
    out = to_instants(v, z, raw=v["raw"], place=v["mic"], zone_place=z["mic"], tz_name=z["tz"], day_first=z["df"]).collect()
    assert len(out) == len(rows)
    return {r["id"]: r["utc_us"] for r in out}


TEXTS = [
    "2024-03-10", "2024-03-10 02:30:00", "2024-11-03 01:30:00", "2020-02-30", "2019-02-29", "2020-02-29", "20200229", "202002", "2020-W53-7", "2021-W53-1",
    "2020-366", "2021-366", "05/06/2020", "13/06/2020", "5.6.2020", "31.12.2020 24:00", "31.12.2020 24:01", "19-Jun-13", "31-Feb-13", "Jun 3, 2020",
    "Jun 3, 2020 12:30 AM", "06/07/2020 12:05 PM", "1500000000", "1500000000123", "1500000000123456", "0", "12345", "2020-01-01T10:00:00Z",
    "2020-01-01t10:00:00z", "2020-01-01T10:00:00.123456789+05:30", "2020-01-01 10:00:00,5", "Thu, 02 Jan 2020 03:04:05 GMT",
    "Thu, 02 Jan 2020 03:04:05 -0500", "2020-07-01T10:00:00[Europe/London]", "2020-07-01T10:00:00-04:00[America/New_York]", "20200102 030405",
    "20200102T030405Z", "  2020-01-01\t", "n/a", "", "09:30", "25:00", "2020-01-01T25:00:00Z", "2020-01-01 10:60:00", "0000-00-00",
]


def test_against_brute_force(spark):
    rows = [(t, m) for t in TEXTS for m in (None, "XNYS", "XLON", "XASX", "????")]
    zone = {m: (tz, df) for m, tz, df in ZONES}
    got = run(spark, rows)
    for i, (t, m) in enumerate(rows):
        tz, df = zone.get(m, (None, False))
        assert got[i] == brute(t, tz, df), (t, m)


def test_abbreviations_and_nulls(spark):
    rows = [("2020-06-01 10:00:00 EDT", None), ("2020-06-01 10:00:00 EST", "XASX"), ("2020-06-01 10:00:00 IST", "XNSE"), ("2020-06-01 10:00:00 QQQ", "XNYS"), (None, None), ("x" * 100_000, None), ("2020-06-01T10:00:00[Nowhere/Land]", "XNYS")]
    got = run(spark, rows)
    at = lambda h, m=0, d=1: micros(datetime(2020, 6, d, h, m))
    assert [got[i] for i in range(7)] == [at(14), at(0), at(4, 30), None, None, None, None]


def test_gap_and_overlap(spark):
    got = run(spark, [("2024-03-10 02:30:00", "XNYS"), ("2024-11-03 01:30:00", "XNYS")])
    assert got[0] == micros(datetime(2024, 3, 10, 7, 30)), "offset in force before the change"
    assert got[1] == micros(datetime(2024, 11, 3, 5, 30)), "the first occurrence"


def test_empty_and_clashing(spark):
    z = spark.createDataFrame(ZONES, "mic string, tz string, df boolean")
    v = spark.createDataFrame([], "id int, mic string, raw string")
    args = dict(place=v["mic"], zone_place=z["mic"], tz_name=z["tz"], day_first=z["df"])
    assert to_instants(v, z, raw=v["raw"], **args).count() == 0
    with pytest.raises(ValueError):
        to_instants(v, z, raw=v["raw"], into="MIC", **args)
