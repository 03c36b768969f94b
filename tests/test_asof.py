import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quillon.operators.asof import known_as_of

D0 = date(2020, 1, 1)
EV, FA = "id int, k string, day date, note string", "fid int, k string, period date, known date, v double, note string"


def run(spark, events, facts):
    e, f = spark.createDataFrame(events, EV), spark.createDataFrame(facts, FA)
    return known_as_of(e, f, event_key=e["k"], event_time=e["day"], fact_key=f["k"], known_from=f["known"], precedence=["period", "known", "fid"])


def test_brute_force(spark):
    rng = random.Random(1)
    day = lambda: D0 + timedelta(days=rng.randrange(60))
    events = [(i, rng.choice(["a", "b", "hot", "hot", "hot", None]), rng.choice([day(), day(), None]), "e") for i in range(300)]
    facts = [(i, rng.choice(["a", "hot", "c", None]), rng.choice([day(), None]), rng.choice([day(), day(), None]), float(i), "f") for i in range(80)]
    got = {r["id"]: r["fact"]["fid"] for r in run(spark, events, facts).collect()}
    want = {}
    for i, k, d, _ in events:
        known = [f for f in facts if k is not None and d is not None and f[1] == k and f[3] is not None and f[3] <= d]
        if known:
            want[i] = max(known, key=lambda f: (f[2] or date.min, f[3], f[0]))[0]
    assert got == want and got


def test_late_filing_repeats_and_names(spark):
    facts = [(1, "a", D0, D0 + timedelta(10), 1.0, "x"), (2, "a", D0 - timedelta(90), D0 + timedelta(20), 2.0, "x"), (1, "a", D0, D0 + timedelta(10), 1.0, "x")]
    events = [(1, "a", D0 + timedelta(9), "n"), (2, "a", D0 + timedelta(10), "n"), (3, "a", D0 + timedelta(30), "n"), (3, "a", D0 + timedelta(30), "n")]
    got = sorted((r["id"], r["fact"]["fid"], r["note"], r["fact"]["note"]) for r in run(spark, events, facts).collect())
    assert got == [(2, 1, "n", "x"), (3, 1, "n", "x"), (3, 1, "n", "x")]


def test_empty_and_clash(spark):
    assert run(spark, [], []).count() == 0
    e, f = spark.createDataFrame([], EV).withColumn("fact", F.lit(1)), spark.createDataFrame([], FA)
    with pytest.raises(ValueError):
        known_as_of(e, f, event_key=e["k"], event_time=e["day"], fact_key=f["k"], known_from=f["known"], precedence=["fid"])
