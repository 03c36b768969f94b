import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quillon.operators.history import attribute_history

T0 = datetime(2020, 1, 1)
DDL = "k string, at timestamp_ntz, got timestamp_ntz, sector string, active boolean, gone date, k_ string"


def brute(rows):
    by = {}
    for k, at, got, s, a, g, _ in rows:
        if k is not None and at is not None:
            by.setdefault(k, {}).setdefault(at, []).append((got, s, a, g))
    out = []
    for k, times in by.items():
        state = None
        for at in sorted(times):
            _, s, a, g = max(times[at], key=lambda x: x[0])
            new = (s if s is not None else (state or (None,) * 3)[0], a if a is not None else (state or (None,) * 3)[1], g)
            if state is None or new != state:
                out.append([k, at, None, *new])
                if state is not None and out[-2][0] == k:
                    out[-2][2] = at
            state = new
    return sorted(map(tuple, out), key=str)


def run(spark, rows, block):
    r = spark.createDataFrame(rows, DDL)
    h = attribute_history(r, entity=r["k"], changed_at=r["at"], received_at=r["got"], carried={"sector": r["sector"], "active": r["active"]}, stated={"gone": r["gone"]}, block_rows=block)
    return sorted(map(tuple, h.collect()), key=str)


def test_brute_force_with_hot_key_and_small_blocks(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        at = rng.choice([T0 + timedelta(hours=rng.randrange(150)), None]) if i % 50 == 0 else T0 + timedelta(hours=rng.randrange(150))
        gone = rng.choice([None, None, None, T0.date()])
        rows.append((rng.choice(["hot", "hot", "b", "c", None]), at, T0 + timedelta(seconds=i), rng.choice(["x", "y", None]), rng.choice([True, False, None, None]), gone, "z"))
    for block in (3, 16, 1024):
        assert run(spark, rows, block) == brute(rows)


def test_hot_key_that_changes_at_every_row(spark):
    rows = [("hot", T0 + timedelta(hours=i), T0, "xyz"[i % 3] if i % 7 else None, [True, False, None][i % 5 % 3], None if i % 4 else T0.date(), "") for i in range(400)]
    rows += [("calm", T0 + timedelta(hours=i), T0, "x", None, None, "") for i in range(60)]
    for block in (2, 5, 1024):
        assert run(spark, rows, block) == brute(rows)


def test_windows_see_block_summaries_only(spark):
    r = spark.createDataFrame([("a", T0, T0, "x", None, None, "")], DDL)
    h = attribute_history(r, entity=r["k"], changed_at=r["at"], received_at=r["got"], carried={"sector": r["sector"]}, stated={"gone": r["gone"]})
    plan = h._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("__q_block" in w and "__q_rows" not in w for w in windows)


def test_labels_are_carried_but_not_compared(spark):
    day = lambda i: T0 + timedelta(i)
    rows = [("a", day(0), T0, "Real Estate", None, None, ""), ("a", day(1), T0, "RealEstate", None, None, ""), ("a", day(2), T0, None, True, None, ""), ("a", day(3), T0, "x y", None, None, ""), ("a", day(4), T0, "realestate", None, None, "")]
    r = spark.createDataFrame(rows, DDL)
    key = F.lower(F.translate(r["sector"], " ", ""))
    for block in (1, 2, 3, 1024):
        h = attribute_history(
            r, entity=r["k"], changed_at=r["at"], received_at=r["got"], carried={"key": key, "active": r["active"]}, stated={"gone": r["gone"]},
            labels={"sector": ("key", r["sector"])}, block_rows=block,
        )
        got = [(x["valid_from"], x["sector"], x["active"]) for x in h.orderBy("valid_from").collect()]
        assert got == [(day(0), "Real Estate", None), (day(2), "Real Estate", True), (day(3), "x y", True), (day(4), "realestate", True)]


def test_empty_and_repeats(spark):
    assert run(spark, [], 8) == []
    row = ("a", T0, T0, None, None, None, "")
    assert len(run(spark, [row] * 5, 8)) == 1
