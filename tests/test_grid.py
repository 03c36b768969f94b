import math
import random
from datetime import date, timedelta

import numpy as np

from quillon.operators.grid import regular_grid

D0 = date(2020, 1, 6)
DDL = "s string, d date, v float, r int, series string"


def run(spark, rows, cal, **kw):
    r, c = spark.createDataFrame(rows, DDL), spark.createDataFrame(cal, "s string, f string")
    return regular_grid(r, c, series=r["s"], day=r["d"], value=r["v"], revision=r["r"], calendar_series=c["s"], frequency=c["f"], **kw)


def test_daily_fit_against_direct_regression(spark):
    rng = random.Random(3)
    rows = [("a", D0 + timedelta(i), float(i * 2 + rng.random()), 1, "x") for i in range(1200) if rng.random() < 0.6]
    rows += [("a", D0 + timedelta(5), float("nan"), 2, "x"), ("a", D0 + timedelta(7), None, 2, "x")]
    got = {r["period_index"]: r for r in run(spark, rows, [("a", "D"), ("a", "D")]).collect()}
    good = {(d - date(1970, 1, 1)).days: np.float32(v) for _, d, v, _, _ in rows if v is not None and not math.isnan(v)}
    lo, hi = min(good), max(good)
    assert sorted(got) == list(range(lo, hi + 1))
    for g, r in got.items():
        near = [(t - g, v) for t, v in good.items() if abs(t - g) < 3]
        w = np.array([(1 - (abs(x) / 3) ** 3) ** 3 for x, _ in near])
        assert r["n_readings"] == (g in good)
        assert r["status"] == ("observed" if g in good else r["status"])
        if len(near) > 1:
            x, y = np.array([x for x, _ in near]), np.array([v for _, v in near], float)
            c = np.polyfit(x, y, 1, w=np.sqrt(w)) if len(set(x)) > 1 else [0, y.mean()]
            assert abs(r["fit"] - c[1]) < 1e-6 * max(1, abs(c[1]))
            assert abs(r["support"] - w.sum() ** 2 / (w**2).sum()) < 1e-9


def test_periods(spark):
    rows = [("b", date(2024, 1, 5), 1.0, 1, ""), ("b", date(2024, 1, 6), 9.0, 1, ""), ("b", date(2024, 1, 9), 2.0, 1, ""), ("m", date(2023, 11, 30), 1.0, 1, ""), ("m", date(2024, 2, 1), 1.0, 1, ""), ("w", date(2024, 1, 1), 1.0, 1, ""), ("w", date(2024, 1, 21), 1.0, 1, ""), ("q", date(2023, 12, 31), 1.0, 1, ""), ("q", date(2024, 7, 1), 1.0, 1, ""), ("none", date(2024, 1, 1), 1.0, 1, ""), ("x", date(2024, 1, 1), 1.0, 1, "")]
    got = run(spark, rows, [("b", "B"), ("m", "M"), ("w", "W"), ("q", "Q"), ("x", "?")])
    holes = sorted((r["series"], str(r["period_start"])) for r in got.where("n_readings = 0").collect())
    assert holes == [("b", "2024-01-08"), ("m", "2023-12-01"), ("m", "2024-01-01"), ("q", "2024-01-01"), ("q", "2024-04-01"), ("w", "2024-01-08")]


def test_revisions_ties_long_gap_and_empty(spark):
    rows = [("a", D0, 1.0, 1, ""), ("a", D0, 5.0, 2, ""), ("a", D0, 5.0, 2, ""), ("a", D0 + timedelta(20), 2.0, 1, "")]
    got = {str(r["period_start"]): r for r in run(spark, rows, [("a", "D")]).collect()}
    assert got[str(D0)]["observed"] == 5.0 and len(got) == 21
    middle = got[str(D0 + timedelta(10))]
    assert middle["status"] == "missing" and middle["value"] is None and middle["support"] == 0
    assert run(spark, [], [("a", "D")]).count() == 0 and run(spark, rows, []).count() == 0
