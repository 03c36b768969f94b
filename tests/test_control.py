from datetime import date, datetime, timedelta

import numpy as np

from quillon.operators.control import Limits, chart, implausible_rows

DDL = "id int, k string, d date, c double, v bigint, s double, at timestamp_ntz, reasons_ string"


def calm(n=120, seed=0):
    rng = np.random.default_rng(seed)
    return 50 * np.exp(np.cumsum(rng.normal(0, 0.01, n))), np.exp(rng.normal(12, 0.3, n)).round(), np.ones(n)


def test_each_kind():
    c, v, s = calm()
    c[60] *= 1.3  # spike of one day
    c[80:82] *= 0.7  # of two days
    c[90:96] = c[90]  # five repeats
    v[30], v[31] = v[30] * 200, 1
    s[100] = 2.0  # the close doesn't follow
    c[105] = -1.0
    m = chart(c, v, s, Limits())
    assert m[60] & 2 and m[80] & 2 and m[81] & 2
    assert [bool(x & 4) for x in m[90:97]] == [False, True, True, True, True, True, False]
    assert m[30] == 8 and m[31] == 16 and m[100] == 32 and m[105] == 1
    assert np.count_nonzero(m) == 3 + 5 + 4


def test_no_cases():
    c, v, s = calm(seed=1)
    c[50:] *= 1.5  # a level move that lasts
    c[70:] /= 3
    s[70], v[70:] = 3.0, v[70:] * 3  # a split that the close follows
    v[50] *= 30  # explained by the move
    c[20], v[21] = np.nan, np.nan  # missing values
    assert not chart(c, v, s, Limits()).any()


def test_scale_follows_a_calm_and_a_wild_period():
    rng = np.random.default_rng(4)
    moves = np.concatenate((rng.normal(0, 0.002, 150), rng.normal(0, 0.03, 250)))
    c, v, s = 50 * np.exp(np.cumsum(moves)), np.exp(rng.normal(12, 0.3, 400)).round(), np.ones(400)
    assert not chart(c, v, s, Limits())[200:].any()
    c[100] *= 1.06  # 30 scales of its own period
    c[300] *= 1.5
    m = chart(c, v, s, Limits())
    assert m[100] == 2 and m[300] == 2 and not m[200:300].any() and not m[301:].any()


def test_spike_on_the_last_days_and_plateau_are_suspicions():
    c, v, s = calm(seed=5)
    c[-1] *= 10
    assert chart(c, v, s, Limits()).nonzero()[0].tolist() == [119] and chart(c, v, s, Limits())[119] == 64
    for width, bit in ((2, 2), (4, 128), (10, 128), (11, 0)):
        c, v, s = calm(seed=5)
        c[80 : 80 + width] *= 10
        m = chart(c, v, s, Limits())
        assert m.nonzero()[0].tolist() == (list(range(80, 80 + width)) if bit else []) and set(m[m > 0].tolist()) <= {bit}
    c, v, s = calm(seed=5)
    c[-2:] *= 1.5
    assert set(chart(c, v, s, Limits())[-2:].tolist()) == {64}
    c[-3:-2] *= 1.5  # three days already stand: a move that lasts, as far as anyone knows
    assert not chart(c, v, s, Limits()).any()


def test_flags_do_not_depend_on_later_periods():
    rng = np.random.default_rng(7)
    early = rng.normal(0, 0.002, 150)
    for later in (0.002, 0.06):
        c = 50 * np.exp(np.cumsum(np.concatenate((early, rng.normal(0, later, 250)))))
        c[100] *= 1.03
        m = chart(c, np.exp(np.random.default_rng(1).normal(12, 0.3, 400)).round(), np.ones(400), Limits())
        assert m[:149].nonzero()[0].tolist() == [100], "a wild later period doesn't widen the early limits"


def test_thinly_traded_idle_days():
    c, v, s = calm(seed=2)
    for a in (10, 40, 70):
        c[a : a + 9], v[a + 1 : a + 9] = c[a], 0
    m = chart(c, v, s, Limits())
    assert not (m & (4 | 16)).any()


def test_rows_copies_nulls_and_empty(spark):
    c, v, s = calm()
    c[60] *= 1.4
    day = lambda i: date(2022, 1, 3) + timedelta(i)
    at = datetime(2022, 1, 1)
    rows = [(i, "a", day(i), float(c[i]), int(v[i]), 1.0, at, "x") for i in range(120)]
    rows += [(500, "a", day(60), float(c[60]), None, 1.0, at, "x"), (501, None, day(60), -1.0, 1, 1.0, at, "x"), (502, "a", None, -1.0, 1, 1.0, at, "x"), (503, "b", day(1), None, None, None, None, None)]

    def run(rows, **kw):
        r = spark.createDataFrame(rows, DDL)
        return implausible_rows(r, source=r["k"], day=r["d"], close=r["c"], volume=r["v"], split=r["s"], loaded=r["at"], **kw)

    for most in (10, 0):  # flagged days broadcast, or joined by shuffle
        got = {r["id"]: r["reasons"] for r in run(rows, max_days=most).collect()}
        assert got == {60: ["spike"], 500: ["spike"]}
    assert run([]).count() == 0
