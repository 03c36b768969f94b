"""Irregular readings onto a regular grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Day number of Monday 1970-01-05, from which weeks are counted.
MONDAY = 4
#: Grid periods that one block of the grid holds.
BLOCK = 512


def period_index(day: Column, frequency: Column) -> Column:
    """Running number of the period that a date belongs to; null for a weekend at frequency B.

    D: calendar days, B: Mondays to Fridays, W: weeks from Monday, M: months, Q: quarters.
    """
    n = F.unix_date(day).cast("long")
    week, dow = F.floor((n - MONDAY) / 7), F.pmod(n - MONDAY, F.lit(7))
    return (
        F.when(frequency == "D", n)
        .when((frequency == "B") & (dow < 5), week * 5 + dow)
        .when(frequency == "W", week)
        .when(frequency == "M", F.year(day) * 12 + F.month(day) - 1)
        .when(frequency == "Q", F.year(day) * 4 + F.quarter(day) - 1)
        .cast("long")
    )


def period_start(index: Column, frequency: Column) -> Column:
    """First day of a period, the inverse of :func:`period_index`."""
    month = F.when(frequency == "M", index).otherwise(index * 3)
    return (
        F.when(frequency == "D", F.date_from_unix_date(index.cast("int")))
        .when(frequency == "B", F.date_from_unix_date((F.floor(index / 5) * 7 + F.pmod(index, F.lit(5)) + MONDAY).cast("int")))
        .when(frequency == "W", F.date_from_unix_date((index * 7 + MONDAY).cast("int")))
        .when(frequency.isin("M", "Q"), F.add_months(F.lit("1970-01-01").cast("date"), (month - 1970 * 12).cast("int")))
    )


def finite(value: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    v = value.cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def regular_grid(
    readings: DataFrame,
    calendar: DataFrame,
    *,
    series: Column,
    day: Column,
    value: Column,
    revision: Column,
    calendar_series: Column,
    frequency: Column,
    half_width: float = 3.0,
    min_support: float = 2.0,
) -> DataFrame:
    """One row per series and period from its first to its last period with a good reading.

    Columns: series, frequency, period_index, period_start, n_readings (dates with a good reading in the
    period), observed (reading of the latest such date, its latest revision), fit, support, value, status.
    ``fit`` is a local linear regression at the period's middle over the readings within ``half_width``
    periods, weighted with the tricube kernel, which is zero beyond that width; ``support`` is the effective
    number of readings, (sum w)^2 / sum w^2. status: ``observed`` (value = observed), ``filled`` (no reading;
    value = fit), ``missing`` (no reading and support below ``min_support``, or readings on one side only;
    value null).

    Method: every reading adds its kernel-weighted moments to the few grid periods it can reach, and each
    period solves its 2x2 system in closed form; no window, no Python.

    Scale: readings are first reduced to one per series and date (map-side combined), then placed in blocks of
    512 periods with a halo of ``half_width``; regression and grid are computed inside a block, so a series
    with a third of all rows is spread over its blocks, and no task holds a whole series.

    Defined cases: void readings (null, NaN, infinite), readings without series or date, of a series not in
    the calendar or one with an unknown frequency, and weekend readings at frequency B are no readings. Of
    several readings of a date, the one with the greatest ``revision`` holds, then the greatest value. A
    calendar that names a series twice counts once (least frequency code). Empty inputs give no rows.
    """
    good = readings.select(series.alias("s"), day.cast("date").alias("d"), value.cast("double").alias("v"), revision.alias("r")).where(
        finite(F.col("v")) & F.col("s").isNotNull() & F.col("d").isNotNull()
    )
    per_day = good.groupBy("s", "d").agg(F.max(F.struct("r", "v")).alias("x")).select("s", "d", F.col("x.v").alias("v"))
    freq = (
        calendar.select(calendar_series.alias("s"), frequency.alias("f"))
        .where(F.col("s").isNotNull() & F.col("f").isin("D", "B", "W", "M", "Q"))
        .groupBy("s")
        .agg(F.min("f").alias("f"))
    )
    placed = per_day.join(freq, "s").withColumn("i", period_index(F.col("d"), F.col("f"))).where("i is not null")
    start = period_start(F.col("i"), F.col("f"))
    length = F.when(F.col("f").isin("D", "B"), 1.0).when(F.col("f") == "W", 7.0).otherwise(
        F.datediff(period_start(F.col("i") + 1, F.col("f")), start).cast("double")
    )
    #: Middle of the reading's day, in periods; a period's own middle is its index plus one half.
    placed = placed.withColumn("p", F.col("i") + (F.datediff(F.col("d"), start) + 0.5) / length)
    # A reading reaches the periods whose middle lies less than half_width from it.
    reach = int(half_width) + 1
    lo, hi = F.col("i") - reach, F.col("i") + reach
    halo = placed.select(
        "s", "f", F.explode(F.sequence(F.floor(lo / BLOCK), F.floor(hi / BLOCK))).alias("b"), "i", "d", "p", "v",
        F.lit(None).cast("long").alias("g0"), F.lit(None).cast("long").alias("g1"),
    )
    ends = placed.groupBy("s", "f").agg(F.min("i").alias("g0"), F.max("i").alias("g1"))
    empty = lambda t: F.lit(None).cast(t)
    skeleton = ends.select(
        "s", "f", F.explode(F.sequence(F.floor(F.col("g0") / BLOCK), F.floor(F.col("g1") / BLOCK))).alias("b"),
        empty("long").alias("i"), empty("date").alias("d"), empty("double").alias("p"), empty("double").alias("v"), "g0", "g1",
    )
    both = halo.unionByName(skeleton).repartition("s", "f", "b")
    first, last = F.col("b") * BLOCK, F.col("b") * BLOCK + (BLOCK - 1)
    spread = both.select(
        "*",
        F.explode(
            F.when(F.col("i").isNull(), F.sequence(F.greatest("g0", first), F.least("g1", last))).otherwise(
                F.filter(F.sequence(lo, hi), lambda g: (g >= first) & (g <= last))
            )
        ).alias("g"),
    )
    x = F.col("p") - F.col("g") - 0.5
    u = F.abs(x) / half_width
    t = 1 - u * u * u
    w = F.when(u < 1, t * t * t)
    own = F.col("i") == F.col("g")
    moments = (
        spread.withColumn("x", x)
        .withColumn("w", w)
        .groupBy("s", "f", "b", "g")
        .agg(
            F.max(F.col("i").isNull()).alias("on_grid"),
            F.count(F.when(own, 1)).alias("n_readings"),
            F.max(F.when(own, F.struct("d", "v"))).alias("obs"),
            *[F.sum(e).alias(n) for n, e in {
                "s0": F.col("w"), "ww": F.col("w") * F.col("w"), "s1": F.col("w") * F.col("x"),
                "s2": F.col("w") * F.col("x") * F.col("x"), "t0": F.col("w") * F.col("v"),
                "t1": F.col("w") * F.col("x") * F.col("v"),
                "left": F.when((F.col("w") > 0) & (F.col("x") <= 0), 1), "right": F.when((F.col("w") > 0) & (F.col("x") >= 0), 1),
            }.items()],
        )
        .where("on_grid")
    )
    det = F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1")
    line = (F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1")) / det
    fit = F.when(F.col("s0") > 0, F.when(det > 1e-9 * F.col("s0") * F.col("s0"), line).otherwise(F.col("t0") / F.col("s0")))
    support = F.coalesce(F.when(F.col("s0") > 0, F.col("s0") * F.col("s0") / F.col("ww")), F.lit(0.0))
    enough = (support >= min_support - 1e-9) & F.col("left").isNotNull() & F.col("right").isNotNull()
    out = moments.select(
        F.col("s").alias("series"), F.col("f").alias("frequency"), F.col("g").alias("period_index"),
        period_start(F.col("g"), F.col("f")).alias("period_start"), "n_readings", F.col("obs.v").alias("observed"),
        fit.alias("fit"), support.alias("support"), enough.alias("__q_enough"),
    )
    status = F.when(F.col("n_readings") > 0, "observed").when(F.col("__q_enough"), "filled").otherwise("missing")
    return out.withColumn("status", status).select(
        *[c for c in out.columns if c != "__q_enough"],
        F.when(F.col("status") == "observed", F.col("observed")).when(F.col("status") == "filled", F.col("fit")).alias("value"),
        "status",
    )
