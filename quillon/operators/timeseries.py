"""Trading calendars, last observation carried forward, newest rows and changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def trading_days(spark: SparkSession, start: str, end: str, holidays: DataFrame, market: str = "NYSE") -> DataFrame:
    """(trading_day): Mondays to Fridays from ``start`` to ``end``, both included, without the market's holidays.

    ``holidays`` has event_date and market. Null dates are no holidays; an empty range gives no rows.
    """
    span = spark.range(1).select(F.explode(F.expr(f"if(date'{start}' <= date'{end}', sequence(date'{start}', date'{end}', interval 1 day), array())")).alias("trading_day"))
    closed = holidays.where(F.col("market") == market).select(F.col("event_date").cast("date").alias("trading_day")).distinct()
    return span.where(F.weekday("trading_day") < 5).join(closed, "trading_day", "left_anti")


def locf(value: Column, order: Sequence[Column | str], partition: Sequence[Column | str] = ()) -> Column:
    """Window expression: the last value that is not null up to the current row; leading nulls stay null.

    Give ``partition`` whenever there is more than one series, else one task sorts all rows.
    """
    w = Window.partitionBy(*partition) if partition else Window
    return F.last(value, ignorenulls=True).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def locf_agg(value: Column, order: Column) -> Column:
    """Aggregate expression: the value, not null, with the greatest order."""
    return F.max_by(value, F.when(value.isNotNull(), order))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order`` (give it newest first and with a tie-break)."""
    return df.withColumn("__q_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__q_n = 1").drop("__q_n")


def changes_only(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str) -> DataFrame:
    """Rows whose value differs from the row before of the same key, and each key's first row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumns({"__q_before": F.lag(value).over(w), "__q_n": F.row_number().over(w)})
        .where((F.col("__q_n") == 1) | ~F.col(value).eqNullSafe(F.col("__q_before")))
        .drop("__q_before", "__q_n")
    )


def changes_against(batch: DataFrame, stored: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Rows of ``batch`` whose value differs from the one before of the same key: in the batch, or the newest that is stored.

    ``order`` is a column that both have; the stored rows of a key count as before its batch rows, whatever their
    order. A key that isn't stored yet gives its first row. Null is a value. Of stored rows with one ``order`` the one with the
    greatest value is the newest.
    """
    newest = stored.groupBy(*keys).agg(F.max(F.struct(order, value)).alias("x")).select(*keys, F.col(f"x.{value}").alias("__q_stored"), F.lit(True).alias("__q_known"))
    w = Window.partitionBy(*keys).orderBy(order, value)
    ranked = batch.withColumns({"__q_before": F.lag(value).over(w), "__q_n": F.row_number().over(w)})
    same = [ranked[k].eqNullSafe(newest[k]) for k in keys]
    joined = ranked.join(newest, same, "left")
    first = (ranked["__q_n"] == 1) & (newest["__q_known"].isNull() | ~ranked[value].eqNullSafe(newest["__q_stored"]))
    later = (ranked["__q_n"] > 1) & ~ranked[value].eqNullSafe(ranked["__q_before"])
    return joined.where(first | later).select(*[ranked[c] for c in batch.columns])
