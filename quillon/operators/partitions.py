"""Date-range buckets of stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partition column: first year of a row's bucket.
BUCKET = "bucket_start"
# Bucket borders; from the last one on, buckets have five years.
EDGES = (1900, 2000, 2005, 2010, 2015)
STEP = 5


def bucket_start(day: Column) -> Column:
    """First year of the bucket of a date (start included, end excluded); null before the first bucket."""
    y = F.year(day)
    c = F.when(y >= EDGES[-1], y - F.pmod(y - EDGES[-1], F.lit(STEP)))
    for e in reversed(EDGES[:-1]):
        c = c.when(y >= e, F.lit(e))
    return c.cast("int")


def bucket_names(table: str, last_year: int) -> list[str]:
    """Names table_start_end of all buckets that begin before the year after ``last_year``."""
    starts = [*EDGES, *range(EDGES[-1] + STEP, last_year + 1, STEP)]
    ends = [*EDGES[1:], *[s + STEP for s in starts[len(EDGES) - 1 :]]]
    return [f"{table}_{a}_{b}" for a, b in zip(starts, ends, strict=True)]


def start_of_year(year: int) -> int | None:
    """First year of the bucket that holds a year."""
    if year >= EDGES[-1]:
        return year - (year - EDGES[-1]) % STEP
    return next((e for e in reversed(EDGES[:-1]) if year >= e), None)


def in_range(df: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """Rows from ``start`` to ``end``, both included, with the bucket predicate that prunes partitions."""
    low, high = start_of_year(int(start[:4])), start_of_year(int(end[:4]))
    pruned = df if low is None else df.where(F.col(BUCKET) >= low)
    return pruned.where((F.col(BUCKET) <= (high if high is not None else 0)) & F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def read_range(spark: SparkSession, path: str, day: str, start: str, end: str) -> DataFrame:
    """A pruned read of a bucketed table."""
    return in_range(spark.read.parquet(path), day, start, end).drop(BUCKET)
