"""Attributes as known at event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, DAY, NUM, RANK = "__q_key", "__q_day", "__q_num", "__q_rank"


def known_as_of(
    events: DataFrame,
    facts: DataFrame,
    *,
    event_key: Column,
    event_time: Column,
    fact_key: Column,
    known_from: Column,
    precedence: Sequence[str],
    attributes: Sequence[str] | None = None,
    as_name: str = "fact",
) -> DataFrame:
    """Every event that has a known fact, with that fact as a struct column ``as_name``.

    The struct has the ``precedence`` columns and ``attributes`` (None: all columns of the facts); name only what is
    needed, since a struct is read whole.

    A fact is known from ``known_from`` on (that moment included). Of the facts of the event's key known
    at the event's time, the one with the greatest ``precedence`` columns holds, compared left to right,
    nulls lowest; so a late filing of an old period does not replace a newer period.

    Method: facts become versions wherever the running maximum of the precedence changes; the narrow rows
    (key, time) of versions and of *distinct* event times are counted cumulatively, which gives every event
    time a version number; the wide attributes join on (key, number), and the events on (key, time).

    Scale: the narrow window sees at most one row per key and distinct time on either side, whatever the
    number of events, so a key with a third of all events is one row per calendar day there; the events
    themselves are joined on (key, time), which spreads such a key over the days. Nothing is broadcast by
    hint.

    Defined cases: a null key or time, of an event or a fact, never matches. Repeated events count each.
    Facts equal in every precedence column are one version: the greatest by the remaining columns. Empty
    inputs give an empty result. All columns of both sides are kept; those of the facts are inside the
    struct, so names cannot clash (``as_name`` itself must not be a column of ``events``).
    """
    if as_name.lower() in {c.lower() for c in events.columns}:
        raise ValueError(f"events already has a column {as_name}")
    wanted = [c for c in facts.columns if attributes is None or c in attributes or c in precedence]
    rest = [c for c in wanted if c not in precedence]
    keyed = facts.select(fact_key.alias(K), known_from.alias(DAY), *[facts[c] for c in wanted]).where(
        F.col(K).isNotNull() & F.col(DAY).isNotNull()
    )
    rank = F.struct(*[F.col(c) for c in precedence])
    offers = keyed.groupBy(K, DAY).agg(F.max(rank).alias(RANK))
    ev = events.select("*", event_key.alias(K), event_time.alias(DAY)).where(
        F.col(K).isNotNull() & F.col(DAY).isNotNull()
    )
    days = ev.select(K, DAY).distinct()
    narrow = offers.select(K, DAY, RANK).withColumn("__q_ask", F.lit(0)).unionByName(
        days.withColumn(RANK, F.lit(None).cast(offers.schema[RANK].dataType)).withColumn("__q_ask", F.lit(1))
    )
    order = Window.partitionBy(K).orderBy(DAY, "__q_ask")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    best = F.max(RANK).over(before)
    changed = F.col(RANK).isNotNull() & (best.isNull() | (F.col(RANK) > best))
    counted = narrow.withColumn("__q_new", changed).withColumn(
        NUM, F.sum(F.col("__q_new").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    asked = counted.where((F.col("__q_ask") == 1) & (F.col(NUM) > 0)).select(K, DAY, NUM)
    versions = counted.where(F.col("__q_new")).select(
        K, NUM, *[F.col(f"{RANK}.{c}").alias(f"__q_p{i}") for i, c in enumerate(precedence)]
    )
    place = {c: i for i, c in enumerate(precedence)}
    if rest:
        # One wide row per key and precedence; repeats of a filing collapse to the greatest.
        wide = keyed.groupBy(F.col(K).alias("__q_wk"), *[F.col(c).alias(f"__q_w{i}") for i, c in enumerate(precedence)]).agg(
            F.max(F.struct(*[F.col(c) for c in rest])).alias("__q_rest")
        )
        same = F.col(K) == F.col("__q_wk")
        for i in range(len(precedence)):
            same &= F.col(f"__q_p{i}").eqNullSafe(F.col(f"__q_w{i}"))
        versions = versions.join(wide, same)
    fact = F.struct(*[(F.col(f"__q_p{place[c]}") if c in place else F.col(f"__q_rest.{c}")).alias(c) for c in wanted]).alias(as_name)
    attributed = versions.select(K, NUM, fact)
    at_day = asked.join(attributed, [K, NUM]).select(K, DAY, as_name)
    return ev.join(at_day, [K, DAY]).select(*[ev[c] for c in events.columns], as_name)
