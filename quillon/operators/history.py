"""History of changing entity attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.common import cut

E_, T_, S_, POS = "__q_entity", "__q_time", "__q_state", "__q_pos"

#: Rows that one array fold takes at most.
BLOCK_ROWS = 1024


def attribute_history(
    rows: DataFrame,
    *,
    entity: Column,
    changed_at: Column,
    received_at: Column,
    carried: Mapping[str, Column],
    stated: Mapping[str, Column],
    labels: Mapping[str, tuple[str, Column]] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Versions of each entity: (entity, valid_from, valid_to, *labels, *carried, *stated), valid_to null while open.

    ``carried`` attributes take null as "not reported": the state before goes on. ``stated`` attributes take
    null as a value of its own. ``labels`` name a carried attribute and how a row writes it: they are not compared, and a
    version has the label of the row that brought its value. Of several rows of an entity with one ``changed_at``, the one with the latest
    ``received_at`` holds (then the greatest attribute values). The first row of an entity opens its first
    version; a later row opens one only if an attribute differs from the state before.

    Method: the rows are range-partitioned and sorted by (entity, time) and cut into blocks of at most
    ``block_rows``. Each block's sorted struct array is folded by a higher-order function that appends a version only
    upon change, starting from the state that the blocks before leave; the appended structs are exploded with end times.

    Scale: no array is longer than ``block_rows``, so a key with a third of all rows is cut over many blocks and tasks,
    whether its state changes often or never. Only summaries of blocks (first and last values and when they first
    change, one row per entity and block) see a window by entity: they give each block the state before it and the time of
    the next version after it. The blocks are checkpointed in the shared folder, since both passes need the same ones.

    Defined cases: rows without entity or time are left out; repeated rows make no version; an empty input
    gives an empty result; other columns of ``rows`` are not used, so their names cannot clash.
    """
    labels = labels or {}
    names = [*labels, *carried, *stated]
    base = rows.select(
        entity.alias(E_),
        changed_at.alias(T_),
        received_at.alias("__q_got"),
        *[c.alias(f"__q_v{i}") for i, c in enumerate([*[c for _, c in labels.values()], *carried.values(), *stated.values()])],
    ).where(F.col(E_).isNotNull() & F.col(T_).isNotNull())
    vals = [f"__q_v{i}" for i in range(len(names))]
    one = (
        base.groupBy(E_, T_)
        .agg(F.max(F.struct("__q_got", *vals)).alias(S_))
        .select(E_, T_, *[F.col(f"{S_}.{v}").alias(v) for v in vals])
    )
    placed = one.repartitionByRange(E_, T_).sortWithinPartitions(E_, T_).withColumn(POS, F.monotonically_increasing_id())
    blocks = placed.groupBy(E_, F.expr(f"{POS} div {int(block_rows)}").alias("__q_block")).agg(
        F.sort_array(F.collect_list(F.struct(T_, *vals))).alias("__q_rows")
    )
    blocks = cut(blocks)
    types = dict(one.dtypes)
    carry, stay = vals[len(labels) : len(labels) + len(carried)], vals[len(labels) + len(carried) :]
    key_of = {vals[i]: vals[len(labels) + list(carried).index(k)] for i, (k, _) in enumerate(labels.values())}
    known = _states_between(blocks, types, carry, stay, key_of)
    prev = lambda v: f"try_element_at(acc, -1).{v}"
    state = {v: f"coalesce(x.{v}, {prev(v)})" for v in carry} | {v: f"x.{v}" for v in stay}
    state |= {b: f"if(size(acc) = 0 or (x.{k} is not null and not (x.{k} <=> {prev(k)})), x.{b}, {prev(b)})" for b, k in key_of.items()}
    differs = " or ".join(f"not ({state[v]} <=> {prev(v)})" for v in (*carry, *stay))
    element = f"struct<{T_}:{types[T_]}," + ",".join(f"{v}:{types[v]}" for v in vals) + ">"
    fields = lambda time, of: f"named_struct('{T_}', {time}, " + ", ".join(f"'{v}', {of(v)}" for v in vals) + ")"
    before = f"if(__q_known.later, array({fields(f'cast(null as {types[T_]})', lambda v: f'__q_known.{v}')}), cast(array() as array<{element}>))"
    fold = f"aggregate(__q_rows, {before}, (acc, x) -> if(size(acc) = 0 or {differs}, concat(acc, array({fields(f'x.{T_}', lambda v: state[v])})), acc))"
    folded = blocks.join(known, [E_, "__q_block"]).select(E_, F.col("__q_known.next").alias("__q_next"), F.expr(f"filter({fold}, y -> y.{T_} is not null)").alias("__q_made"))
    ends = f"transform(__q_made, (y, i) -> struct(y as made, coalesce(try_element_at(__q_made, i + 2).{T_}, __q_next) as until))"
    versions = folded.select(E_, F.explode(F.expr(ends)).alias("__q_x"))
    return versions.select(
        F.col(E_).alias("entity"), F.col(f"__q_x.made.{T_}").alias("valid_from"), F.col("__q_x.until").alias("valid_to"),
        *[F.col(f"__q_x.made.{v}").alias(n) for v, n in zip(vals, names, strict=True)],
    )


def _states_between(blocks: DataFrame, types: Mapping[str, str], carry: Sequence[str], stay: Sequence[str], key_of: Mapping[str, str]) -> DataFrame:
    """(entity, __q_block, __q_known): the state before each block, whether there is one, and the next version after the block.

    ``carry`` values take null as "not reported", ``stay`` values as a value; ``key_of`` maps a label to the value it writes.
    """
    void = lambda t: f"cast(null as {t})"

    def summary(v: str) -> str:
        """First value f and its time tf, time tg of the first other value, last value l, and the labels that brought l."""
        own = [b for b, k in key_of.items() if k == v]
        made = lambda f, tf, tg, last, label: f"named_struct('f', {f}, 'tf', {tf}, 'tg', {tg}, 'l', {last}" + "".join(f", '{b}', {label(b)}" for b in own) + ")"
        start = made(void(types[v]), void(types[T_]), void(types[T_]), void(types[v]), lambda b: void(types[b]))
        opened = made(f"x.{v}", f"x.{T_}", "acc.tg", f"x.{v}", lambda b: f"x.{b}")
        moved = made("acc.f", "acc.tf", f"coalesce(acc.tg, x.{T_})", f"x.{v}", lambda b: f"x.{b}")
        skip = f"x.{v} is null" if v in carry else "false"
        return f"aggregate(__q_rows, {start}, (acc, x) -> if({skip}, acc, if(acc.tf is null, {opened}, if(x.{v} <=> acc.l, acc, {moved}))))"

    short = blocks.select(E_, "__q_block", F.expr(f"__q_rows[0].{T_}").alias("t0"), *[F.expr(summary(v)).alias(f"s{v}") for v in (*carry, *stay)])
    past = Window.partitionBy(E_).orderBy("__q_block").rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy(E_).orderBy("__q_block")
    seen = short.select(
        "*", (F.row_number().over(order) > 1).alias("later"), *[F.last(f"s{v}.l", ignorenulls=True).over(past).alias(v) for v in carry],
        *[F.lag(f"s{v}.l").over(order).alias(v) for v in stay],
    )
    brings = lambda b, k: F.when(F.col(f"s{k}.tf").isNotNull() & (F.col(f"s{k}.tg").isNotNull() | ~F.col(f"s{k}.f").eqNullSafe(F.col(k))), F.struct(F.col(f"s{k}.{b}")))
    first = F.least(*[F.when(F.col(f"s{v}.f").eqNullSafe(F.col(v)), F.col(f"s{v}.tg")).otherwise(F.col(f"s{v}.tf")) for v in (*carry, *stay)] * 2)
    labelled = seen.select("*", F.when(F.col("later"), first).otherwise(F.col("t0")).alias("first"), *[F.last(brings(b, k), ignorenulls=True).over(past)[b].alias(b) for b, k in key_of.items()])
    following = Window.partitionBy(E_).orderBy(F.desc("__q_block")).rowsBetween(Window.unboundedPreceding, -1)
    state = [*key_of, *carry, *stay]
    return labelled.withColumn("next", F.last("first", ignorenulls=True).over(following)).select(E_, "__q_block", F.struct("later", "next", *state).alias("__q_known"))
