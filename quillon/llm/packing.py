"""Filling fixed-capacity containers with texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.common import cut
from quillon.llm.tokens import TOKENIZER, token_counts

#: Buckets of length that a pack has at most; up to this capacity every length is its own bucket.
BUCKETS = 256
#: Rows of the offsets of all parts, buckets and packs up to which they are broadcast.
OFFSETS = 1_000_000


def _bisection(n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of a bisection of 1..n-1: the middles of each level and their nearest neighbours of earlier levels (0 and n at the ends)."""
    levels, lo, hi = [], np.array([0]), np.array([n])
    while len(lo):
        open_ = hi - lo > 1
        lo, hi = lo[open_], hi[open_]
        if len(lo):
            mid = (lo + hi) // 2
            levels.append((mid, lo, hi))
            lo, hi = np.stack((lo, mid), 1).ravel(), np.stack((mid, hi), 1).ravel()
    return levels


def length_buckets(histogram: np.ndarray, buckets: int) -> np.ndarray:
    """Upper bounds of at most ``buckets`` length buckets with the least total padding.

    ``histogram[l]`` counts the items of length l. Dynamic programming over the occurring lengths: the cost of
    a bucket is the room between each item and the bucket's bound, which is its longest item. The best
    start of a bucket never moves back as its end moves on, so a layer is solved level by level of a bisection, each
    level with a few array operations over all its middles at once.
    """
    lengths = np.flatnonzero(histogram[1:]) + 1
    n = len(lengths)
    if n <= buckets:
        return lengths
    counts = histogram[lengths].astype(np.float64)
    items, tokens = np.concatenate(([0], np.cumsum(counts))), np.concatenate(([0], np.cumsum(counts * lengths)))
    size = lengths.astype(np.float64)
    alone = size * items[1:] - tokens[1:]
    best, levels = alone.copy(), _bisection(n)
    choice = np.zeros((buckets, n), np.int32)
    start = np.empty(n + 1, np.int64)  # best start of a last bucket that ends at each length
    for k in range(1, buckets):
        base = np.concatenate(([np.inf], best[:-1])) + tokens[:-1]
        start[0], start[n] = 1, n - 1
        row = best.copy()
        for mid, left, right in levels:
            first, last = start[left], np.minimum(start[right], mid)
            width = last - first + 1
            ends = np.cumsum(width)
            begin = ends - width
            js = np.arange(ends[-1]) + np.repeat(first - begin, width)
            cost = base[js] - np.repeat(size[mid], width) * items[js]
            least = np.minimum.reduceat(cost, begin)
            hit = np.flatnonzero(cost == np.repeat(least, width))
            hit = hit[np.searchsorted(hit, begin)]  # the first of each middle
            start[mid] = js[hit]
            row[mid] = least + alone[mid]
        better = row < best
        choice[k][better] = start[:n][better]
        best = np.minimum(row, best)
    ends, j, k = [], n - 1, buckets - 1
    while j >= 0 and k >= 0:
        ends.append(lengths[j])
        j, k = (int(choice[k, j]) - 1 if k else -1), k - 1
    return np.array(sorted(ends))


@dataclass
class Plan:
    """Where the items of each bucket go, by their rank in the bucket.

    ``rows[b]`` has, for each pattern that uses bucket b, its first rank, items per container, first container
    and first position; ``items`` and ``first`` have each pattern's items per container and first container.
    """

    bounds: np.ndarray
    rows: dict[int, np.ndarray]
    items: np.ndarray
    first: np.ndarray
    containers: int


def plan(histogram: np.ndarray, capacity: int, buckets: int = BUCKETS, mix: bool = True) -> Plan:
    """Container patterns for a histogram of item lengths up to ``capacity``.

    A pattern is a batch under the token budget: as many items as fit of the longest bucket left, then, with
    ``mix``, of each shorter bucket in turn; it is repeated as long as all its buckets last. So the plan has a
    few patterns per bucket, whatever the number of items.
    """
    bounds = length_buckets(histogram, buckets)
    left = np.array([int(histogram[(bounds[i - 1] if i else 0) + 1 : b + 1].sum()) for i, b in enumerate(bounds)], np.int64)
    used, rows, items, first, container = np.zeros(len(bounds), np.int64), {}, [], [], 0
    top = len(bounds) - 1
    while top >= 0:
        if not left[top]:
            top -= 1
            continue
        room, batch = capacity, []
        b = top
        while b >= 0 and room > 0:
            if left[b] and bounds[b] <= room:
                m = min(room // int(bounds[b]), int(left[b]))
                batch.append((b, m))
                room -= m * int(bounds[b])
            if not mix:
                break
            b = min(b, int(np.searchsorted(bounds, room, side="right"))) - 1
        times = min(int(left[b]) // m for b, m in batch)
        place = 0
        for b, m in batch:
            rows.setdefault(b, []).append((int(used[b]), m, container, place))
            place += m
            used[b] += m * times
            left[b] -= m * times
        items.append(place)
        first.append(container)
        container += times
    return Plan(bounds, {b: np.array(r, np.int64) for b, r in rows.items()}, np.array(items, np.int64), np.array(first, np.int64), container)


def place(p: Plan, bucket: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(container, position) of items by bucket number and rank in the bucket; bucket -1 are items of no tokens.

    Those are dealt out over all containers, after the other items.
    """
    container, position = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
    for b in np.unique(bucket):
        at = bucket == b
        if b < 0:
            if p.containers:
                c = rank[at] % p.containers
                container[at] = c
                position[at] = p.items[np.searchsorted(p.first, c, side="right") - 1] + rank[at] // p.containers
            else:
                position[at] = rank[at]
            continue
        start, per, first, offset = p.rows[int(b)].T
        k = np.searchsorted(start, rank[at], side="right") - 1
        r = rank[at] - start[k]
        container[at], position[at] = first[k] + r // per[k], offset[k] + r % per[k]
    return container, position


def _ranked(batches: Iterator[pa.RecordBatch], plans: dict[str, Plan]) -> Iterator[pa.RecordBatch]:
    """Pieces with their bucket, the number of their part (task), and their rank in the bucket inside the part."""
    from pyspark import TaskContext

    part, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        names, sizes = batch.column(0).dictionary_encode(), batch.column(4).to_numpy()
        codes = names.indices.to_numpy()
        bucket, rank = np.zeros(len(sizes), np.int32), np.zeros(len(sizes), np.int64)
        for code, name in enumerate(names.dictionary.to_pylist()):
            at = np.flatnonzero(codes == code)
            own = np.where(sizes[at] == 0, -1, np.searchsorted(plans[name].bounds, sizes[at])).astype(np.int32)
            order = np.argsort(own, kind="stable")
            kinds, first, count = np.unique(own[order], return_index=True, return_counts=True)
            before = np.array([seen.get((name, int(b)), 0) for b in kinds], np.int64)
            bucket[at] = own
            rank[at[order]] = np.arange(len(at)) + np.repeat(before - first, count)
            for b, n in zip(kinds.tolist(), (before + count).tolist(), strict=True):
                seen[name, b] = n
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(bucket), pa.array(np.full(len(sizes), part, np.int32)), pa.array(rank)],
            names=[*batch.schema.names, "bucket", "part", "r"],
        )


def _place(batches: Iterator[pa.RecordBatch], plans: dict[str, Plan]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column(0).dictionary_encode()
        codes, bucket, rank = names.indices.to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        container, position = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        for code, name in enumerate(names.dictionary.to_pylist()):
            at = codes == code
            container[at], position[at] = place(plans[name], bucket[at], rank[at])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(container), pa.array(position), *batch.columns[3:]],
            names=["pack_name", "container_id", "position", *batch.schema.names[3:]],
        )


def pack(
    documents: DataFrame, packs: DataFrame, *, doc_id: Column, text: Column, pack_name: Column, capacity: Column,
    tokenizer: str = TOKENIZER, buckets: int = BUCKETS, mix: bool = True,
) -> DataFrame:
    """(pack_name, container_id, position, doc_id, piece, token_start, n_tokens): every text in every pack.

    A text up to the capacity is one piece. Only a longer text is split: into full containers and one rest, which
    is packed like a short text. Containers of a pack are numbered from 0, positions in a container too.

    Method: the histogram of piece lengths over all texts (at most one row per length, so bounded by the capacity)
    goes to the driver; dynamic programming chooses the length buckets with the least padding; batches under the
    token budget are formed from the longest bucket on. Within one bucket alone (``mix=False``) every container
    of a bucket above half the capacity stays with one item; ``mix`` tops a batch up with shorter buckets.

    Scale: sizes are measured once per text and checkpointed in the shared folder. An item's place follows from its
    bucket and its rank in the bucket: each part (task) of the checkpoint ranks its own items as they come, and parts get
    offsets from their counts. So no item is shuffled, whatever ids or lengths repeat; the offsets, one row per
    part and bucket, are broadcast up to ``OFFSETS`` rows and joined by shuffle beyond. Where an item lies
    depends on the files' layout.

    Defined cases: null and empty texts have no tokens and are dealt out over the containers; repeated ids are
    items of their own; packs without name or positive capacity are left out, a name given twice takes the
    smaller capacity; with no documents the result is empty.
    """
    limits = {
        r["n"]: int(r["c"])
        for r in packs.select(pack_name.alias("n"), capacity.alias("c")).where("n is not null and c > 0").groupBy("n").agg(F.min("c").alias("c")).collect()
    }
    sizes = cut(token_counts(documents, text, {"doc_id": doc_id.cast("bigint")}, tokenizer))
    if not limits:
        return sizes.limit(0).select(F.lit("").alias("pack_name"), *[F.lit(0).cast("bigint").alias(c) for c in ("container_id", "position")], "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("token_start"), "n_tokens")
    # Each document once in each of a handful of packs, which the capacity table names.
    caps = F.inline(F.array(*[F.struct(F.lit(n).alias("pack_name"), F.lit(c).cast("bigint").alias("cap")) for n, c in limits.items()]))
    last = F.greatest(F.ceil(F.col("n_tokens") / F.col("cap")) - 1, F.lit(0))
    pieces = (
        sizes.select("doc_id", "n_tokens", caps)
        .select("pack_name", "cap", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
        .select("pack_name", "doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * F.col("cap")).alias("token_start"), F.least("cap", F.col("n_tokens") - F.col("piece") * F.col("cap")).alias("n_tokens"))
    )
    histograms = {n: np.zeros(c + 1, np.int64) for n, c in limits.items()}
    for r in pieces.groupBy("pack_name", "n_tokens").count().collect():
        histograms[r["pack_name"]][r["n_tokens"]] = r["count"]
    plans = {n: plan(h, limits[n], buckets, mix) for n, h in histograms.items()}
    kept = "pack_name string, doc_id bigint, piece int, token_start bigint, n_tokens bigint"
    ranked = pieces.mapInArrow(lambda it: _ranked(it, plans), f"{kept}, bucket int, part int, r bigint")
    group = ["pack_name", "bucket", "part"]
    counts = cut(ranked.groupBy(*group).count())
    before = F.sum("count").over(Window.partitionBy("pack_name", "bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*group, F.coalesce(before, F.lit(0)).alias("offset"))
    if counts.count() <= OFFSETS:
        offsets = F.broadcast(offsets)
    rank = (F.col("r") + F.col("offset")).alias("rank")
    return ranked.join(offsets, group).select("pack_name", "bucket", rank, "doc_id", "piece", "token_start", "n_tokens").mapInArrow(
        lambda it: _place(it, plans),
        "pack_name string, container_id bigint, position bigint, doc_id bigint, piece int, token_start bigint, n_tokens bigint",
    )
