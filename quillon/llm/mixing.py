"""Mixing sources to target weights."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.common import cut, squeezed
from quillon.llm.tokens import TOKENIZER, token_counts

#: Size classes: twice the binary logarithm of a text's size over its source's mean, cut to this range.
CLASSES = range(-2, 3)
#: Binary logarithm of the bins that one pass makes of each unit, or bin, of the sampling rank; at most ``PASSES`` passes.
BITS, PASSES = 10, 4
#: Copies of one row that a task lists at once.
LISTED = 100_000
#: What tells a row from all others: copies of a row are numbered.
ROW = ("doc_id", "h", "n_tokens", "copy")
TARGET = ["mix_name", "source"]


def expected_copies(tokens: dict[int, float], goal: float, most: int) -> dict[int, float]:
    """Expected copies of a text of each size class, proportional to the class weight and at most ``most``.

    The weight is 2 to the power of class / 2. The factor is found by bisection so that the expected tokens of
    all classes reach ``goal``.
    """
    weight = {c: 2.0 ** (c / 2) for c in tokens}
    reach = lambda x: sum(min(x * weight[c], most) * t for c, t in tokens.items())
    lo, hi = 0.0, most / min(weight.values(), default=1.0)
    if reach(hi) <= goal:
        return dict.fromkeys(tokens, float(most))
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if reach(mid) < goal else (lo, mid)
    return {c: min(hi * w, float(most)) for c, w in weight.items()}


def allocation(targets: list[tuple[str, str, float, int]], tokens: dict[tuple[str, int], float]) -> list[tuple]:
    """(mix, source, size class, whole copies, fraction, tokens still to sample) for each mix.

    A mix's total is the largest that all its sources can reach with their shares and their caps; listed sources
    without tokens are left out, the others keep their proportions.
    """
    supply: dict[str, float] = {}
    for (s, _), t in tokens.items():
        supply[s] = supply.get(s, 0.0) + t
    merged: dict[tuple[str, str], list[float]] = {}
    for mix, source, share, most in targets:
        m = merged.setdefault((mix, source), [0.0, most])
        m[0], m[1] = m[0] + share, min(m[1], most)
    out = []
    for mix in sorted({k[0] for k in merged}):
        parts = {s: (sh, int(mx)) for (m, s), (sh, mx) in merged.items() if m == mix and supply.get(s, 0) > 0 and sh > 0 and mx >= 1}
        total = min((mx * supply[s] / sh for s, (sh, mx) in parts.items()), default=0.0)
        for s, (sh, mx) in sorted(parts.items()):
            own = {c: t for (x, c), t in tokens.items() if x == s}
            copies = expected_copies(own, sh * total, mx)
            whole = {c: math.floor(e + 1e-9) for c, e in copies.items()}
            rest = max(0.0, sh * total - sum(whole[c] * own[c] for c in own))
            out += [(mix, s, c, int(whole[c]), float(max(0.0, copies[c] - whole[c])), rest) for c in own]
    return out


def _numbered(sized: DataFrame) -> DataFrame:
    """One row per row of ``sized`` (source, doc_id, n_tokens, h), rows that agree in all of them numbered from 0.

    They are counted first, so copies cost one row in the shuffle, and listed in blocks of ``LISTED`` that are spread
    over the tasks.
    """
    counted = sized.groupBy("source", "doc_id", "n_tokens", "h").count()
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("count") - 1) / LISTED))))
    first = F.col("block") * LISTED
    each = F.sequence(first, F.least(first + LISTED, F.col("count")) - 1)
    return blocks.hint("rebalance").select("source", "doc_id", "n_tokens", "h", F.explode(each).alias("copy"))


def _edges(ranked: DataFrame, level: int) -> DataFrame:
    """(mix_name, source, edge, before, n): the bin of a level in which the tokens reach ``rest``.

    ``ranked`` has ``start``, the tokens of the ranks before all of its own; n counts the rows of the bin.
    """
    sums = ranked.groupBy(*TARGET, "rest", "start", _bin(level).alias("bin")).agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*TARGET).orderBy("bin")
    before = F.col("start") + F.coalesce(F.sum("t").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sums.withColumn("before", before).where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("t") > F.col("rest"))).select(
        *TARGET, F.col("bin").alias("edge"), "before", "n"
    )


def _bin(level: int) -> Column:
    return F.floor(F.col("q") * float(1 << BITS * level))


def mixed(
    documents: DataFrame, mixes: DataFrame, *, doc_id: Column, text: Column, source: Column, mix_name: Column,
    mix_source: Column, share: Column, max_repeat: Column, seed: int = 7, tokenizer: str = TOKENIZER, max_targets: int = 10_000,
    sorted_rows: int = 200_000, folded_rows: int = 512,
) -> DataFrame:
    """(mix_name, source, doc_id, n_tokens, repeats): the documents of each mix, each with its copies.

    Every source of a mix contributes its target share of the mix's tokens, up to less than one document and never
    more, as long as no document has more than ``max_repeat`` copies; the mix is the largest for which that holds. Longer
    texts of a source are a little likelier than stubs: a text's expected copies go with the root of its size
    over the source's mean, in five classes.

    Method: Pareto order sampling. The whole part of the expected copies is certain; for one copy more,
    documents are ranked by their random odds over their inclusion odds, and the lowest ranks are taken as long
    as they fit the source's tokens; what is left, less than one document, goes to the next ranks that fit, until none
    does. The random numbers are hashes of the row, so a run can be repeated whatever the files' layout.

    Scale: sizes are measured once and checkpointed in the shared folder; the driver sees one row per listed
    source and size class. The cut-off rank of a source comes from token sums of rank bins (map-side combined); the bin
    at the cut-off is cut into ``2 ** BITS`` finer ones until it has at most ``sorted_rows`` rows, and only then put in
    order, so no task sorts more, however large a source is. The last room is filled ``folded_rows`` ranks at a time;
    neither parameter changes the result. The tables per mix and source are broadcast; more than ``max_targets`` targets are
    an error, so their size is bounded.

    Defined cases: sources are compared without case and blanks; documents without source, of a source not
    listed, or without tokens are never chosen; listed sources without documents get nothing and the other shares
    keep their proportions; null or non-positive shares and caps count as not listed. Rows that repeat an id are
    documents of their own, drawn independently, also if they agree in everything; each is a row of the result. Ties of
    the rank are ordered by id, text hash, size and number of the copy.
    """
    listed = mixes.select(mix_name.alias("m"), squeezed(mix_source).alias("s"), share.cast("double").alias("p"), max_repeat.cast("int").alias("r")).where(
        "m is not null and s is not null and p > 0 and r >= 1"
    )
    # Every small table below has at most one row per listed mix and source, so one check of that list covers all.
    goals = [(r["m"], r["s"], r["p"], r["r"]) for r in listed.limit(max_targets + 1).collect()]
    if len(goals) > max_targets:
        raise ValueError(f"more than {max_targets} targets")
    small = F.broadcast
    own = squeezed(source)
    wanted = documents.where(own.isin(sorted({s for _, s, _, _ in goals}))) if goals else documents.where("false")
    keep = {"doc_id": doc_id.cast("bigint"), "source": own, "h": F.xxhash64(text.cast("string"))}
    sized = cut(_numbered(token_counts(wanted, text, keep, tokenizer).where("n_tokens > 0")))
    mean = sized.groupBy("source").agg(F.avg("n_tokens").alias("mean"))
    size_class = F.greatest(F.lit(CLASSES[0]), F.least(F.lit(CLASSES[-1]), F.round(2 * F.log2(F.col("n_tokens") / F.col("mean"))).cast("int")))
    means = [(r["source"], r["mean"]) for r in mean.collect()]
    spark = documents.sparkSession
    classed = sized.join(small(spark.createDataFrame(means, "source string, mean double")), "source").withColumn("c", size_class).drop("mean")
    tokens = {(r["source"], r["c"]): float(r["t"]) for r in classed.groupBy("source", "c").agg(F.sum("n_tokens").alias("t")).collect()}
    plan = spark.createDataFrame(allocation(goals, tokens), "mix_name string, source string, c int, whole int, part double, rest double")
    offered = classed.join(small(plan), ["source", "c"])
    # A uniform number in (0, 1) from 52 bits of a hash.
    u = (F.shiftrightunsigned(F.xxhash64(*ROW, *TARGET, F.lit(seed)), 12).cast("double") + 0.5) / float(1 << 52)
    q = F.when((F.col("part") > 1e-9) & (F.col("rest") > 0), F.ln(u / (1 - u)) - F.ln(F.col("part") / (1 - F.least(F.col("part"), F.lit(1 - 1e-12)))))
    offered = offered.select(*TARGET, *ROW, "whole", "rest", q.alias("q"))
    ranked, near, level = offered.where("q is not null").withColumn("start", F.lit(0).cast("bigint")), None, 0
    while True:
        level += 1
        found = _edges(ranked if near is None else near, level).collect()  # one row per mix and source at most
        edges = spark.createDataFrame([tuple(r) for r in found], "mix_name string, source string, edge bigint, before bigint, n bigint")
        inside = (ranked if near is None else near).drop("start").join(small(edges), TARGET).where(_bin(level) == F.col("edge"))
        near = cut(inside.select(*ranked.columns[:-1], F.col("before").alias("start")))
        if level == PASSES or all(r["n"] <= sorted_rows for r in found):
            break
    rank = F.struct("q", *ROW)
    run = F.sum("n_tokens").over(Window.partitionBy(*TARGET).orderBy("q", *ROW).rowsBetween(Window.unboundedPreceding, 0))
    fits = F.col("upto") <= F.col("rest")
    # The last rank taken of each source that doesn't take all, and the room that it leaves.
    ends = near.withColumn("upto", F.col("start") + run).groupBy(*TARGET).agg(
        F.max(F.when(fits, rank)).alias("end"), (F.first("rest") - F.coalesce(F.max(F.when(fits, F.col("upto"))), F.first("start"))).alias("room")
    )
    ends = cut(ends.join(small(edges.select(*TARGET, "edge")), TARGET))
    judged = offered.join(small(ends), TARGET, "left")
    given = F.col("q").isNotNull() & (F.col("edge").isNull() | (_bin(level) < F.col("edge")) | F.coalesce((_bin(level) == F.col("edge")) & (rank <= F.col("end")), F.lit(False)))
    beyond = judged.where(F.col("q").isNotNull() & ~given).select(*TARGET, *ROW, "q")
    next_ranks = F.row_number().over(Window.partitionBy(*TARGET).orderBy("q", *ROW))
    state, rounds = ends.select(*TARGET, "room", F.lit(None).cast(ends.schema["end"].dataType).alias("last")), []
    while True:  # every round passes ``folded_rows`` ranks of a source
        fitting = beyond.join(small(state), TARGET).where((F.col("n_tokens") <= F.col("room")) & (F.col("last").isNull() | (rank > F.col("last"))))
        folded = cut(
            fitting.withColumn("n", next_ranks)
            .where(F.col("n") <= folded_rows)
            .groupBy(*TARGET)
            .agg(F.sort_array(F.collect_list(rank)).alias("next"), F.first("room").alias("room"))
            .select(*TARGET, F.expr(
                "aggregate(next, struct(double(room) as room, slice(next, 1, 0) as got), (acc, x) -> if(x.n_tokens <= acc.room, "
                "struct(acc.room - x.n_tokens as room, concat(acc.got, array(x)) as got), acc))"
            ).alias("x"), F.element_at("next", -1).alias("last"), F.size("next").alias("seen"))
        )
        rounds.append(folded.select(*TARGET, F.explode("x.got").alias("x")).select(*TARGET, *[F.col(f"x.{c}").alias(c) for c in ROW], F.lit(1).alias("topped")))
        if (folded.agg(F.max("seen")).first()[0] or 0) < folded_rows:
            break  # each source's fitting ranks were all seen
        state = folded.select(*TARGET, "x.room", "last")
    extra = F.when(given, 1).otherwise(0)
    for r in rounds:  # a few rows each: what fits less than one document
        judged, extra = judged.join(r.withColumnRenamed("topped", f"topped{len(judged.columns)}"), [*TARGET, *ROW], "left"), extra + F.coalesce(F.col(f"topped{len(judged.columns)}"), F.lit(0))
    return judged.select(*TARGET, "doc_id", "n_tokens", (F.col("whole") + extra).alias("repeats")).where("repeats > 0")


def shares(chosen: DataFrame, mixes: DataFrame, *, mix_name: Column, mix_source: Column, share: Column) -> DataFrame:
    """(mix_name, source, target_share, actual_share, documents, copies, tokens, most_repeats) of every listed source."""
    got = chosen.groupBy("mix_name", "source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("repeats").alias("copies"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"),
        F.max("repeats").alias("most_repeats"),
    )
    goal = mixes.select(mix_name.alias("mix_name"), squeezed(mix_source).alias("source"), share.alias("p")).where("mix_name is not null and source is not null")
    both = goal.groupBy("mix_name", "source").agg(F.sum("p").alias("target_share")).join(got, ["mix_name", "source"], "left")
    whole = F.sum("tokens").over(Window.partitionBy("mix_name"))
    return both.select(
        "mix_name", "source", "target_share", F.coalesce(F.col("tokens") / whole, F.lit(0.0)).alias("actual_share"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("documents", "copies", "tokens", "most_repeats")],
    )
