"""Implausible spikes, stuck values and impossible readings of daily prices, per source."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.common import bounded_broadcast, cut

#: Bits of the reason mask, in the order of the names that the operator returns.
IMPOSSIBLE, SPIKE, STUCK, VOLUME_HIGH, VOLUME_LOW, SPLIT, OPEN, PLATEAU = 1, 2, 4, 8, 16, 32, 64, 128
REASONS = ("impossible", "spike", "stuck", "volume_high", "volume_low", "split", "open", "plateau")
#: Reasons that say only that a reading may be wrong: it isn't known yet, or it can't be told from a lasting move.
SUSPECT = ("open", "plateau")


@dataclass(frozen=True)
class Limits:
    """Limits of the control charts, all relative to the source's own behaviour."""

    weight: float = 0.05  # of a new value in the exponentially weighted mean and scale
    clip: float = 3.0  # scales to which a value is clipped before it updates mean and scale
    calmest: float = 0.1  # least scale of moves, in parts of their mean scale so far
    memory: float = 0.005  # weight of a new move in that mean scale
    move: float = 6.5  # scales that make a move of the close suspect
    back: float = 0.5  # part of a suspect move that may remain after the step that takes it back
    back_busy: float = 0.3  # the same where the volume tells of an event
    stay: float = 0.6  # part of the move at which a second suspect day still stands
    busy: float = 3.0  # times the usual volume that tell of an event
    back_days: int = 2  # trading days within which it returns
    plateau_days: int = 10  # trading days within which a plateau returns, which is suspect only
    repeats: int = 5  # unchanged closes after the first
    usual_repeats: float = 0.3  # share of unchanged closes up to which a source counts as moving
    volume_ratio: float = 20.0  # times the usual volume
    volume_scales: float = 6.5  # and scales of its logarithm
    calm: float = 4.0  # scales of the move that would explain a high volume
    low_ratio: float = 1 / 300.0  # of the usual volume, next to nothing
    idle_share: float = 0.05  # share of days without volume from which a source counts as thinly traded
    split_tolerance: float = 0.5  # part of the split's logarithm by which the close may miss it
    warm_up: int = 40  # first moves and volumes from which the charts start


def chart(close: np.ndarray, volume: np.ndarray, split: np.ndarray, lim: Limits) -> np.ndarray:
    """Reason mask of each day of one source; the days are in order, missing values are NaN."""
    n = len(close)
    mask = np.zeros(n, np.int32)
    mask[(close <= 0) | np.isinf(close) | (volume < 0) | (split <= 0) | np.isinf(split)] |= IMPOSSIBLE
    days = np.flatnonzero((close > 0) & np.isfinite(close))
    seen = volume[(volume >= 0)]
    thin = len(seen) > 0 and float(np.mean(seen == 0)) >= lim.idle_share
    if len(days) == 0:
        return mask
    price = np.log(close[days])
    factor = _splits(days, price, split, mask, lim)
    level = price + factor
    moves = np.abs(np.diff(level))
    moving = moves[moves > 0]
    surprise = np.zeros(n)
    # Days without a close take the split factor of the last close before.
    last = np.searchsorted(days, np.arange(n), side="right") - 1
    day_factor = np.where(last >= 0, factor[np.maximum(last, 0)], 0.0)
    logs = np.full(n, np.nan)
    traded = volume > 0
    logs[traded] = np.log(volume[traded]) - day_factor[traded]
    if len(moving):
        busy = _busy(logs, lim) & (not thin)
        _closes(days, level, moving, busy, mask, surprise, lim)
    _repeats(days, close, volume, thin, mask, lim)
    _volumes(volume, logs, surprise, thin, mask, lim)
    return mask


def _splits(days: np.ndarray, price: np.ndarray, split: np.ndarray, mask: np.ndarray, lim: Limits) -> np.ndarray:
    """Cumulative logarithm of the splits that the close follows; flags those that it doesn't."""
    out, total, pending = np.zeros(len(days)), 0.0, [int(d) for d in np.flatnonzero((split > 0) & np.isfinite(split) & (split != 1))]
    if not pending:
        return out
    places = {}
    for d in pending:  # a split takes effect at the first close on or after its day
        k = int(np.searchsorted(days, d))
        if 0 < k < len(days):
            places.setdefault(k, []).append(d)
    for k in range(len(days)):
        for d in places.get(k, ()):
            size = math.log(split[d])
            # Also against the close after, so that a wrong close on the day itself doesn't hide the split.
            near = [abs(price[j] - price[k - 1] + size) for j in (k, k + 1) if j < len(days)]
            if min(near) <= lim.split_tolerance * abs(size):
                total += size
            else:
                mask[d] |= SPLIT
        out[k] = total
    return out


def _busy(logs: np.ndarray, lim: Limits) -> np.ndarray:
    """Days whose volume is ``busy`` times the weighted mean of the days before."""
    out = np.zeros(len(logs), bool)
    at = np.flatnonzero(~np.isnan(logs))
    if not len(at):
        return out
    mean, high = float(np.median(logs[at[: lim.warm_up]])), math.log(lim.busy)
    for d in at.tolist():
        off = logs[d] - mean
        out[d] = off > high
        mean += lim.weight * max(-high, min(high, off))
    return out


def _closes(days, level, moving, busy, mask, surprise, lim) -> None:
    """Chart of daily moves: a suspect close that comes back is flagged and leaves no trace in the chart.

    It comes back in one step, from the last suspect day to at most a part of that day's distance; a level that
    wears off, step by step and after a day of event-like volume, doesn't. Mean and scale come from the moves before
    (the first ``warm_up`` moves from their own median). A suspect close after which the series ends too early to tell is
    ``open``; one that stays for more than ``back_days`` and then returns in one step is a ``plateau``.
    """
    scale = usual = 1.4826 * float(np.median(moving[: lim.warm_up]))
    mean, base, n, k, values = 0.0, level[0], len(level), 1, level.tolist()

    def followed(deviation: float) -> None:
        nonlocal scale, usual
        scale = max(lim.calmest * usual, scale + lim.weight * (1.2533 * deviation - scale))
        usual += lim.memory * (1.2533 * deviation - usual)

    while k < n:
        off = values[k] - base
        z = abs(off - mean) / scale
        surprise[days[k]] = z
        if z > lim.move:
            rest = lim.back_busy if busy[days[k]] else lim.back
            for step in range(1, lim.back_days + 1):
                # An earlier return is looked for first; missing closes between count as trading days.
                if k + step >= n or days[k + step] - days[k] > lim.back_days:
                    continue
                away = values[k + step - 1] - base
                stays = step == 1 or (away * off > 0 and abs(away) >= lim.stay * abs(off))
                if stays and abs(values[k + step] - base) <= rest * abs(away):
                    for j in range(k, k + step):
                        mask[days[j]] |= SPIKE
                        surprise[days[j]] = abs(values[j] - base) / scale
                    k += step
                    break
            else:
                _suspect(days, values, k, base, rest, mask, lim)
                base = values[k]
                followed(min(abs(off), lim.clip * scale))
                k += 1
            continue
        if off:
            held = max(-lim.clip * scale, min(lim.clip * scale, off))
            mean += lim.weight * (held - mean)
            followed(abs(held - mean))
        base = values[k]
        k += 1


def _suspect(days, values, k, base, rest, mask, lim) -> None:
    """Mark a suspect close that doesn't return in time as open or as a plateau, where it is one."""
    off, n = values[k] - base, len(values)
    end = k + 1
    while end < n and end - k <= lim.plateau_days and (values[end] - base) * off > 0 and abs(values[end] - base) >= lim.stay * abs(off):
        end += 1
    if end == n:
        if n - k <= lim.back_days:
            mask[days[k:n]] |= OPEN
    elif lim.back_days < end - k <= lim.plateau_days and abs(values[end] - base) <= rest * abs(values[end - 1] - base):
        mask[days[k:end]] |= PLATEAU


def _repeats(days, close, volume, thin, mask, lim) -> None:
    """Run-length counter of unchanged closes; idle days of a thinly traded source neither count nor end a run."""
    active = [int(d) for d in days if not (thin and volume[d] == 0)]
    same = sum(close[a] == close[b] for a, b in zip(active, active[1:], strict=False))
    runs, start = [], 0
    for k in range(1, len(active) + 1):
        if k == len(active) or close[active[k]] != close[active[start]]:
            if k - start > lim.repeats:
                runs.append(active[start + 1 : k])
            start = k
    inside = sum(map(len, runs))
    if len(active) - 1 - inside <= 0 or (same - inside) / (len(active) - 1 - inside) > lim.usual_repeats:
        return
    for run in runs:
        mask[run] |= STUCK


def _volumes(volume, logs, surprise, thin, mask, lim) -> None:
    """Chart of the logarithm of the split-adjusted volume."""
    ok = np.flatnonzero(volume >= 0)
    traded = ok[volume[ok] > 0]
    if len(traded) < 5:
        return
    first = logs[traded[: lim.warm_up]]
    mean = float(np.median(first))
    whole = logs[traded]
    floor = 0.5 * 1.4826 * float(np.median(np.abs(whole - np.median(whole)))) or 0.05
    scale = max(1.4826 * float(np.median(np.abs(first - mean))), floor)
    high, low = math.log(lim.volume_ratio), math.log(lim.low_ratio)
    for d in ok.tolist():
        if volume[d] == 0:
            if not thin:
                mask[d] |= VOLUME_LOW
            continue
        off = logs[d] - mean
        if off > max(high, lim.volume_scales * scale) and surprise[d] < lim.calm:
            mask[d] |= VOLUME_HIGH
        elif off < min(low, -lim.volume_scales * scale) and not thin:
            mask[d] |= VOLUME_LOW
        held = max(-lim.clip * scale, min(lim.clip * scale, off))
        mean += lim.weight * held
        scale = max(floor, scale + lim.weight * (1.2533 * abs(held) - scale))


def _charts(batches: Iterator[pa.RecordBatch], lim: Limits) -> Iterator[pa.RecordBatch]:
    """Cut sorted batches at the sources' borders, chart each source, give the flagged days."""
    rest: pa.Table | None = None

    def flagged(t: pa.Table) -> pa.RecordBatch:
        keys = t.column(0).combine_chunks()
        num = [t.column(i).cast(pa.float64()).to_numpy() for i in (2, 3, 4)]
        bad = t.column(5).to_numpy(zero_copy_only=False).astype(bool)
        codes = keys.dictionary_encode().indices.to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(np.diff(codes)) + 1, [len(codes)])) if len(codes) else np.array([0])
        mask = np.zeros(len(codes), np.int32)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            mask[a:b] = chart(num[0][a:b], num[1][a:b], num[2][a:b], lim)
        mask[bad] |= IMPOSSIBLE
        keep = pa.array(mask != 0)
        return pa.RecordBatch.from_arrays(
            [keys.filter(keep), t.column(1).combine_chunks().filter(keep), pa.array(mask[mask != 0], pa.int32())],
            names=["__q_key", "__q_day", "reasons"],
        )

    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None and rest.num_rows else t
        if not t.num_rows:
            continue
        last = t.column(0)[-1]
        codes = t.column(0).combine_chunks().dictionary_encode()
        cut = int(np.argmax(codes.indices.to_numpy() == codes.indices[-1].as_py())) if last.is_valid else 0
        if cut:
            yield flagged(t.slice(0, cut))
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        yield flagged(rest)


def implausible_days(
    rows: DataFrame, *, source: Column, day: Column, close: Column, volume: Column, split: Column, loaded: Column,
    limits: Limits | None = None,
) -> DataFrame:
    """(__q_key, __q_day, reasons) of every source's day with an implausible reading; reasons is a bit mask.

    Bits: impossible (close, split not above zero; volume below zero; in any stored copy), spike (a close far
    off the usual moves that is back within two trading days), stuck (an unchanged close repeated at least five
    times), volume_high (far above usual and no matching move of the close), volume_low (next to nothing in a
    source that always trades), split (a split factor that the close doesn't follow). Two more are suspicions only
    (``SUSPECT``): open (a close far off on the last days, of which nobody knows yet whether it returns) and plateau (one
    that returns in one step after three to ten trading days).

    Method: exponentially weighted control charts per source, whose mean and scale are updated with clipped
    values only, a run-length counter and physical limits. The recurrence runs in Arrow batches.

    Scale: copies are first reduced to one row per source and day (map-side combined), so a source has at most
    as many rows as there are trading days; sources are hashed over the tasks and streamed in order, and a task
    holds one batch and one source at a time.

    Defined cases: rows without source or day are left out; of several copies of a day, each value is taken
    from the latest copy that has it (then the greatest); a missing value is never flagged; an empty input
    gives no rows.
    """
    lim = limits or Limits()
    base = rows.select(source.alias("__q_key"), day.cast("date").alias("__q_day"), close.cast("double").alias("c"), volume.cast("double").alias("v"), split.cast("double").alias("s"), loaded.alias("l")).where(
        "__q_key is not null and __q_day is not null"
    ).withColumns({x: F.when(~F.isnan(x), F.col(x)) for x in "cvs"})
    latest = lambda x: F.max(F.when(F.col(x).isNotNull(), F.struct("l", x)))[x].alias(x)
    wrong = (F.col("c") <= 0) | (F.col("v") < 0) | (F.col("s") <= 0)
    per_day = base.groupBy("__q_key", "__q_day").agg(
        latest("c"), latest("v"), latest("s"), F.max(F.coalesce(wrong, F.lit(False))).alias("bad")
    )
    ordered = per_day.repartition("__q_key").sortWithinPartitions("__q_key", "__q_day")
    return ordered.mapInArrow(lambda it: _charts(it, lim), "__q_key string, __q_day date, reasons int")


def implausible_rows(
    rows: DataFrame, *, source: Column, day: Column, close: Column, volume: Column, split: Column, loaded: Column,
    limits: Limits | None = None, into: str = "reasons", max_days: int = 1_000_000,
) -> DataFrame:
    """Every stored row whose source and day :func:`implausible_days` flags, with its reasons as texts.

    The flagged days are few; they are checkpointed in the shared folder, counted, and broadcast if there are at most
    ``max_days``, so the rows aren't shuffled to find them; else both sides are joined by shuffle, with the same result.
    """
    days = implausible_days(rows, source=source, day=day, close=close, volume=volume, split=split, loaded=loaded, limits=limits)
    named = F.filter(F.array(*[F.when(F.col("reasons").bitwiseAND(1 << i) != 0, F.lit(r)) for i, r in enumerate(REASONS)]), lambda x: x.isNotNull())
    keyed = rows.select(*[F.struct(*rows.columns).alias("__q_row")], source.alias("__q_key"), day.cast("date").alias("__q_day"))
    flagged = bounded_broadcast(cut(days.select("__q_key", "__q_day", named.alias("__q_why"))), max_days)
    return keyed.join(flagged, ["__q_key", "__q_day"]).select(
        *[F.col("__q_row")[c].alias(c) for c in rows.columns], F.col("__q_why").alias(into)
    )
