"""ST2: online (forward-only) filter per series with arbitrary state.

The state of a (location, pest) is its readings so far, at most one per week, so it
is bounded by the calendar, and snapshots of the filter: after every ``EVERY``-th reading and after the last.
A reading of the next week costs one filter step from the last snapshot; one that arrives late replays the weeks from the nearest snapshot
before it, and every week from it on is emitted with the next ``revision``.  Nothing is dropped: a
reading that arrives late changes the estimates after it, and a second
reading of a week replaces the first; of several of one week in one micro-batch the largest counts.  ``latest`` keeps the last revision of
each week, which equals the batch filter (``kalman_smooth``'s ``level_f`` / ``slope_f``)
however the input was cut into micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from agroframe.operators.smoothing import Q_LEVEL, Q_SLOPE, R_OBS, first_state, next_state, state_mean

EVERY = 16
STATE_SCHEMA = "weeks array<long>, readings array<double>, snap_at array<int>, snaps array<double>, revision long"
OUT_SCHEMA = ("location string, pest string, week_id long, value double, level_f double, slope_f double, "
              "revision long")


def replay(weeks: list, readings: list, snap_at: list, snaps: list, new: dict, ql: float, qs: float, r: float):
    """The series with its *new* {week: reading}: weeks, readings, snapshots, first changed place, its estimates on, steps taken."""
    held = dict(zip(weeks, readings)) | new
    order = sorted(held)
    vals = [held[w] for w in order]
    at = order.index(min(new))
    snaps = {i: tuple(snaps[5 * k:5 * k + 5]) for k, i in enumerate(snap_at) if i < at}
    i = max(snaps, default=-1)
    state, means, steps = snaps.get(i), [], 0
    kept = {k: v for k, v in snaps.items() if k % EVERY == EVERY - 1}
    for j in range(i + 1, len(order)):
        z = float(np.log1p(vals[j]))
        state = first_state(z, r) if j == 0 else next_state(state, float(order[j] - order[j - 1]), z, ql, qs, r)
        steps += 1
        if j >= at:
            means.append(state_mean(state))
        if j % EVERY == EVERY - 1 or j == len(order) - 1:
            kept[j] = state
    return order, vals, list(kept), [x for v in kept.values() for x in v], at, means, steps


def online_filter(weekly: DataFrame, value: str = "value", q_level: float = Q_LEVEL,
                  q_slope: float = Q_SLOPE, r_obs: float = R_OBS) -> DataFrame:
    """Apply the filter to a (streaming or batch) DataFrame of weekly readings.

    Rows without week or value are no readings.  Emits one row per week that a
    micro-batch adds or changes; see the module for revisions.
    """
    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        weeks, readings, snap_at, snaps, revision = state.get if state.exists else ([], [], [], [], 0)
        held, new = dict(zip(weeks, readings)), {}
        for pdf in batches:
            for w, v in zip(pdf["week_id"].tolist(), pdf[value].tolist()):
                new[w] = max(v, new.get(w, v))
        new = {w: v for w, v in new.items() if held.get(w) != v}
        if not new:
            return
        order, vals, snap_at, snaps, at, means, _ = replay(list(weeks), list(readings), list(snap_at), list(snaps), new, q_level, q_slope, r_obs)
        state.update((order, vals, snap_at, snaps, revision + 1))
        means = np.array(means)
        out = pd.DataFrame({"location": key[0], "pest": key[1], "week_id": order[at:], "value": vals[at:]})
        yield out.assign(level_f=means[:, 0], slope_f=means[:, 1], revision=revision + 1)

    return (weekly.select("location", "pest", "week_id", value).where(f"week_id is not null and {value} is not null")
            .groupBy("location", "pest")
            .applyInPandasWithState(fn, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout))


def latest(estimates: DataFrame) -> DataFrame:
    """The last revision of every week of the (batch-read) output of ``online_filter``."""
    cells = ["value", "level_f", "slope_f"]
    last = estimates.groupBy("location", "pest", "week_id").agg(F.max_by(F.struct(*cells), "revision").alias("_last"))
    return last.select("location", "pest", "week_id", *[F.col(f"_last.{c}").alias(c) for c in cells])
