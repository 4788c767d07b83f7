import numpy as np
from pyspark.sql import functions as F

from agroframe.operators.long_smoothing import smooth_long
from agroframe.operators.smoothing import kalman_smooth


def test_blocks_equal_the_whole_series(spark):
    rng = np.random.default_rng(0)
    rows = [("a", "p", int(w), float(v)) for w, v in zip(np.cumsum(rng.integers(1, 9, 400)), rng.poisson(20, 400))]
    rows += [("b", "p", 5, 3.0), ("c", "p", 1, 0.0), ("c", "p", 900, 7.0), ("d", "p", 3, None), (None, "p", 3, 1.0)]
    df = spark.createDataFrame(rows, "location string, pest string, week_id long, value double").repartition(5)
    span = max(r[2] for r in rows) // 16 + 1  # the long series in 16 blocks
    got = {(r.location, r.week_id): r for r in smooth_long(df, block_weeks=span).collect()}
    want = kalman_smooth(df.dropna()).collect()
    assert len(got) == len(want) == 403 and df.where("location = 'a'").select(F.floor(F.col("week_id") / span)).distinct().count() == 16
    for r in want:
        g = got[r.location, r.week_id]
        np.testing.assert_allclose([g[c] for c in r.__fields__[2:]], list(r)[2:], rtol=1e-9, atol=1e-9)
    one = {(r.location, r.week_id): r.level for r in smooth_long(df).collect()}
    assert all(abs(one[k] - got[k].level) < 1e-9 for k in got)
    assert smooth_long(df.limit(0)).count() == 0


def test_snapshots_bound_the_replay():
    """In-order readings cost one step each; a late one replays from the nearest snapshot before it."""
    from agroframe.operators.smoothing import Q_LEVEL, Q_SLOPE, R_OBS, local_trend
    from agroframe.streaming.online import EVERY, replay
    rng = np.random.default_rng(2)
    weeks, vals = list(range(0, 400, 2)), rng.poisson(9, 200).astype(float).tolist()
    state = ([], [], [], [])
    for i, (w, v) in enumerate(zip(weeks, vals)):
        *state, at, means, steps = replay(*state, {w: v}, Q_LEVEL, Q_SLOPE, R_OBS)
        assert steps == 1 and at == i and len(state[2]) <= i // EVERY + 2
    *state, at, means, steps = replay(*state, {301: 5.0}, Q_LEVEL, Q_SLOPE, R_OBS)
    assert at == 151 and 50 <= steps <= 50 + EVERY
    want, _, _ = local_trend(np.array(state[0], dtype=float), np.log1p(np.array(state[1])), Q_LEVEL, Q_SLOPE, R_OBS, smooth=False)
    np.testing.assert_array_equal(np.array(means), want[at:])
    *state, at, means, steps = replay(*state, {-5: 2.0}, Q_LEVEL, Q_SLOPE, R_OBS)
    assert at == 0 and steps == len(state[0]) == 202
