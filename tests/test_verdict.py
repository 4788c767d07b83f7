import os
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row

from agroframe.streaming.live import run_available_now
from agroframe.streaming.verdict import DeviceVerdict, device_verdicts, latest_verdicts, rocksdb_state

RULES = {"t": (10.0, 20.0), "h": (30.0, 60.0)}
SCHEMA = "device_id long, ts timestamp, event_id long, variable string, value double"
START = datetime(2024, 1, 1)


def expected(rows):
    last = {}
    for d, ts, e, v, x in rows:
        if v in RULES and d is not None and ts is not None and e is not None and (ts, e) >= last.get((d, v), (datetime.min, 0, None))[:2]:
            last[d, v] = (ts, e, x)
    out = {}
    for d in {d for d, _ in last}:
        held = {v: last[d, v] for v in RULES if (d, v) in last}
        bad = sum(v not in held or held[v][2] is None or not lo <= held[v][2] <= hi for v, (lo, hi) in RULES.items())
        out[d] = (len(held), bad, "At risk" if bad else "Healthy", max(x[0] for x in held.values()))
    return out


def replay(spark, path, rows, cuts):
    for i, part in enumerate(cuts):
        spark.createDataFrame([rows[k] for k in part], SCHEMA).coalesce(1).write.parquet(f"{path}/{i:03d}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)
    with rocksdb_state(spark):
        out = run_available_now(device_verdicts(stream, RULES), "verdict-test")
    got = spark.read.parquet(out)
    return {r.device_id: (r.seen, r.out_of_range, r.status, r.as_of) for r in latest_verdicts(got).collect()}, got


@pytest.mark.parametrize("seed", [1, 2])
def test_same_verdicts_for_any_cut_and_order(spark, tmpdir_path, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([1, 2, 3, None]), START + timedelta(minutes=rnd.randint(0, 40)), i, rnd.choice(["t", "h", "other"]),
             rnd.choice([5.0, 15.0, 40.0, None])) for i in range(120)]
    rows += [(4, START, 500, "t", 15.0), (4, START, 501, "h", 40.0), (5, START, 502, "t", 15.0), (6, None, 503, "t", 1.0)]
    rows.append(rows[0])  # a repeated reading
    order = list(range(len(rows)))
    rnd.shuffle(order)
    cuts = [order[i::4] for i in range(4)] if seed == 1 else [order]
    got, revisions = replay(spark, f"{tmpdir_path}/r", rows, cuts)
    assert got == expected(rows) and got[4][2] == "Healthy" and got[5][:3] == (1, 1, "At risk")
    seen = {}
    for r in revisions.collect():
        seen.setdefault(r.device_id, []).append(r.revision)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in seen.values())


def test_a_silent_device_is_reported_and_forgotten(spark, tmpdir_path):
    src, out = f"{tmpdir_path}/in", f"{tmpdir_path}/out"
    os.makedirs(src)
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(src)
    with rocksdb_state(spark):
        q = (device_verdicts(stream, RULES, silence=3000).writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", f"{tmpdir_path}/c").trigger(processingTime="500 milliseconds").start())
    try:
        def wait(status):
            for _ in range(120):
                time.sleep(0.5)
                try:
                    rows = [tuple(r) for r in spark.read.parquet(out).select("revision", "seen", "status").collect()]
                except Exception:  # noqa: BLE001 - nothing written yet
                    rows = []
                if any(r[2] == status for r in rows):
                    return sorted(rows)
            raise AssertionError(q.status)
        spark.createDataFrame([(1, START, 1, "t", 15.0), (1, START, 2, "h", 40.0)], SCHEMA).coalesce(1).write.parquet(f"{src}/a")
        assert wait("Healthy")[0] == (1, 2, "Healthy")
        assert wait("Silent")[-1] == (2, 0, "Silent")
        spark.createDataFrame([(1, START, 3, "t", 15.0)], SCHEMA).coalesce(1).write.parquet(f"{src}/b")
        assert (3, 1, "At risk") in wait("At risk")  # the humidity before the silence is forgotten
    finally:
        q.stop()


def test_one_read_and_one_write_of_state_for_a_device_and_batch():
    """Calls to the state store are round trips to another process: they must not grow with the variables."""
    class Handle:
        calls, held = 0, None

        def getValueState(self, *_, **__):
            return self

        def get(self):
            self.calls += 1
            return self.held

        def update(self, value):
            self.calls, self.held = self.calls + 1, value

    handle, device = Handle(), DeviceVerdict(RULES)
    device.init(handle)
    rows = [Row(variable=v, ts=t, reading=t, value=x) for v, t, x in (("t", 2, 15.0), ("t", 1, 99.0), ("h", 3, 40.0), ("h", 3, 41.0))]
    (first,) = device.handleInputRows((7,), iter(rows), None)
    (again,) = device.handleInputRows((7,), iter(rows[1:2]), None)
    assert handle.calls == 4
    assert first == Row(device_id=7, revision=1, seen=2, out_of_range=0, status="Healthy", as_of=3) and again == first.__class__(
        device_id=7, revision=2, seen=2, out_of_range=0, status="Healthy", as_of=3)
