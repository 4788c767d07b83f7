"""ST1 + P23: the verdict per device, kept up to date as readings arrive.

The state of a device is the last reading of every variable (by time,
then reading id), one value read and written once a micro-batch, so a reading that arrives late or again changes nothing that is newer.
Every micro-batch emits one row for each device that it touches, with the next
``revision``; ``latest_verdicts`` keeps the last one, which is the same however
the input was cut into micro-batches.

With ``silence`` a device that sends nothing for that long (processing time) is
reported once as silent and its readings are forgotten; so is a single
variable's reading after that time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from agroframe.operators.sensor import THRESHOLDS

SCHEMA = "device_id long, revision long, seen int, out_of_range int, status string, as_of long"  # in us
STATE = "revision long, last array<struct<variable: string, ts: long, reading: long, value: double, at: long>>"  # times in us, at in ms
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class DeviceVerdict(StatefulProcessor):
    """Last value of every variable with a rule, and the verdict over all rules (a variable never read is out of range)."""

    def __init__(self, rules: dict[str, tuple[float, float]], silence: int | None = None):
        self.rules, self.silence = rules, silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # every call to the state store is a round trip: one read and one write for a device and batch
        now = 0 if self.silence is None else timerValues.getCurrentProcessingTimeInMs()
        revision, held = self.state.get() or (0, [])
        last = {variable: (ts, reading, value, at) for variable, ts, reading, value, at in held
                if self.silence is None or at + self.silence > now}
        for r in rows:
            seen = last.get(r.variable)
            if seen is None or (r.ts, r.reading) >= seen[:2]:
                last[r.variable] = (r.ts, r.reading, None if r.value is None or r.value != r.value else r.value, now)
        bad = sum(variable not in last or last[variable][2] is None or not lo <= last[variable][2] <= hi
                  for variable, (lo, hi) in self.rules.items())
        if self.silence is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(now + self.silence)
        self.state.update((revision + 1, [(variable, *cells) for variable, cells in last.items()]))
        yield Row(device_id=key[0], revision=revision + 1, seen=len(last), out_of_range=bad,
                  status="At risk" if bad else "Healthy", as_of=max(v[0] for v in last.values()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        revision = self.state.get()[0] + 1
        self.state.update((revision, []))
        yield Row(device_id=key[0], revision=revision, seen=0, out_of_range=len(self.rules), status="Silent", as_of=None)

    def close(self) -> None:
        pass


def device_verdicts(readings: DataFrame, rules=None, silence: int | None = None) -> DataFrame:
    """Streaming (device_id, ts, event_id, variable, value) readings -> verdict revisions per device.

    Readings of variables without a rule, and without device, time or id, are no part of a verdict.
    *silence* is in milliseconds.  Start the query inside ``rocksdb_state``.
    """
    rules = dict(THRESHOLDS if rules is None else rules)
    rows = (readings.where(F.col("variable").isin(*rules) & F.col("device_id").isNotNull() & F.col("ts").isNotNull()
                           & F.col("event_id").isNotNull())
            .select(F.col("device_id").cast("long").alias("device_id"), "variable",
                    F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), F.col("event_id").cast("long").alias("reading"),
                    F.col("value").cast("double").alias("value")))
    verdicts = rows.groupBy("device_id").transformWithState(
        statefulProcessor=DeviceVerdict(rules, silence), outputStructType=SCHEMA, outputMode="Append",
        timeMode="None" if silence is None else "ProcessingTime")
    return verdicts.withColumn("as_of", F.timestamp_micros("as_of"))


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Arbitrary state lives in RocksDB; queries started inside use it, the session's own setting comes back afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def latest_verdicts(revisions: DataFrame) -> DataFrame:
    """The last revision of every device of the (batch-read) output of ``device_verdicts``."""
    cells = ["seen", "out_of_range", "status", "as_of"]
    last = revisions.groupBy("device_id").agg(F.max_by(F.struct(*cells), "revision").alias("_last"))
    return last.select("device_id", *[F.col(f"_last.{c}").alias(c) for c in cells])
