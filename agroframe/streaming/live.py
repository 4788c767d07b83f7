"""ST1: live sensor check on Structured Streaming.

The same column function serves batch and stream: a reading joins the tiny
static rules table (stream-static broadcast join) and gets its in-range flag.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroframe.operators.sensor import THRESHOLDS, rules_table
from agroframe.session import ensure_checkpoint_dir


def live_check(readings: DataFrame, rules=None) -> DataFrame:
    """Per reading (long form: variable, value): label, range text, ok, status.

    Works unchanged on a batch or a streaming DataFrame.  Readings of a
    variable without a rule (e.g. raw soil moisture) are kept, ok = NULL.
    """
    r = rules_table(readings.sparkSession, THRESHOLDS if rules is None else rules)
    j = readings.join(F.broadcast(r), "variable", "left")
    ok = F.when(F.col("lo").isNotNull(), F.coalesce(F.col("value").between(F.col("lo"), F.col("hi")), F.lit(False)))
    return (j.withColumn("ok", ok)
            .withColumn("status", F.when(F.col("ok"), "✓ in range").when(~F.col("ok"), "✗ out of range"))
            .drop("lo", "hi"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def run_available_now(stream: DataFrame, name: str, output_mode: str = "append") -> str:
    """Run *stream* to a Parquet sink until the available input is consumed; return the sink path."""
    spark = stream.sparkSession
    root = scratch_path(spark, name)
    out, ckpt = os.path.join(root, "out"), os.path.join(root, "checkpoint")
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out
