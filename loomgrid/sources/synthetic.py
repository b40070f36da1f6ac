"""Deterministic test recordings with closed-form values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrid.functions.clock import NANOS
from loomgrid.functions.signal import sampled_sine


def robot_messages(spark: SparkSession, robots: list[str], rate: float, seconds: float, amplitudes: list[float], offsets: list[float], frequency: float, start_ns: int = 0) -> DataFrame:
    """Messages of state topics ``/<robot>/state``: ``topic, bag_stamp_ns, t, vec``."""
    n = int(seconds * rate) + 1
    topics = F.array(*(F.struct(F.lit(f"/{r}/state").alias("topic"), F.lit(i).alias("entity")) for i, r in enumerate(robots)))
    rows = spark.range(n).select("id", F.explode(topics).alias("x")).select((F.col("id") / F.lit(rate)).alias("t"), "x.topic", "x.entity")
    stamp = F.lit(start_ns) + F.rint(F.col("t") * NANOS).cast("bigint")
    return rows.select("topic", stamp.alias("bag_stamp_ns"), "t", sampled_sine(F.col("t"), F.col("entity"), amplitudes, offsets, frequency).alias("vec"))


def live_signal(spark: SparkSession, rows_per_second: int = 20) -> DataFrame:
    """The same signal as a stream (Spark's rate source)."""
    stream = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    t = F.col("value") / F.lit(float(rows_per_second))
    return stream.select(F.lit("/robot_0/state").alias("topic"), "timestamp", sampled_sine(t, F.lit(0), [1.0] * 7, [0.0] * 7, 0.5).alias("vec"))
