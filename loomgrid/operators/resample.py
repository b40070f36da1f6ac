"""Zero-order hold: topics of irregular messages onto a fixed-rate grid.

The grid of an episode starts when each required topic has been seen and ends with its last message; tick k is
at ``start + round_half_even(k * 1e9 / fps)``. A tick takes of each topic the latest message at or before it;
of messages at one time, the one read last.

Time is cut into chunks, so that a long episode is not one task. A chunk starts from seeds, the last message of each
topic before it, which a window over (episode, topic, chunk) hands on; within a chunk, samples and ticks are
unioned and one window with one sort holds the values of all topics. Messages are read and sorted once: the
grid's bounds and the seeds come from one small aggregate of them.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgrid.functions.clock import NANOS, tick_offset


def resample(messages: DataFrame, topics: list[str], fps: Fraction | int, payload: list[str] | None = None, chunk_ticks: int = 100_000) -> DataFrame:
    """``episode_index, frame_index, tick_ns`` and, per topic, a struct column named as the topic:
    ``source_index, bag_stamp_ns`` and the columns ``payload`` of the message that is held."""
    fps = Fraction(fps)
    fields = ["source_index", "bag_stamp_ns", *(payload or [])]
    period = f"{NANOS * fps.denominator}D / {fps.numerator}D"
    width = max(1, chunk_ticks * NANOS * fps.denominator // fps.numerator)
    chunk_of = lambda column: F.expr(f"({column} - pmod({column}, {width}L)) div {width}L")

    wanted = messages.where(F.col("topic").isin(topics))
    indexed = wanted.withColumn("source_index", (F.row_number().over(Window.partitionBy("episode_index", "topic").orderBy("seq")) - 1).cast("bigint"))
    placed = indexed.withColumn("chunk", chunk_of("bag_stamp_ns"))
    ends = placed.groupBy("episode_index", "topic", "chunk").agg(
        F.max_by(F.struct(*fields, "seq"), F.struct("bag_stamp_ns", "seq")).alias("end"), F.min("bag_stamp_ns").alias("first_ns"), F.max("bag_stamp_ns").alias("last_ns")
    )
    whole = ends.groupBy("episode_index", "topic").agg(F.min("first_ns").alias("first_ns"), F.max("last_ns").alias("last_ns"))
    bounds = (
        whole.groupBy("episode_index")
        .agg(F.count(F.lit(1)).alias("n"), F.max("first_ns").alias("start_ns"), F.max("last_ns").alias("last_ns"))
        .where(F.col("n") == len(topics))
    )

    # ticks of each chunk: a few too many by rounding, then those that fall into it
    chunks = bounds.select("episode_index", "start_ns", "last_ns", F.explode(F.sequence(chunk_of("start_ns"), chunk_of("last_ns"))).alias("chunk"))
    low = F.expr(f"greatest(0L, CAST(floor((chunk * {width}L - start_ns) / ({period})) AS BIGINT) - 1)")
    high = F.expr(f"CAST(ceil((least((chunk + 1) * {width}L, last_ns + 1) - start_ns) / ({period})) AS BIGINT) + 1")
    ticks = chunks.select("*", F.explode(F.sequence(low, F.greatest(low, high))).alias("frame_index")).withColumn("at", F.col("start_ns") + tick_offset(F.col("frame_index"), fps))
    ticks = ticks.where((F.col("at") <= F.col("last_ns")) & (chunk_of("at") == F.col("chunk")))
    ticks = ticks.select("episode_index", "chunk", "at", F.lit(1).alias("is_tick"), F.lit(0).cast("bigint").alias("seq"), "frame_index")

    nothing = F.lit(None).cast("bigint").alias("frame_index")
    samples = placed.select("episode_index", "chunk", F.col("bag_stamp_ns").alias("at"), F.lit(0).alias("is_tick"), "seq", nothing, "topic", F.struct(*fields).alias("held"))
    following = F.lead("chunk").over(Window.partitionBy("episode_index", "topic").orderBy("chunk"))
    final = F.max("chunk").over(Window.partitionBy("episode_index"))
    seeds = (
        ends.select("*", F.coalesce(following, final).alias("reach"))
        .where(F.col("reach") > F.col("chunk"))
        .select("*", F.explode(F.sequence(F.col("chunk") + 1, F.col("reach"))).alias("into"))
        .select("episode_index", F.col("into").alias("chunk"), F.col("end.bag_stamp_ns").alias("at"), F.lit(0).alias("is_tick"), F.col("end.seq").alias("seq"), nothing, "topic", F.struct(*(F.col(f"end.{f}").alias(f) for f in fields)).alias("held"))
    )
    rows = samples.unionByName(seeds).unionByName(ticks, allowMissingColumns=True)
    w = Window.partitionBy("episode_index", "chunk").orderBy("at", "is_tick", "seq").rowsBetween(Window.unboundedPreceding, 0)
    holds = [F.last(F.when(F.col("topic") == t, F.col("held")), ignorenulls=True).over(w).alias(t) for t in topics]
    return rows.select("episode_index", "frame_index", F.col("at").alias("tick_ns"), "is_tick", *holds).where("is_tick = 1").drop("is_tick")


def long_frames(frames: DataFrame, topics: list[str]) -> DataFrame:
    """One row per frame and topic: ``episode_index, frame_index, tick_ns, topic`` and the held columns."""
    pairs = F.array(*(F.struct(F.lit(t).alias("topic"), F.col(f"`{t}`").alias("held")) for t in topics))
    return frames.select("episode_index", "frame_index", "tick_ns", F.explode(pairs).alias("x")).select("episode_index", "frame_index", "tick_ns", "x.topic", "x.held.*")


def reuse_statistics(frames: DataFrame, topics: list[str]) -> DataFrame:
    """Per episode and topic: ``output_frames``, ``resampled_reuses`` and ``max_source_age_ns``.

    A held index never goes down, so reuses are frames less distinct indices: one partially aggregated pass
    without a window.
    """
    age = F.greatest(F.lit(0), F.col("tick_ns") - F.col("bag_stamp_ns"))
    return (
        long_frames(frames, topics)
        .groupBy("episode_index", "topic", "source_index")
        .agg(F.count(F.lit(1)).alias("n"), F.max(age).alias("age"))
        .groupBy("episode_index", "topic")
        .agg(F.sum("n").alias("output_frames"), (F.sum("n") - F.count(F.lit(1))).alias("resampled_reuses"), F.max("age").alias("max_source_age_ns"))
    )


def frame_dataset(frames: DataFrame, cameras: dict[str, str], actions: list[str], states: list[str], task: str) -> DataFrame:
    """Frames as a dataset's rows: images by camera, and robot vectors joined in the order of the mapping."""
    images = [F.col(f"`{topic}`.image").alias(f"observation.images.{camera}") for camera, topic in cameras.items()]
    joined = lambda topics: F.concat(*(F.col(f"`{t}`.vec") for t in topics)).cast("array<float>")
    return frames.select("episode_index", "frame_index", "tick_ns", F.lit(task).alias("task"), *images, joined(states).alias("observation.state"), joined(actions).alias("action"))
