"""Video segments of a frame dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgrid.functions.clock import frame_number
from loomgrid.functions.text import video_path


def segment_layout(episodes: DataFrame, features: list[str], fps: float, template: str, place: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """One segment per episode and feature: ``episode_index, feature, video_path, start_frame, length, end_frame``.

    ``episodes`` has ``episode_index, length`` and, for each feature, ``videos/<feature>/chunk_index``, ``.../file_index``
    and ``.../from_timestamp`` (or other columns, given by ``place``). The features are a short fixed list, so this
    is an explode.
    """

    def of(feature: str, what: str) -> Column:
        return place[feature][what] if place else F.col(f"`videos/{feature}/{what}`")

    rows = []
    for feature in features:
        start = frame_number(of(feature, "from_timestamp"), fps)
        path = video_path(template, F.lit(feature), of(feature, "chunk_index"), of(feature, "file_index"))
        rows.append(F.struct(F.lit(feature).alias("feature"), path.alias("video_path"), start.alias("start_frame"), F.col("length").cast("bigint").alias("length"), (start + F.col("length")).alias("end_frame")))
    return episodes.select("episode_index", F.explode(F.array(*rows)).alias("s")).select("episode_index", "s.*")


def segment_overlaps(segments: DataFrame) -> DataFrame:
    """Segments that begin before the one before them in their file ends."""
    w = Window.partitionBy("video_path").orderBy("start_frame", "end_frame")
    return segments.withColumn("previous_end", F.lag("end_frame").over(w)).where("start_frame < previous_end")


def first_episodes(episodes: DataFrame, most: int | None) -> DataFrame:
    """The first ``most`` episodes by index; all without a limit."""
    if most is None:
        return episodes.orderBy("episode_index")
    if most < 1:
        raise ValueError("max_episodes must be at least 1")
    return episodes.orderBy("episode_index").limit(most)


def dataset_totals(segments: DataFrame, first_feature: str) -> DataFrame:
    """Distinct episodes and features, and frames of the first feature only."""
    return segments.agg(
        F.countDistinct("episode_index").alias("n_episodes"),
        F.countDistinct("feature").alias("n_features"),
        F.coalesce(F.sum(F.when(F.col("feature") == first_feature, F.col("length"))), F.lit(0)).cast("bigint").alias("total_frames"),
    )
