"""Detectors over frame signatures: ``signatures(segment keys..., frame_index, sig ARRAY)``, frames from 0 without holes.

Scores and thresholds are double precision throughout (the arithmetic of single-precision scores differs
from it by less than 1e-7 of the scale of the values). A finding's span has inclusive frames. A segment is
the unit of sequence; segments are independent, so all windows partition by segment.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgrid.functions.arrays import block_differences, mean_abs_difference, mean_abs_second_difference, population_std
from loomgrid.operators.islands import dilate, islands


@dataclass(frozen=True)
class AnalysisConfig:
    """Thresholds of the detectors (fixed values: the defaults of the validation profile)."""

    duplicate_threshold: float = 0.1
    freeze_min_seconds: float = 1.0
    repeat_threshold: float = 0.1
    repeat_min_cycles: int = 3
    repeat_max_period_seconds: float = 5.0
    jump_percentile: float = 10.0
    jump_min_score: float = 0.1
    artifact_block_threshold: float = 20.0
    artifact_min_block_fraction: float = 0.05
    artifact_max_duration_frames: int = 3
    flat_frame_std_threshold: float = 2.0
    temporal_discontinuity_threshold: float = 5.0
    state_motion_support_threshold: float = 0.02
    max_findings: int = 100

    @property
    def blocks(self) -> int:
        return 4


SPAN = ["kind", "severity", "start_frame", "end_frame", "score", "threshold", "period", "cycles"]


def _sequence(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("frame_index")


def frame_scores(signatures: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, transition, score``: transition i is the change from frame i to frame i + 1."""
    following = F.lead("sig").over(_sequence(keys))
    scored = signatures.select(*keys, F.col("frame_index").cast("bigint").alias("transition"), mean_abs_difference(F.col("sig"), following).alias("score"), following.isNotNull().alias("has"))
    return scored.where("has").drop("has")


def jump_thresholds(scores: DataFrame, keys: list[str], config: AnalysisConfig) -> DataFrame:
    """Per segment the percentile of moving scores, at least the minimum; the minimum where nothing moves."""
    moving = F.when(F.col("score") > config.duplicate_threshold, F.col("score"))
    p = F.percentile(moving, F.lit(config.jump_percentile / 100.0))
    return scores.groupBy(*keys).agg(F.coalesce(F.greatest(p, F.lit(config.jump_min_score)), F.lit(config.jump_min_score)).alias("jump_threshold"), F.count(F.lit(1)).alias("transitions"))


def _finding(keys: list[str], kind: Column, severity: str, start: Column, end: Column, score: Column, threshold: Column, period: Column | None = None, cycles: Column | None = None) -> list[Column]:
    none = F.lit(None).cast("bigint")
    values = [kind, F.lit(severity), start.cast("bigint"), end.cast("bigint"), score.cast("double"), threshold.cast("double"), none if period is None else period.cast("bigint"), none if cycles is None else cycles.cast("bigint")]
    return [*map(F.col, keys), *(v.alias(n) for v, n in zip(values, SPAN, strict=True))]


def freezes(scores: DataFrame, keys: list[str], fps: float, config: AnalysisConfig) -> DataFrame:
    """Frozen spans that end in a jump or with the segment (FAIL)."""
    least = max(2, math.ceil(config.freeze_min_seconds * fps))
    limits = jump_thresholds(scores, keys, config)
    runs = islands(scores, keys, "transition", F.col("score") <= config.duplicate_threshold, []).where(F.col("length") + 1 >= least)
    after = scores.select(*keys, F.col("transition").alias("stop"), F.col("score").alias("jump"))
    ended = runs.join(limits, keys).join(after, [*keys, "stop"], "left")
    terminal = F.col("jump").isNull()
    kept = ended.where(terminal | (F.col("jump") >= F.col("jump_threshold")))
    return kept.select(*_finding(keys, F.when(terminal, "freeze_at_episode_end").otherwise("freeze_then_jump"), "FAIL", F.col("start"), F.col("stop"), F.coalesce("jump", F.lit(0.0)), F.col("jump_threshold")))


def repeat_candidates(signatures: DataFrame, scores: DataFrame, keys: list[str], fps: float, config: AnalysisConfig) -> DataFrame:
    """Spans that repeat with a period, before overlapping ones are dropped: ``start, end, period, cycles, jump, terminal``.

    Each frame meets the one a period later in an equi-join on (segment, frame); periods are bounded by
    the configuration, so a segment of n frames gives at most n * periods rows.
    """
    longest = max(2, math.floor(config.repeat_max_period_seconds * fps))
    frames = signatures.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    period_limit = F.least(F.lit(longest), F.greatest(F.lit(2), F.expr(f"CAST(n div {config.repeat_min_cycles} AS INT)")))
    left = signatures.join(frames, keys).select(*keys, "n", F.col("frame_index").cast("bigint").alias("at"), "sig", F.explode(F.sequence(F.lit(2), period_limit)).alias("period"))
    right = signatures.select(*keys, F.col("frame_index").cast("bigint").alias("partner"), F.col("sig").alias("later"))
    compared = left.withColumn("partner", F.col("at") + F.col("period")).join(right, [*keys, "partner"]).select(*keys, "n", "period", "at", mean_abs_difference(F.col("sig"), F.col("later")).alias("offset_score"))
    runs = islands(compared, [*keys, "n", "period"], "at", F.col("offset_score") <= config.repeat_threshold, []).where(F.col("length") >= F.col("period") * (config.repeat_min_cycles - 1))
    runs = runs.withColumn("stop_frame", F.col("stop") + F.col("period"))
    spans = runs.withColumn("transition", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("period") - 2)))
    motion = spans.join(scores, [*keys, "transition"]).groupBy(*keys, "period", "start").agg(F.max("score").alias("first_motion"))
    jump = scores.select(*keys, (F.col("transition") + 1).alias("stop_frame"), F.col("score").alias("jump"))
    limits = jump_thresholds(scores, keys, config)
    out = runs.join(motion.where(F.col("first_motion") > config.duplicate_threshold), [*keys, "period", "start"]).join(jump, [*keys, "stop_frame"], "left").join(limits, keys)
    terminal = F.col("stop_frame") == F.col("n")
    return out.where(terminal | (F.col("jump") >= F.col("jump_threshold"))).select(
        *keys,
        "start",
        (F.col("stop_frame") - 1).alias("end"),
        F.col("period").cast("bigint").alias("period"),
        F.expr("(stop_frame - start) div period").alias("cycles"),
        F.when(terminal, F.lit(0.0)).otherwise(F.col("jump")).alias("jump"),
        terminal.alias("terminal"),
        "jump_threshold",
    )


def repeats(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates in the order of period and start, each kept unless it overlaps one kept before it (FAIL).

    What is kept depends on what was kept, so it is a fold over a segment's candidates in order; they are few.
    """
    values = [c for c in candidates.columns if c not in (*keys, "terminal")]
    one = F.struct("period", "start", *(c for c in values if c not in ("period", "start")))
    grouped = candidates.groupBy(*keys, "terminal").agg(F.sort_array(F.collect_list(one)).alias("all"))
    apart = lambda c: lambda k: (c["end"] < k["start"]) | (c["start"] > k["end"])
    fold = F.aggregate("all", F.filter("all", lambda c: F.lit(False)), lambda kept, c: F.when(F.forall(kept, apart(c)), F.concat(kept, F.array(c))).otherwise(kept))
    kept = grouped.select(*keys, "terminal", F.explode(fold).alias("c")).select(*keys, "terminal", "c.*")
    kind = F.when(F.col("terminal"), "repeated_motion_at_episode_end").otherwise("repeated_motion_then_jump")
    return kept.select(*_finding(keys, kind, "FAIL", F.col("start"), F.col("end"), F.col("jump"), F.col("jump_threshold"), F.col("period"), F.col("cycles")))


def flat_frames(signatures: DataFrame, keys: list[str], config: AnalysisConfig) -> DataFrame:
    """Spans of frames without contrast (WARN)."""
    spread = signatures.select(*keys, F.col("frame_index").cast("bigint").alias("frame_index"), population_std(F.col("sig")).alias("std"))
    limit = config.flat_frame_std_threshold
    runs = islands(spread, keys, "frame_index", F.col("std") <= limit, [F.min("std").alias("least")])
    return runs.select(*_finding(keys, F.lit("low_information_frames"), "WARN", F.col("start"), F.col("stop") - 1, F.lit(limit) - F.col("least"), F.lit(limit)))


def motion_support(states: DataFrame, signatures: DataFrame, keys: list[str], config: AnalysisConfig) -> DataFrame:
    """``keys, frame_index, supported`` for every frame: whether the robot's own acceleration explains a visual change.

    ``states(keys, frame_index, state ARRAY)`` count only if a segment has as many as it has frames, 3 at least.
    Axes with a value that isn't finite, or that don't vary, are left out; the rest are scaled by
    their p95 - p5.
    """
    frames = signatures.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts = states.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"))
    usable = frames.join(counts, keys).where("n = m AND n >= 3").select(*keys)
    axes = states.join(usable, keys, "left_semi").select(*keys, F.col("frame_index").cast("bigint").alias("frame_index"), F.posexplode("state").alias("axis", "value"))
    finite = F.coalesce(~F.isnan("value") & (F.abs("value") < F.lit(float("inf"))), F.lit(False))
    scales = axes.groupBy(*keys, "axis").agg(F.bool_and(finite).alias("finite"), (F.percentile(F.when(finite, F.col("value")), F.lit(0.95)) - F.percentile(F.when(finite, F.col("value")), F.lit(0.05))).alias("scale"))
    scales = scales.where(F.col("finite") & (F.col("scale") > 2.0**-23))
    w = Window.partitionBy(*keys, "axis").orderBy("frame_index")
    bent = axes.join(scales, [*keys, "axis"]).withColumn("x", F.col("value") / F.col("scale"))
    bent = bent.withColumn("bend", F.abs(F.lag("x").over(w) - 2.0 * F.col("x") + F.lead("x").over(w)))
    acceleration = bent.groupBy(*keys, "frame_index").agg(F.coalesce(F.avg("bend"), F.lit(0.0)).alias("acceleration"))
    every = signatures.select(*keys, F.col("frame_index").cast("bigint").alias("frame_index")).join(acceleration, [*keys, "frame_index"], "left")
    moved = F.coalesce(F.col("acceleration") >= config.state_motion_support_threshold, F.lit(False))
    return every.select(*keys, "frame_index", dilate(moved, keys, "frame_index", config.artifact_max_duration_frames).alias("supported"))


def artifact_scores(signatures: DataFrame, keys: list[str], side: int, config: AnalysisConfig) -> DataFrame:
    """``keys, frame_index, artifact_score``: the largest share, over radii, of blocks that differ from both
    neighbours while the neighbours resemble each other; 0 for flat frames and at the ends."""
    w = _sequence(keys)
    radii = range(1, config.artifact_max_duration_frames + 1)
    # a difference over some lag is one neighbour's for one frame and across for another, so each is taken once
    lags = sorted({x for r in radii for x in (r, 2 * r)})
    flat = population_std(F.col("sig")) <= config.flat_frame_std_threshold
    frames = signatures.select(*keys, F.col("frame_index").cast("bigint").alias("frame_index"), "sig", flat.alias("flat"), *(F.lag("sig", x).over(w).alias(f"sig{x}") for x in lags))
    frames = frames.select(*keys, "frame_index", "flat", *(F.when(F.col(f"sig{x}").isNotNull(), block_differences(F.col(f"sig{x}"), F.col("sig"), side, config.blocks)).alias(f"d{x}") for x in lags))
    ahead = [F.lead(f"d{x}", r).over(w).alias(f"{n}{r}") for r in radii for n, x in (("right", r), ("across", 2 * r))]
    frames = frames.select(*keys, "frame_index", "flat", *(F.col(f"d{r}").alias(f"left{r}") for r in radii), *ahead)
    limit = F.lit(config.artifact_block_threshold)
    stands_out = lambda x: (x["a"] >= limit) & (x["b"] >= limit) & (x["c"] <= F.least(x["a"], x["b"]) * 0.5)
    blocks = min(config.blocks, side) ** 2
    shares = [F.size(F.filter(F.arrays_zip(F.col(f"left{r}").alias("a"), F.col(f"right{r}").alias("b"), F.col(f"across{r}").alias("c")), stands_out)) / F.lit(float(blocks)) for r in radii]
    shares = [F.when(F.col(f"left{r}").isNotNull() & F.col(f"right{r}").isNotNull() & F.col(f"across{r}").isNotNull(), x).otherwise(F.lit(0.0)) for r, x in zip(radii, shares, strict=True)]
    score = F.greatest(*shares) if len(shares) > 1 else shares[0]
    return frames.select(*keys, "frame_index", "flat", F.when(F.col("flat"), F.lit(0.0)).otherwise(score).alias("artifact_score"))


def transient_corruption(scores: DataFrame, support: DataFrame, keys: list[str], config: AnalysisConfig) -> DataFrame:
    """Spans of artifacts that the robot's motion doesn't explain (WARN)."""
    limit = config.artifact_min_block_fraction
    rows = scores.join(support, [*keys, "frame_index"], "left")
    mask = (F.col("artifact_score") >= limit) & ~F.coalesce("supported", F.lit(False))
    runs = islands(rows, keys, "frame_index", mask, [F.max("artifact_score").alias("best")])
    return runs.select(*_finding(keys, F.lit("transient_visual_corruption"), "WARN", F.col("start"), F.col("stop") - 1, F.col("best"), F.lit(limit)))


def temporal_scores(signatures: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, frame_index, temporal_score, interior``: mean absolute second difference, 0 at the ends."""
    w = _sequence(keys)
    before, after = F.lag("sig").over(w), F.lead("sig").over(w)
    interior = before.isNotNull() & after.isNotNull()
    bend = mean_abs_second_difference(before, F.col("sig"), after)
    return signatures.select(*keys, F.col("frame_index").cast("bigint").alias("frame_index"), F.when(interior, bend).otherwise(F.lit(0.0)).alias("temporal_score"), interior.alias("interior"))


def robust_thresholds(scores: DataFrame, keys: list[str], value: str, minimum: float) -> DataFrame:
    """max(minimum, median + 6 * 1.4826 * MAD) of interior values; the minimum without any."""
    interior = scores.where("interior")
    medians = interior.groupBy(*keys).agg(F.median(value).alias("median"))
    mads = interior.join(medians, keys).groupBy(*keys).agg(F.first("median").alias("median"), F.median(F.abs(F.col(value) - F.col("median"))).alias("mad"))
    return mads.select(*keys, F.greatest(F.lit(minimum), F.col("median") + 6.0 * 1.4826 * F.col("mad")).alias("temporal_threshold"))


def temporal_discontinuities(signatures: DataFrame, artifacts: DataFrame, support: DataFrame, repeated: DataFrame, keys: list[str], config: AnalysisConfig) -> DataFrame:
    """Spans of sudden change (WARN) outside what motion, artifacts, flat frames (and their neighbours) or repeats explain."""
    scores = temporal_scores(signatures, keys)
    limits = robust_thresholds(scores, keys, "temporal_score", config.temporal_discontinuity_threshold)
    rows = scores.join(limits, keys, "left").join(artifacts, [*keys, "frame_index"]).join(support, [*keys, "frame_index"], "left")
    limit = F.coalesce("temporal_threshold", F.lit(config.temporal_discontinuity_threshold))
    rows = rows.withColumns({"limit": limit, "supported": F.coalesce("supported", F.lit(False))})
    anomaly = F.col("flat") | ((F.col("artifact_score") >= config.artifact_min_block_fraction) & ~F.col("supported"))
    rows = rows.withColumn("excluded", dilate(anomaly, keys, "frame_index", 1))
    inside = repeated.select(*keys, F.explode(F.sequence("start_frame", "end_frame")).alias("frame_index"), F.lit(True).alias("repeating")).distinct()
    rows = rows.join(inside, [*keys, "frame_index"], "left")
    mask = (F.col("temporal_score") >= F.col("limit")) & ~F.col("supported") & ~F.col("excluded") & F.col("repeating").isNull()
    runs = islands(rows, keys, "frame_index", mask, [F.max("temporal_score").alias("best"), F.first("limit").alias("limit")])
    return runs.select(*_finding(keys, F.lit("temporal_discontinuity"), "WARN", F.col("start"), F.col("stop") - 1, F.col("best"), F.col("limit")))


def analyze(signatures: DataFrame, keys: list[str], fps: float, side: int, config: AnalysisConfig | None = None, states: DataFrame | None = None) -> DataFrame:
    """All findings of all segments: ``keys, kind, severity, start_frame, end_frame, score, threshold, period, cycles``."""
    config = config or AnalysisConfig()
    scores = frame_scores(signatures, keys)
    repeated = repeats(repeat_candidates(signatures, scores, keys, fps, config), keys)
    if states is None:
        support = signatures.select(*keys, F.col("frame_index").cast("bigint").alias("frame_index"), F.lit(False).alias("supported"))
    else:
        support = motion_support(states, signatures, keys, config)
    artifacts = artifact_scores(signatures, keys, side, config)
    parts = [
        freezes(scores, keys, fps, config),
        repeated,
        flat_frames(signatures, keys, config),
        transient_corruption(artifacts, support, keys, config),
        temporal_discontinuities(signatures, artifacts, support, repeated, keys, config),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: Order of kinds in a report (fixed values).
EMISSION = ["freeze_then_jump", "freeze_at_episode_end", "repeated_motion_then_jump", "repeated_motion_at_episode_end", "low_information_frames", "transient_visual_corruption", "temporal_discontinuity"]


#: Checks with the severity of their findings, and which kinds belong to each, in order.
CHECKS = [("frozen frames", "FAIL", EMISSION[:2]), ("repeated motion", "FAIL", EMISSION[2:4]), ("visual integrity", "WARN", EMISSION[4:6]), ("temporal continuity", "WARN", EMISSION[6:])]


def check_rollup(findings: DataFrame, segments: DataFrame) -> DataFrame:
    """``position, check, severity, n``: the named checks, decided on all findings before any cap."""
    skipped = ((F.countDistinct("episode_index") - 1) * F.countDistinct("feature")).cast("bigint")
    metadata = segments.agg(skipped.alias("n")).select(F.lit(0).alias("position"), F.lit("metadata and boundaries").alias("check"), F.lit("PASS").alias("severity"), "n")
    counts = findings.groupBy("kind").agg(F.count(F.lit(1)).alias("found"))
    kinds = findings.sparkSession.createDataFrame([(i + 1, name, level, kind) for i, (name, level, own) in enumerate(CHECKS) for kind in own], "position int, check string, level string, kind string")
    rows = kinds.join(counts, "kind", "left").groupBy("position", "check", "level").agg(F.coalesce(F.sum("found"), F.lit(0)).cast("bigint").alias("n"))
    rows = rows.select("position", "check", F.when(F.col("n") > 0, F.col("level")).otherwise("PASS").alias("severity"), "n")
    return metadata.unionByName(rows).orderBy("position")
