"""Detectors on closed-form signatures: a texture 0..63 plus a level, so adjacent changes are the levels' differences."""

import numpy as np
import pytest

from loomgrid.functions.arrays import block_edges
from loomgrid.operators import signatures
from loomgrid.operators.signatures import AnalysisConfig

KEYS = ["episode_index"]


def frames(spark, levels):
    rows = [(0, i, [float(p + v) for p in range(64)]) for i, v in enumerate(levels)]
    return spark.createDataFrame(rows, "episode_index int, frame_index bigint, sig array<double>")


def found(spark, levels, fps, **config):
    rows = signatures.analyze(frames(spark, levels), KEYS, fps, 8, AnalysisConfig(**config)).collect()
    return {r.kind: r for r in rows}


def test_freeze(spark):
    r = found(spark, [0, 5, 5, 5, 5, 9, 12], 4)["freeze_then_jump"]
    assert (r.start_frame, r.end_frame, r.score) == (1, 4, 4.0) and r.threshold == pytest.approx(3.2)


def test_repeat(spark):
    r = found(spark, [0, 4, 0, 4, 0, 4, 20], 2)["repeated_motion_then_jump"]
    assert (r.start_frame, r.end_frame, r.period, r.cycles, r.score, r.threshold) == (0, 5, 2, 3, 16.0, 4.0)


def test_spike(spark):
    rows = found(spark, [i + 50 * (i == 10) for i in range(20)], 10)
    r = rows["transient_visual_corruption"]
    assert (r.start_frame, r.end_frame, r.score) == (10, 10, 1.0) and "temporal_discontinuity" not in rows


def test_step(spark):
    r = found(spark, [i + 10 * (i >= 10) for i in range(20)], 10)["temporal_discontinuity"]
    assert (r.start_frame, r.end_frame, r.score, r.threshold) == (9, 10, 10.0, 5.0)


def test_flat_and_terminal(spark):
    rows = spark.createDataFrame([(0, i, [7.0] * 64) for i in range(6)], "episode_index int, frame_index bigint, sig array<double>")
    kinds = {r.kind: r for r in signatures.analyze(rows, KEYS, 4, 8).collect()}
    assert kinds["low_information_frames"].score == 2.0 and kinds["freeze_at_episode_end"].end_frame == 5


def test_block_edges():
    assert [block_edges(n, 4) for n in (8, 10, 32, 3)] == [[0, 2, 4, 6, 8], [0, 2, 5, 7, 10], [0, 8, 16, 24, 32], [0, 1, 2, 3]]
    for n in range(1, 70):
        assert block_edges(n, 4) == np.linspace(0, n, min(4, n) + 1, dtype=int).tolist()


def test_motion_support(spark):
    levels = [0, 0, 0, 5, 0, 0, 0, 0, 0, 0]
    states = spark.createDataFrame([(0, i, [float(v), 1.0]) for i, v in enumerate(levels)], "episode_index int, frame_index bigint, state array<double>")
    config = AnalysisConfig(artifact_max_duration_frames=1)
    mask = [r.supported for r in signatures.motion_support(states, frames(spark, levels), KEYS, config).orderBy("frame_index").collect()]
    values = np.array(levels, float) / (np.percentile(levels, 95) - np.percentile(levels, 5))
    bend = np.zeros(10)
    bend[1:-1] = abs(values[:-2] - 2 * values[1:-1] + values[2:])
    moved = bend >= 0.02
    wanted = [bool(moved[max(0, i - 1) : i + 2].any()) for i in range(10)]
    assert mask == wanted
    short = states.limit(4)
    assert not any(r.supported for r in signatures.motion_support(short, frames(spark, levels), KEYS, config).collect())
