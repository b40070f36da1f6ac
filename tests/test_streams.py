"""Resampling, source quality and islands on hand-made rows."""

import itertools
import random
import time
from fractions import Fraction

import pytest

from loomgrid.operators import islands, resample, source_quality
from loomgrid.streaming import live
from pyspark.sql import functions as F

MS = 1_000_000
SCHEMA = "episode_index int, seq bigint, topic string, bag_stamp_ns bigint, source_stamp_ns bigint, fingerprint string, value double"


def table(spark, rows):
    """rows: (topic, time in ms, fingerprint)"""
    full = [(0, i, t, int(at * MS), int(at * MS), f, float(i)) for i, (t, at, f) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


GOLDEN = [("act", 0, None), ("st", 0, None), ("cam", 0, "A"), ("cam", 200, "A"), ("cam", 400, "B"), ("act", 500, None), ("st", 500, None)]


@pytest.mark.parametrize("chunk", [1, 2, 100])
def test_golden_hold(spark, chunk):
    rows = table(spark, GOLDEN)
    frames = resample.resample(rows, ["act", "cam", "st"], 10, chunk_ticks=chunk)
    held = sorted((r.frame_index, r.tick_ns, r.cam.source_index) for r in frames.collect())
    assert held == [(k, k * 100 * MS, i) for k, i in enumerate([0, 0, 1, 1, 2, 2])]
    stats = {r.topic: r for r in resample.reuse_statistics(frames, ["act", "cam", "st"]).collect()}
    assert (stats["cam"].output_frames, stats["cam"].resampled_reuses, stats["cam"].max_source_age_ns) == (6, 3, 100 * MS)
    runs = source_quality.duplicate_runs(rows.where("topic = 'cam'")).collect()
    assert [(r.run_start_ns, r.run_end_ns, r.source_frames) for r in runs] == [(0, 200 * MS, 2)]
    assert source_quality.gap_findings(rows.where("topic = 'cam'")).count() == 0


def test_fractional_period(spark):
    rows = table(spark, [("a", 0, None), ("a", 1000, None)])
    ticks = sorted(r.tick_ns for r in resample.resample(rows, ["a"], 3).collect())
    assert ticks == [0, 333333333, 666666667, 1000000000]


def test_ties_start_and_missing_topic(spark):
    rows = table(spark, [("a", 0, None), ("a", 0, None), ("st", 250, None), ("a", 300, None), ("st", 450, None)])
    frames = resample.resample(rows, ["a", "st"], 10, payload=["value"]).orderBy("tick_ns").collect()
    assert [r.tick_ns for r in frames] == [250 * MS, 350 * MS, 450 * MS]
    assert frames[0].a.value == 1.0  # the later of two at one time
    assert resample.resample(rows, ["a", "st", "none"], 10).count() == 0
    back = table(spark, [("a", 5, None), ("a", 3, None)])
    assert islands.order_violations(back, ["episode_index"], "seq", "bag_stamp_ns").count() == 1


def hold_loop(rows, topics, fps):
    latest, start, k, out = {}, None, 0, []
    for at, same in itertools.groupby(rows, key=lambda r: r[1]):
        while start is not None and start + round(Fraction(k * 10**9) / fps) < at:
            out.append((k, start + round(Fraction(k * 10**9) / fps), *(latest[t] for t in topics)))
            k += 1
        for topic, _, number in same:
            latest[topic] = number
        if start is None and len(latest) == len(topics):
            start = at
    last = rows[-1][1]
    while start is not None and start + round(Fraction(k * 10**9) / fps) <= last:
        out.append((k, start + round(Fraction(k * 10**9) / fps), *(latest[t] for t in topics)))
        k += 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_hold_equals_loop(spark, seed):
    dice = random.Random(seed)
    stamps = sorted(dice.randrange(0, 3000) * MS for _ in range(120))
    count = {"a": 0, "b": 0, "c": 0}
    rows = []
    for i, at in enumerate(stamps):
        topic = dice.choice("abc")
        rows.append((topic, at, count[topic]))
        count[topic] += 1
    full = [(0, i, t, at, None, None, 0.0) for i, (t, at, _) in enumerate(rows)]
    fps = Fraction(dice.choice([3, 7, 10, 30]))
    frames = resample.resample(spark.createDataFrame(full, SCHEMA), ["a", "b", "c"], fps, chunk_ticks=dice.choice([1, 5, 1000]))
    found = sorted((r.frame_index, r.tick_ns, r.a.source_index, r.b.source_index, r.c.source_index) for r in frames.collect())
    assert found == hold_loop(rows, ["a", "b", "c"], fps)


def test_gap_and_drop(spark):
    rows = table(spark, [("cam", t, str(i)) for i, t in enumerate([0, 100, 200, 300, 550, 1650])])
    found = {r.kind: r for r in source_quality.gap_findings(rows).collect()}
    assert found["camera_source_frame_drop"].estimated_missing_frames == 1
    assert found["camera_source_gap"].severity == "FAIL" and len(found) == 2


def test_duplicate_evidence(spark):
    rows = table(spark, [("cam", 0, "A"), ("other", 50, "x"), ("cam", 100, "A"), ("other", 120, "y"), ("other", 150, "y"), ("cam", 200, "A"), ("cam", 300, "B")])
    states = spark.createDataFrame([(0, t * MS, [float(v), 0.0]) for t, v in [(0, 0), (100, 2), (200, 3), (300, 90)]], "episode_index int, tick_ns bigint, state array<double>")
    (run,) = source_quality.duplicate_findings(rows, states, min_frames=3).collect()
    assert (run.source_frames, run.max_state_motion, run.other_camera_content_changes, run.severity) == (3, 2.0, 1, "WARN")


def test_islands_equal_groupby(spark):
    dice = random.Random(5)
    mask = [dice.random() < 0.5 for _ in range(300)]
    df = spark.createDataFrame([(1, i, m) for i, m in enumerate(mask)], "k int, i bigint, m boolean")
    wanted, at = [], 0
    for value, run in itertools.groupby(mask):
        n = len(list(run))
        if value:
            wanted.append((at, at + n))
        at += n
    assert sorted((r.start, r.stop) for r in islands.islands(df, ["k"], "i", F.col("m"), []).collect()) == wanted


def test_insufficient_and_tail(spark):
    rows = table(spark, [("a", t, None) for t in (0, 100, 200)] + [("b", 5000, None)])
    kinds = {(r.topic, r.kind) for r in source_quality.tail_findings(rows).collect()}
    assert kinds == {("a", "camera_source_tail_gap")}
    few = {(r.topic, r.source_frames) for r in source_quality.insufficient_frames(rows, ["a", "b", "c"], 2).collect()}
    assert few == {("b", 1), ("c", 0)}


def control(spark, rows):
    return spark.createDataFrame([(1, at, i, c) for i, (at, c) in enumerate(rows)], "recorder int, at_ns bigint, seq bigint, command string")


def test_sessions(spark):
    given = [(1, "stop"), (5, "start"), (20, "start"), (35, "status"), (65, "stop"), (66, "discard"), (70, "start"), (80, "discard"), (90, "start"), (95, "status")]
    answers = [(r.accepted, r.state, r.session) for r in live.session_control(control(spark, given)).orderBy("at_ns").collect()]
    assert answers == [
        (False, "idle", 0), (True, "recording", 1), (False, "recording", 1), (True, "recording", 1), (True, "idle", 1),
        (False, "idle", 1), (True, "recording", 2), (True, "idle", 2), (True, "recording", 3), (True, "recording", 3),
    ]
    rows = spark.createDataFrame([(1, t) for t in range(0, 120, 5)], "recorder int, bag_stamp_ns bigint")
    kept = lambda **more: sorted((r.session, r.bag_stamp_ns) for r in live.with_sessions(rows, control(spark, given), **more).collect())
    first = [(1, t) for t in range(5, 65, 5)]
    assert kept() == first and kept(keep_open=True) == first + [(3, t) for t in range(90, 120, 5)]


def streamed(spark, tmp_path, batches, schema, plan):
    """All rows of ``plan`` over a stream of the batches, one file each."""
    folder = tmp_path / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    query = plan(stream).writeStream.format("memory").queryName("streamed").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.sql("SELECT * FROM streamed").collect()


def test_stream_equals_batch(spark, tmp_path):
    dice = random.Random(3)
    stamps = sorted(dice.randrange(0, 2000) * MS for _ in range(60))
    rows = [(0, i, dice.choice(["a", "b"]), t, t, dice.choice("xy"), float(i)) for i, t in enumerate(stamps)]
    # topics of the streams end with messages that have no topic, or no content
    last = rows[-1][3]
    end = [(0, 100, None, last, last, None, 0.0)]
    held = streamed(spark, tmp_path / "hold", [rows[:20], rows[20:45], rows[45:], end], SCHEMA, lambda s: live.online_hold(s, ["a", "b"], 10))
    batch = resample.resample(spark.createDataFrame(rows, SCHEMA), ["a", "b"], 10, payload=["value"]).collect()
    assert sorted((r.frame_index, r.tick_ns, r.values["a"], r.values["b"]) for r in held) == sorted((r.frame_index, r.tick_ns, r.a.value, r.b.value) for r in batch)
    ends = [(0, 100 + i, t, last, last, None, 0.0) for i, t in enumerate("ab")]
    runs = streamed(spark, tmp_path / "runs", [rows[:20], rows[20:45], rows[45:], ends], SCHEMA, live.online_runs)
    wanted = source_quality.duplicate_runs(spark.createDataFrame(rows, SCHEMA)).select("episode_index", "topic", "run_start_ns", "run_end_ns", "source_frames").collect()
    assert sorted(map(tuple, runs)) == sorted(map(tuple, wanted)) and wanted


def test_stream_of_disorder(spark, tmp_path):
    stamp = [5, 9, 7, 9, 3, 12, 11]
    rows = [(0, i, "a", t, t, None, 0.0) for i, t in enumerate(stamp)]
    late = streamed(spark, tmp_path, [rows[:3], rows[3:5], rows[5:]], SCHEMA, live.disordered)
    assert sorted((r.seq, r.clock_ns) for r in late) == [(2, 9), (4, 9), (6, 12)]


def test_camera_without_a_message(spark):
    rows = table(spark, GOLDEN)
    frames = resample.resample(rows, ["act", "cam", "st"], 10)
    found = {r.topic: r for r in source_quality.camera_statistics(rows, resample.reuse_statistics(frames, ["act", "cam", "st"]), ["cam", "none"]).collect()}
    assert found["cam"].source_frames == 3 and (found["none"].source_frames, found["none"].median_source_period_ms) == (0, None)
