"""Streaming forms: counts, automatic sessions, recording, and an online zero-order hold."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomgrid.functions.clock import NANOS


def topic_counts(messages: DataFrame) -> DataFrame:
    """Messages by topic, batch or stream."""
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def session_number(stamp_ns: Column, origin_ns: Column | int, duration_s: int, pause_s: int) -> Column:
    """Automatic sessions of ``duration_s`` with pauses between: the session's number, null within a pause."""
    origin = F.lit(origin_ns) if isinstance(origin_ns, int) else origin_ns
    offset, cycle = stamp_ns - origin, (duration_s + pause_s) * NANOS
    inside = F.pmod(offset, F.lit(cycle)) < duration_s * NANOS
    return F.when((offset >= 0) & inside, F.floor(offset / F.lit(cycle)).cast("bigint"))


def _command_order(commands: DataFrame) -> list[str]:
    return [c for c in ("at_ns", "seq") if c in commands.columns]


def session_control(commands: DataFrame) -> DataFrame:
    """``commands(recorder, at_ns, seq, command)`` with what each does: ``accepted``, ``state`` after it (recording, idle) and
    ``session`` (the number of the last session begun, 0 before any).

    Without a column ``seq`` commands of one time have no order. A start while recording is refused, and so is a stop, save or discard while idle; status is always answered and changes nothing.
    """
    order = Window.partitionBy("recorder").orderBy(*_command_order(commands))
    kind = F.when(F.col("command") == "start", "recording").when(F.col("command").isin("stop", "save", "discard"), "idle")
    rows = commands.withColumn("__kind", kind)
    before = F.coalesce(F.last("__kind", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit("idle"))
    rows = rows.withColumn("__before", before)
    rows = rows.withColumns({"accepted": F.coalesce(F.col("__kind") != F.col("__before"), F.col("command") == "status"), "state": F.coalesce("__kind", "__before")})
    begun = F.count_if((F.col("command") == "start") & F.col("accepted")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("session", begun).drop("__kind", "__before")


def with_sessions(messages: DataFrame, commands: DataFrame, keep_open: bool = False) -> DataFrame:
    """Messages with the session that an accepted start opened and the next accepted stop, save or discard closed; messages outside
    sessions and those of discarded sessions go, and so does a session that is still open at the end, unless ``keep_open``.
    ``commands`` are those of ``session_control`` and few."""
    w = Window.partitionBy("recorder").orderBy(*_command_order(commands))
    acts = session_control(commands).where("accepted AND command <> 'status'")
    closed = acts.withColumns({"to_ns": F.lead("at_ns").over(w), "end": F.lead("command").over(w)}).where("command = 'start'")
    kept = closed.where(F.coalesce(F.col("end") != "discard", F.lit(keep_open)))
    sessions = kept.select("recorder", F.col("at_ns").alias("from_ns"), F.coalesce("to_ns", F.lit((1 << 63) - 1)).alias("to_ns"), "session")
    return messages.join(sessions, "recorder").where("bag_stamp_ns >= from_ns AND bag_stamp_ns < to_ns").drop("from_ns", "to_ns")


def record(messages: DataFrame, path: str, checkpoint: str):
    """Write a stream of messages as it arrives (file sink); returns the query."""
    return messages.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def online_hold(messages: DataFrame, topics: list[str], fps: Fraction | int) -> DataFrame:
    """Zero-order hold of a stream: ``episode_index, frame_index, tick_ns, values`` (by topic).

    State per episode: the latest value of each topic, the grid's start and the next tick. A tick comes out
    when a later message shows that nothing more belongs to it, or with the message without a topic that ends the episode, at
    whose time or before it the last ticks lie. A message of a time already passed raises, as in the batch form
    (``disordered`` finds such messages).
    """
    fps = Fraction(fps)
    place = {t: i for i, t in enumerate(topics)}

    def hold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        latest, known, start, k, clock = (list(state.get[0]), list(state.get[1]), *state.get[2:]) if state.exists else ([0.0] * len(topics), [False] * len(topics), -1, 0, -1)
        rows = []
        data = pd.concat(list(parts))
        tick = lambda i: start + round(Fraction(i * NANOS) / fps)
        for at, same in data.sort_values(["bag_stamp_ns", "seq"]).groupby("bag_stamp_ns"):
            if at < clock:
                raise ValueError(f"episode {key[0]}: messages aren't sorted by time")
            while start >= 0 and tick(k) < at:
                rows.append((key[0], k, tick(k), dict(zip(topics, latest, strict=True))))
                k += 1
            for topic, value in zip(same["topic"], same["value"], strict=True):
                if topic in place:
                    latest[place[topic]], known[place[topic]] = float(value), True
            clock = int(at)
            if start < 0 and all(known):
                start = clock
            while start >= 0 and same["topic"].isna().any() and tick(k) <= clock:
                rows.append((key[0], k, tick(k), dict(zip(topics, latest, strict=True))))
                k += 1
        state.update((latest, known, start, k, clock))
        yield pd.DataFrame(rows, columns=["episode_index", "frame_index", "tick_ns", "values"])

    return messages.groupBy("episode_index").applyInPandasWithState(
        hold,
        "episode_index int, frame_index bigint, tick_ns bigint, values map<string,double>",
        "latest array<double>, known array<boolean>, start bigint, k bigint, clock bigint",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def disordered(messages: DataFrame) -> DataFrame:
    """Messages of a stream that come after a later one of their episode, as ``episode_index, seq, bag_stamp_ns, clock_ns``: a way
    aside for what ``online_hold`` refuses. Within one micro-batch the order is that of ``seq``."""

    def late(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        clock = state.get[0] if state.exists else -(1 << 62)
        data = pd.concat(list(parts)).sort_values("seq")
        most = data["bag_stamp_ns"].cummax().shift(fill_value=clock).clip(lower=clock)
        state.update((max(clock, int(data["bag_stamp_ns"].max())),))
        yield pd.DataFrame({"episode_index": key[0], "seq": data["seq"], "bag_stamp_ns": data["bag_stamp_ns"], "clock_ns": most})[(data["bag_stamp_ns"] < most).values]

    return messages.groupBy("episode_index").applyInPandasWithState(late, "episode_index int, seq bigint, bag_stamp_ns bigint, clock_ns bigint", "clock bigint", "append", GroupStateTimeout.NoTimeout)


def online_runs(messages: DataFrame) -> DataFrame:
    """Runs of two or more messages of a topic with one content in a row, as ``source_quality.duplicate_runs`` finds them:
    ``episode_index, topic, run_start_ns, run_end_ns, source_frames``.

    A run comes out when other content follows, or with the message of its topic that has no content, which ends the stream.
    """

    def runs(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        content, first, last, n = state.get if state.exists else (None, 0, 0, 0)
        out = []
        data = pd.concat(list(parts)).sort_values("seq")
        for at, own in zip(data["bag_stamp_ns"], data["fingerprint"], strict=True):
            if n and own == content:
                last, n = int(at), n + 1
                continue
            if n > 1:
                out.append((*key, first, last, n))
            content, first, last, n = own, int(at), int(at), int(own is not None)
        state.update((content, first, last, n))
        yield pd.DataFrame(out, columns=["episode_index", "topic", "run_start_ns", "run_end_ns", "source_frames"])

    schema = "episode_index int, topic string, run_start_ns bigint, run_end_ns bigint, source_frames bigint"
    return messages.groupBy("episode_index", "topic").applyInPandasWithState(runs, schema, "content string, first bigint, last bigint, n bigint", "append", GroupStateTimeout.NoTimeout)
