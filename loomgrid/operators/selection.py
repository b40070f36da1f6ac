"""Choosing and removing episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgrid.operators.severity import reaches


def selected_episodes(*parts: DataFrame) -> DataFrame:
    """The distinct ``episode_index`` of several selections."""
    out = parts[0].select("episode_index")
    for part in parts[1:]:
        out = out.union(part.select("episode_index"))
    return out.distinct()


def out_of_bounds(selection: DataFrame, total: int) -> DataFrame:
    return selection.where((F.col("episode_index") < 0) | (F.col("episode_index") >= total))


def renumbered(episodes: DataFrame, span: int = 100_000) -> DataFrame:
    """``episode_index, new_index``: survivors numbered from 0 in order.

    Indices are numbered within spans of ``span`` of them; what comes before a span is a sum over one row a span.
    """
    each = episodes.select("episode_index").distinct().withColumn("span", F.floor(F.col("episode_index") / span))
    counts = each.groupBy("span").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("span").orderBy("episode_index")) - 1
    numbered = each.withColumn("place", place).join(counts.select("span", before.alias("before")), "span")
    return numbered.select("episode_index", (F.col("before") + F.col("place")).cast("int").alias("new_index"))


def without_episodes(rows: DataFrame, selection: DataFrame, renumber: bool = True) -> DataFrame:
    """Rows of the episodes that aren't selected, episodes renumbered from 0 without holes."""
    kept = rows.join(selection.select("episode_index").distinct(), "episode_index", "left_anti")
    if not renumber:
        return kept
    numbers = renumbered(kept)
    return kept.join(numbers, "episode_index").drop("episode_index").withColumnRenamed("new_index", "episode_index").select(*rows.columns)


def remove_failed(rows: DataFrame, selection: DataFrame, total: int, dry_run: bool = False, states: DataFrame | None = None) -> tuple[str, DataFrame, DataFrame]:
    """``(status, rows, episodes)``: no_change, dry_run or filtered, and the distinct episodes selected.

    Refuses indices out of range, a selection of all, and reports with a problem (``states`` of ``reports.report_states``). Only
    counts and bounds come to the driver.
    """
    if states is not None and (bad := states.where("problem IS NOT NULL").orderBy("report_id").first()):
        raise ValueError(f"report {bad['report_id']}: {bad['problem']} {'; '.join(bad['blockers'])}".rstrip())
    chosen = selected_episodes(selection)
    n, low, high = chosen.agg(F.count(F.lit(1)), F.min("episode_index"), F.max("episode_index")).first()
    if n and (low < 0 or high >= total):
        raise ValueError(f"episodes out of range: from {low} to {high}, of {total}")
    if not n:
        return "no_change", rows, chosen
    if n == total:
        raise ValueError("all episodes are selected")
    if dry_run:
        return "dry_run", rows, chosen
    return "filtered", without_episodes(rows, chosen), chosen


def policy_outcome(episodes: DataFrame, findings: DataFrame, policy: str, drop_on: str) -> DataFrame:
    """``episode_index, severity, status, dataset_episode_index`` under an input policy.

    off: no validation, severity NOT_RUN; warn: all are kept; drop: episodes at or above ``drop_on`` are
    rejected; fail: episodes that aren't PASS are marked ``abort`` (see ``enforce``).
    """
    if policy not in ("off", "warn", "fail", "drop"):
        raise ValueError(f"unknown policy {policy!r}")
    worst = findings.groupBy("episode_index").agg(F.max(F.when(F.col("severity") == "FAIL", 2).when(F.col("severity") == "WARN", 1).otherwise(0)).alias("rank"))
    rated = episodes.select("episode_index").distinct().join(worst, "episode_index", "left")
    severity = F.element_at(F.array(F.lit("PASS"), F.lit("WARN"), F.lit("FAIL")), F.coalesce("rank", F.lit(0)) + 1)
    rated = rated.select("episode_index", (F.lit("NOT_RUN") if policy == "off" else severity).alias("severity"))
    status = F.lit("converted")
    if policy == "drop":
        status = F.when(reaches(F.col("severity"), drop_on), "rejected").otherwise("converted")
    if policy == "fail":
        status = F.when(F.col("severity") != "PASS", "abort").otherwise("converted")
    rated = rated.withColumn("status", status)
    numbers = renumbered(rated.where("status = 'converted'"))
    return rated.join(numbers, "episode_index", "left").withColumnRenamed("new_index", "dataset_episode_index")


def enforce(outcome: DataFrame) -> None:
    """Raise for the first episode that aborts, or if none survives."""
    first = outcome.where("status = 'abort'").agg(F.min("episode_index")).first()[0]
    if first is not None:
        raise ValueError(f"episode {first} failed input validation")
    if outcome.where("status = 'converted'").isEmpty():
        raise ValueError("no episode survives input validation")
