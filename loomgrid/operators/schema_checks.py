"""Frozen schemas: topics that must exist, types that must fit, vectors that must have their length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def topic_problems(required: DataFrame, available: DataFrame) -> DataFrame:
    """``topic, problem`` for each required topic (``topic, type``) that a recording lacks or has with another type."""
    joined = required.join(available.select("topic", F.col("type").alias("found")), "topic", "left")
    problem = F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("type"), "type")
    return joined.withColumn("problem", problem).where("problem IS NOT NULL").select("topic", "problem")


def missing_topics(required: list[str], messages: DataFrame) -> DataFrame:
    """``episode_index, topic`` of required topics without a message."""
    episodes = messages.select("episode_index").distinct().select("episode_index", F.explode(F.array(*map(F.lit, required))).alias("topic"))
    return episodes.join(messages.select("episode_index", "topic").distinct(), ["episode_index", "topic"], "left_anti")


def inferred_schema(messages: DataFrame, described: list[str]) -> DataFrame:
    """What the first message of each episode and topic says of itself (columns ``described``)."""
    return messages.groupBy("episode_index", "topic").agg(*(F.min_by(c, "seq").alias(c) for c in described))


def schema_violations(schema: DataFrame, described: list[str]) -> DataFrame:
    """Rows of ``inferred_schema`` that differ from the first episode's row of their topic."""
    first = schema.groupBy("topic").agg(*(F.min_by(c, "episode_index").alias(f"first_{c}") for c in described))
    differs = [~F.col(c).eqNullSafe(F.col(f"first_{c}")) for c in described]
    any_differs: Column = differs[0]
    for d in differs[1:]:
        any_differs = any_differs | d
    return schema.join(first, "topic").where(any_differs)


def shape_violations(messages: DataFrame, frozen: DataFrame, described: list[str]) -> DataFrame:
    """Messages that differ from the frozen schema of their topic."""
    fixed = frozen.select("topic", *(F.col(c).alias(f"frozen_{c}") for c in described))
    condition = F.lit(False)
    for c in described:
        condition = condition | ~F.col(c).eqNullSafe(F.col(f"frozen_{c}"))
    return messages.join(fixed, "topic").where(condition)


def assign_tasks(inputs: DataFrame, tasks: DataFrame, default: str) -> DataFrame:
    """``path, task``: by the full path, else by its last part, else the default."""
    name = F.element_at(F.split(F.rtrim(F.col("path"), F.lit("/")), "/"), -1)
    by = lambda key: tasks.select(F.col("key").alias(f"{key}_key"), F.col("task").alias(f"{key}_task"))
    joined = inputs.withColumn("name", name)
    joined = joined.join(by("full"), F.col("path") == F.col("full_key"), "left").join(by("base"), F.col("name") == F.col("base_key"), "left")
    return joined.select("path", F.coalesce("full_task", "base_task", F.lit(default)).alias("task"))


def unknown_task_keys(inputs: DataFrame, tasks: DataFrame) -> DataFrame:
    name = F.element_at(F.split(F.rtrim(F.col("path"), F.lit("/")), "/"), -1)
    known = inputs.select(F.explode(F.array("path", name)).alias("key")).distinct()
    return tasks.select("key").join(known, "key", "left_anti")


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def nested_paths(paths: DataFrame) -> DataFrame:
    """``outer_path, inner_path``: paths that lie in (or equal) another. Each path is exploded into its parents, so
    this is an equi-join and never compares all pairs."""
    own = paths.select("path").withColumn("path", F.rtrim(F.col("path"), F.lit("/")))
    numbered = own.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    parts = F.split("path", "/")
    parents = numbered.select(F.col("path").alias("inner_path"), "n", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("path"))
    return parents.join(numbered.select("path"), "path").where("path <> inner_path OR n > 1").select(F.col("path").alias("outer_path"), "inner_path")
