"""The severity lattice PASS < WARN < FAIL, roll-ups and caps on findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANKS = {"PASS": 0, "WARN": 1, "FAIL": 2}


def rank(severity: Column) -> Column:
    """0, 1 or 2; null for anything else."""
    out = F.lit(None).cast("int")
    for name, number in RANKS.items():
        out = F.when(severity == name, F.lit(number)).otherwise(out)
    return out


def named(number: Column) -> Column:
    return F.element_at(F.array(*(F.lit(n) for n in RANKS)), F.coalesce(number, F.lit(0)).cast("int") + 1)


def reaches(severity: Column, threshold: str) -> Column:
    return F.coalesce(rank(severity) >= RANKS[threshold.upper()], F.lit(False))


def worst(severity: Column) -> Column:
    """An aggregate: the highest severity, PASS without rows."""
    return named(F.max(rank(severity)))


def rollup(findings: DataFrame, keys: list[str]) -> DataFrame:
    return findings.groupBy(*keys).agg(worst(F.col("severity")).alias("severity"))


def summary(findings: DataFrame, keys: list[str] | None = None, levels: tuple[str, ...] = ("WARN", "FAIL")) -> DataFrame:
    """Findings of each level, zero where there are none."""
    return findings.groupBy(*(keys or [])).agg(*(F.count_if(F.col("severity") == x).alias(f"n_{x.lower()}") for x in levels))


def capped(findings: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """The first ``most`` findings of each key in emission order, and a marker row where some were left out.

    The columns are ``keys, position, entity, kind, severity``. Roll up what this returns: a finding beyond
    the cap doesn't count towards the severity.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    placed = findings.withColumn("position", F.row_number().over(w).cast("bigint"))
    kept = placed.where(F.col("position") <= most).select(*keys, "position", "entity", "kind", "severity")
    over = placed.where(F.col("position") == most + 1)
    marker = over.select(*keys, "position", F.lit("*").alias("entity"), F.lit("findings_truncated").alias("kind"), F.lit("WARN").alias("severity"))
    return kept.unionByName(marker)
