"""Array arithmetic of signatures, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def mean(values: Column) -> Column:
    """The mean; the array is bound once, so that a computed one isn't computed twice."""
    return F.element_at(F.transform(F.array(values), lambda v: total(v) / F.size(v)), 1)


def mean_abs_difference(a: Column, b: Column) -> Column:
    """Mean absolute difference of two arrays of one length, in double precision."""
    return mean(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def mean_abs_second_difference(before: Column, now: Column, after: Column) -> Column:
    twice = F.zip_with(before, after, lambda x, y: x.cast("double") + y.cast("double"))
    return mean(F.zip_with(twice, now, lambda s, x: F.abs(s - 2.0 * x.cast("double"))))


def max_abs_difference(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def population_std(values: Column) -> Column:
    """Spread about the mean, in two passes so that large means lose no digits."""
    m = mean(values)
    return F.sqrt(mean(F.transform(values, lambda x: (x.cast("double") - m) * (x.cast("double") - m))))


def block_edges(side: int, blocks: int) -> list[int]:
    """Edges of equal parts of ``side``, cut down to whole pixels."""
    n = min(blocks, side)
    return [side * i // n for i in range(n + 1)]


def block_differences(a: Column, b: Column, side: int, blocks: int = 4) -> Column:
    """Mean absolute difference within each block of a square image, row by row of blocks."""
    edges = block_edges(side, blocks)
    spans = list(zip(edges, edges[1:], strict=False))

    def parts(difference: Column) -> Column:
        rows = lambda top, bottom, left, right: F.concat(*(F.slice(difference, row * side + left + 1, right - left) for row in range(top, bottom)))
        return F.array(*(mean(rows(*ys, *xs)) for ys in spans for xs in spans))

    difference = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    # bound by a lambda so that the difference is taken once, not once a block
    return F.element_at(F.transform(F.array(difference), parts), 1)


def axis_names(robots: Column, joints: Column) -> Column:
    """``robot.joint`` for each robot, its joints in order."""
    return F.flatten(F.transform(F.arrays_zip(robots.alias("r"), joints.alias("j")), lambda x: F.transform(x["j"], lambda j: F.concat_ws(".", x["r"], j))))


def valid_vector(values: Column, axes: int = 7) -> Column:
    """Whether a vector has the agreed length and only finite numbers."""
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(values) == axes) & finite, F.lit(False))


def unique_names(names: Column) -> Column:
    return F.size(F.array_distinct(names)) == F.size(names)
