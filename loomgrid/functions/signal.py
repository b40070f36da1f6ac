"""The closed-form test signal."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def sampled_sine(t: Column, entity: Column, amplitudes: list[float], offsets: list[float], frequency: float) -> Column:
    """offset + amplitude * sin(2 pi f max(0, t) + 0.61 entity + 0.37 axis), an array over the axes."""
    if len(amplitudes) != len(offsets):
        raise ValueError("one amplitude and one offset for each axis")
    phase = F.lit(2.0 * math.pi * frequency) * F.greatest(F.lit(0.0), t.cast("double")) + F.lit(0.61) * entity
    return F.array(*(F.lit(float(o)) + F.lit(float(a)) * F.sin(phase + F.lit(0.37 * i)) for i, (a, o) in enumerate(zip(amplitudes, offsets, strict=True))))
