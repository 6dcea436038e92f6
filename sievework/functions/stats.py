"""Closed-form statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column, digits: int = 3) -> Column:
    """Null where the denominator is 0."""
    return F.round(F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0))), digits)


def wilson(k: Column, n: Column, z: float = 1.96, clamped: bool = True, digits: int = 3) -> tuple[Column, Column]:
    """Lower and upper end of the Wilson interval; null where n is 0."""
    n = F.nullif(n.cast("double"), F.lit(0.0))
    p = k / n
    middle, spread = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    low, high = (middle - spread) / (1 + z * z / n), (middle + spread) / (1 + z * z / n)
    if clamped:
        low, high = F.greatest(low, F.lit(0.0)), F.least(high, F.lit(1.0))
    return F.round(F.when(n.isNotNull(), low), digits), F.round(F.when(n.isNotNull(), high), digits)


def kappa(observed: Column, expected: Column, certain: float | None = None, digits: int = 3) -> Column:
    """Cohen's kappa; ``certain`` is given where the raters agree by chance for sure."""
    return F.round(F.when(expected < 1, (observed - expected) / (1 - expected)).otherwise(F.lit(certain).cast("double")), digits)
