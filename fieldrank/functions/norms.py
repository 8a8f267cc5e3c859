"""Scaling of a metric to 0..100 within its snapshot.

``lo`` and ``hi`` are the bounds of the metric in the row's snapshot. A
snapshot where the metric does not vary (or has no value) cannot tell its
entities apart: every row gets ``FLAT``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the score of a metric that does not vary.
FLAT = 50.0


def _flat(lo: Column, hi: Column) -> Column:
    return lo.isNull() | hi.isNull() | (lo == hi)


def _share(x: Column, lo: Column, hi: Column) -> Column:
    return (x - lo) / F.nullif(hi - lo, F.lit(0.0))


def min_max(x: Column, lo: Column, hi: Column) -> Column:
    """Lowest value 0, highest 100."""
    return F.when(_flat(lo, hi), F.lit(FLAT)).otherwise(_share(x, lo, hi) * 100.0)


def inverse_min_max(x: Column, lo: Column, hi: Column) -> Column:
    """Lowest value 100, highest 0: for metrics where less is better."""
    return F.when(_flat(lo, hi), F.lit(FLAT)).otherwise((F.lit(1.0) - _share(x, lo, hi)) * 100.0)


def inverse_log_min_max(x: Column, lo: Column, hi: Column) -> Column:
    """:func:`inverse_min_max` on the logarithm of a positive metric."""
    return inverse_min_max(F.ln(x), F.ln(lo), F.ln(hi))


def clipped_z(x: Column, mean: Column, deviation: Column, clip: float) -> Column:
    """Standard score cut at ``-clip..clip``; 0 where the metric does not vary."""
    z = (x - mean) / F.nullif(deviation, F.lit(0.0))
    cut = F.greatest(F.lit(-clip), F.least(F.lit(clip), z))
    return F.when(deviation.isNull() | (deviation == 0.0), F.lit(0.0)).otherwise(
        F.when(x.isNotNull(), cut)
    )


def z_to_scale(z: Column, clip: float) -> Column:
    """A clipped standard score on the 0..100 scale."""
    return (z + F.lit(clip)) / F.lit(2.0 * clip) * 100.0


def weighted_sum(parts: list[tuple[Column, float]]) -> Column:
    total = None
    for column, weight in parts:
        term = column * F.lit(float(weight))
        total = term if total is None else total + term
    return total
