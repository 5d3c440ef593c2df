"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` with the half nudged by a thousandth.

    Floating-point sums depend on their order in the last bits; a mean that
    sits on a half would round up in one run and down in the next.  The nudge
    sends halves up whatever those bits are, in any engine."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.501)) / F.lit(scale)


def exact_mean(c, decimals: int) -> Column:
    """Aggregate: mean of values that carry at most ``decimals`` decimals
    (prices in cents, …), computed from an exact integer sum.

    Each value is turned once into integer units (``round(x * 10^d)``), the
    units are summed as a decimal (exact, so independent of the summation order
    — i.e. of partitioning and of retries), and the mean is one division by
    the count and one by the unit.  A floating-point ``avg`` sums in task
    order; its last bits, and any rounding of a value that sits on a half,
    then differ from run to run and from engine to engine.
    """
    c = F.col(c) if isinstance(c, str) else c
    unit = float(10 ** decimals)
    units = F.round(c * F.lit(unit)).cast("decimal(28,0)")  # summed as decimal(38,0)
    return F.sum(units).cast("double") / F.count(c) / F.lit(unit)
