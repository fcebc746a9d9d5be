"""Histogram bucket bounds and quantiles of bucketed counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..errors import InvalidPipelineError

# Default bucket layouts (start, factor, count).
LAG_BUCKETS = (0.001, 2.0, 20)
BATCH_SIZE_BUCKETS = (1.0, 2.0, 12)


def exp_buckets(start: float, factor: float, count: int) -> list[float]:
    """Ascending bounds ``start * factor^i``."""
    if start <= 0 or factor <= 1 or count < 1:
        raise InvalidPipelineError("buckets need start > 0, factor > 1 and count >= 1")
    bounds = [float(start)]
    while len(bounds) < count:
        bounds.append(bounds[-1] * factor)
    return bounds


def quantile_of(counts: Column, bounds: Column, q: float) -> Column:
    """Quantile by linear interpolation inside the bucket that holds its rank.

    ``counts`` has one entry more than ``bounds``: the tail beyond the last bound. A rank
    in the tail gives the last bound, no samples give 0.
    """
    zero = F.lit(0).cast("bigint")
    total = F.aggregate(counts, zero, lambda a, c: a + c)
    target = F.lit(float(q)) * total
    # Cumulative count before and including every bucket.
    cumulative = F.transform(
        F.sequence(F.lit(1), F.size(counts)),
        lambda i: F.aggregate(F.slice(counts, 1, i), zero, lambda a, c: a + c),
    )
    index = F.array_position(
        F.zip_with(counts, cumulative, lambda c, up: (c > 0) & (up.cast("double") >= target)), True
    ).cast("int")
    count = F.try_element_at(counts, index)
    before = (F.try_element_at(cumulative, index) - count).cast("double")
    low = F.when(index > 1, F.try_element_at(bounds, index - 1)).otherwise(0.0)
    high = F.try_element_at(bounds, index)
    inside = low + (high - low) * (target - before) / count
    last = F.try_element_at(bounds, F.size(bounds))
    return F.when((total == 0) | (F.size(bounds) == 0), F.lit(0.0)).when(
        (index == 0) | (index > F.size(bounds)), last
    ).otherwise(inside)


def highest_bound(counts: Column, bounds: Column) -> Column:
    """Upper bound of the last non-empty bucket, the tail counting as the last bound."""
    used = F.filter(F.sequence(F.lit(1), F.size(counts)), lambda i: F.element_at(counts, i) > 0)
    top = F.array_max(used)
    bound = F.try_element_at(bounds, F.least(top, F.size(bounds)))
    return F.when(top.isNull(), F.lit(0.0)).otherwise(bound)
