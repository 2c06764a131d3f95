"""Normal-approximation p-value as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The series is used below this argument and the continued fraction above.
_SERIES_BELOW = 1.0
_SERIES_TERMS = 30
_FRACTION_DEPTH = 300


def erfc(x: Column) -> Column:
    """Complementary error function of ``x >= 0`` to full double accuracy.

    Small arguments take the series of ``erf`` with positive terms only, large ones the continued
    fraction of ``erfc``, from its far end; both have a fixed number of steps.
    """
    x = x.cast("double")
    square = x * x

    def next_term(state: Column, k: Column) -> Column:
        term = state["term"] * 2 * square / (2 * k + 1)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    one = F.lit(1.0)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_SERIES_TERMS)),
        F.struct(one.alias("term"), one.alias("total")),
        next_term,
        lambda state: state["total"],
    )
    small = 1 - 2 / math.sqrt(math.pi) * F.exp(-square) * x * series
    fraction = F.aggregate(
        F.sequence(F.lit(_FRACTION_DEPTH), F.lit(1), F.lit(-1)), one, lambda rest, k: 1 + k / (2 * square) / rest
    )
    large = F.exp(-square) / (x * math.sqrt(math.pi) * fraction)
    return F.when(x < _SERIES_BELOW, small).when(x.isNotNull(), large)


def normal_two_sided_p(mean: Column | str, sigma: Column | str) -> Column:
    """``2 * min(P(N(mean, sigma) < 0), P(N(-mean, sigma) < 0))``; NULL for sigma = 0."""
    mean = F.col(mean) if isinstance(mean, str) else mean
    sigma = F.col(sigma) if isinstance(sigma, str) else sigma
    scaled = F.abs(mean.cast("double")) / (F.nullif(sigma.cast("double"), F.lit(0.0)) * math.sqrt(2.0))
    return F.when(sigma > 0, erfc(scaled))


def normal_upper_p(z: Column) -> Column:
    """``P(N(0, 1) > z)``."""
    tail = erfc(F.abs(z) / math.sqrt(2.0)) / 2
    return F.when(z >= 0, tail).otherwise(1 - tail)
