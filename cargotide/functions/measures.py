"""Ratios, scaling, sample weights and loss terms."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from .cleaning import as_column

# Quantity floor of the density, spike and peak-phase multipliers.
DENSITY_EPS = 1e-3
SPIKE_QUANTILE = 0.8
SPIKE_WEIGHT = 3.0
PEAK_PHASE_MULTIPLIER = 10.0
FOCAL_EPS = 1e-8


def density(cbm: str | Column, qty: str | Column, eps: float = DENSITY_EPS) -> Column:
    """C22. Volume per unit, kept within [0, 1]."""
    q = as_column(qty)
    units = F.when(q.isNull() | (q == 0), F.lit(eps)).otherwise(q)
    ratio = F.coalesce(as_column(cbm), F.lit(0.0)) / units
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio))


def scale(value: str | Column, mean: str | Column, std: str | Column) -> Column:
    """C24."""
    return (as_column(value) - as_column(mean)) / as_column(std)


def unscale(value: str | Column, mean: str | Column, std: str | Column) -> Column:
    """C24."""
    return as_column(value) * as_column(std) + as_column(mean)


def early_month_weight(day: Column, base: float) -> Column:
    """F1. Full weight on days 1-5, exponential decay to 1 on day 10, then 1."""
    rate = math.log(base) / 5.0
    return (F.when(day <= 5, F.lit(float(base)))
            .when(day <= 10, F.lit(float(base)) * F.exp(F.lit(-rate) * (day - 5)))
            .otherwise(F.lit(1.0)))


@dataclass(frozen=True)
class WeightProfile:
    """Sample-weight settings of one category; 1.0 switches a term off."""

    weekday: Mapping[int, float] = field(default_factory=dict)
    early_month_base: float | None = None
    early_month_static: float = 1.0
    golden: float | None = None
    peak_loss: float = 1.0
    august: float = 1.0
    category: Mapping[str, float] = field(default_factory=dict)


def sample_weight(y: str | Column, date: str | Column, threshold: str | Column,
                  profile: WeightProfile = WeightProfile(),
                  category: str | Column = "CATEGORY",
                  golden: str | Column | None = None,
                  peak_loss: str | Column | None = None) -> Column:
    """F1. Product of the terms of the profile, on the date of the label."""
    d = as_column(date)
    day, dow = F.dayofmonth(d), F.weekday(d)
    weight = F.when(as_column(y) > as_column(threshold), F.lit(SPIKE_WEIGHT)).otherwise(F.lit(1.0))

    def term(condition: Column, factor: float) -> Column:
        return F.when(condition, F.lit(float(factor))).otherwise(F.lit(1.0))

    for weekday, factor in profile.weekday.items():
        if factor > 1.0:
            weight = weight * term(dow == weekday, factor)
    if profile.early_month_base is not None:
        weight = weight * early_month_weight(day, profile.early_month_base)
    elif profile.early_month_static > 1.0:
        weight = weight * term(day <= 10, profile.early_month_static)
    if golden is not None and profile.golden is not None:
        weight = weight * term(as_column(golden) > 0.5, profile.golden * PEAK_PHASE_MULTIPLIER)
    if peak_loss is not None and profile.peak_loss > 1.0:
        weight = weight * term(as_column(peak_loss) > 0.5, profile.peak_loss)
    if profile.august > 1.0:
        weight = weight * term(F.month(d) == 8, profile.august)
    for name, factor in profile.category.items():
        weight = weight * term(as_column(category) == name, factor)
    return weight


def squared_error(predicted: Column, actual: Column) -> Column:
    return (predicted - actual) * (predicted - actual)


def smooth_l1(predicted: Column, actual: Column, beta: float = 1.0) -> Column:
    """Quadratic below `beta`, linear above."""
    e = F.abs(predicted - actual)
    return F.when(e < beta, F.lit(0.5) * e * e / F.lit(float(beta))).otherwise(e - F.lit(0.5 * beta))


def huber(predicted: Column, actual: Column, delta: float = 1.0) -> Column:
    """Half the square up to `delta`, then slope `delta`."""
    e = F.abs(predicted - actual)
    return (F.when(e <= delta, F.lit(0.5) * e * e)
            .otherwise(F.lit(float(delta)) * (e - F.lit(0.5 * delta))))


def pinball(predicted: Column, actual: Column, quantile: float = 0.9) -> Column:
    """Under-forecasts cost `quantile`, over-forecasts `1 - quantile` per unit."""
    e = actual - predicted
    return F.greatest(F.lit(quantile) * e, F.lit(quantile - 1.0) * e)


def asymmetric_factor(predicted: Column, actual: Column, is_peak: Column,
                      over: float = 2.0, under: float = 1.0) -> Column:
    """Penalty by the side of the error, outside peak periods only."""
    return (F.when(is_peak, F.lit(1.0)).when(predicted > actual, F.lit(float(over)))
            .otherwise(F.lit(float(under))))


def focal(predicted: Column, actual: Column, max_error: Column, alpha: float = 1.0,
          gamma: float = 2.0) -> Column:
    """Squared error weighted by its share of the largest error to the power `gamma`."""
    e = F.abs(predicted - actual)
    share = F.when(max_error > 0, e / (max_error + F.lit(FOCAL_EPS))).otherwise(e)
    return F.lit(float(alpha)) * F.pow(share + F.lit(FOCAL_EPS), F.lit(float(gamma))) * e * e
