"""Safe division, finance, distances, weights and the t quantile, as native expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_METERS = 6371008.8
METERS_PER_MILE = 1609.34
DEGREE_METERS = 111000.0
EQUATOR_METERS = 6378137.0
FLATTENING = 1 / 298.257223563
DECAY = 4.4
SMOOTHING_METERS = 8046.7


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is null or not positive."""
    return F.when(b > 0, a / b)


def computed_or(calculated: Column, given: Column) -> Column:
    """The calculated value unless it is zero or null."""
    return F.coalesce(F.nullif(calculated, F.lit(0.0)), given)


def mortgage_payment(principal: Column, yearly_percent: float, years: int = 30) -> Column:
    """Monthly payment of an annuity loan."""
    r, n = yearly_percent / 100 / 12, years * 12
    return principal * F.lit(r * (1 + r) ** n / ((1 + r) ** n - 1))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_METERS) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return F.lit(2 * radius) * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))  # null without a coordinate


def geodesic(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Meters on the WGS 84 spheroid by Lambert's formula: within some millionths for near places, and about 10 m for far ones."""
    one, two = (F.atan(F.tan(F.radians(lat)) * (1 - FLATTENING)) for lat in (lat1, lat2))
    a = F.pow(F.sin((two - one) / 2), F.lit(2.0)) + F.cos(one) * F.cos(two) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    angle = 2 * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))
    square = lambda c: F.pow(c, F.lit(2.0))
    middle, half = (one + two) / 2, (two - one) / 2
    x = (angle - F.sin(angle)) * square(F.sin(middle) * F.cos(half) / F.cos(angle / 2))
    y = (angle + F.sin(angle)) * square(F.cos(middle) * F.sin(half) / F.nullif(F.sin(angle / 2), F.lit(0.0)))
    return EQUATOR_METERS * (angle - FLATTENING / 2 * (x + F.when(angle == 0, 0.0).otherwise(y)))


def miles(meters: Column) -> Column:
    return F.round(meters / METERS_PER_MILE, 2)


def decay_weight(meters: Column, radius: float = SMOOTHING_METERS, k: float = DECAY) -> Column:
    return F.exp(-k * meters / radius)


def gaussian_weight(distance: Column, sigma: float) -> Column:
    return F.exp(-0.5 * F.pow(distance / sigma, F.lit(2.0)))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: the mean of the values that aren't null; null without any weight."""
    return F.sum(weight * value) / F.nullif(F.sum(F.when(value.isNotNull(), weight)), F.lit(0.0))


def weighted_mean_int(value: Column, weight: Column) -> Column:
    return F.bround(weighted_mean(value, weight), 0).cast("int")


def _t_cdf(t: float, dof: int) -> float:
    """Student's t distribution function by its finite sums."""
    theta = math.atan(t / math.sqrt(dof))
    if dof == 1:
        return 0.5 + theta / math.pi
    s, c = math.sin(theta), math.cos(theta)
    if dof % 2:
        term, total = c, c
        for k in range(2, dof - 1, 2):
            term *= k / (k + 1) * c * c
            total += term
        return 0.5 + (theta + s * total) / math.pi
    term, total = 1.0, 1.0
    for k in range(1, dof - 1, 2):
        term *= k / (k + 1) * c * c
        total += term
    return 0.5 + s * total / 2


def t_quantile(p: float, dof: int) -> float:
    """By bisection on the distribution function."""
    low, high = 0.0, 1e6
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _t_cdf(middle, dof) < p else (low, middle)
    return (low + high) / 2


def t_table(p: float, most: int = 200) -> list[float]:
    return [t_quantile(p, dof) for dof in range(1, most + 1)]


def t_column(p: float, dof: Column, most: int = 200) -> Column:
    """The quantile for each row's degrees of freedom: a table, and beyond it the usual expansion around the normal."""
    low, high = 0.0, 40.0
    for _ in range(200):
        z = (low + high) / 2
        low, high = (z, high) if 0.5 * (1 + math.erf(z / math.sqrt(2))) < p else (low, z)
    terms = [(z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384]
    far = F.lit(z)
    for power, term in enumerate(terms, start=1):
        far = far + F.lit(term) / F.pow(dof.cast("double"), F.lit(float(power)))
    table = F.array(*(F.lit(x) for x in t_table(p, most)))
    return F.when(dof <= most, F.element_at(table, F.least(dof, F.lit(most)).cast("int"))).otherwise(far)


def rounded(c: Column, places: int) -> Column:
    """Halves up, also where a sum's last bits put a half just below itself."""
    scale = 10.0**places
    return F.floor(c * scale + (0.5 + 1e-6)) / scale
