"""Column functions of snow climatology."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gev_quantile(loc: Column, scale: Column, shape: Column, period: Column) -> Column:
    """The value that is passed once in ``period`` years; shape 0 is the Gumbel form."""
    y = -F.log(1.0 - 1.0 / period.cast("double"))
    flat = loc - scale * F.log(y)
    bent = loc + scale / shape * (1.0 - F.pow(y, shape))
    return F.when(shape == 0, flat).otherwise(bent)


def gev_density(x: Column, loc: Column, scale: Column, shape: Column) -> Column:
    """Probability density; 0 outside the support."""
    z = (x - loc) / scale
    inner = 1.0 - shape * z
    t = F.when(shape == 0, F.exp(-z)).otherwise(F.when(inner > 0, F.pow(inner, 1.0 / shape)))
    return F.coalesce(F.pow(t, 1.0 - shape) * F.exp(-t) / scale, F.lit(0.0))


def snow_year(day: Column) -> Column:
    """July 1 that begins the snow year of a day."""
    return F.make_date(
        F.year(day) - F.when(F.month(day) < 7, 1).otherwise(0), F.lit(7), F.lit(1)
    )


def block_start(day: Column, origin: str, days: int) -> Column:
    """First day of the block of ``days`` that holds a day, counted from ``origin``."""
    start = F.to_date(F.lit(origin))
    return F.date_add(start, (F.floor(F.datediff(day, start) / days) * days).cast("int"))


def lapse_rate(distance_km: Column) -> Column:
    """Snow lapse rate by distance to the coast."""
    near, far, at_near, at_far = 90.0, 240.0, 0.0923, 0.0373  # fixed values
    between = at_near + (distance_km - near) * ((at_far - at_near) / (far - near))
    return F.when(distance_km < near, at_near).when(distance_km > far, at_far).otherwise(between)
