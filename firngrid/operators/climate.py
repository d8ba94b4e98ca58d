"""Snow climatology: block sums, block maxima, extreme values."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firngrid.functions import climate as C

PERIODS = (10, 30, 100, 300)


def daily(steps: DataFrame) -> DataFrame:
    """Sum of the time steps ``cell, ts, value`` of a day."""
    return steps.groupBy("cell", F.to_date("ts").alias("day")).agg(F.sum("value").alias("acsnow"))


def block_sums(snow: DataFrame, origin: str, last_day: str, days: int = 3) -> DataFrame:
    """Sums of blocks of days from a fixed origin; a block that ends after ``last_day`` is dropped."""
    sums = snow.groupBy("cell", C.block_start(F.col("day"), origin, days).alias("start")).agg(F.sum("acsnow").alias("acsnow"))
    return sums.where(F.date_add("start", days - 1) <= F.to_date(F.lit(last_day)))


def missing_days(snow: DataFrame, first: str, last: str) -> DataFrame:
    """Days of the calendar without any row."""
    span = f"select explode(sequence(date '{first}', date '{last}')) as day"
    return snow.sparkSession.sql(span).join(snow.select("day").distinct(), "day", "left_anti")


def series(sums: DataFrame) -> DataFrame:
    """One sorted series for each cell."""
    return sums.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("start", "acsnow"))).alias("series"))


def block_maxima(values: DataFrame) -> DataFrame:
    """Maximum by cell and snow year."""
    return values.groupBy("cell", C.snow_year(F.col("day")).alias("year")).agg(F.max("v").alias("v"))


def year_blocks(starts: DataFrame) -> DataFrame:
    """First block of each year and the first of the next year. There is a row for each year only."""
    first = starts.groupBy(F.year("start").alias("year")).agg(F.min("start").alias("first"))
    return first.withColumn("end", F.lead("first").over(Window.orderBy("year")))


def moment_fit(maxima: DataFrame) -> DataFrame:
    """Gumbel and GEV parameters of each cell by probability-weighted moments, in SQL.

    A cell of zeros has zeros; fewer than three values give null.
    """
    w = Window.partitionBy("cell").orderBy("v")
    ranked = maxima.select("cell", "v", (F.row_number().over(w) - 1).alias("r"))
    n, r, v = F.count("*"), F.col("r"), F.col("v")
    b = ranked.groupBy("cell").agg(
        n.alias("n"), F.avg("v").alias("b0"), F.sum(r * v).alias("s1"), F.sum(r * (r - 1) * v).alias("s2"), F.max("v").alias("top")
    )
    pairs, none = F.col("n") * (F.col("n") - 1), F.lit(0)
    b = b.select("cell", "n", "b0", "top", (F.col("s1") / F.nullif(pairs, none)).alias("b1"),
                 (F.col("s2") / F.nullif(pairs * (F.col("n") - 2), none)).alias("b2"))
    l2 = 2 * F.col("b1") - F.col("b0")
    c = l2 / F.nullif(3 * F.col("b2") - F.col("b0"), F.lit(0.0)) - math.log(2) / math.log(3)
    shape = 7.8590 * c + 2.9554 * c * c
    gumbel = l2 / math.log(2)
    usable = F.col("n") >= 3
    zero = F.col("top") == 0
    pick = lambda x: F.when(zero, 0.0).when(usable & (l2 > 0), x)
    return b.select(
        "cell", pick(F.col("b0") - 0.5772156649015329 * gumbel).alias("gumbel_loc"), pick(gumbel).alias("gumbel_scale"), pick(shape).alias("shape"), pick(l2).alias("l2")
    )


def _log_likelihoods(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The negative log likelihood of each row of ``x`` under its ``loc, log scale, shape``."""
    loc, log_scale, shape = p.T[:, :, None]
    gumbel = np.abs(shape) < 1e-9
    shape = np.where(gumbel, 0.0, shape)
    z = (x - loc) / np.exp(log_scale)
    t = 1 - shape * z
    y = np.where(gumbel, z, -np.log(np.where(t > 0, t, 1.0)) / np.where(gumbel, 1.0, shape))
    return np.where((t > 0).all(axis=1), -np.sum(-log_scale - y * (1 - shape) - np.exp(-y), axis=1), math.inf)


def _simplexes(start: np.ndarray, x: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Downhill simplexes over the negative log likelihood, one for each row of ``x``; NaN where none is finite."""
    n = len(x)
    points = np.repeat(start[:, None, :], 4, axis=1)
    points[:, 1, 0] += 0.2 * np.exp(start[:, 1])
    points[:, 2, 1] += 0.2
    points[:, 3, 2] += 0.1
    values = np.stack([_log_likelihoods(points[:, k], x) for k in range(4)], axis=1)
    going = np.arange(n)  # rows that have not settled
    for _ in range(rounds):
        order = np.argsort(values[going], axis=1, kind="stable")
        at, v = points[going[:, None], order], values[going[:, None], order]
        points[going], values[going] = at, v
        on = ~(np.isfinite(v[:, 3]) & (v[:, 3] - np.where(np.isfinite(v[:, 0]), v[:, 0], 0.0) < 1e-9))
        going, at, v = going[on], at[on], v[on]
        if not len(going):
            break
        own, centre, worst = x[going], at[:, :3].mean(axis=1), at[:, 3].copy()
        trial = centre + (centre - worst)
        value = _log_likelihoods(trial, own)
        better = np.flatnonzero(value < v[:, 0])
        further = centre[better] + 2.0 * (centre[better] - worst[better])
        at_further = _log_likelihoods(further, own[better])
        gain = at_further < value[better]
        trial[better[gain]], value[better[gain]] = further[gain], at_further[gain]
        left = np.flatnonzero(~(value < v[:, 2]))
        nearer = centre[left] + 0.5 * (worst[left] - centre[left])
        at_nearer = _log_likelihoods(nearer, own[left])
        gain = at_nearer < v[left, 3]
        trial[left[gain]], value[left[gain]] = nearer[gain], at_nearer[gain]
        shrunk = left[~gain]
        at[:, 3], v[:, 3] = trial, value
        if len(shrunk):
            whole = np.concatenate([at[shrunk, :3], worst[shrunk, None]], axis=1)
            at[shrunk] = whole[:, :1] + 0.5 * (whole - whole[:, :1])
            v[shrunk, 1:] = np.stack([_log_likelihoods(at[shrunk, k], own[shrunk]) for k in (1, 2, 3)], axis=1)
        points[going], values[going] = at, v
    best = np.argmin(values, axis=1)
    return np.where(np.isfinite(values[np.arange(n), best])[:, None], points[np.arange(n), best], np.nan)


def likelihood_fit(maxima: DataFrame) -> DataFrame:
    """GEV parameters of each cell by maximum likelihood; zeros give zeros, a failure null.

    A cell's values are the maxima of its years, so a series is short. Series of one length
    are fitted together, by array operations over many cells at a time.
    """
    series = maxima.groupBy("cell").agg(F.sort_array(F.collect_list(F.coalesce(F.col("v").cast("double"), F.lit(math.nan)))).alias("v"))

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = np.full((len(frame), 3), np.nan)
            lengths = frame["v"].map(len).to_numpy(int)
            for n in np.unique(lengths):
                rows = np.flatnonzero(lengths == n)
                x = np.stack(frame["v"].to_numpy()[rows]).astype(float)
                found[rows[x.max(axis=1) == 0]] = 0.0
                usable = (x.max(axis=1) != 0) & (x.std(axis=1) > 0)
                if n < 3 or not usable.any():
                    continue
                rows, x = rows[usable], x[usable]
                scale = x.std(axis=1) * math.sqrt(6) / math.pi
                with np.errstate(all="ignore"):
                    p = _simplexes(np.stack([x.mean(axis=1) - 0.5772 * scale, np.log(scale), np.zeros(len(x))], axis=1), x)
                found[rows] = np.stack([p[:, 0], np.exp(p[:, 1]), p[:, 2]], axis=1)
            columns = np.where(np.isnan(found), None, found).T
            yield pd.DataFrame({"cell": frame["cell"], "loc": columns[0], "scale": columns[1], "shape": columns[2]})

    return series.mapInPandas(fit, "cell long, loc double, scale double, shape double")


@lru_cache
def order_weights(n: int) -> tuple[tuple[float, float], ...]:
    """Weights of the sorted values for Gumbel location and scale, by generalised least squares.

    They follow from the means and covariances of the order statistics of ``n`` values. The
    k-th smallest of n uniform values is a beta variable, and a smaller one is a share of it
    that is an independent beta variable; both integrals are taken on doubly exponential nodes.
    """
    x = np.linspace(-3.6, 3.6, 181)
    s = math.pi * np.sinh(x)
    low, high = -np.logaddexp(0, -s), -np.logaddexp(0, s)
    step = (x[1] - x[0]) * math.pi * np.cosh(x)

    def beta(a: int, b: int) -> np.ndarray:
        return step * np.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * low + b * high)

    value = -np.log(-low)
    both = value[:, None] * -np.log(-(low[:, None] + low[None, :]))
    own = [beta(k, n - k + 1) for k in range(1, n + 1)]
    mean = np.array([w @ value for w in own])
    second = np.diag([w @ value**2 for w in own])
    for k in range(2, n + 1):
        of_largest = own[k - 1] @ both
        for i in range(1, k):
            second[i - 1, k - 1] = second[k - 1, i - 1] = of_largest @ beta(i, k - i)
    design = np.column_stack([np.ones(n), mean])
    weighted = np.linalg.solve(second - np.outer(mean, mean), design)
    found = np.linalg.solve(design.T @ weighted, weighted.T)
    return tuple((float(a), float(b)) for a, b in found.T)


def order_fit(maxima: DataFrame) -> DataFrame:
    """Gumbel parameters of each cell as the best linear sums of its sorted values (Lieblein).

    A cell of zeros has zeros; fewer than two values, or equal ones, give null; null values
    are left out. There is a weight for each year of each length of series, so this side is small.
    """
    w = Window.partitionBy("cell")
    ranked = maxima.where("v is not null").select(
        "cell", "v", F.row_number().over(w.orderBy("v")).alias("r"), F.count("*").over(w).alias("n")
    )
    lengths = [r.n for r in ranked.select("n").where("n > 1").distinct().collect()]
    rows = [(n, k, a, b) for n in lengths for k, (a, b) in enumerate(order_weights(n), 1)]
    weights = maxima.sparkSession.createDataFrame(rows, "n long, r int, a double, b double")
    sums = ranked.join(F.broadcast(weights), ["n", "r"], "left").groupBy("cell").agg(
        F.sum(F.col("a") * F.col("v")).alias("loc"), F.sum(F.col("b") * F.col("v")).alias("scale"),
        F.max("v").alias("top"), F.min("v").alias("least"),
    )
    pick = lambda x: F.when(F.col("top") == 0, 0.0).when(F.col("top") > F.col("least"), x)
    return sums.select("cell", *[pick(x).alias(c) for c, x in (("loc", F.col("loc")), ("scale", F.col("scale")), ("shape", F.lit(0.0)))])


def return_levels(params: DataFrame, periods: tuple[int, ...] = PERIODS) -> DataFrame:
    """``cell, period, level`` from ``cell, loc, scale, shape``."""
    each = params.withColumn("period", F.explode(F.array(*[F.lit(p) for p in periods])))
    level = C.gev_quantile(F.col("loc"), F.col("scale"), F.col("shape"), F.col("period"))
    return each.select("cell", "period", level.alias("level"))
