"""Skew-reducing power transform with a fitted exponent per column."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuriver.functions.numeric import numeric_columns

GRID_LOW, GRID_HIGH, GRID_STEPS, REFINEMENTS = -2.0, 4.0, 41, 2


def power_column(x: Column, lam: float) -> Column:
    """Yeo-Johnson transform of a column for one exponent."""
    up = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1, F.lit(lam)) - 1) / lam
    rest = 2.0 - lam
    down = -F.log1p(-x) if abs(rest) < 1e-12 else -(F.pow(1 - x, F.lit(rest)) - 1) / rest
    return F.when(x >= 0, up).when(x < 0, down)


def _power(x: np.ndarray, lam: float) -> np.ndarray:
    out = np.empty_like(x)
    pos = x >= 0
    out[pos] = np.log1p(x[pos]) if abs(lam) < 1e-12 else np.expm1(lam * np.log1p(x[pos])) / lam
    rest = 2.0 - lam
    neg = ~pos
    out[neg] = -np.log1p(-x[neg]) if abs(rest) < 1e-12 else -np.expm1(rest * np.log1p(-x[neg])) / rest
    return out


def _partial_sums(grids: Mapping[str, Sequence[float]]):
    """Per batch and column: count, sum of sign(x) ln(1+|x|), and mean / squared
    deviation of the transform for every exponent of the grid."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, grid in grids.items():
                x = batch[name].to_numpy(dtype=float)
                x = x[~np.isnan(x)]
                if not len(x):
                    continue
                slope = float(np.sum(np.sign(x) * np.log1p(np.abs(x))))
                for lam in grid:
                    y = _power(x, lam)
                    mean = float(y.mean())
                    rows.append((name, float(lam), len(x), slope, mean, float(((y - mean) ** 2).sum())))
            yield pd.DataFrame(rows, columns=["name", "lam", "n", "slope", "mean", "m2"])

    return run


def _log_likelihood(df: DataFrame, grids: Mapping[str, Sequence[float]]) -> DataFrame:
    """Rows (name, lam, llf). Tasks reduce their batches; a few rows per batch move on."""
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in grids]).mapInPandas(
        _partial_sums(grids), "name string, lam double, n long, slope double, mean double, m2 double"
    )
    n, total = F.sum("n"), F.sum(F.col("n") * F.col("mean"))
    between = F.sum(F.col("n") * F.col("mean") * F.col("mean")) - total * total / n
    variance = (F.sum("m2") + F.greatest(between, F.lit(0.0))) / n
    return parts.groupBy("name", "lam").agg(
        (-n / 2 * F.log(variance) + (F.col("lam") - 1) * F.sum("slope")).alias("llf")
    )


def fit_power(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Maximum-likelihood exponent per column.

    A grid on [-2, 4] for all columns at once. Where the best value lies at an edge, the
    grid is moved there and made twice as wide, until the best lies inside; then it is
    refined twice around it. Every round is one pass that returns one row per column. A
    column the likelihood says nothing about (constant or empty) keeps exponent 1; one
    whose likelihood rises without end keeps the last exponent whose transform is finite.
    """
    brackets = {c: (GRID_LOW, GRID_HIGH, REFINEMENTS) for c in columns}
    best: dict[str, float] = {}
    while brackets:
        grids = {c: np.linspace(low, high, GRID_STEPS).tolist() for c, (low, high, _) in brackets.items()}
        likely = _log_likelihood(df, grids).where(F.abs("llf") < math.inf)
        found = {r["name"]: r["lam"] for r in likely.groupBy("name").agg(F.max_by("lam", "llf").alias("lam")).collect()}
        for c, (low, high, left) in list(brackets.items()):
            lam = found.get(c)
            if lam is None:
                del brackets[c]
                continue
            best[c], step = lam, (high - low) / (GRID_STEPS - 1)
            if lam in (grids[c][0], grids[c][-1]):
                brackets[c] = (lam - (high - low), lam + (high - low), left)
            elif left:
                brackets[c] = (lam - step, lam + step, left - 1)
            else:
                del brackets[c]
    return {c: best.get(c, 1.0) for c in columns}


def apply_power(df: DataFrame, exponents: Mapping[str, float]) -> DataFrame:
    """Transform each column, but only where its population skew gets smaller."""
    changed = {c: power_column(F.col(c).cast("double"), lam) for c, lam in exponents.items()}
    skews = []
    for c, y in changed.items():
        skews += [F.skewness(c).alias(f"{c}_before"), F.skewness(y).alias(f"{c}_after")]
    fitted = df.agg(F.struct(*skews)).scalar()
    out = {
        c: F.when(
            F.abs(F.col("_skew")[f"{c}_before"]) > F.abs(F.col("_skew")[f"{c}_after"]), y
        ).otherwise(F.col(c).cast("double"))
        for c, y in changed.items()
    }
    return df.withColumn("_skew", fitted).withColumns(out).drop("_skew")


def reduce_skew(
    df: DataFrame, *, ignore: Sequence[str] = (), columns: Sequence[str] | None = None,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Fit and apply; fitted on all rows unless ``fit_on`` names a split."""
    columns = numeric_columns(df, ignore) if columns is None else list(columns)
    return apply_power(df, fit_power(df if fit_on is None else fit_on, columns))
