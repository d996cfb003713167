"""Statistics Spark SQL lacks."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no installed package


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    out = d.copy()
    for m in range(1, 2000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + step / np.where(np.abs(c) < tiny, tiny, c)
            change = c * d
            out = out * change
        if np.all(np.abs(change - 1.0) < 1e-15):
            break
    return out


def _regularised_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    log_gamma = np.vectorize(math.lgamma, otypes=[float])
    x = np.clip(x, 0.0, 1.0)
    with np.errstate(divide="ignore"):
        front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b)
                       + a * np.log(x) + b * np.log1p(-x))
    swap = x > (a + 1.0) / (a + b + 2.0)
    low = front * _beta_fraction(a, b, np.where(swap, 0.0, x)) / a
    high = 1.0 - front * _beta_fraction(b, a, np.where(swap, 1.0 - x, 0.0)) / b
    return np.where(swap, high, low)


@pandas_udf(DoubleType())
def correlation_p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p of a correlation r over n points; null without r or with n <= 2.

    With df = n - 2, P(|T| > t) = I_x(df/2, 1/2) at x = df/(df + t^2) = 1 - r^2.
    """
    usable = r.notna() & (n > 2)
    out = pd.Series(np.nan, index=r.index, dtype="float64")
    if usable.any():
        half_df = (n[usable].to_numpy(float) - 2.0) / 2.0
        rr = np.clip(r[usable].to_numpy(float), -1.0, 1.0)
        out[usable] = _regularised_beta(half_df, np.full_like(half_df, 0.5), 1.0 - rr * rr)
    return out.astype(object).where(out.notna(), None)


def correlation(x: str, y: str) -> Column:
    """Pearson correlation aggregate, null when either side is constant."""
    x, y = F.col(x).cast("double"), F.col(y).cast("double")
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(spread > 0, F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0)))
