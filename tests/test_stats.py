import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from voxstar.functions import stats
from voxstar.plans import correlation

PAIRS = [(0, 3), (0, 4), (1, 5), (1, 9), (1, 6)]


def test_known_correlation(frame):
    df = frame("g string, sentiment int, tweets int", [("e", x, y) for x, y in PAIRS])
    row = correlation.point_biserial(df, ["g"]).first()
    r = np.corrcoef(*zip(*PAIRS))[0, 1]
    assert (row.n, row.correlation, row.p_value) == (5, round(r, 4), 0.1414)
    line = correlation.trend(df, ["g"]).first()
    assert (line.slope, line.intercept) == (3.1667, 3.5)


def test_degenerate_groups(frame, rows):
    df = frame("g string, sentiment int, tweets int", [
        ("constant x", 1, 1), ("constant x", 1, 2), ("constant x", 1, 5),
        ("constant y", 0, 2), ("constant y", 1, 2), ("constant y", 1, 2), ("two", 0, 1), ("two", 1, 4), ("one", 1, 1)])
    got = {r.g: (r.correlation, r.p_value) for r in correlation.point_biserial(df, ["g"]).collect()}
    assert got == {"constant x": (None, None), "constant y": (None, None), "two": (1.0, None), "one": (None, None)}
    lines = {r.g: r.slope for r in correlation.trend(df, ["g"]).collect()}
    assert lines == {"constant x": None, "constant y": 0.0, "two": 3.0, "one": None}


def test_p_value_matches_regression(spark):
    rng = np.random.default_rng(7)
    for n in (3, 4, 9, 40, 501):
        x = rng.integers(0, 2, n)
        x[:2] = (0, 1)
        y = rng.normal(size=n) + 0.4 * x
        df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(x, y)], "x int, y double")
        fit = LinearRegression(featuresCol="f", labelCol="y", solver="normal").fit(
            VectorAssembler(inputCols=["x"], outputCol="f").transform(df))
        r = float(np.corrcoef(x, y)[0, 1])
        got = spark.createDataFrame([(r, n)], "r double, n long").select(stats.correlation_p_value("r", "n")).first()[0]
        assert got == pytest.approx(fit.summary.pValues[0], abs=1e-9)


@pytest.mark.parametrize("df,t,p", [(1, 1.0, 0.5), (2, math.sqrt(2), 0.29289321881345254), (10, 2.228138852, 0.05), (1000, 1.962339081, 0.05)])
def test_beta_against_tables(df, t, p):
    x = np.array([df / (df + t * t)])
    assert stats._regularised_beta(np.array([df / 2]), np.array([0.5]), x)[0] == pytest.approx(p, abs=1e-8)


def test_extremes(spark):
    df = spark.createDataFrame([(1.0, 10), (-1.0, 10), (0.0, 10), (None, 10), (0.5, 2)], "r double, n long")
    assert [r[0] for r in df.select(stats.correlation_p_value("r", "n")).collect()] == [0.0, 0.0, 1.0, None, None]
