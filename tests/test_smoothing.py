"""Order statistics, local regression and cutoffs against plain computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ribolith.operators import quality
from ribolith.operators.ranges import order_statistics
from ribolith.operators.smoothing import local_regression, split_ranks


def test_order_statistics(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, 3000), np.full(1500, 0.25), rng.exponential(1e6, 10), [-1e9]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    ranks = [0, 1, 700, 2500, len(x) - 2, len(x) - 1]
    got = order_statistics(df, [F.col("x")] * 6 + [F.abs(F.col("x") - 0.1)], [*ranks, 1000], bins=7)
    assert got == [*np.sort(x)[ranks], np.sort(np.abs(x - 0.1))[1000]]


def plain_curve(x, y, at, span=0.75):
    """Fits at the vertices and Hermite cubics between them, in numpy."""
    n, order = len(x), np.sort(x)
    margin = 0.005 * max(x.max() - x.min(), 1e-3 * max(abs(x.min()), abs(x.max())) + 1e-30)
    vertices = sorted({x.min() - margin, x.max() + margin, *((order[m - 1] + order[m]) / 2 for m in split_ranks(n, math.floor(n * span * 0.2)))})
    fits = []
    for v in vertices:
        h = np.sort(np.abs(x - v))[max(1, math.floor(n * span + 1e-5)) - 1] * (1 + 1e-9)
        w = np.sqrt(np.clip(1 - (np.abs(x - v) / h) ** 3, 0, None) ** 3)
        c = np.linalg.lstsq(np.stack([w, w * (x - v), w * (x - v) ** 2], axis=1), w * y, rcond=None)[0]
        fits.append(c[:2])
    out = []
    for a in at:
        k = max(0, min(len(vertices) - 2, int(np.searchsorted(vertices, a, side="right")) - 1))
        (f0, g0), (f1, g1), d = fits[k], fits[k + 1], vertices[k + 1] - vertices[k]
        z = (a - vertices[k]) / d
        out.append(f0 * (1 - z) ** 2 * (1 + 2 * z) + f1 * z * z * (3 - 2 * z) + d * (g0 * z * (1 - z) ** 2 - g1 * z * z * (1 - z)))
    return np.array(out)


@pytest.mark.parametrize("n", [9, 40, 1200])
def test_local_regression(spark, n):
    rng = np.random.default_rng(n)
    x = np.sort(rng.gamma(2, 0.5, n))
    y = np.sin(2 * x) + rng.normal(0, 0.1, n)
    curve = local_regression(spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (1.0, float("nan"))], "x double, y double"))
    at = np.linspace(x[0], x[-1], 101)
    got = [r["v"] for r in spark.createDataFrame([(float(a),) for a in at], "a double").select("a", curve(F.col("a")).alias("v")).orderBy("a").collect()]
    assert len(curve.vertices) < 20 and np.allclose(got, plain_curve(x, y, at), atol=1e-6)


def test_cutoffs_for_every_whole_number(spark):
    rows = [(float(n), 0.1 + 0.05 * math.log10(n) ** 2 + 0.01 * math.sin(n)) for n in range(2, 3001)]
    got = quality.floss_cutoff(spark.createDataFrame(rows, "mean_reads double, extreme double")).orderBy("nreads").collect()
    assert [r["nreads"] for r in got] == list(range(2, 3001))
    x, y = np.log10([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert np.allclose([r["cutoff"] for r in got], plain_curve(x, y, x), atol=1e-6)


def test_few_windows(spark):
    empty = spark.createDataFrame([], "mean_reads double, extreme double")
    assert quality.floss_cutoff(empty).count() == 0
    one = quality.floss_cutoff(spark.createDataFrame([(5.0, 0.3), (5.0, 0.3), (0.0, 1.0), (None, None)], "mean_reads double, extreme double")).collect()
    assert [(r["nreads"], round(r["cutoff"], 6)) for r in one] == [(5, 0.3)]
