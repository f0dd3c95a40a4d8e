"""Local regression over tables of any size: fits at a few vertices, blended between them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ribolith.operators.ranges import order_statistics, staged


class Curve:
    """A piecewise cubic: values and slopes at rising vertices."""

    def __init__(self, vertices: list[float], values: list[float], slopes: list[float]):
        self.vertices, self.values, self.slopes = vertices, values, slopes

    def __call__(self, x: Column) -> Column:
        """The curve at `x`, null outside the vertices: value and slope of a cell's two ends, blended by Hermite cubics."""
        v = self.vertices
        if len(v) < 2:
            return F.when(x == (v[0] if v else None), self.values[0] if v else None)
        cell = sum((F.when(x >= c, 1).otherwise(0) for c in v[1:-1]), F.lit(1))
        at = lambda row, shift=0: F.element_at(F.array(*map(F.lit, row)), (cell + shift).cast("int"))
        width = at(v, 1) - at(v)
        z = (x - at(v)) / width
        ends = at(self.values) * (1 - z) * (1 - z) * (1 + 2 * z) + at(self.values, 1) * z * z * (3 - 2 * z)
        bends = width * (at(self.slopes) * z * (1 - z) * (1 - z) - at(self.slopes, 1) * z * z * (1 - z))
        return F.when((x >= v[0]) & (x <= v[-1]), ends + bends)


def split_ranks(n: int, most: int) -> list[int]:
    """Places (from 1) after which a sorted table of `n` rows is halved, until no part has more than `most` rows."""
    out, todo = [], [(1, n)]
    while todo:
        a, z = todo.pop()
        if z - a + 1 > max(1, most):
            m = (a + z) // 2
            out.append(m)
            todo += [(a, m), (m + 1, z)]
    return sorted(out)


def local_regression(points: DataFrame, span: float = 0.75, cell: float = 0.2) -> Curve:
    """Locally weighted quadratic regression of y on x over `points` (x, y: double).

    Vertices: both ends, a little outside, and the medians at which the table is halved until a part has at most `span` * `cell` of
    its rows. At each vertex the nearest `span` of all points are fitted by least squares with tricube weights; the fit's value and slope make
    the curve. Vertices and bandwidths are exact order statistics; a fit is eight sums in one pass over the table for all vertices. What
    reaches the driver follows the vertices, about nine of them, not the rows. Rows with a null or NaN take no part.
    """
    import numpy as np

    rows = staged(points.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).dropna().where("not isnan(x) and not isnan(y)"))
    n, low, high = rows.agg(F.count("*"), F.min("x"), F.max("x")).first()
    if not n:
        return Curve([], [], [])
    margin = 0.005 * max(high - low, 1e-3 * max(abs(low), abs(high)) + 1e-30)
    ranks = split_ranks(n, math.floor(n * span * cell))
    found = iter(order_statistics(rows, [F.col("x")] * (2 * len(ranks)), [r for m in ranks for r in (m - 1, m)]))
    vertices = sorted({low - margin, high + margin, *((a + z) / 2 for a, z in zip(found, found))})
    nearest = max(1, min(n, math.floor(n * span + 1e-5)))
    reach = order_statistics(rows, [F.abs(F.col("x") - v) for v in vertices], [nearest - 1] * len(vertices))
    reach = [h * max(1.0, span) * (1 + 1e-9) + 1e-300 for h in reach]
    sums = []
    for k, (v, h) in enumerate(zip(vertices, reach)):
        u = (F.col("x") - v) / h
        w = F.when(F.abs(u) < 1, F.pow(1 - F.pow(F.abs(u), 3), 3)).otherwise(0.0)
        sums += [F.sum(w * F.pow(u, F.lit(i))).alias(f"s{k}_{i}") for i in range(5)] + [F.sum(w * F.pow(u, F.lit(i)) * F.col("y")).alias(f"t{k}_{i}") for i in range(3)]
    got = rows.agg(*sums).first()
    values, slopes = [], []
    for k, h in enumerate(reach):
        a = np.array([[got[f"s{k}_{i + j}"] for j in range(3)] for i in range(3)])
        c = np.linalg.lstsq(a, np.array([got[f"t{k}_{i}"] for i in range(3)]), rcond=1e-12)[0]
        values.append(float(c[0]))
        slopes.append(float(c[1]) / h)
    return Curve(vertices, values, slopes)
