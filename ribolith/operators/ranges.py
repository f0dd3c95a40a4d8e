"""Running sums and ranks over all rows of a table, without a window that gathers them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Least number of ranges that an order is cut into (at most eight times as many), rows that a range has at least where there are more, texts of a sample.
RANGES, ROWS, SAMPLE = 64, 200_000, 20_000


def staged(df: DataFrame) -> DataFrame:
    """`df`, computed once: in the session's checkpoint folder, which all executors share, or kept by Spark where none is set."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()


def order_statistics(df: DataFrame, columns: list[Column], ranks: list[int], bins: int = 256) -> list[float]:
    """For each column the value at its rank (from 0) in rising order, exactly; the columns are doubles without null and NaN.

    Each pass counts the values between the bounds known so far in `bins` equal parts and goes on in the part that holds the rank, until
    its least and greatest value are the same. A pass returns at most `bins` rows for each column, whatever the table's size.
    """
    if not columns:
        return []
    named = df.select(*(c.alias(f"c{i}") for i, c in enumerate(columns)))
    ends = named.agg(*(f(f"c{i}").alias(f"{k}{i}") for i in range(len(columns)) for k, f in (("a", F.min), ("z", F.max)))).first()
    low, high = ([ends[f"{k}{i}"] for i in range(len(columns))] for k in "az")
    left = list(ranks)
    while True:
        open_ = [i for i in range(len(columns)) if low[i] != high[i]]
        if not open_:
            return low
        part = lambda i: F.least(F.floor((F.col(f"c{i}") - low[i]) / (high[i] - low[i]) * bins), F.lit(bins - 1)).cast("int")
        pairs = F.array(*(F.when(F.col(f"c{i}").between(low[i], high[i]), F.struct(F.lit(i).alias("i"), part(i).alias("b"), F.col(f"c{i}").alias("x"))) for i in open_))
        rows = named.select(F.explode(pairs).alias("p")).where("p is not null").groupBy("p.i", "p.b").agg(F.count("*").alias("n"), F.min("p.x").alias("a"), F.max("p.x").alias("z")).collect()
        for i in open_:
            for r in sorted((r for r in rows if r["i"] == i), key=lambda r: r["b"]):
                if left[i] < r["n"]:
                    low[i], high[i] = r["a"], r["z"]
                    break
                left[i] -= r["n"]


def _cuts(df: DataFrame, order: str) -> list:
    """Values that cut the order into ranges of about equal size: quantiles of a number, or of a sample of at most about `SAMPLE` texts.

    The number of ranges follows the number of rows.
    """
    known = df.select(order).where(F.col(order).isNotNull())
    n = known.count()
    ranges = max(RANGES, min(8 * RANGES, n // ROWS))
    if dict(df.dtypes)[order] != "string":
        return sorted(set(known.select(F.col(order).cast("double").alias("x")).approxQuantile("x", [i / ranges for i in range(1, ranges)], 0.1 / ranges)))
    some = known.where(F.pmod(F.xxhash64(order), F.lit(1_000_000)) < 1_000_000 * min(1.0, SAMPLE / max(1, n))).distinct().limit(4 * SAMPLE)
    sample = sorted(r[0].encode() for r in some.collect())
    return [x.decode() for x in sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)})] if sample else []


def running(df: DataFrame, order: str, values: dict[str, Column], ascending: bool = True) -> DataFrame:
    """`df` with, for each name in `values`, the sum of its column over all rows before, in the order of the column `order`.

    The order is cut into ranges at quantiles, of texts at sampled whole values; a range depends on a row's own value alone, so that every reading of the input gives the
    same. Windows run inside a range, and the ranges' totals, a row for each, are added up and broadcast. Rows that share a value
    share a range: give one row for each value where values repeat often. Null orders come first.
    """
    cuts = _cuts(df, order)
    plain = df.withColumn("__x", F.col(order) if dict(df.dtypes)[order] == "string" else F.col(order).cast("double"))
    ranged = plain.withColumn("__range", F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("__x"))) if cuts else F.lit(0))
    ranged = ranged.withColumn("__range", F.coalesce(F.when(F.col("__x").isNotNull(), F.col("__range")), F.lit(-1)))
    way = F.asc if ascending else F.desc
    for name, value in values.items():
        ranged = ranged.withColumn(f"__v_{name}", value)
    totals = ranged.groupBy("__range").agg(*(F.sum(f"__v_{n}").alias(f"__t_{n}") for n in values))
    above = Window.orderBy(way("__range")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    totals = totals.select("__range", *(F.coalesce(F.sum(f"__t_{n}").over(above), F.lit(0)).alias(f"__b_{n}") for n in values))
    inside = Window.partitionBy("__range").orderBy(way(order)).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(totals), "__range")
    for n in values:
        out = out.withColumn(n, F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)) + F.col(f"__b_{n}"))
    return out.drop("__x", "__range", *(f"__{k}_{n}" for n in values for k in "vb"))
