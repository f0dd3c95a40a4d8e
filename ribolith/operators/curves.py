"""Curves over ordered rows: rolling statistics, identification curves, polynomial fits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ribolith.operators.ranges import running, staged


def rolling_extreme(scores: DataFrame, key: str = "feature_id", reads: str = "nreads", score: str = "floss", width: int = 200, block: int = 20_000) -> DataFrame:
    """Mean reads, quartiles of the score and q3 + 3 (q3 - q1) over each full window of `width` rows in the order of reads.

    Ranks come from one row for each distinct count. Rows are then cut into blocks of `block` ranks, each with the
    `width` - 1 rows before it, so that no task sees the whole order. `rank` is that of a window's last row.
    """
    scores = staged(scores.select(key, reads, score))  # read by the counts, by the cuts of their order and by the rows
    by = scores.groupBy(reads).agg(F.count("*").alias("n"))
    by = running(by, reads, {"before": F.col("n")})
    rows = scores.select(key, reads, score).join(by.drop("n"), reads)
    rows = rows.withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy(reads).orderBy(key)))
    home = F.floor((F.col("rank") - 1) / block)
    rows = rows.withColumn("home", home).withColumn("next", F.floor((F.col("rank") + width - 2) / block))
    rows = rows.withColumn("block", F.explode(F.sequence("home", "next")))
    near = Window.partitionBy("block").orderBy("rank").rowsBetween(-(width - 1), 0)
    quartile = lambda p: F.percentile(score, p).over(near)
    out = rows.select(
        "rank", "home", "block", F.count("*").over(near).alias("n"), F.avg(reads).over(near).alias("mean_reads"),
        quartile(0.25).alias("q1"), quartile(0.5).alias("median"), quartile(0.75).alias("q3"),
    )
    kept = out.where((F.col("home") == F.col("block")) & (F.col("n") == width)).withColumn("extreme", F.col("q3") + 3 * (F.col("q3") - F.col("q1")))
    return kept.select("rank", *(F.round(c, 8).alias(c) for c in ("mean_reads", "q1", "median", "q3", "extreme")))


def identification_curve(psms: DataFrame, q: str = "q", target: str = "target") -> DataFrame:
    """Targets with at most each q, and how many of them are expected to be true (W16). Running sums come from ranges of q."""
    by = psms.groupBy(q).agg(F.count_if(target).alias("n"))
    rows = running(by, q, {"before": F.col("n")}).select(q, (F.col("before") + F.col("n")).alias("targets"))
    return rows.withColumn("true_positives", F.round(F.col("targets") * (1 - F.col(q)), 6))


def set_overlap(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One row: distinct keys of `a` alone, of both, and of `b` alone (V7)."""
    tagged = a.select(*keys, F.lit(1).alias("f")).unionByName(b.select(*keys, F.lit(2).alias("f")))
    sides = tagged.groupBy(*keys).agg(F.bit_or("f").alias("sides"))
    return sides.agg(*(F.count_if(F.col("sides") == v).alias(n) for n, v in (("only_a", 1), ("overlap", 3), ("only_b", 2))))


def poly_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row c0, c1, c2, r2: least squares of log10 y on x and x squared, over rows where both are positive.

    One aggregate of sums of powers of x around its mean, then the normal equations in closed form. Under three different x
    the coefficients are null.
    """
    rows = df.where((F.col(x) > 0) & (F.col(y) > 0)).select(F.col(x).cast("double").alias("x"), F.log10(y).alias("y"))
    rows = staged(rows)  # read for the means and for the sums
    rows = rows.crossJoin(F.broadcast(rows.agg(F.avg("x").alias("mx"), F.avg("y").alias("my")))).selectExpr("x - mx u", "y - my v", "mx", "my")
    sums = rows.selectExpr("u", "v", "u * u uu", "mx", "my").agg(
        F.count("*").alias("n"), F.sum("uu").alias("s2"), F.sum(F.expr("uu * u")).alias("s3"), F.sum(F.expr("uu * uu")).alias("s4"),
        F.sum(F.expr("u * v")).alias("t1"), F.sum(F.expr("uu * v")).alias("t2"), F.sum(F.expr("v * v")).alias("vv"), F.max("mx").alias("mx"), F.max("my").alias("my"),
    )
    fit = sums.withColumn("det", F.expr("s2 * (s4 - s2 * s2 / n) - s3 * s3"))
    fit = fit.withColumn("b", F.expr("case when det > 1e-12 * s2 * s4 then (t1 * (s4 - s2 * s2 / n) - s3 * t2) / det end"))
    fit = fit.withColumn("a", F.expr("case when det > 1e-12 * s2 * s4 then (s2 * t2 - s3 * t1) / det end"))
    fit = fit.withColumn("r2", F.expr("(b * t1 + a * t2) / vv"))
    return fit.selectExpr("round(my - a * s2 / n - b * mx + a * mx * mx, 4) c0", "round(b - 2 * a * mx, 4) c1", "round(a, 4) c2", "round(r2, 4) r2")
